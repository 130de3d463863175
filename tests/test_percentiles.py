"""Exact percentiles against brute force, on uneven groups and awkward values."""

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardlake import session
from wardlake.operators import percentiles
from wardlake.operators.percentiles import with_exact_percentiles


def brute(values, q):
    return float(np.percentile(np.array(values, dtype=float), q * 100))


@pytest.fixture(scope="module")
def uneven():
    rng = random.Random(7)
    groups = {
        "hot": [round(rng.lognormvariate(8, 2), 2) for _ in range(4000)],
        "one": [3.25],
        "two": [1.0, 2.0],
        "ties": [5.0] * 700 + [6.0] * 700,
        "signs": [rng.uniform(-1e6, 1e6) for _ in range(301)] + [0.0, -0.0, 1e-12, -1e-12],
        None: [10.0, 20.0, 30.0, 40.0],
    }
    return groups


@pytest.mark.parametrize("bounded", [True, False])
def test_matches_brute_force(spark, uneven, bounded):
    rows = spark.createDataFrame(
        [(g, v) for g, values in uneven.items() for v in values] + [("hot", None)], "g string, v double"
    ).repartition(5)
    report = rows.groupBy("g").agg(F.count("v").alias("n"), F.avg("v").alias("mean"))
    wanted = {"p0": 0.0, "p25": 0.25, "median": 0.5, "p99": 0.99, "p100": 1.0}
    got = {r.g: r for r in with_exact_percentiles(report, rows, ["g"], "v", wanted, bounded).collect()}
    assert set(got) == set(uneven)
    for g, values in uneven.items():
        assert got[g].n == len(values)
        for name, q in wanted.items():
            assert got[g][name] == pytest.approx(brute(values, q), rel=1e-12, abs=1e-12), (g, name)


def test_two_keys_and_a_subset_of_groups(spark):
    rows = spark.createDataFrame(
        [(a, b, float(a * 10 + b + i)) for a in range(3) for b in range(3) for i in range(a + b + 1)],
        "a int, b int, v double",
    )
    report = rows.groupBy("a", "b").agg(F.count("*").alias("n")).filter("a > 0")
    got = with_exact_percentiles(report, rows, ["a", "b"], "v", {"median": 0.5}).collect()
    assert len(got) == 6
    for r in got:
        assert r["median"] == statistics.median(r.a * 10 + r.b + i for i in range(r.a + r.b + 1))


def test_agrees_with_the_built_in_on_given_data(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    report = rows.groupBy("l_returnflag").agg(F.count("*").alias("n"))
    got = with_exact_percentiles(
        report, rows, ["l_returnflag"], "l_extendedprice", {"p50": 0.5, "p90": 0.9}
    )
    expected = rows.groupBy("l_returnflag").agg(
        F.percentile("l_extendedprice", 0.5).alias("p50"),
        F.percentile("l_extendedprice", 0.9).alias("p90"),
    )
    left = {r.l_returnflag: (r.p50, r.p90) for r in got.collect()}
    right = {r.l_returnflag: (r.p50, r.p90) for r in expected.collect()}
    assert left.keys() == right.keys()
    for k in left:
        assert left[k] == pytest.approx(right[k], rel=1e-12)


@pytest.mark.parametrize("most", [1, 50, 1 << 16])
def test_crowded_buckets_are_cut_again(spark, most, monkeypatch):
    """Distinct values within one magnitude bucket, next doubles, ties and both signs."""
    rng = random.Random(11)
    step = float(np.spacing(1e6))
    groups = {
        "close": [1e6 + i * 1e-4 for i in rng.sample(range(10**6), 3000)],
        "next": [1e6 + step * i for i in range(500)],
        "ties": [7.0] * 3000 + [7.0001] * 3001,
        "ends": [1e6] * 400 + [1e6 + step * i for i in range(200)] + [1e6 + 2000] * 400,
        "below": [-1e6 - i * 1e-4 for i in rng.sample(range(10**6), 2000)],
        "one": [3.5],
        None: [1e-300 * (1 + i * 1e-6) for i in range(700)],
    }
    passes = []
    monkeypatch.setattr(percentiles, "stored", lambda df, label: passes.append(label) or session.stored(df, label))
    rows = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v double").repartition(4)
    report = rows.groupBy("g").agg(F.count("v").alias("n"))
    wanted = {"p0": 0.0, "p10": 0.1, "median": 0.5, "p99": 0.99, "p100": 1.0}
    got = {r.g: r for r in with_exact_percentiles(report, rows, ["g"], "v", wanted, most=most).collect()}
    for g, values in groups.items():
        for name, q in wanted.items():
            assert got[g][name] == pytest.approx(brute(values, q), rel=1e-14, abs=0), (g, name)
    assert len(passes) <= 4
    assert len(passes) > 1 or most == 1 << 16


def test_a_last_pass_has_few_rows(spark, monkeypatch):
    held = []
    monkeypatch.setattr(percentiles, "stored", lambda df, label: held.append(session.stored(df, label)) or held[-1])
    rows = spark.range(40_000).select((F.lit(1e6) + F.col("id") / 1e3).alias("v"), F.lit("all").alias("g"))
    report = rows.groupBy("g").agg(F.count("*").alias("n"))
    row = with_exact_percentiles(report, rows, ["g"], "v", {"median": 0.5}, most=100).first()
    assert row["median"] == pytest.approx(brute([1e6 + i / 1e3 for i in range(40_000)], 0.5), rel=1e-14)
    assert held[0].agg(F.max("_n")).first()[0] > 100
    assert held[-1].agg(F.max("_n")).first()[0] <= 100
