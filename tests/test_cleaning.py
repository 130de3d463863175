import datetime as dt

import pytest
from pyspark.sql import functions as F

from wardlake.functions.cleaning import clean_numeric, normalised_name
from wardlake.functions.reporting import freshness, guarded_rate, health, rank_of
from wardlake.operators import rows


@pytest.mark.parametrize(
    "text, number",
    [
        ("$1,234.50", 1234.5),
        ("120 +", 120.0),
        ("NULL", None),
        ("", None),
        (None, None),
        ("1.2.3", None),
        ("-5.5", 5.5),
    ],
)
def test_clean_numeric(spark, text, number):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(clean_numeric(F.col("t"))).first()[0] == number


def test_numeric_targets_are_not_routed_through_text(spark):
    df = spark.createDataFrame([(12345678.9, "12 +"), (-5.5, "x")], "total_costs double, length_of_stay string")
    got = rows.clean_targets(df).select("total_costs_numeric", "length_of_stay_numeric").collect()
    assert [tuple(r) for r in got] == [(12345678.9, 12.0), (-5.5, None)]


def test_normalised_names():
    assert normalised_name("Hospital County") == "hospital_county"
    assert normalised_name("Age-Group") == "age_group"
    assert normalised_name("Total.Charges ($)") == "total_charges_"


def test_colliding_names_are_refused(spark):
    with pytest.raises(ValueError, match="collide"):
        rows.normalise_columns(spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int"))


def test_unknown_covers_numbers_too(spark):
    df = spark.createDataFrame([(None, 1), ("x", None)], "a string, b int")
    assert [tuple(r) for r in rows.fill_unknown(df, ["a", "b"]).collect()] == [
        ("Unknown", "1"),
        ("x", "Unknown"),
    ]


def test_valid_target_drops_null_zero_and_negative(spark):
    df = spark.createDataFrame([(None,), (0.0,), (-1.0,), (2.0,)], "t double")
    assert rows.valid_target(df, "t").collect() == [(2.0,)]


def test_sanitise(spark):
    df = spark.createDataFrame(
        [(float("nan"), 1), (float("inf"), 2), (float("-inf"), 3), (1.5, 4), (None, 5)], "v double, n int"
    )
    assert [r.v for r in rows.sanitise(df).orderBy("n").collect()] == [None, None, None, 1.5, None]


def test_clean_rows_keeps_whole_numbers(spark):
    df = spark.createDataFrame([(float("nan"), 3)], "v float, n int")
    cleaned = rows.clean_rows(df)
    assert cleaned.dtypes == [("v", "double"), ("n", "int")]
    assert tuple(cleaned.first()) == (None, 3)


def test_status_texts(spark):
    df = spark.createDataFrame([(None, 0), (29.9, 4), (30.0, 5)], "age double, errors int")
    got = df.select(freshness(F.col("age")), health(F.col("errors"))).collect()
    assert [tuple(r) for r in got] == [
        ("None", "healthy"),
        ("Active", "degraded"),
        ("30s ago", "failing"),
    ]


def test_rate_is_guarded(spark):
    df = spark.createDataFrame([(10, 0.0), (10, 3.0)], "n int, s double")
    assert [r[0] for r in df.select(guarded_rate(F.col("n"), F.col("s"))).collect()] == [0.0, 3.33]


def test_rank_puts_strangers_last(spark):
    df = spark.createDataFrame([("b",), ("a",), ("z",), (None,)], "c string")
    assert [r[0] for r in df.select(rank_of(F.col("c"), ["a", "b"])).collect()] == [2, 1, 3, 3]


def test_filters(spark):
    day = dt.datetime(2024, 5, 1)
    df = spark.createDataFrame([(1, day, "abc"), (5, day - dt.timedelta(days=1), "xbz")], "n int, ts timestamp, t string")
    assert rows.filter_gt(df, "n", 1).count() == 1
    assert rows.filter_since(df, "ts", day.date()).count() == 1
    assert rows.filter_like(df, "t", "b").count() == 2


def test_holdout_is_disjoint_complete_and_independent_of_layout(spark):
    df = spark.range(5000).withColumnRenamed("id", "record_id")
    training, testing = rows.split_holdout(df)
    assert training.count() + testing.count() == 5000
    assert training.join(testing, "record_id").count() == 0
    assert 400 < testing.count() < 600
    moved = rows.split_holdout(df.repartition(13))[1]
    assert sorted(testing.collect()) == sorted(moved.collect())


def test_sampling_is_off_by_default_and_near_the_wish(spark):
    df = spark.range(20000).withColumnRenamed("id", "record_id")
    assert rows.cap_training_rows(df) is df
    assert 4500 < rows.cap_training_rows(df, 5000).count() < 5500
    assert rows.cap_training_rows(df, 50000).count() == 20000
