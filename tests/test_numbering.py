import pytest
from pyspark.sql import functions as F

from wardlake import session
from wardlake.operators import numbering
from wardlake.operators.numbering import count_batches, number_records, recent
from wardlake.sources.messages import to_messages


def numbers(df, order, **options):
    return number_records(df, order, "n", **options).orderBy("n").collect()


@pytest.mark.parametrize("range_rows", [20, 1 << 24])
def test_dense_numbers_however_many_ranges(spark, range_rows):
    ids = [3 * i + (i % 2) for i in range(500)]
    df = spark.createDataFrame([(i,) for i in ids], "id bigint").repartition(6)
    got = numbers(df, "id", range_rows=range_rows)
    assert [(r.id, r.n) for r in got] == list(zip(ids, range(500)))


def test_negative_and_widely_spread_ids(spark):
    ids = sorted({-(2**63), 2**63 - 1, 2**53, 2**53 + 1, *range(-25, 26, 5), *(2**k for k in range(60))})
    df = spark.createDataFrame([(i,) for i in ids], "id bigint").repartition(4)
    assert [(r.id, r.n) for r in numbers(df, "id")] == list(zip(ids, range(len(ids))))


def test_composite_text_and_descending_keys(spark):
    rows = [(p, o, f"t{o % 7}") for p in range(3) for o in range(100)]
    df = spark.createDataFrame(rows, "partition int, offset bigint, t string").repartition(5)
    assert [(r.partition, r.offset) for r in numbers(df, ["partition", "offset"])] == sorted(r[:2] for r in rows)
    got = numbers(df, [F.desc("t"), "offset", "partition"])
    assert [(r.t, r.offset, r.partition) for r in got] == sorted(
        ((t, o, p) for p, o, t in rows), key=lambda r: (-int(r[0][1:]), r[1], r[2])
    )


def test_ties_get_numbers_of_their_own(spark):
    """A key that most rows share is cut into several ranges; rows that are equal throughout count too."""
    rows = [("hot", i % 400) for i in range(900)] + [(None, 0), (None, 0), ("a", 1), ("z", 1)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(4)
    got = numbers(df, "k", range_rows=60)
    assert [r.n for r in got] == list(range(904))
    assert [r.k for r in got] == [None, None, "a", *["hot"] * 900, "z"]
    assert sorted((r.k or "", r.v) for r in got) == sorted((k or "", v) for k, v in rows)


def test_no_range_is_over_the_bound(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(numbering, "stored", lambda df, label: kept.append((label, session.stored(df, label))) or kept[-1][1])
    df = spark.range(3000).select((F.col("id") % 5).alias("k"), F.lit("x").alias("v"))
    assert [r.n for r in numbers(df, "k", range_rows=100)] == list(range(3000))
    sizes = [r.rows for r in [f for label, f in kept if label == "range-sizes"][-1].collect()]
    assert sum(sizes) == 3000 and max(sizes) <= 100


def test_numbering_does_not_depend_on_the_input_partitions(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"), F.col("id").alias("v"))
    one, other = (sorted(numbers(df.repartition(n, "v"), "k")) for n in (2, 7))
    assert one == other


def test_columns_and_maps_survive(spark):
    df = spark.range(20).select("id", F.lit(1).alias("content"), F.lit(2).alias("RANGE"), F.create_map(F.lit("a"), "id").alias("m"))
    got = number_records(df, "id")
    assert got.columns == ["id", "content", "RANGE", "m", "record_no"]
    assert [(r.record_no, r.m["a"], r.content) for r in got.orderBy("id").collect()] == [(i, i, 1) for i in range(20)]
    assert number_records(df.limit(0), "id").collect() == []


def test_batch_sizes_add_up(spark):
    df = spark.range(1234)
    batches = count_batches(df, "id", 100).orderBy("batch_no").collect()
    assert [b.record_count for b in batches] == [100] * 12 + [34]
    assert [b.first_id for b in batches] == [100 * i for i in range(13)]


def test_batches_of_composite_keys(spark):
    df = spark.range(250).select((F.col("id") % 2).alias("p"), "id")
    batches = count_batches(df, ["p", "id"], 100).orderBy("batch_no").collect()
    assert [(b.record_count, tuple(b.first_id)) for b in batches] == [(100, (0, 0)), (100, (0, 200)), (50, (1, 151))]


def test_messages_keep_nulls(spark):
    df = spark.createDataFrame([(5, None), (2, "x")], "record_id bigint, race string")
    got = to_messages(df).orderBy("key").collect()
    assert [tuple(r) for r in got] == [
        ("record_0", '{"record_id":2,"race":"x"}'),
        ("record_1", '{"record_id":5,"race":null}'),
    ]


def test_recent_is_newest_first(spark):
    df = spark.range(200).withColumn("ts", F.col("id") % 10)
    got = recent(df, "ts", "id", 3).collect()
    assert [r.id for r in got] == [199, 189, 179]


def test_a_record_without_an_id_is_refused(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "id bigint")
    with pytest.raises(Exception, match="has no id"):
        number_records(df, "id", required=True).collect()
    assert [r.id for r in numbers(df, "id")] == [None, 1, 3]
