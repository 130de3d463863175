import pytest

from wardlake.operators import query
from wardlake.schema import RAW_SCHEMA
from wardlake.sources import lake

SCHEMA = "record_id bigint, hospital_county string, total_charges string"


def relation(spark, n=5):
    return spark.createDataFrame([(i, f"C{i % 2}", f"${i}.50") for i in range(n)], SCHEMA)


def write_json_array(spark, path, texts):
    """One file holding one pretty-printed array."""
    body = "[\n  " + ",\n  ".join(texts) + "\n]"
    spark.createDataFrame([(body,)], "value string").coalesce(1).write.text(path)


@pytest.mark.parametrize(
    "path, fmt, expected",
    [
        ("a/b.parquet", "auto", "parquet"),
        ("a/B.CSV", "auto", "csv"),
        ("a/b.json", "auto", "json"),
        ("a/b.dat", "auto", "csv"),
        ("a/b.parquet", "csv", "csv"),
    ],
)
def test_format_from_suffix(path, fmt, expected):
    assert lake.file_format(path, fmt) == expected


def test_csv_columns_go_by_header(spark, folder):
    relation(spark).select("total_charges", "record_id", "hospital_county").write.option(
        "header", True
    ).csv(folder)
    got = lake.read_lake(spark, folder, "csv", relation(spark).schema).orderBy("record_id")
    assert got.collect() == relation(spark).orderBy("record_id").collect()


def test_csv_quotes_survive(spark, folder):
    df = spark.createDataFrame([(1, 'a "b", c', None), (2, "x\\y", "1")], SCHEMA)
    lake.export_csv(df, folder)
    assert lake.read_lake(spark, folder, "csv", df.schema).orderBy("record_id").collect() == df.collect()


def test_differing_csv_headers_are_refused(spark, folder):
    df = relation(spark).coalesce(1)
    df.write.option("header", True).csv(folder)
    df.select("total_charges", "record_id", "hospital_county").write.mode("append").option(
        "header", True
    ).csv(folder)
    with pytest.raises(Exception, match="(?i)header"):
        lake.read_lake(spark, folder, "csv", df.schema).collect()
    with pytest.raises(Exception, match="(?i)header"):
        lake.read_lake(spark, folder, "csv", df.schema).select("record_id").collect()


def test_missing_csv_columns_are_null(spark, folder):
    relation(spark).drop("total_charges").write.option("header", True).csv(folder)
    got = lake.read_lake(spark, folder, "csv", RAW_SCHEMA)
    assert got.filter("total_charges IS NULL AND record_id IS NOT NULL").count() == 5


def test_path_is_percent_decoded(spark, folder):
    relation(spark).write.parquet(f"{folder}/my data")
    assert lake.read_lake(spark, f"{folder}/my%20data", "parquet").count() == 5


def test_json_array_and_single_object(spark, folder):
    write_json_array(spark, f"{folder}/a", ['{"record_id": 1}', '{"record_id": 2}'])
    spark.createDataFrame([('{\n"record_id": 3\n}',)], "value string").coalesce(1).write.text(f"{folder}/b")
    got = lake.read_lake(spark, [f"{folder}/a", f"{folder}/b"], "json", relation(spark).schema, True)
    assert sorted(r.record_id for r in got.collect()) == [1, 2, 3]


def test_load_prefers_json_and_skips_manifests(spark, folder):
    relation(spark, 4).write.json(f"{folder}/raw/year=2024/month=06")
    relation(spark, 9).write.option("header", True).csv(f"{folder}/raw/csv")
    spark.createDataFrame([("b", 4)], "batch_id string, record_count int").write.json(
        f"{folder}/raw/manifest/x"
    )
    assert lake.load_raw(spark, folder, relation(spark).schema).count() == 4


def test_load_falls_back_to_csv_then_fails(spark, folder):
    relation(spark, 9).write.option("header", True).csv(f"{folder}/csv")
    assert lake.load_raw(spark, folder, relation(spark).schema).count() == 9
    relation(spark).write.parquet(f"{folder}-other")
    with pytest.raises(FileNotFoundError):
        lake.load_raw(spark, f"{folder}-other")


def test_union_by_name(spark):
    a = relation(spark, 2)
    b = relation(spark, 3).select("hospital_county", "record_id")
    got = lake.union_files([a, b])
    assert got.columns == a.columns and got.count() == 5
    assert got.filter("total_charges IS NULL").count() == 3


def test_main_file_is_the_largest_csv(spark, folder):
    for n in (3, 50, 7):
        relation(spark, n).coalesce(1).write.option("header", True).csv(f"{folder}/{n}")
    relation(spark, 500).coalesce(1).write.json(f"{folder}/json")
    assert "/50/" in lake.pick_main_file(spark, folder).first()["path"]


def test_gate_and_inventory(spark, folder):
    relation(spark).coalesce(1).write.json(f"{folder}/raw/a")
    relation(spark).coalesce(1).write.option("header", True).csv(f"{folder}/raw/b")
    spark.createDataFrame([(1,)], "x int").coalesce(1).write.json(f"{folder}/raw/manifest/m")
    assert not lake.has_enough_data(spark, folder, 3)
    assert lake.has_enough_data(spark, folder, 2)
    spark.createDataFrame([("",)], "t string").coalesce(1).write.text(f"{folder}/processed")
    inventory = [tuple(r)[:3] for r in lake.lake_inventory(spark, folder).filter("bytes > 0").collect()]
    assert inventory == [("processed", "txt", 1), ("raw", "csv", 1), ("raw", "json", 2)]


def test_no_limit_unless_named(spark):
    df = spark.range(52000).withColumnRenamed("id", "limit_id")
    assert query.query_frame(df).count() == 52000
    assert query.query_frame(df, "SELECT limit_id FROM {table};").count() == 52000
    assert query.query_frame(df, "SELECT * FROM (SELECT * FROM {table} LIMIT 11000) x").count() == 11000
    assert query.query_frame(df, "SELECT * FROM {table}", 51000).count() == 51000
    assert query.query_frame(df, "SELECT * FROM {table} LIMIT 51000").count() == 51000
    assert query.query_frame(df, "SELECT * FROM {table} limit 2500 OFFSET 3 ;").count() == 2500
    assert query.query_frame(df, limit=7).count() == 7


def test_compressed_files_are_loaded(spark, folder):
    relation(spark, 5).write.json(f"{folder}/raw/plain")
    relation(spark, 7).write.option("compression", "gzip").json(f"{folder}/raw/packed")
    assert lake.load_raw(spark, f"{folder}/raw", relation(spark).schema).count() == 12


def test_unfinished_attempt_is_not_loaded(spark, folder):
    from wardlake.streaming.ingest import write_batch

    write_batch(relation(spark, 6), 0, folder)
    relation(spark, 6).write.json(f"{folder}/raw/json/year=2024/month=06/batch_id=1")
    for base in (folder, f"{folder}/raw"):
        assert lake.load_raw(spark, base, relation(spark).schema).count() == 6


def test_csv_columns_go_by_name_in_any_order(spark, folder):
    spark.createDataFrame([(1, "a")], "x int, y string").write.option("header", True).csv(f"{folder}/one")
    spark.createDataFrame([("b", 2)], "y string, x int").write.option("header", True).csv(f"{folder}/two")
    paths = [f"{folder}/one", f"{folder}/two"]
    for schema in (None, lake.T.StructType.fromDDL("x int, y string")):
        got = lake.read_lake(spark, paths, "csv", schema).select("x", "y").orderBy("x").collect()
        assert [tuple(r) for r in got] == [(1, "a"), (2, "b")]
    with pytest.raises(Exception, match="(?i)header"):
        lake.read_lake(spark, f"{folder}/{{one,two}}").collect()


def test_zone_of_nested_folders(spark, folder):
    relation(spark).write.option("header", True).csv(f"{folder}/raw/raw/x")
    zones = {r.zone for r in lake.lake_inventory(spark, f"{folder}/raw").collect()}
    assert zones == {"raw"}


def test_main_file_is_a_dataset(spark, folder):
    many = relation(spark, 9).repartition(9)
    many.write.option("header", True).csv(f"{folder}/many.csv")
    relation(spark, 2).coalesce(1).write.option("header", True).csv(f"{folder}/few.csv")
    path = lake.pick_main_file(spark, folder).first()["path"]
    assert path.endswith("/many.csv")
    assert lake.read_lake(spark, path).count() == 9


def test_braces_in_sql_are_left_alone(spark):
    df = spark.createDataFrame([("aa",), ("b",)], "t string")
    assert query.query_frame(df, "SELECT * FROM {table} WHERE t RLIKE '^a{2}$'").count() == 1


def test_views_and_schema(spark, folder):
    relation(spark).write.parquet(folder)
    query.create_view(spark, "lake_test_view", folder, "parquet")
    assert query.query_view(spark, "lake_test_view").count() == 5
    assert query.query_view(spark, "lake_test_view", "SELECT COUNT(*) FROM lake_test_view").first()[0] == 5
    assert query.run_sql(spark, "SELECT * FROM lake_test_view WHERE record_id > 2").count() == 2
    described = {r.col_name: r.data_type for r in query.describe(spark, folder, "parquet").collect()}
    assert described == {"record_id": "bigint", "hospital_county": "string", "total_charges": "string"}
