"""Ingest: retries, restarts, quarantine; windowed counts on a stream."""

import datetime as dt

from pyspark.sql import functions as F

from wardlake.schema import MESSAGE_SCHEMA
from wardlake.sources.messages import parse_messages, read_stream
from wardlake.streaming import ingest, reports

RECORD_SCHEMA = "record_id bigint, hospital_county string"
AT = dt.datetime(2024, 6, 3, tzinfo=dt.timezone.utc)


def records(spark, n, start=0):
    return spark.createDataFrame([(start + i, f"C{i % 3}") for i in range(n)], RECORD_SCHEMA)


def schema(spark):
    return records(spark, 1).schema


def send(spark, path, n, start=0, broken=()):
    rows = [
        (
            f"record_{i}",
            '{"record_id": ' if i in broken else f'{{"record_id": {i}, "hospital_county": "C"}}',
            "t",
            i % 3,
            i,
            dt.datetime(2024, 6, 1) + dt.timedelta(minutes=i),
        )
        for i in range(start, start + n)
    ]
    spark.createDataFrame(rows, MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def drain(spark, base):
    stream = read_stream(spark, "parquet", path=f"{base}/messages", maxFilesPerTrigger="1")
    query = ingest.ingest(stream, base, schema(spark), drain=True)
    query.awaitTermination()
    return query


def test_batch_folder_pads_the_month():
    assert ingest.batch_folder("json", 7, AT) == "raw/json/year=2024/month=06/batch_id=7"


def test_retry_replaces_the_batch(spark, folder):
    ingest.write_batch(records(spark, 5), 1, folder, AT)
    ingest.write_batch(records(spark, 5), 1, folder, AT)
    ingest.write_batch(records(spark, 2, 100), 2, folder, AT)
    for fmt in ("json", "csv"):
        got = ingest.read_batches(spark, folder, fmt, schema(spark))
        assert got.count() == 7
        assert {(r.year, r.month) for r in got.select("year", "month").distinct().collect()} == {
            ("2024", "06")
        }
    manifest = ingest.read_manifest(spark, folder).orderBy("batch_id").collect()
    assert [(m.batch_id, m.record_count, m.schema_version) for m in manifest] == [
        ("1", 5, "1.0"),
        ("2", 2, "1.0"),
    ]


def test_files_without_a_manifest_are_not_read(spark, folder):
    ingest.write_batch(records(spark, 5), 1, folder, AT)
    records(spark, 3).write.json(f"{folder}/raw/json/year=2024/month=05/batch_id=1")
    assert ingest.read_batches(spark, folder, "json", schema(spark)).count() == 5


def test_empty_batch_leaves_no_trace(spark, folder):
    ingest.write_batch(records(spark, 1), 1, folder, AT)
    ingest.write_batch(records(spark, 1).limit(0), 2, folder, AT)
    assert ingest.read_manifest(spark, folder).count() == 1


def test_restart_adds_only_new_rows(spark, folder):
    send(spark, f"{folder}/messages", 10, 0, broken={4})
    send(spark, f"{folder}/messages", 10, 10)
    query = drain(spark, folder)
    assert reports.progress_frame(spark, query).agg(F.sum("messages")).first()[0] == 20
    totals = reports.manifest_totals(ingest.read_manifest(spark, folder)).first()
    assert (totals.total_batches, totals.total_messages, totals.errors) == (2, 19, 1)
    assert (totals.success_rate, totals.health) == (100.0, "degraded")
    assert spark.read.json(f"{folder}/quarantine").count() == 1
    stats = reports.running_stats(ingest.read_manifest(spark, folder), query, 9.5).first()
    assert (stats.status, stats.messages_per_second) == ("stopped", 2.0)

    drain(spark, folder)
    assert ingest.read_batches(spark, folder, "json", schema(spark)).count() == 19
    send(spark, f"{folder}/messages", 5, 20)
    drain(spark, folder)
    got = ingest.read_batches(spark, folder, "json", schema(spark))
    assert got.count() == got.select("record_id").distinct().count() == 24


def test_enrichment(spark, folder):
    send(spark, folder, 3)
    parsed = parse_messages(spark.read.schema(MESSAGE_SCHEMA).parquet(folder), schema(spark))
    row = parsed.orderBy("kafka_offset").collect()[2]
    assert (row.kafka_offset, row.kafka_partition, row.record_id) == (2, 2, 2)
    assert row.kafka_timestamp == 1717200120000
    assert row.consumer_timestamp is not None


def test_append_windows_wait_for_the_watermark(spark, folder):
    send(spark, f"{folder}/messages", 180)
    stream = read_stream(spark, "parquet", path=f"{folder}/messages")
    counts = reports.windowed_counts(stream.withWatermark("timestamp", "10 minutes"), "timestamp")
    query = (
        counts.writeStream.outputMode("append")
        .format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/check")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    got = spark.read.parquet(f"{folder}/out").orderBy("window_start").collect()
    assert [r.messages for r in got] == [60, 60]


def test_progress_log_keeps_the_newest(spark):
    log = reports.ProgressLog(size=2)
    for i in range(4):
        log.samples.append(("q", i, "t", 10 * i, 1.0))
    assert [r.messages for r in log.frame(spark).orderBy("batch_id").collect()] == [20, 30]
