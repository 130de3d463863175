"""Progress that outlives the driver, and the timeline of a live stream."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wardlake.plans.inputs import with_progress
from wardlake.schema import MESSAGE_SCHEMA
from wardlake.sources.messages import read_stream
from wardlake.streaming import ingest, progress, reports, timeline

START = dt.datetime(2024, 6, 1)
ROW = progress.PROGRESS_SCHEMA


def send(spark, base, minutes, broken=()):
    rows = [
        (f"k{m}", "{" if m in broken else f'{{"record_id": {m}}}', "t", 0, m, START + dt.timedelta(minutes=m))
        for m in minutes
    ]
    spark.createDataFrame(rows, MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/messages")


def messages(spark, base):
    return read_stream(spark, "parquet", path=f"{base}/messages", maxFilesPerTrigger="1")


def drain_ingest(spark, base, schema):
    return with_progress(spark, base, lambda: ingest.ingest(messages(spark, base), base, schema, drain=True))


def drain_windows(spark, base, **options):
    query = with_progress(spark, base, lambda: timeline.stream_windows(messages(spark, base), base, "timestamp", **options))
    timeline.stream_days(spark, base).awaitTermination()
    return query


def test_progress_of_a_restarted_ingest_equals_its_manifest(spark, folder):
    schema = spark.range(0).select(F.col("id").alias("record_id")).schema
    send(spark, folder, range(10), broken={3})
    send(spark, folder, range(10, 25))
    drain_ingest(spark, folder, schema)
    send(spark, folder, range(25, 32))
    drain_ingest(spark, folder, schema)
    rows = progress.read_progress(spark, f"{folder}/progress")
    totals = progress.progress_totals(rows).first()
    assert (totals.runs, totals.total_messages, totals.current_batch_size) == (2, 32, 7)
    assert totals.busy_seconds > 0 and totals.uptime_seconds >= totals.busy_seconds * 0.9
    stats = progress.ingest_statistics(ingest.read_manifest(spark, folder), rows).first()
    assert (stats.total_messages, stats.errors, stats.total_batches, stats.runs) == (31, 1, 3, 2)
    assert (stats.unreported_batches, stats.differing_batches, stats.current_batch_size) == (0, 0, 7)
    assert (stats.files_saved.json, stats.files_saved.csv, stats.health) == (3, 3, "degraded")
    line = progress.progress_timeline(rows).agg(F.max("total_messages")).first()[0]
    assert line == 32


def test_a_batch_that_was_run_again_counts_once(spark, folder):
    at = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    first = [("q", "run1", 0, at, 10, 1.0, 0, 0), ("q", "run1", 1, at + dt.timedelta(seconds=5), 4, 1.0, 0, 0)]
    again = [("q", "run2", 1, at + dt.timedelta(seconds=60), 6, 2.0, 0, 0)]
    for rows in (first, again):
        spark.createDataFrame(rows, ROW).write.json(f"{folder}/{rows[0][1]}")
    rows = progress.read_progress(spark, folder)
    totals = progress.progress_totals(rows).first()
    assert (totals.total_batches, totals.total_messages, totals.runs, totals.uptime_seconds) == (2, 16, 2, 62.0)
    assert totals.messages_per_second == 0.26


def test_lost_progress_is_told_and_counted_from_the_manifest(spark, folder):
    records = spark.createDataFrame([(i,) for i in range(8)], "record_id bigint")
    for batch in range(3):
        ingest.write_batch(records, batch, folder)
    at = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    spark.createDataFrame([("q", "r", 0, at, 8, 1.0, 0, 0), ("q", "r", 1, at, 9, 1.0, 0, 0)], ROW).write.json(f"{folder}/p")
    stats = progress.ingest_statistics(ingest.read_manifest(spark, folder), progress.read_progress(spark, f"{folder}/p")).first()
    assert (stats.total_messages, stats.total_batches, stats.unreported_batches, stats.differing_batches) == (24, 3, 1, 2)


def test_no_progress_yet(spark, folder):
    assert progress.read_progress(spark, f"{folder}/nothing").collect() == []
    assert progress.progress_totals(progress.read_progress(spark, f"{folder}/nothing")).collect() == []


def test_rows_that_cannot_be_written_are_kept(spark, folder, monkeypatch):
    class Event:
        pass

    table = progress.ProgressTable(spark, folder)
    at = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    monkeypatch.setattr(progress, "progress_row", lambda p: ("q", "r", p.batchId, at, 5, 1.0, 0, 0))
    monkeypatch.setattr(table, "path", "nosuchstore://x")
    for batch in range(3):
        event = Event()
        event.progress = Event()
        event.progress.runId, event.progress.batchId = "r", batch
        table.onQueryProgress(event)
        table.path = folder if batch else "nosuchstore://x"
    assert progress.read_progress(spark, folder).agg(F.sum("input_rows")).first()[0] == 15


def test_windows_are_appended_once_and_days_follow(spark, folder):
    """Two days, restarted between batches: closed windows, open ones from the state, running totals."""
    day = 24 * 60
    send(spark, folder, range(0, day, 10))
    drain_windows(spark, folder, late="1 hour")
    send(spark, folder, range(day, 2 * day, 20))
    send(spark, folder, range(2 * day, 2 * day + 90, 30))
    drain_windows(spark, folder, late="1 hour")
    closed = timeline.closed_windows(spark, folder)
    assert closed.count() == closed.select("window_start").distinct().count() > 24
    days = spark.read.parquet(f"{folder}/days").orderBy("day").collect()
    assert [(str(d.day), d.of_day) for d in days][:1] == [("2024-06-01", 144)]
    got = timeline.read_timeline(spark, folder).orderBy("window_start").collect()
    expected = reports.rate_timeline(spark.read.parquet(f"{folder}/messages"), "timestamp").orderBy("window_start").collect()
    assert [tuple(r)[:4] for r in got] == [tuple(r) for r in expected]
    assert got[-1].is_open and not got[0].is_open and got[-1].total_messages == 144 + 72 + 3


def test_late_messages_are_counted_as_late(spark, folder):
    send(spark, folder, range(0, 600, 10))
    drain_windows(spark, folder, late="30 minutes")
    send(spark, folder, [5, 15, 25, 595])  # three far behind the watermark
    query = drain_windows(spark, folder, late="30 minutes")
    rows = progress.read_progress(spark, f"{folder}/progress")
    late = timeline.lateness(spark, folder, rows, str(query.id)).first()
    assert tuple(late) == (64, 61, 3)


@pytest.mark.parametrize("width", ["15 minutes", "2 hours"])
def test_other_window_widths(spark, folder, width):
    send(spark, folder, range(0, 3000, 7))
    drain_windows(spark, folder, width=width, late="1 hour")
    got = timeline.read_timeline(spark, folder).drop("is_open").orderBy("window_start").collect()
    whole = spark.read.parquet(f"{folder}/messages")
    assert got == reports.rate_timeline(whole, "timestamp", width).orderBy("window_start").collect()
