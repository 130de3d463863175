"""Monitoring reports over messages, manifests and stream progress."""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from wardlake.functions.reporting import freshness, guarded_rate, health, percent_of

PROGRESS_SCHEMA = (
    "query string, batch_id bigint, at string, messages bigint, messages_per_second double"
)


def ingest_totals(messages: DataFrame, ts: str) -> DataFrame:
    """Messages, first and last time, and the overall rate."""
    seconds = F.unix_micros(F.max(F.col(ts).cast("timestamp"))) - F.unix_micros(
        F.min(F.col(ts).cast("timestamp"))
    )
    return messages.agg(
        F.count("*").alias("total_messages"),
        F.min(ts).alias("first_message_time"),
        F.max(ts).alias("last_message_time"),
        guarded_rate(F.count("*"), seconds / 1e6).alias("messages_per_second"),
    )


def windowed_counts(
    messages: DataFrame, ts: str, width: str = "1 hour", counted: Column | None = None
) -> DataFrame:
    """Messages per tumbling window; on a stream with a watermark it can run in append mode.

    `counted` is an aggregate to use in place of the number of rows.
    """
    amount = F.count("*") if counted is None else counted
    return (
        messages.groupBy(F.window(ts, width).alias("w"))
        .agg(amount.alias("messages"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "messages")
    )


def day_totals(windows: DataFrame) -> DataFrame:
    """Messages per day of windows that do not cross midnight."""
    return windows.groupBy(F.to_date("window_start").alias("day")).agg(F.sum("messages").alias("of_day"))


def with_running_total(windows: DataFrame, days: DataFrame) -> DataFrame:
    """Rate of each window and the running total up to it.

    The running total has two levels: within each day, side by side, and over the days, of which
    there is one row each.
    """
    within = Window.partitionBy("day").orderBy("window_start")
    so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    before = days.select("day", F.coalesce(F.sum("of_day").over(earlier), F.lit(0)).alias("before"))
    seconds = (
        F.unix_micros(F.col("window_end").cast("timestamp"))
        - F.unix_micros(F.col("window_start").cast("timestamp"))
    ) / 1e6
    dated = windows.withColumn("day", F.to_date("window_start"))
    return dated.withColumn("inside", F.sum("messages").over(so_far)).join(before, "day").select(
        "window_start",
        "messages",
        guarded_rate(F.col("messages"), seconds).alias("messages_per_second"),
        (F.col("before") + F.col("inside")).alias("total_messages"),
    )


def rate_timeline(
    messages: DataFrame, ts: str, width: str = "1 hour", counted: Column | None = None
) -> DataFrame:
    """Per window: messages, rate, and the running total. Days are summed from the same windows."""
    windows = windowed_counts(messages, ts, width, counted)
    return with_running_total(windows, day_totals(windows))


def freshness_report(messages: DataFrame, key: str, ts: str, is_error) -> DataFrame:
    """Per stream key: newest message, its age against the newest of all, errors and health."""
    by_key = messages.groupBy(key).agg(
        F.count("*").alias("messages"),
        F.max(ts).alias("last_message_time"),
        F.count_if(is_error).alias("errors"),
    )
    # with all columns in the maximum, it reads the same grouped rows and not the messages again
    whole = F.max(F.struct("last_message_time", "messages", "errors"))
    newest = by_key.agg(whole.alias("newest")).select("newest.last_message_time").scalar()

    def micros(c):
        return F.unix_micros(c.cast("timestamp"))

    return (
        by_key
        .withColumn("age_seconds", (micros(newest) - micros(F.col("last_message_time"))) / 1e6)
        .withColumn("freshness", freshness(F.col("age_seconds")))
        .withColumn("health", health(F.col("errors")))
    )


def manifest_totals(manifest: DataFrame) -> DataFrame:
    """Running statistics of the ingest, from its manifest.

    A batch should leave two files, so the success rate is files over twice the batches.
    """
    csv_files = F.count_if("csv_saved")
    return manifest.agg(
        F.count("*").alias("total_batches"),
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("total_messages"),
        F.coalesce(F.sum("error_count"), F.lit(0)).alias("errors"),
        F.count("json_path").alias("json_files"),
        csv_files.alias("csv_files"),
        F.max("timestamp").alias("last_batch_time"),
        percent_of(
            F.count("json_path") + csv_files, F.greatest(F.lit(2) * F.count("*"), F.lit(1))
        ).alias("success_rate"),
        health(F.coalesce(F.sum("error_count"), F.lit(0))).alias("health"),
    )


def stream_status(query: StreamingQuery) -> str:
    if query.exception() is not None:
        return "failed"
    if not query.isActive:
        return "stopped"
    return "consuming" if query.lastProgress else "initializing"


def running_stats(manifest: DataFrame, query: StreamingQuery, uptime_seconds: float) -> DataFrame:
    """Manifest totals with the state of the query, its uptime and the messages per second."""
    uptime = F.lit(float(uptime_seconds))
    return manifest_totals(manifest).withColumns(
        {
            "status": F.lit(stream_status(query)),
            "uptime_seconds": uptime,
            "messages_per_second": guarded_rate(F.col("total_messages"), uptime),
        }
    )


def _progress_row(progress) -> tuple:
    rate = progress["processedRowsPerSecond"] if "processedRowsPerSecond" in progress else None
    return (
        str(progress["id"]),
        int(progress["batchId"]),
        str(progress["timestamp"]),
        int(progress["numInputRows"]),
        None if rate is None else float(rate),
    )


def progress_frame(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Recent progress of a query, one row per micro-batch."""
    return spark.createDataFrame([_progress_row(p) for p in query.recentProgress], PROGRESS_SCHEMA)


class ProgressLog(StreamingQueryListener):
    """Keeps the newest progress samples of all queries of a session."""

    def __init__(self, size: int = 50):
        self.samples: deque = deque(maxlen=size)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.samples.append(
            (str(p.id), p.batchId, p.timestamp, p.numInputRows, p.processedRowsPerSecond)
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.samples), PROGRESS_SCHEMA)
