"""The message timeline of a live stream: counts, rate and running total, each row written once.

A first query counts messages per window and appends a window when the watermark has passed its end. A
second one reads these windows as a stream, sums them per day and appends a day when a later day's window
has been closed. Both write through Spark's file sink, which keeps what a retried batch wrote out of sight.
Windows that are still open are read from the state of the first query, so a report has every counted
message: the days that are closed come from the second table, and only the open ones are summed again.

Messages behind the watermark are not counted in a window that was closed; `lateness` tells how many,
from the rows that came in by the progress table and the rows that were counted.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardlake.streaming.reports import day_totals, windowed_counts, with_running_total

WINDOWS = "window_start timestamp, window_end timestamp, messages bigint"
DAYS = "day date, of_day bigint"


def _append(rows: DataFrame, base: str, name: str, trigger: dict) -> StreamingQuery:
    writer = rows.writeStream.outputMode("append").format("parquet").queryName(name)
    writer = writer.option("path", f"{base}/{name}").option("checkpointLocation", f"{base}/_{name}")
    return writer.trigger(**trigger).start()


def stream_windows(
    messages: DataFrame, base: str, ts: str, width: str = "1 hour", late: str = "1 hour", **trigger
) -> StreamingQuery:
    """Start counting a message stream per window; windows may not cross midnight.

    A window is closed when a message more than `late` behind its end has come. Without a trigger the
    query takes what is there and stops, and goes on from there when it is started again.
    """
    timed = messages.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    return _append(windowed_counts(timed, ts, width), base, "windows", trigger or {"availableNow": True})


def stream_days(spark: SparkSession, base: str, **trigger) -> StreamingQuery:
    """Start summing the closed windows per day.

    Windows are closed in the order of time, and the file sink shows a batch of them at once, so no
    window comes behind the watermark of a batch that has been read. Every batch is read as a whole.
    """
    windows = spark.readStream.schema(WINDOWS).parquet(f"{base}/windows").withWatermark("window_start", "0 seconds")
    daily = (
        windows.groupBy(F.window("window_start", "1 day").alias("w"))
        .agg(F.sum("messages").alias("of_day"))
        .select(F.to_date("w.start").alias("day"), "of_day")
    )
    return _append(daily, base, "days", trigger or {"availableNow": True})


def _appended(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What a query has appended so far; nothing before its first batch."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def closed_windows(spark: SparkSession, base: str) -> DataFrame:
    return _appended(spark, f"{base}/windows", WINDOWS)


def open_windows(spark: SparkSession, base: str) -> DataFrame:
    """The windows that are still counted, as of the last batch that ended."""
    state = spark.read.format("statestore").load(f"{base}/_windows")
    return state.select(
        F.col("key.window.start").alias("window_start"),
        F.col("key.window.end").alias("window_end"),
        F.col("value.count").alias("messages"),
    )


def read_timeline(spark: SparkSession, base: str) -> DataFrame:
    """Every window with its messages, rate and the running total, and whether it is still open."""
    closed, counting = closed_windows(spark, base), open_windows(spark, base)
    windows = closed.unionByName(counting)
    done = _appended(spark, f"{base}/days", DAYS)
    rest = windows.join(done, F.to_date("window_start") == F.col("day"), "left_anti")
    timeline = with_running_total(windows, done.unionByName(day_totals(rest)))
    still = counting.select("window_start", F.lit(True).alias("is_open"))
    return timeline.join(still, "window_start", "left").fillna(False, ["is_open"])


def lateness(spark: SparkSession, base: str, progress: DataFrame, query_id: str) -> DataFrame:
    """Messages that came in, that were counted, and that came too late to be."""
    counted = closed_windows(spark, base).unionByName(open_windows(spark, base))
    counted = counted.agg(F.coalesce(F.sum("messages"), F.lit(0)).alias("counted"))
    own = progress.filter(F.col("query") == query_id).agg(F.coalesce(F.sum("input_rows"), F.lit(0)).alias("received"))
    return own.withColumn("counted", counted.scalar()).withColumn("late", F.col("received") - F.col("counted"))
