"""Progress of streams as a table in shared storage, which outlives the driver.

A listener appends one row for every micro-batch. A query keeps its id over restarts and gets a new run
id with each, so a batch that is run again after a failure has a row for every run; reports take the newest
one. Rows that could not be written are kept and go with the next batch. What a driver that died had not
yet written is missing here but not in the manifest, and `batch_report` shows where the two differ.
"""

from __future__ import annotations

import datetime as dt
import logging
import threading

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from wardlake.functions.reporting import guarded_rate, health
from wardlake.streaming.reports import rate_timeline

logger = logging.getLogger(__name__)

PROGRESS_SCHEMA = (
    "query string, run string, batch_id bigint, started_at timestamp, input_rows bigint, "
    "busy_seconds double, late_groups bigint, state_rows bigint"
)


def progress_row(progress) -> tuple:
    """The row of one progress event."""
    started = dt.datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00"))
    states = progress.stateOperators or []
    return (
        str(progress.id),
        str(progress.runId),
        progress.batchId,
        started,
        progress.numInputRows,
        (progress.durationMs or {}).get("triggerExecution", 0) / 1e3,
        sum(s.numRowsDroppedByWatermark for s in states),
        sum(s.numRowsTotal for s in states),
    )


class ProgressTable(StreamingQueryListener):
    """Appends the progress of a session's queries to the table below `path`.

    Every `every` batches of a run make one small file, so the table has fewer files than the stream has
    batches; a run's last ones are written when it ends.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 1):
        self.spark, self.path, self.every = spark, path, every
        self._rows: dict[str, list[tuple]] = {}
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        rows = self._rows.setdefault(run, [])
        rows.append(progress_row(event.progress))
        if len(rows) >= self.every:
            self._flush(run)

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        self._flush(run)
        with self._change:
            self._ended.add(run)
            self._change.notify_all()

    def _flush(self, run: str) -> None:
        rows = self._rows.get(run)
        if not rows:
            return
        try:
            # named by the first batch, so rows that are written again replace themselves
            frame = self.spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1)
            frame.write.mode("overwrite").json(f"{self.path}/{run}-{rows[0][2]}")
        except Exception as error:  # the stream must not stop for its statistics
            logger.warning("progress of run %s is not written yet: %s", run, error)
        else:
            self._rows[run] = []

    def wait_for(self, query: StreamingQuery, timeout: float = 60.0) -> bool:
        """Wait until the rows of an ended query are written; events come after the query's end."""
        with self._change:
            return self._change.wait_for(lambda: str(query.runId) in self._ended, timeout)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The newest row of every batch; no rows where nothing has been written."""
    try:
        rows = spark.read.schema(PROGRESS_SCHEMA).option("recursiveFileLookup", True).json(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], PROGRESS_SCHEMA)
    facts = [c for c in rows.columns if c not in ("query", "batch_id")]
    newest = F.max_by(F.struct(*facts), F.struct("started_at", "run")).alias("newest")
    return rows.groupBy("query", "batch_id").agg(newest).select("query", "batch_id", "newest.*")


def progress_totals(progress: DataFrame) -> DataFrame:
    """Per query, over all its runs: batches, messages, first and last time, uptime and rates."""
    ended = F.timestamp_micros((F.unix_micros("started_at") + F.col("busy_seconds") * 1e6).cast("bigint"))
    uptime = (F.unix_micros(F.max("ended_at")) - F.unix_micros(F.min("started_at"))) / 1e6
    return (
        progress.withColumn("ended_at", ended)
        .groupBy("query")
        .agg(
            F.countDistinct("run").alias("runs"),
            F.count("*").alias("total_batches"),
            F.sum("input_rows").alias("total_messages"),
            F.max_by("input_rows", F.when(F.col("input_rows") > 0, F.col("batch_id"))).alias("current_batch_size"),
            F.min("started_at").alias("start_time"),
            F.max(F.when(F.col("input_rows") > 0, F.col("ended_at"))).alias("last_message_time"),
            uptime.alias("uptime_seconds"),
            F.sum("busy_seconds").alias("busy_seconds"),
            guarded_rate(F.sum("input_rows"), uptime).alias("messages_per_second"),
            guarded_rate(F.sum("input_rows"), F.sum("busy_seconds")).alias("messages_per_busy_second"),
        )
    )


def progress_timeline(progress: DataFrame, width: str = "1 minute") -> DataFrame:
    """Messages, rate and running total per window of processing time."""
    return rate_timeline(progress, "started_at", width, F.sum("input_rows"))


def batch_report(manifest: DataFrame, progress: DataFrame, prefix: str = "") -> DataFrame:
    """One row per batch of the manifest or the progress table, with what each of them counted.

    A batch agrees if its records and errors are the rows that came in; an empty batch leaves no
    manifest row.
    """
    said = manifest.select(
        "batch_id", (F.col("record_count") + F.col("error_count")).alias("manifest_rows"), "record_count", "error_count"
    )
    seen = progress.select(
        F.concat(F.lit(prefix), F.col("batch_id").cast("string")).alias("batch_id"),
        "run",
        "started_at",
        F.col("input_rows").alias("progress_rows"),
        "busy_seconds",
    )
    agrees = F.coalesce("manifest_rows", F.lit(0)) == F.coalesce("progress_rows", F.lit(0))
    return said.join(seen, "batch_id", "full").withColumn("agrees", agrees)


def ingest_statistics(manifest: DataFrame, progress: DataFrame, prefix: str = "") -> DataFrame:
    """Statistics of an ingest over all its runs, from its manifest and its progress.

    Counts of records, errors and files come from the manifest, which misses no batch; times, runs and
    rates from the progress, which may miss some.
    """
    report = batch_report(manifest, progress, prefix)
    files = manifest.agg(F.struct(F.count("json_path").alias("json"), F.count_if("csv_saved").alias("csv")).alias("files"))
    ended = F.unix_micros("started_at") + F.col("busy_seconds") * 1e6
    uptime = (F.max(ended) - F.min(F.unix_micros("started_at"))) / 1e6
    messages = F.coalesce(F.sum("record_count"), F.lit(0))
    errors = F.coalesce(F.sum("error_count"), F.lit(0))
    return report.agg(
        messages.alias("total_messages"),
        F.count("manifest_rows").alias("total_batches"),
        F.max_by("record_count", F.when(F.col("record_count").isNotNull(), F.col("started_at"))).alias("current_batch_size"),
        errors.alias("errors"),
        health(errors).alias("health"),
        F.countDistinct("run").alias("runs"),
        F.min("started_at").alias("start_time"),
        F.timestamp_micros(F.max(ended).cast("bigint")).alias("last_message_time"),
        uptime.alias("uptime_seconds"),
        guarded_rate(messages, uptime).alias("messages_per_second"),
        F.count_if(F.col("manifest_rows").isNotNull() & F.col("progress_rows").isNull()).alias("unreported_batches"),
        F.count_if(~F.col("agrees")).alias("differing_batches"),
    ).withColumn("files_saved", files.scalar())
