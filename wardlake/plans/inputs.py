"""Relations the registered queries start from, built by Spark from the given tables.

Tables that several queries share are written once per application to the shared folder and read
back, so an executor that is lost takes no intermediate result with it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardlake.models.registry import load_models, save_model
from wardlake.models.training import train_all
from wardlake.plans.discharges import discharges, raw_discharges, table, to_processed
from wardlake.session import scratch_path
from wardlake.sources.lake import export_csv
from wardlake.sources.messages import read_stream, to_messages, write_messages
from wardlake.sources.zones import read_processed, write_processed
from wardlake.streaming.ingest import compact, ingest, read_batches, write_batch
from wardlake.streaming.progress import ProgressTable
from wardlake.streaming.timeline import stream_days, stream_windows

# One request body per discharge, as JSON: some without a group code, some with a code in quotes,
# supplied texts, explicit nulls, unreadable weights, and always a key nobody knows.
REQUEST_SQL = """
SELECT
  record_id AS request_id,
  '{{"ticket": ' || CAST(record_id AS VARCHAR(20))
  || CASE WHEN record_id % 13 = 0 THEN '' WHEN record_id % 17 = 0 THEN ', "drg_code": "' || apr_drg_code || '"'
          WHEN record_id % 19 = 0 THEN ', "drg_code": null' ELSE ', "drg_code": ' || apr_drg_code END
  || CASE WHEN apr_severity_of_illness_code IS NULL THEN ''
          ELSE ', "severity_code": ' || apr_severity_of_illness_code END
  || CASE WHEN record_id % 5 = 0 THEN ', "age_group": "' || age_group || '"' ELSE '' END
  || CASE WHEN record_id % 3 = 0 THEN ', "race": ' || COALESCE('"' || race || '"', 'null') ELSE '' END
  || CASE WHEN record_id % 9 = 0 THEN ', "drg_description": "As dictated"' ELSE '' END
  || CASE WHEN record_id % 11 = 0 THEN ', "severity": "As charted", "mortality_risk": "As charted"' ELSE '' END
  || CASE WHEN record_id % 8 = 3 THEN ', "birth_weight": ' || birth_weight
          WHEN record_id % 8 = 4 THEN ', "birth_weight": "abc"' ELSE '' END
  || CASE WHEN record_id % 10 = 0 THEN ', "gender": "' || gender || '"' ELSE '' END
  || CASE WHEN record_id % 7 = 0 THEN ', "county": "' || hospital_county || '"' ELSE '' END
  || '}}' AS body
FROM {discharges}
"""

# Micro-batch size of the registered streams; files are as many as the input's partitions.
BATCH_BYTES = str(64 << 20)
# The text copies of the discharges are several times as large as their tables and compress well.
TEXT_CODEC = "gzip"
# A task reads at least a row group: small ones let all cores share the files of one micro-batch.
MESSAGE_FILES = {"compression": "zstd", "parquet.block.size": str(8 << 20)}
TOPIC = "discharges"


def once_per_application(build: Callable) -> Callable:
    """Remember the result of build(spark, sf_dir) for as long as the application runs."""
    results: dict[tuple[str, str], object] = {}

    @wraps(build)
    def cached(spark: SparkSession, sf_dir: str):
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in results:
            results[key] = build(spark, sf_dir)
        return results[key]

    return cached


@once_per_application
def processed_base(spark: SparkSession, sf_dir: str) -> str:
    base = scratch_path(spark, "zone")
    write_processed(discharges(spark, sf_dir), base)
    return base


def processed_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_processed(spark, processed_base(spark, sf_dir))


@once_per_application
def lake_base(spark: SparkSession, sf_dir: str) -> str:
    return scratch_path(spark, "lake")


def lake_file(fmt: str) -> Callable[[SparkSession, str], str]:
    """The folder of the raw relation in one format, so that a scan of it needs no others."""

    @once_per_application
    def build(spark: SparkSession, sf_dir: str) -> str:
        path = f"{lake_base(spark, sf_dir)}/discharges.{fmt}"
        raw = raw_discharges(spark, sf_dir)
        if fmt == "csv":
            export_csv(raw, path, TEXT_CODEC)
        elif fmt == "json":
            raw.write.options(ignoreNullFields=False, compression=TEXT_CODEC).json(path)
        else:
            raw.write.parquet(path)
        return path

    return build


LAKE_FILES = {fmt: lake_file(fmt) for fmt in ("csv", "json", "parquet")}


def lake_files(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The raw relation as CSV, JSON Lines and Parquet files; folder by format."""
    return {fmt: build(spark, sf_dir) for fmt, build in LAKE_FILES.items()} | {"base": lake_base(spark, sf_dir)}


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table in the shape of broker messages."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("key"),
        F.col("props").alias("value"),
        F.lit("events").alias("topic"),
        (F.col("event_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
    )


def damaged_event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event messages of which some lost the end of their JSON text on the way."""
    cut = F.expr("substring(value, 1, length(value) - 1)")
    return event_messages(spark, sf_dir).withColumn(
        "value", F.when(F.col("offset") % 40 == 0, cut).otherwise(F.col("value"))
    )


@once_per_application
def ingested(spark: SparkSession, sf_dir: str):
    """The folder of ingested_base, and the drained query."""
    return _ingest(spark, sf_dir)


def ingested_base(spark: SparkSession, sf_dir: str) -> str:
    return ingested(spark, sf_dir)[0]


@once_per_application
def ingested_zone(spark: SparkSession, sf_dir: str) -> str:
    """The processed zone of the ingested records, in a folder of its own."""
    base = scratch_path(spark, "ingested-zone")
    write_processed(to_processed(read_batches(spark, ingested_base(spark, sf_dir))), base)
    return base


@once_per_application
def damaged_lake(spark: SparkSession, sf_dir: str) -> str:
    """Raw records in two finished batches, and a third attempt without a manifest row."""
    base = scratch_path(spark, "attempts")
    raw = raw_discharges(spark, sf_dir)
    for batch in (0, 1):
        write_batch(raw.filter(F.col("record_id") % 2 == batch), batch, base, compression=TEXT_CODEC)
    folder = f"{base}/raw/json/year=1999/month=01/batch_id=2"
    raw.write.options(ignoreNullFields=False, compression=TEXT_CODEC).json(folder)
    return base


@once_per_application
def reordered_files(spark: SparkSession, sf_dir: str) -> list[str]:
    """The raw relation in two CSV datasets whose columns stand in opposite order."""
    base = scratch_path(spark, "reordered")
    raw = raw_discharges(spark, sf_dir)
    paths = []
    for part, names in enumerate((raw.columns, raw.columns[::-1])):
        own = raw.filter(F.col("record_id") % 2 == part).select(*names)
        paths.append(export_csv(own, f"{base}/part{part}.csv", TEXT_CODEC))
    return paths


def _ingest(spark: SparkSession, sf_dir: str):
    """All discharges sent as messages, some damaged, and ingested by a drained stream.

    Half of the messages come after the stream has stopped, so it is started twice; its progress goes to
    a table.
    """
    base = scratch_path(spark, "ingest")
    number = F.substring_index("key", "_", -1).cast("bigint")
    cut = F.expr("substring(value, 1, length(value) - 1)")
    sent = to_messages(raw_discharges(spark, sf_dir)).select(
        "key",
        F.when(number % 101 == 100, cut).otherwise(F.col("value")).alias("value"),
        F.lit(TOPIC).alias("topic"),
        (number % 3).cast("int").alias("partition"),
        number.alias("offset"),
        F.timestamp_seconds(number + 1_704_067_200).alias("timestamp"),
    )
    for half in (0, 1):
        write_messages(sent.filter(number % 2 == half), TOPIC, "parquet", path=f"{base}/{TOPIC}", **MESSAGE_FILES)
        messages = read_stream(spark, "parquet", path=f"{base}/{TOPIC}", maxBytesPerTrigger=BATCH_BYTES)
        query = with_progress(spark, base, lambda: ingest(messages, base, drain=True, compression=TEXT_CODEC))
    return base, query


def with_progress(spark: SparkSession, base: str, start: Callable) -> StreamingQuery:
    """Run a drained query to its end, with its progress in a table below `base`."""
    table_ = ProgressTable(spark, f"{base}/progress")
    spark.streams.addListener(table_)
    try:
        query = start()
        query.awaitTermination()
        if not table_.wait_for(query):
            raise TimeoutError("the progress of a query was not written")
    finally:
        spark.streams.removeListener(table_)
    return query


# The events of the month up to this day are sent first, and those before the second one once more at last.
SECOND_SLICE, REPLAYED = "2024-01-16", "2024-01-06"
LATE = "16 days"


@once_per_application
def timeline(spark: SparkSession, sf_dir: str):
    """The events sent in order of time in two slices, some of the first again, and counted as a stream.

    The stream is drained and started again for each slice. Within a slice files come in any order, so a
    window stays open for as long as a slice is; what is sent again comes behind that and is late.
    Returns the folder and the query that counts.
    """
    base = scratch_path(spark, "timeline")
    events = event_messages(spark, sf_dir).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    first, replayed = F.col("timestamp") < SECOND_SLICE, F.col("timestamp") < REPLAYED
    for part in (events.filter(first), events.filter(~first), events.filter(replayed)):
        write_messages(part, "events", "parquet", path=f"{base}/events")
        messages = read_stream(spark, "parquet", path=f"{base}/events", maxBytesPerTrigger=BATCH_BYTES)
        query = with_progress(spark, base, lambda: stream_windows(messages, base, "timestamp", late=LATE))
        stream_days(spark, base).awaitTermination()
    return base, query


@once_per_application
def compacted(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The same ingested lake before, in the middle of and after a compaction; folder by state."""
    base = scratch_path(spark, "compaction")
    raw = raw_discharges(spark, sf_dir)
    states = {}
    for state in ("before", "during", "after"):
        states[state] = f"{base}/{state}"
        for batch in range(4):
            part = raw.filter(F.col("record_id") % 4 == batch)
            write_batch(part, batch, states[state], COMPACTED_AT, compression=TEXT_CODEC)
    # what a compaction that died before its manifest row leaves behind
    copy = raw.write.options(ignoreNullFields=False, compression=TEXT_CODEC)
    copy.json(f"{states['during']}/raw/json/year=2024/month=03/batch_id=compact-unfinished")
    compact(spark, states["after"], compression=TEXT_CODEC)
    return states


COMPACTED_AT = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)


@once_per_application
def unsaved_csv(spark: SparkSession, sf_dir: str) -> str:
    """An ingest of which one batch has no CSV copy."""
    base = scratch_path(spark, "unsaved")
    raw = raw_discharges(spark, sf_dir)
    write_batch(raw.filter("record_id % 3 <> 0"), 0, base, compression=TEXT_CODEC)
    write_batch(raw.filter("record_id % 3 = 0"), 1, base, formats=("json",), compression=TEXT_CODEC)
    return base


@once_per_application
def twice_saved(spark: SparkSession, sf_dir: str) -> str:
    """A registry with two versions of a model, and a third save that died before its metadata row."""
    base = scratch_path(spark, "versions")
    _, trained = trained_base(spark, sf_dir)
    for _ in range(2):
        save_model(spark, trained[0], base)
    trained[0].model.write().overwrite().save(f"{base}/models/{trained[0].name}/version=3")
    return base


def request_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(REQUEST_SQL, discharges=raw_discharges(spark, sf_dir))


@once_per_application
def trained_base(spark: SparkSession, sf_dir: str):
    """Models of all targets, saved to a registry; returns its folder and the training scores."""
    base = scratch_path(spark, "models")
    trained = train_all(processed_zone(spark, sf_dir))
    for result in trained:
        save_model(spark, result, base)
    return base, trained


def saved_models(spark: SparkSession, sf_dir: str):
    base, _ = trained_base(spark, sf_dir)
    return load_models(spark, base)
