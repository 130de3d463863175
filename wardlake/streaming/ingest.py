"""Micro-batch ingest: each batch goes to the raw zone as JSON and CSV, then gets a manifest row.

A batch may be written again after a failure. All its files sit in folders named by its batch id
and are replaced as a whole, and the manifest comes last, so readers that go by the manifest see
every batch once or not at all.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wardlake.schema import DATA_SOURCE, MANIFEST_SCHEMA, RAW_SCHEMA, SCHEMA_VERSION
from wardlake.session import stored
from wardlake.sources import file_index
from wardlake.sources.lake import CSV_OPTIONS, export_csv, read_csv_by_name
from wardlake.sources.manifests import (
    FOLDER_PARTS,
    MANIFEST_FOLDER,
    REPLACES,
    WITH_REPLACED,
    all_manifests,
    folder_part,
    manifest_folder,
    read_manifest,
)
from wardlake.sources.messages import parse_messages, split_corrupt

logger = logging.getLogger(__name__)

# The age at which a batch is written even if it is not full.
BATCH_AGE = "30 seconds"


def batch_folder(kind: str, batch_id: int | str, at: dt.datetime) -> str:
    return f"raw/{kind}/year={at:%Y}/month={at:%m}/batch_id={batch_id}"


def write_batch(
    records: DataFrame,
    batch_id: int | str,
    base: str,
    at: dt.datetime | None = None,
    error_count: int = 0,
    formats: tuple[str, ...] = ("json", "csv"),
    compression: str = "none",
) -> None:
    """Write one batch as JSON Lines and CSV with a manifest row. Empty batches leave no trace.

    The records are read twice; persist them first if they are costly to compute. Without "csv" among
    the formats the batch has no CSV copy, as if it had failed. `compression` is that of both copies.
    """
    at = at or dt.datetime.now(dt.timezone.utc)
    if records.isEmpty() and not error_count:
        return
    seen = Observation(f"batch_{batch_id}")
    json_path = batch_folder("json", batch_id, at)
    csv_path = batch_folder("csv", batch_id, at)
    counted = records.observe(seen, F.count("*").alias("rows"))
    copy = counted.write.mode("overwrite").options(ignoreNullFields=False, compression=compression)
    copy.json(f"{base}/{json_path}")
    csv_saved = False
    try:
        if "csv" in formats:
            export_csv(records, f"{base}/{csv_path}", compression)
            csv_saved = True
    except Exception as error:  # the JSON copy is the one that counts
        logger.warning("batch %s has no CSV copy: %s", batch_id, error)
    manifest = (
        str(batch_id),
        seen.get["rows"],
        error_count,
        at,
        json_path,
        csv_path,
        csv_saved,
        DATA_SOURCE,
        SCHEMA_VERSION,
    )
    # the folder name carries the batch id
    row = records.sparkSession.createDataFrame([manifest], MANIFEST_SCHEMA).drop("batch_id")
    manifest_path = f"{base}/raw/manifest/batch_id={batch_id}"
    row.coalesce(1).write.mode("overwrite").json(manifest_path)
    own = [f"{base}/{json_path}", *([f"{base}/{csv_path}"] if csv_saved else []), manifest_path]
    file_index.add(records.sparkSession, f"{base}/raw", own, f"batch-{batch_id}")


def ingest(
    messages: DataFrame,
    base: str,
    schema: T.StructType = RAW_SCHEMA,
    drain: bool = False,
    batch_age: str = BATCH_AGE,
    prefix: str = "",
    compression: str = "none",
) -> StreamingQuery:
    """Start the ingest of a message stream into `base`.

    Batch size is set on the source (maxOffsetsPerTrigger or maxFilesPerTrigger). `drain` takes
    what is there and stops; otherwise a batch is cut at least every `batch_age`. Undecodable
    messages go to a quarantine folder and are counted in the manifest.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_messages(batch, schema).persist()
        try:
            good, bad = split_corrupt(parsed)
            errors = bad.count()
            if errors:
                bad.write.mode("overwrite").json(f"{base}/quarantine/batch_id={prefix}{batch_id}")
            write_batch(good, f"{prefix}{batch_id}", base, error_count=errors, compression=compression)
        finally:
            parsed.unpersist()

    writer = messages.writeStream.foreachBatch(write).option(
        "checkpointLocation", f"{base}/_stream"
    )
    trigger = {"availableNow": True} if drain else {"processingTime": batch_age}
    return writer.trigger(**trigger).start()


def read_batches(
    spark: SparkSession, base: str, fmt: str = "json", schema: T.StructType = RAW_SCHEMA
) -> DataFrame:
    """Records of all manifested batches, with year, month and batch_id from the folder names.

    Folders without a manifest row, left by an attempt that did not finish, are not read. A batch whose
    CSV copy could not be written is read from its JSON copy.
    """
    # before the folders are listed, so that every batch named here is among them
    manifest = read_manifest(spark, base)
    if fmt == "json":
        return _records(spark, base, "json", schema, manifest)
    saved = _records(spark, base, "csv", schema, manifest.filter("csv_saved"))
    unsaved = manifest.filter("NOT csv_saved")
    if unsaved.isEmpty():
        return saved
    return saved.unionByName(_records(spark, base, "json", schema, unsaved))


def _records(spark: SparkSession, base: str, fmt: str, schema: T.StructType, manifest: DataFrame) -> DataFrame:
    """Records of the manifest's batches from their copies in one format."""
    zones = T.StructType([*schema.fields, *[T.StructField(c, T.StringType()) for c in FOLDER_PARTS]])
    path = f"{base}/raw/{fmt}"
    if fmt == "csv":
        records = read_csv_by_name(spark, [path], zones)
    else:
        records = spark.read.schema(zones).json(path)
    done = manifest.select(*[folder_part(F.col(f"{fmt}_path"), c).alias(f"_{c}") for c in FOLDER_PARTS])
    # on the partition columns themselves, so folders without a manifest row need not be opened
    same = (
        (F.col("year") == F.col("_year"))
        & (F.lpad("month", 2, "0") == F.col("_month"))
        & (F.col("batch_id") == F.col("_batch_id"))
    )
    found = records.join(done, same, "left_semi")
    return found.withColumn("month", F.lpad("month", 2, "0"))


def compact(
    spark: SparkSession,
    base: str,
    least_records: int | None = None,
    schema: T.StructType | None = None,
    compression: str = "none",
) -> int:
    """Rewrite the batches of each month as one batch of few files; returns how many were replaced.

    `least_records` leaves larger batches as they are. Fields and types of the records are taken from
    their JSON texts, unless a schema names them. The CSV copies of a month are joined if all were saved;
    else the new batch has none and is read from JSON. The new manifest rows are written last, as one file:
    until then nothing counts, and a run that died leaves only folders that are never read. The replaced
    folders stay until `remove_replaced`, for readers that have begun. One compaction runs at a time;
    ingests may go on.
    """
    manifest = stored(read_manifest(spark, base), "manifest")
    if least_records is not None:
        manifest = manifest.filter(F.col("record_count") < least_records)
    dated = manifest.withColumns({c: folder_part(F.col("json_path"), c) for c in ("year", "month")})
    name = f"compact-{uuid.uuid4().hex}"
    # a name of its own for each month, since batches are replaced by name
    batch = F.concat(F.lit(f"{name}-"), "year", "month")
    folder = F.concat(F.lit("/year="), "year", F.lit("/month="), "month", F.lit("/batch_id="), batch)
    months = stored(
        dated.groupBy("year", "month")
        .agg(
            F.count("*").alias("batches"),
            F.sum("record_count").alias("record_count"),
            F.sum("error_count").alias("error_count"),
            F.max("timestamp").alias("timestamp"),
            F.every("csv_saved").alias("csv_saved"),
            F.first("data_source").alias("data_source"),
            F.max("schema_version").alias("schema_version"),
            F.collect_list("batch_id").alias(REPLACES),
        )
        .filter("batches > 1")
        .withColumns({f"{fmt}_path": F.concat(F.lit(f"raw/{fmt}"), folder) for fmt in ("json", "csv")}),
        "compaction",
    )
    replaced = months.agg(F.sum("batches")).first()[0] or 0
    if not replaced:
        return 0
    chosen = months.filter("record_count > 0").select("csv_saved", "year", "month", F.explode(REPLACES).alias("batch_id"))
    written = []
    for fmt in ("json", "csv"):
        own = chosen.filter("csv_saved") if fmt == "csv" else chosen
        if own.isEmpty():
            continue
        path = f"{base}/raw/{fmt}"
        if fmt == "csv":
            text = spark.read.options(**CSV_OPTIONS).csv(path).columns
            fields = [T.StructField(c, T.StringType()) for c in text]
        else:
            fields = schema.fields if schema else spark.read.json(path).schema.fields
        fields = [f for f in fields if f.name not in FOLDER_PARTS]
        data = [f.name for f in fields]
        reader = spark.read.schema(T.StructType([*fields, *[T.StructField(c, T.StringType()) for c in FOLDER_PARTS]]))
        rows = reader.json(path) if fmt == "json" else reader.options(**CSV_OPTIONS, enforceSchema=False).csv(path)
        rows = rows.withColumn("month", F.lpad("month", 2, "0")).join(own.drop("csv_saved"), list(FOLDER_PARTS), "left_semi")
        parts = rows.select(*data, "year", "month", batch.alias("batch_id")).hint("rebalance", "year", "month")
        writer = parts.write.mode("append").option("compression", compression).partitionBy(*FOLDER_PARTS)
        if fmt == "json":
            writer.option("ignoreNullFields", False).json(path)
        else:
            writer.options(**CSV_OPTIONS).csv(path)
        written.append(f"{path}/*/*/batch_id={name}-*")
    filled = months.filter("record_count > 0").agg(F.collect_list("json_path").alias("paths"), F.sum("record_count").alias("said")).first()
    said = filled["said"] or 0
    copied = spark.read.text([f"{base}/{path}" for path in filled["paths"]]).count() if said else 0
    if copied != said:
        raise RuntimeError(f"{copied} records were copied, the manifests have {said}")
    fields = [c for c in WITH_REPLACED.fieldNames() if c != "batch_id"]
    manifest_path = f"{manifest_folder(base)}/{name}"
    months.select(*fields).coalesce(1).write.json(manifest_path)
    file_index.add(spark, f"{base}/raw", [*written, manifest_path], name)
    return replaced


def remove_replaced(spark: SparkSession, base: str, before: dt.datetime) -> int:
    """Remove the folders of batches replaced by compactions written before a time; returns how many.

    Choose the time so that all readers that began before the compactions have ended.
    """
    rows = spark.read.schema(WITH_REPLACED).option("recursiveFileLookup", True).json(manifest_folder(base))
    written = F.col("_metadata.file_modification_time") < F.lit(before)
    old = rows.filter(written).select(F.explode(REPLACES).alias("batch_id"))
    gone = all_manifests(spark, [manifest_folder(base)]).join(old, "batch_id", "left_semi")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    removed = 0
    for row in gone.select("batch_id", "json_path", "csv_path").toLocalIterator():
        # the data first: a manifest row without data would count again if its replacement were lost
        for folder in (row.json_path, row.csv_path, f"raw{MANIFEST_FOLDER}batch_id={row.batch_id}"):
            path = jvm.org.apache.hadoop.fs.Path(f"{base}/{folder}")
            path.getFileSystem(conf).delete(path, True)
        removed += 1
    return removed
