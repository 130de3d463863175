"""Lake files: scans by format, the raw-zone load, inventory and export."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlake.schema import RAW_SCHEMA
from wardlake.sources.file_index import files_below
from wardlake.sources.manifests import MANIFEST_FOLDER, live_manifests

# Names that mark files which are not data.
MANIFEST_SUFFIX = "metadata.json"
CSV_OPTIONS = {"header": True, "escape": '"'}
PLACEHOLDER_SUFFIX = ".placeholder"
# Compressed files are read like plain ones.
PACKED = "gz,bz2,zst,lz4,snappy,deflate"
DATA_FILE = r"\.(json|csv)(\.(" + PACKED.replace(",", "|") + r"))?$"
# The folder of an ingested batch, which counts only with a manifest row.
BATCH_FOLDER = r"(raw/(?:json|csv)/year=[^/]+/month=[^/]+/batch_id=[^/]+)/"


def file_format(path: str, fmt: str = "csv") -> str:
    """`auto` goes by the suffix; whatever is not Parquet or JSON counts as CSV."""
    if fmt != "auto":
        return fmt
    name = path.lower().rstrip("/")
    return next((f for f in ("parquet", "json") if name.endswith(f".{f}")), "csv")


def read_lake(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "csv",
    schema: T.StructType | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Scan one path or several. Paths may be percent-encoded.

    With a schema the files are not read twice for inference. `multi_line` is for JSON files that
    hold one pretty-printed array; JSON Lines files stay splittable without it.
    """
    paths = [unquote(p) for p in ([path] if isinstance(path, str) else path)]
    fmt = file_format(paths[0], fmt)
    reader = spark.read if schema is None else spark.read.schema(schema)
    if fmt == "parquet":
        return reader.parquet(*paths)
    if fmt == "json":
        return reader.option("multiLine", multi_line).json(paths)
    if schema is not None:
        groups = [read_csv_by_name(spark, group, schema) for group in same_header(spark, paths)]
    else:
        by_name = spark.read.options(**CSV_OPTIONS, enforceSchema=False, inferSchema=True)
        groups = [by_name.csv(group) for group in same_header(spark, paths)]
    return union_files(groups)


def same_header(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """The named CSV paths grouped by their header line, in order of appearance.

    Files below one path share a header; where they do not, the read ends with an error.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        header = spark.read.options(**CSV_OPTIONS).csv(path).columns if len(paths) > 1 else ()
        groups.setdefault(tuple(header), []).append(path)
    return list(groups.values())


def read_csv_by_name(
    spark: SparkSession,
    paths: list[str],
    schema: T.StructType,
    with_path: str | None = None,
    **options,
) -> DataFrame:
    """CSV columns matched to the schema by header, whatever their order in the files.

    Only one header line is read up front. A file whose header differs from it is an error, not a
    silent shift of columns. Columns the files lack are null. `with_path` names a column for the path
    of each row's file.
    """
    reader = spark.read.options(**CSV_OPTIONS, **options).option("enforceSchema", False)
    text = reader.csv(paths)
    if any(not isinstance(f.dataType, T.StringType) for f in text.schema):
        # names of folders keep their leading zeros only as text
        text = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in text.columns])).csv(paths)
    return text.select(
        *[
            (F.col(f"`{f.name}`") if f.name in text.columns else F.lit(None))
            .try_cast(f.dataType)
            .alias(f.name)
            for f in schema
        ],
        *([F.col("_metadata.file_path").alias(with_path)] if with_path else []),
    )


def union_files(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames, matched by column name; a column missing somewhere is null there."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def _is_data(path: Column) -> Column:
    manifest = path.endswith(MANIFEST_SUFFIX) | path.contains(MANIFEST_FOLDER)
    return path.rlike(DATA_FILE) & ~manifest


def _manifested(live: DataFrame, fmt: str, records: DataFrame, path: Column) -> DataFrame:
    """Records outside of batch folders, and those of batches with a manifest row that counts."""
    done = live.select(F.explode(F.array(f"{fmt}_path", F.lit(""))).alias("_done")).distinct()
    folder = F.regexp_extract(path, BATCH_FOLDER, 1)
    return records.withColumn("_folder", folder).join(done, F.col("_folder") == F.col("_done"), "left_semi")


def load_raw(
    spark: SparkSession,
    base: str,
    schema: T.StructType = RAW_SCHEMA,
    multi_line: bool = False,
) -> DataFrame:
    """All raw records below `base`: JSON files if there are any, else CSV, plain or compressed.

    If the ingest has left manifests below `base`, only its manifested batches count, so an attempt
    that did not finish adds nothing. There are no file or row caps. Which files there are is read from
    the folder's index, if it has one, so only Spark's reader lists them.
    """
    data = _is_data(F.col("path"))
    kinds = files_below(spark, base).agg(
        F.count_if(F.col("path").rlike(r"\.json(\.|$)") & data).alias("json"),
        F.count_if(F.col("path").rlike(r"\.csv(\.|$)") & data).alias("csv"),
        # one folder per ingest
        F.collect_set(F.regexp_extract("path", f"^(.*?{MANIFEST_FOLDER})", 1)).alias("manifests"),
    )
    found = kinds.first()
    fmt = "json" if found["json"] else "csv"
    if not found[fmt]:
        raise FileNotFoundError(f"no data files below {base}")
    live = None
    if manifests := [folder for folder in found["manifests"] if folder]:
        # before the data is listed, so that every batch named here is among them
        live = live_manifests(spark, manifests)
        if fmt == "csv" and not live.filter("NOT csv_saved AND record_count > 0").isEmpty():
            raise FileNotFoundError(f"a batch below {base} has neither a JSON nor a CSV copy")
    below = {"recursiveFileLookup": True, "pathGlobFilter": f"*.{fmt}{{,.{PACKED.replace(',', ',.')}}}"}
    path = F.col("_metadata.file_path")
    if fmt == "csv":
        records = read_csv_by_name(spark, [base], schema, with_path="_path", **below)
        path = F.col("_path")
    else:
        records = spark.read.schema(schema).options(**below).option("multiLine", multi_line).json(base)
        records = records.filter(_is_data(path))
    if live is not None:
        records = _manifested(live, fmt, records, path)
    return records.select(*schema.fieldNames())


def pick_main_file(spark: SparkSession, folder: str) -> DataFrame:
    """The largest CSV dataset in a folder, as one row of path and length.

    A dataset is a file, or a folder named `*.csv` with all the part files in it.
    """
    dataset = F.regexp_extract("path", r"(?i)^(.*?\.csv(?:\.[a-z0-9]+)?)(?:/|$)", 1)
    return (
        files_below(spark, folder)
        .filter(F.col("path").rlike(r"(?i)\.csv(\.[a-z0-9]+)?$"))
        .groupBy(dataset.alias("path"))
        .agg(F.sum("length").alias("length"))
        .orderBy(F.desc("length"), "path")
        .limit(1)
    )


def has_enough_data(spark: SparkSession, base: str, min_files: int = 3) -> bool:
    """Whether at least `min_files` data files, manifests not counted, lie below `base`."""
    return files_below(spark, base).filter(_is_data(F.col("path"))).limit(min_files).count() >= min_files


def zone_and_format(files: DataFrame, base: str) -> DataFrame:
    """Files with their zone, the folder directly below `base`, and their format, the suffix of the name.

    The format of a compressed file is that of its contents.
    """
    suffix = F.regexp_extract("path", rf"\.([A-Za-z0-9]+)(?:\.(?:{PACKED.replace(',', '|')}))?$", 1)
    # the path of a file is the scheme, the base and what lies below it
    start = re.sub(r"^[a-zA-Z0-9]+:/+", "", unquote(base).rstrip("/")).lstrip("/") + "/"
    below = F.col("path").substr(F.locate(start, "path") + F.lit(len(start)), F.length("path"))
    zone = F.when(below.contains("/"), F.substring_index(below, "/", 1))
    return files.withColumns({"zone": zone, "format": suffix})


def lake_inventory(spark: SparkSession, base: str) -> DataFrame:
    """Files and bytes by zone (folder directly below `base`) and format, without placeholders."""
    files = files_below(spark, base).filter(~F.col("path").endswith(PLACEHOLDER_SUFFIX))
    return (
        zone_and_format(files, base)
        .groupBy("zone", "format")
        .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
        .orderBy("zone", "format")
    )


def export_csv(df: DataFrame, path: str, compression: str = "none") -> str:
    """Write a result as CSV with a header, plain or compressed."""
    df.write.mode("overwrite").options(**CSV_OPTIONS, compression=compression).csv(path)
    return path
