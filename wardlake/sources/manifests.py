"""Manifest rows of ingested batches: which folders count, and compactions that replace others.

Every batch has a manifest row in a folder of its own. A compaction writes the rows of its batches in one
file of one row a month, which also names the batches they replace. The file appears at once, so a reader
finds the replaced batches or those that replace them, never both: it reads the manifests first and lists
the data afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlake.schema import MANIFEST_SCHEMA

MANIFEST_FOLDER = "/manifest/"
REPLACES = "replaces"
WITH_REPLACED = T.StructType([*MANIFEST_SCHEMA.fields, T.StructField(REPLACES, T.ArrayType(T.StringType()))])
# The folder of a batch, below the base of its ingest, and the parts of its name.
BATCH_PATH = r"raw/(?:json|csv)/year=([^/]+)/month=([^/]+)/batch_id=([^/]+)"
FOLDER_PARTS = ("year", "month", "batch_id")


def folder_part(path: Column, part: str) -> Column:
    """Year, month or batch id of a batch's folder, from any path into it."""
    return F.regexp_extract(path, BATCH_PATH, FOLDER_PARTS.index(part) + 1)


def manifest_folder(base: str) -> str:
    return f"{base}/raw{MANIFEST_FOLDER}".rstrip("/")


def all_manifests(spark: SparkSession, folders: list[str]) -> DataFrame:
    """Every row below the manifest folders, replaced or not."""
    rows = spark.read.schema(WITH_REPLACED).option("recursiveFileLookup", True).json(folders)
    # the folder name carries the batch id
    return rows.withColumn("batch_id", folder_part(F.col("json_path"), "batch_id"))


def live_manifests(spark: SparkSession, folders: list[str]) -> DataFrame:
    """The rows that count: those that no compaction has replaced."""
    rows = all_manifests(spark, folders)
    replaced = rows.select(F.explode(REPLACES).alias("_replaced"))
    return rows.join(replaced, F.col("batch_id") == F.col("_replaced"), "left_anti").drop(REPLACES)


def read_manifest(spark: SparkSession, base: str) -> DataFrame:
    """The manifest of one ingest: a row for every batch that counts."""
    return live_manifests(spark, [manifest_folder(base)])
