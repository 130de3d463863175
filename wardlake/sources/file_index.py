"""An index of the files of a lake folder: path, size and time, kept as a table next to them.

Whoever writes files adds them by listing only the folders it wrote; an addition is one file, so it is
there as a whole or not at all, and adding one of the same name again replaces it. `refresh` lists
everything once as the new base of the index, so files that came or went by other ways are known too, and
additions from before that listing no longer count. Readers take the newest row of each path and list
nothing. As Spark's listings do, the index passes over files without bytes.
"""

from __future__ import annotations

import time
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.session import stored

# A hidden folder: Spark's readers pass over names that begin with an underscore.
INDEX_FOLDER = "_files"
FILE = "path string, length bigint, modificationTime timestamp"
ROW = f"{FILE}, added bigint"
MARKER = "base string, started bigint"


def list_files(spark: SparkSession, folders: str | list[str]) -> DataFrame:
    """Path, size and time of every file below the folders, by listing them; contents are not read."""
    paths = [unquote(f) for f in ([folders] if isinstance(folders, str) else folders)]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    return files.select("path", "length", "modificationTime")


def _folder(base: str, name: str) -> str:
    return f"{unquote(base)}/{INDEX_FOLDER}/{name}"


def _read(spark: SparkSession, base: str, name: str, schema: str, fmt: str) -> DataFrame | None:
    """A table of the index; None before its first row."""
    try:
        return spark.read.schema(schema).option("recursiveFileLookup", True).format(fmt).load(_folder(base, name))
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return None


def _newest_base(spark: SparkSession, base: str):
    markers = _read(spark, base, "markers", MARKER, "json")
    return None if markers is None else markers.agg(F.max_by(F.struct("base", "started"), "started").alias("m")).first()["m"]


def read_index(spark: SparkSession, base: str) -> DataFrame | None:
    """The files of the folder as the index has them; None where there is no index."""
    marker = _newest_base(spark, base)
    added = _read(spark, base, "additions", ROW, "parquet")
    if marker is None and added is None:
        return None
    rows = spark.createDataFrame([], ROW) if added is None else added
    if marker is not None:
        rows = rows.filter(F.col("added") >= marker["started"])
        rows = spark.read.schema(ROW).parquet(_folder(base, f"bases/{marker['base']}")).unionByName(rows)
    newest = rows.groupBy("path").agg(F.max_by(F.struct("length", "modificationTime"), "added").alias("newest"))
    return newest.select("path", "newest.*")


def files_below(spark: SparkSession, base: str) -> DataFrame:
    """The files of a folder from its index, or by listing them where there is none."""
    index = read_index(spark, base)
    return list_files(spark, base) if index is None else index


def add(spark: SparkSession, base: str, folders: list[str], name: str) -> None:
    """Add the files of some folders below `base`, which were just written."""
    rows = list_files(spark, folders).withColumn("added", F.lit(time.time_ns()))
    rows.coalesce(1).write.mode("overwrite").parquet(_folder(base, f"additions/{name}"))


def refresh(spark: SparkSession, base: str) -> int:
    """Make one listing the base of the index; returns how many files the index had not or otherwise.

    What no longer counts stays for readers that have begun, and goes with the next refresh. One refresh
    runs at a time; additions may go on.
    """
    before = _newest_base(spark, base)
    known = read_index(spark, base)
    known = spark.createDataFrame([], FILE) if known is None else known
    known = stored(known.select("path", F.col("length").alias("l"), F.col("modificationTime").alias("t")), "known-files")
    started = time.time_ns()
    name = f"base-{started}"
    found = list_files(spark, base).withColumn("added", F.lit(started))
    found.write.parquet(_folder(base, f"bases/{name}"))
    marker = spark.createDataFrame([(name, started)], MARKER)
    marker.coalesce(1).write.json(_folder(base, f"markers/{name}"))
    if before is not None:
        _remove_older(spark, base, before["base"], before["started"])
    held = spark.read.schema(ROW).parquet(_folder(base, f"bases/{name}"))
    same = F.col("length").eqNullSafe(F.col("l")) & F.col("modificationTime").eqNullSafe(F.col("t"))
    return held.join(known, "path", "full").filter(~same).count()


def _remove_older(spark: SparkSession, base: str, kept: str, started: int) -> None:
    """Remove bases before the one named, and additions that were written before it began."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(_folder(base, "")).getFileSystem(spark._jsc.hadoopConfiguration())
    for table in ("bases", "markers", "additions"):
        folder = path(_folder(base, table))
        for status in files.listStatus(folder) if files.exists(folder) else []:
            name = status.getPath().getName()
            is_old = status.getModificationTime() * 1_000_000 < started if table == "additions" else name < kept
            if is_old:
                files.delete(status.getPath(), True)
