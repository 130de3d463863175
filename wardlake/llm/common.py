"""Small helpers that several text operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.session import scratch_path

# A side with at most this many rows of bounded width may be broadcast; larger ones are shuffled.
BROADCAST_ROWS = 200_000


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is.

    `lower` also changes letters beyond ASCII, so it only serves texts that have none.
    """
    only_ascii = F.length(text) == F.octet_length(text)
    changed = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(only_ascii, F.lower(text)).otherwise(changed)


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text falls into the given part; a null id never does."""
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(crc % parts == part, F.lit(False))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, outlives lost executors."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, rows: int = 1_000, size: str = "8m") -> None:
    """Let the session hand texts to Python workers in batches of at most so many rows and bytes.

    Spark's own limit is 10,000 rows. A batch is held by the executor, outside its heap, and by the worker;
    documents are long, and the heap that a chain of jobs has grown to leaves little room beside it.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a frame has at most `rows` rows; looks at no more than it must."""
    return df.limit(rows + 1).count() <= rows


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting; otherwise Spark shuffles both sides."""
    return F.broadcast(df) if small(df, rows) else df
