"""The processed zone: the typed discharge relation kept as Parquet, partitioned by year.

The catalogue reads this table instead of raw text, so its scans prune columns, skip row groups
by the pushed filters, and never repeat the text cleaning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from wardlake.schema import CATEGORICALS, NUMERIC_FEATURES, TARGETS

PROCESSED_SCHEMA = T.StructType(
    [T.StructField("record_id", T.LongType())]
    + [T.StructField(name, T.StringType()) for name in CATEGORICALS]
    + [T.StructField("payment_typology_1", T.StringType())]
    + [T.StructField(name, T.DoubleType()) for name in NUMERIC_FEATURES + TARGETS]
    + [T.StructField("discharge_year", T.IntegerType())]
)


def write_processed(processed: DataFrame, base: str) -> str:
    """Write the typed relation under `base`/processed and return that path.

    The rebalance hint lets Spark split a hot year and merge thin ones into files of even size.
    """
    path = f"{base}/processed"
    (
        processed.select(PROCESSED_SCHEMA.fieldNames())
        .hint("rebalance", "discharge_year")
        .write.mode("overwrite")
        .partitionBy("discharge_year")
        .parquet(path)
    )
    return path


def read_processed(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema(PROCESSED_SCHEMA).parquet(f"{base}/processed")
