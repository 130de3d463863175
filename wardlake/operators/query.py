"""SQL over files and views, with results fit for JSON."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from wardlake.operators.rows import sanitise
from wardlake.sources.lake import read_lake


def _result(df: DataFrame, limit: int | None) -> DataFrame:
    """All rows, or as many as the caller names; a LIMIT in the statement is part of its plan."""
    clean = sanitise(df)
    return clean if limit is None else clean.limit(limit)


def query_frame(
    source: DataFrame, sql: str | None = None, limit: int | None = None
) -> DataFrame:
    """Run SQL in which {table} stands for `source`; without SQL, all its columns."""
    if sql is None:
        return _result(source, limit)
    name = f"lake_{uuid.uuid4().hex}"
    source.createOrReplaceTempView(name)
    try:
        df = source.sparkSession.sql(sql.replace("{table}", name).rstrip().rstrip(";"))
    finally:
        # the analysed plan no longer needs the name
        source.sparkSession.catalog.dropTempView(name)
    return _result(df, limit)


def query_file(
    spark: SparkSession,
    path: str,
    sql: str | None = None,
    fmt: str = "csv",
    limit: int | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    return query_frame(read_lake(spark, path, fmt, schema), sql, limit)


def create_view(
    spark: SparkSession, name: str, path: str, fmt: str = "csv", schema: T.StructType | None = None
) -> None:
    read_lake(spark, path, fmt, schema).createOrReplaceTempView(name)


def query_view(
    spark: SparkSession, name: str, sql: str | None = None, limit: int | None = None
) -> DataFrame:
    return _result(spark.table(name) if sql is None else spark.sql(sql), limit)


def run_sql(spark: SparkSession, sql: str, limit: int | None = None) -> DataFrame:
    return _result(spark.sql(sql), limit)


def describe(
    spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType | None = None
) -> DataFrame:
    """Column names and types of a file."""
    name = f"lake_{uuid.uuid4().hex}"
    create_view(spark, name, path, fmt, schema)
    try:
        return spark.sql(f"DESCRIBE QUERY SELECT * FROM {name}").select("col_name", "data_type")
    finally:
        spark.catalog.dropTempView(name)
