"""Column profiles that read each column once or twice, whatever the number of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlake.functions.reporting import percent_of


def _count_per_field(df: DataFrame, fields: list[str], name: str, counted) -> DataFrame:
    """One aggregate row over all fields, turned into one row per field."""
    wide = df.agg(
        F.count("*").alias("total"), *[counted(F.col(f)).alias(f"{f}|n") for f in fields]
    )
    entries = [
        F.struct(
            F.lit(f).alias("field_name"),
            F.col("total").alias("total_records"),
            F.col(f"`{f}|n`").alias(name),
        )
        for f in fields
    ]
    return wide.select(F.inline(F.array(*entries)))


def completeness_of(df: DataFrame, fields: list[str]) -> DataFrame:
    """Non-null share of each field."""
    share = percent_of(F.col("non_null_records"), F.col("total_records"))
    return (
        _count_per_field(df, fields, "non_null_records", F.count)
        .withColumn("completeness_pct", share)
        .orderBy(F.desc("completeness_pct"), "field_name")
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Null count and share of every column."""
    share = percent_of(F.col("null_records"), F.col("total_records"))
    return (
        _count_per_field(df, df.columns, "null_records", lambda c: F.count_if(c.isNull()))
        .withColumn("null_pct", share)
        .orderBy(F.desc("null_pct"), "field_name")
    )


# The widest span of numbers that is counted in bitmaps: 1,024 of them, 4 MB for a task and column.
BITMAP_SPAN = 1 << 25
# Numbers that are whole when multiplied by one of these are counted by their multiples.
SCALES = (1, 100)
FACTS = ["total_records", "non_null_records", "min_text", "max_text", "min_number", "max_number", "mean", "stddev"]


def _facts(name: str, numeric: bool) -> list[Column]:
    """The aggregates of FACTS; text and numbers have columns of their own."""
    value = F.col(f"`{name}`")
    number = value.cast("double")
    no_text, no_number = F.lit(None).cast("string"), F.lit(None).cast("double")
    text = [F.min(value).cast("string"), F.max(value).cast("string"), *[no_number] * 4]
    numbers = [no_text, no_text, F.min(number), F.max(number), F.avg(number), F.stddev_samp(number)]
    return [F.count("*"), F.count(value), *(numbers if numeric else text)]


def _multiple(name: str, scale: int) -> Column:
    return F.round(F.col(f"`{name}`").cast("double") * scale)


def _bitmap_scale(found: dict, name: str) -> int | None:
    """The smallest scale at which all numbers are whole and span few enough bitmaps."""
    low, high = found[f"{name}|min_number"], found[f"{name}|max_number"]
    for scale in SCALES:
        # NaN and infinite values fail the comparison
        if found[f"{name}|{scale}"] and max(-low, high) * scale < 1 << 53 and (high - low) * scale < BITMAP_SPAN:
            return scale
    return None


def _distinct_counts(df: DataFrame, found: dict) -> DataFrame:
    """(field_name, distinct_values) of all columns, each of which is read by one of two scans.

    Numbers in a narrow span are bits of bitmaps, which are joined before and after the shuffle. All other
    values go through it once for each task: numbers as numbers, texts as texts.
    """
    bits, values = [], []
    kinds = {f.name: f.dataType for f in df.schema}
    for field, (name, kind) in enumerate(kinds.items()):
        column = F.col(f"`{name}`")
        scale = _bitmap_scale(found, name) if isinstance(kind, T.NumericType) else None
        if scale is not None:
            bits.append(F.struct(F.lit(field).alias("field"), _multiple(name, scale).cast("bigint").alias("code")))
            continue
        whole = isinstance(kind, T.IntegralType)
        real = isinstance(kind, (T.DoubleType, T.FloatType))
        values.append(
            F.struct(
                F.lit(field).alias("field"),
                (column.cast("bigint") if whole else F.lit(None).cast("bigint")).alias("whole"),
                # 0.0 and -0.0 are one value
                (column.cast("double") + F.lit(0.0) if real else F.lit(None).cast("double")).alias("real"),
                (F.lit(None).cast("string") if whole or real else column.cast("string")).alias("text"),
            )
        )
    counts = []
    if bits:
        codes = df.select(F.inline(F.array(*bits))).filter("code is not null")
        maps = codes.groupBy("field", F.bitmap_bucket_number("code").alias("bucket")).agg(
            F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("code"))).alias("held")
        )
        counts.append(maps.groupBy("field").agg(F.sum("held").alias("distinct_values")))
    if values:
        pairs = df.select(F.inline(F.array(*values))).filter("whole is not null or real is not null or text is not null")
        single = pairs.groupBy("field", "whole", "real", "text").agg(F.lit(1).alias("one"))
        counts.append(single.groupBy("field").agg(F.count("*").alias("distinct_values")))
    names = F.array(*[F.lit(name) for name in kinds])
    every = counts[0] if len(counts) == 1 else counts[0].unionByName(counts[1])
    return every.select(names[F.col("field")].alias("field_name"), "distinct_values")


def column_profile(df: DataFrame) -> DataFrame:
    """Type, counts, extremes, mean and spread of every column.

    A first scan, which runs at once, gives one row with everything but the distinct counts, and tells
    which columns hold numbers in a narrow span. Then every column is read once more for its distinct values.
    """
    numeric = {f.name: isinstance(f.dataType, T.NumericType) for f in df.schema}
    aggregates = []
    for name in df.columns:
        aggregates += [c.alias(f"{name}|{fact}") for c, fact in zip(_facts(name, numeric[name]), FACTS)]
        if numeric[name]:
            number = F.col(f"`{name}`").cast("double")
            for scale in SCALES:
                exact = (_multiple(name, scale) / scale).eqNullSafe(number)
                aggregates.append(F.every(exact).alias(f"{name}|{scale}"))
    wide = df.agg(*aggregates)
    row = wide.first()
    found = {name: value for name, value in row.asDict().items()}
    for name in df.columns:  # a column without a number spans nothing
        if numeric[name] and found[f"{name}|min_number"] is None:
            found |= {f"{name}|{s}": False for s in SCALES}
    spark = df.sparkSession
    entries = [(name, kind, *[found[f"{name}|{fact}"] for fact in FACTS]) for name, kind in df.dtypes]
    schema = "field_name string, data_type string, total_records bigint, non_null_records bigint, min_text string, max_text string, "
    schema += "min_number double, max_number double, mean double, stddev double"
    return (
        spark.createDataFrame(entries, schema)
        .join(_distinct_counts(df, found), "field_name", "left")
        .withColumn("distinct_values", F.coalesce("distinct_values", F.lit(0)))
        .orderBy("field_name")
    )
