"""Row cleaning, filters and splits of the raw and processed relations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlake.functions.cleaning import (
    clean_numeric,
    finite_or_null,
    nan_to_null,
    normalised_name,
    to_double,
    unknown_if_null,
)
from wardlake.schema import ROW_SOURCE, TARGETS

FLOATING = (T.FloatType, T.DoubleType)


def _floating(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, FLOATING)]


def clean_rows(df: DataFrame) -> DataFrame:
    """NaN becomes null; decimals and floats become double, whole numbers stay whole."""
    fractional = [f.name for f in df.schema if isinstance(f.dataType, T.FractionalType)]
    return df.withColumns({name: nan_to_null(F.col(name).cast("double")) for name in fractional})


def with_ingest_meta(df: DataFrame, source: str = ROW_SOURCE) -> DataFrame:
    return df.withColumns({"processed_timestamp": F.current_timestamp(), "source": F.lit(source)})


def normalise_columns(df: DataFrame) -> DataFrame:
    """Rename all columns to lower snake_case; two names that would merge are an error."""
    names = [normalised_name(c) for c in df.columns]
    doubled = sorted({n for n in names if names.count(n) > 1})
    if doubled:
        raise ValueError(f"column names collide after normalisation: {doubled}")
    return df.toDF(*names)


def clean_targets(df: DataFrame, targets: list[str] = TARGETS) -> DataFrame:
    """Add <target>_numeric. Text is stripped of stray signs, numbers are only cast."""
    types = dict(df.dtypes)
    return df.withColumns(
        {
            f"{t}_numeric": (clean_numeric if types[t] == "string" else to_double)(F.col(t))
            for t in targets
            if t in types
        }
    )


def fill_unknown(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: unknown_if_null(F.col(c)) for c in columns})


def valid_target(df: DataFrame, target: str) -> DataFrame:
    """Rows whose target is known and positive."""
    return df.filter(F.col(target) > 0)


def sanitise(df: DataFrame) -> DataFrame:
    """Results fit for JSON: NaN and infinities become null."""
    return df.withColumns({name: finite_or_null(F.col(name)) for name in _floating(df)})


def filter_gt(df: DataFrame, column: str, bound: float) -> DataFrame:
    return df.filter(F.col(column) > bound)


def filter_since(df: DataFrame, column: str, day: dt.date) -> DataFrame:
    return df.filter(F.col(column) >= F.lit(day))


def filter_like(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.filter(F.col(column).like(f"%{pattern}%"))


def top_by(df: DataFrame, column: str, tiebreak: str, n: int = 50) -> DataFrame:
    return df.orderBy(F.desc(column), tiebreak).limit(n)


def basic_aggregates(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.avg(column).alias("avg_value"),
        F.max(column).alias("max_value"),
        F.min(column).alias("min_value"),
    )


def cap_training_rows(df: DataFrame, rows: int | None = None, seed: int = 42) -> DataFrame:
    """Uniform sample of about `rows` rows; without a number all rows are kept.

    The fraction is `rows` over the counted rows, taken from a scalar subquery. Each row is kept
    or not by a hash of its id, so a lost task redoes the same choice.
    """
    if rows is None:
        return df
    fraction = F.try_divide(F.lit(float(rows)), F.count("*"))
    share = df.agg(F.least(F.lit(1.0), fraction).alias("share")).scalar()
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("record_id")), F.lit(1 << 30)) / float(1 << 30)
    return df.filter(draw < share)


def in_holdout(seed: int = 42):
    """One row in ten, chosen by a hash of the record id: the split survives repartitioning."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col("record_id")), F.lit(10)) == 0


def split_holdout(df: DataFrame, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """90 % training rows and 10 % test rows."""
    return df.filter(~in_holdout(seed)), df.filter(in_holdout(seed))
