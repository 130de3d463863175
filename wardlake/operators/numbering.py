"""Dense numbering of all rows in any order, and count-based batches, without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlake.session import stored, unused

# Ranges with more rows are cut again.
RANGE_ROWS = 1 << 24
# monotonically_increasing_id has the partition above these bits and the row in it below.
ROW_BITS = 33

Order = str | Column | list[str | Column]


def _hashable(kind: T.DataType) -> bool:
    """Whether a value of this type can be hashed: a map has no order of its own."""
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind)
    return not isinstance(kind, (T.MapType, T.VariantType))


def number_records(
    df: DataFrame, order: Order, name: str = "record_no", required: bool = False, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """Add 0, 1, 2, ... in the order of one or several keys of any type, nulls first.

    Rows with equal keys are placed by a hash of all their columns and then by position, so they get
    different numbers, a key that a third of all rows share is cut into several ranges, and a task that is
    run again can only swap rows that are equal throughout. With `required`, a row without a key ends the
    job with an error instead.

    Rows are dealt into ranges of the order, sorted there and written to the shared folder with their
    range and their place in it. The rows of each range, one number a range, give the first number of the
    next one. If a range has more than `range_rows` rows, the rows are dealt again into more ranges. The
    input is read twice: for Spark's sample of the keys and for the rows.
    """
    keys = [order] if isinstance(order, (str, Column)) else list(order)
    keys = [F.col(k) if isinstance(k, str) else k for k in keys]
    content, place, range_, inside, first = unused(df, "content", "place", "range", "inside", "first")
    hashed = [F.col(f"`{f.name}`") for f in df.schema if _hashable(f.dataType)]
    source = df
    if required:
        missing = F.exists(F.array(*[k.isNull() for k in keys]), lambda x: x)
        text = F.raise_error(F.lit(f"a record has no {order}")).cast("boolean")
        source = df.filter(F.when(missing, text).otherwise(F.lit(True)))
    placed = source.withColumns({content: F.xxhash64(*hashed), place: F.monotonically_increasing_id()})
    by = [*keys, content, place]
    columns = [F.col(f"`{c}`") for c in df.columns]
    at = F.monotonically_increasing_id()
    ranges: list[int] = []
    while True:
        dealt = placed.repartitionByRange(*ranges, *by).sortWithinPartitions(*by)
        held = stored(
            dealt.select(
                *columns,
                F.shiftright(at, ROW_BITS).cast("int").alias(range_),
                at.bitwiseAND((1 << ROW_BITS) - 1).alias(inside),
            ),
            "numbered",
        )
        sizes = stored(held.groupBy(range_).agg((F.max(inside) + 1).alias("rows")), "range-sizes")
        found = sizes.agg(F.max("rows").alias("most"), F.sum("rows").alias("all"), F.count("*").alias("n")).first()
        if (found["most"] or 0) <= range_rows:
            break
        # the sample that cuts the ranges leaves them uneven
        ranges = [max(2 * found["n"], 2 * -(-found["all"] // range_rows))]
    earlier = Window.orderBy(range_).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(range_, F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias(first))
    # one row for each task that wrote a range
    return held.join(F.broadcast(starts), range_).select(*columns, (F.col(first) + F.col(inside)).alias(name))


def count_batches(df: DataFrame, order: str | list[str], size: int = 100) -> DataFrame:
    """Manifest rows of a bounded replay cut into batches of exactly `size` rows."""
    key = F.col(order) if isinstance(order, str) else F.struct(*order)
    return (
        number_records(df, order)
        .groupBy(F.floor(F.col("record_no") / size).alias("batch_no"))
        .agg(
            F.count("*").alias("record_count"),
            F.min(key).alias("first_id"),
            F.max(key).alias("last_id"),
        )
    )


def recent(df: DataFrame, order: str, tiebreak: str, n: int = 50) -> DataFrame:
    """The newest `n` rows, newest first."""
    return df.orderBy(F.desc(order), F.desc(tiebreak)).limit(n)
