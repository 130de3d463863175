"""Exact interpolated percentiles of large groups by radix selection.

The built-in percentile keeps every distinct value of a group in one aggregation buffer, which
a group holding a third of all rows does not survive. Here a first pass counts each group's
values in narrow magnitude buckets, and the counts tell which bucket holds the wanted rank. While
that bucket has more than 2^16 rows of more than one value, a further pass counts it in 2^16 equal
parts. The last pass counts single values inside the bucket that is left, of which there are then
no more than 2^16. All passes combine map-side, so little is shuffled however uneven the groups
are. Within a magnitude bucket all doubles have the same exponent or two neighbouring ones, so
a part is at least 2^15 times denser in distinct doubles with each pass: four passes are the most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardlake.session import stored

# Buckets per power of ten: neighbouring bucket edges differ by 0.23 %.
BUCKETS_PER_DECADE = 1000
# Parts of a bucket in each further pass, and the rows a bucket may have in the last one.
PARTS = 1 << 16
MOST = 1 << 16


def with_exact_percentiles(
    report: DataFrame,
    rows: DataFrame,
    keys: list[str],
    value: str,
    wanted: dict[str, float],
    bounded: bool = False,
    most: int = MOST,
) -> DataFrame:
    """Add to each row of `report` (one per group of `keys`) exact percentiles of `rows.value`.

    Every group of the report needs at least one non-null value in `rows`. Set `bounded` when a
    LIMIT caps the report, which then is broadcast; otherwise the optimiser picks the join. The passes
    run at once, but for the last one.
    """
    side = F.broadcast if bounded else (lambda df: df)
    key_names = [f"_key{i}" for i in range(len(keys))]
    values = rows.filter(F.col(value).isNotNull()).select(
        *[F.col(k).alias(name) for k, name in zip(keys, key_names)],
        F.col(value).cast("double").alias("_v"),
    )
    # The report's columns depend on its keys; they ride along so that it is computed once.
    columns = report.columns

    def same_group():
        condition = F.lit(True)
        for k, name in zip(keys, key_names):
            condition = condition & F.col(name).eqNullSafe(F.col(k))
        return condition

    histogram = (
        values.join(side(report), same_group())
        .groupBy(
            *columns,
            F.signum("_v").alias("_sign"),
            F.floor(F.log10(F.abs("_v")) * BUCKETS_PER_DECADE).alias("_bucket"),
        )
        .agg(F.count("*").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    )
    group = Window.partitionBy(*keys)
    ascending = group.orderBy("_low").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = histogram.select(
        *columns,
        "_low",
        "_high",
        F.sum("_n").over(group).alias("_total"),
        F.sum("_n").over(ascending).alias("_upto"),
        (F.sum("_n").over(ascending) - F.col("_n")).alias("_before"),
    )

    # Each percentile lies between two neighbouring ranks, counted from zero.
    position = {name: F.lit(q) * (F.col("_total") - 1) for name, q in wanted.items()}
    ranks = F.array(
        *[
            F.struct(
                F.lit(name).alias("name"),
                F.lit(edge).alias("edge"),
                rounding(position[name]).cast("bigint").alias("rank"),
                (position[name] - F.floor(position[name])).alias("weight"),
            )
            for name in wanted
            for edge, rounding in (("lower", F.floor), ("upper", F.ceil))
        ]
    )
    target = ["_name", "_edge", "_weight"]
    targets = (
        placed.withColumn("_want", F.explode(ranks))
        .filter("_want.rank >= _before AND _want.rank < _upto")
        .select(
            *columns,
            "_low",
            "_high",
            (F.col("_upto") - F.col("_before")).alias("_n"),
            F.col("_want.name").alias("_name"),
            F.col("_want.edge").alias("_edge"),
            F.col("_want.weight").alias("_weight"),
            (F.col("_want.rank") - F.col("_before")).alias("_rank"),
        )
    )
    # A row per group, percentile and edge, however many rows the groups have.
    targets = stored(targets, "percentiles")
    slices = Window.partitionBy(*keys, "_name", "_edge")
    upto = F.sum("_n").over(slices.orderBy("_low").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    crowded = (F.col("_n") > most) & (F.col("_low") < F.col("_high"))
    while not targets.filter(crowded).isEmpty():
        # both edges of a bucket get parts of their own, so every pass makes it smaller
        part = F.floor((F.col("_v") - F.col("_low")) / (F.col("_high") - F.col("_low")) * PARTS)
        bounds = targets.filter(crowded).drop("_n")
        parts = (
            values.join(side(bounds), same_group() & F.expr("_v BETWEEN _low AND _high"))
            .groupBy(*columns, *target, "_rank", part.alias("_part"))
            .agg(F.count("*").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
        )
        smaller = (
            parts.withColumn("_upto", upto)
            .filter("_rank < _upto AND _rank >= _upto - _n")
            .withColumn("_rank", F.col("_rank") - (F.col("_upto") - F.col("_n")))
        )
        rest = targets.filter(~crowded)
        targets = stored(rest.unionByName(smaller.select(*rest.columns)), "percentiles")

    # Laid out by group once, which serves both the running count and the final aggregate.
    counted = (
        values.join(side(targets.drop("_n")), same_group() & F.expr("_v BETWEEN _low AND _high"))
        .groupBy(*columns, *target, "_rank", "_v")
        .agg(F.count("*").alias("_n"))
        .repartition(*keys)
    )
    slice_order = slices.orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    picked = counted.withColumn("_upto", F.sum("_n").over(slice_order)).filter(
        "_rank < _upto AND _rank >= _upto - _n"
    )

    def at(name: str, edge: str):
        return F.max(F.when((F.col("_name") == name) & (F.col("_edge") == edge), F.col("_v")))

    def weight(name: str):
        return F.max(F.when(F.col("_name") == name, F.col("_weight")))

    results = [
        (at(name, "lower") * (1 - weight(name)) + at(name, "upper") * weight(name)).alias(name)
        for name in wanted
    ]
    return picked.groupBy(*columns).agg(*results)
