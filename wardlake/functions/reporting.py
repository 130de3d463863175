"""Expressions used by reports: ordering ranks, guarded ratios, status ladders, text stamps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def rank_of(c: Column, ordered: list[str]) -> Column:
    """Position of a category in its display order; anything else comes last."""
    start = F.when(c == ordered[0], 1)
    chain = reduce(lambda w, pair: w.when(c == pair[1], pair[0]), enumerate(ordered[1:], 2), start)
    return chain.otherwise(len(ordered) + 1)


def percent_of(part: Column, whole: Column) -> Column:
    """Null when there is nothing to take a share of."""
    return F.try_divide(part.cast("double") * 100.0, whole.cast("double"))


def guarded_rate(amount: Column, seconds: Column) -> Column:
    """Amount per second at two decimals; 0 when no time has passed."""
    return F.when(seconds > 0, F.round(amount / seconds, 2)).otherwise(F.lit(0.0))


def freshness(age_seconds: Column) -> Column:
    """Status text of the newest message, given its age."""
    return (
        F.when(age_seconds.isNull(), "None")
        .when(age_seconds < 30, "Active")
        .otherwise(F.concat(F.floor(age_seconds).cast("string"), F.lit("s ago")))
    )


def health(errors: Column) -> Column:
    return F.when(errors == 0, "healthy").when(errors < 5, "degraded").otherwise("failing")


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def stamp_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd_HHmmss")
