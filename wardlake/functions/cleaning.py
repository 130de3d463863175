"""Cleaning of dirty text and non-finite numbers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardlake.schema import UNKNOWN


def clean_numeric(c: Column) -> Column:
    """Text to double after dropping everything but digits and dots; unparsable gives null.

    Only for text: a double rendered as text would lose its sign and exponent.
    """
    return F.regexp_replace(c, "[^0-9.]", "").try_cast("double")


def to_double(c: Column) -> Column:
    """Plain numeric cast; unparsable gives null."""
    return c.try_cast("double")


def unknown_if_null(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(UNKNOWN))


def finite_or_null(c: Column) -> Column:
    """NaN and the infinities become null."""
    infinite = c.isin(float("inf"), float("-inf"))
    return F.when(~(F.isnan(c) | infinite), c)


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def normalised_name(name: str) -> str:
    """Lower snake_case: blanks, dashes and dots turn into underscores, other signs go."""
    return re.sub(r"[^\w]", "", re.sub(r"[ .-]", "_", name)).lower()
