"""Numeric parsing of record text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal float text as a strict float parser takes it: optional sign, digits
# with an optional point (".5" and "5." both count), optional exponent; or
# inf / infinity with optional sign, or nan, in any letter case. No surrounding
# space, no type suffix ("5d"), no hex floats.
FLOAT_TEXT = r"^([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:[+-]?(inf|infinity)|nan))$"


def go_float(col: Column) -> Column:
    """Text to double; text that does not parse counts as 0.0.

    The regex guard comes first because a bare cast would also accept
    " 5" and "5d".
    """
    text = col.cast("string")
    return F.when(text.rlike(FLOAT_TEXT), text.try_cast("double")).otherwise(F.lit(0.0))


def numeric_compare(left: Column, right: Column, op: str) -> Column:
    """``left op right`` where any NaN operand makes the result false."""
    cmp = left > right if op == "gt" else left < right
    return F.when(F.isnan(left) | F.isnan(right), F.lit(False)).otherwise(cmp)
