"""Exact ratios and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """numerator / denominator, rounded half away from zero; NULL when dividing by zero.

    The division is done on decimals (16 places) so that a tie such as 0.125 is a tie;
    in binary floating point the outcome would hang on the last bit.
    """
    below = denominator.cast("decimal(24,2)")
    exact = numerator.cast("decimal(24,4)") / F.nullif(below, F.lit(0).cast("decimal(24,2)"))
    return F.round(exact, digits).cast("double")


def mean(column: Column, digits: int) -> Column:
    """Rounded average over the non-null values."""
    return ratio(F.sum(column), F.count(column), digits)


def share(part: Column, whole: Column) -> Column:
    """Unrounded ratio in floating point; NULL when dividing by zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)
