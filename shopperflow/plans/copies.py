"""Keeping one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_per_key(df: DataFrame, keys: Sequence[str], preference: Sequence[str] = ()) -> DataFrame:
    """The first row of each key in the order of `preference`, then of the remaining columns.

    The smallest struct of a group is that row. As an aggregate it is reduced before the shuffle, so
    a key with very many copies moves one row per task, and it is the same row on every run.
    """
    remaining = [c for c in df.columns if c not in keys and c not in preference]
    row = F.struct(*preference, *remaining)
    return df.groupBy(*keys).agg(F.min(row).alias("__row")).select(*keys, "__row.*").select(*df.columns)
