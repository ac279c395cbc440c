"""Joins to a table with one row per key when a few keys hold much of the other side.

A shuffle join sends all rows of one key to one task. Here keys above a measured share of the rows are told
apart: there are at most `share` of them, whatever the size of the data, so their rows of the unique side are few
enough to be sent to every task, and the rows that bear them stay where they are. All other keys are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot if it has more than one in so many rows; so there are fewer hot keys than this.
SHARE = 200
_MARK = "__is_hot"


def hot_keys(counts: DataFrame, count: str, total: int, share: int = SHARE) -> DataFrame:
    """Of a table with the number of rows of each key, the fewer than `share` keys above one `share`-th of `total`."""
    return counts.where(F.col(count) * share > total)


def measured_hot_keys(rows: DataFrame, *keys: str, share: int = SHARE) -> DataFrame:
    """The hot keys of `rows`, counted (each key is reduced before the shuffle)."""
    counts = rows.groupBy(*keys).agg(F.count("*").alias("__rows"))
    total = rows.count()
    return hot_keys(counts.dropna(subset=list(keys)), "__rows", total, share).select(*keys)


def unique_join(rows: DataFrame, unique: DataFrame, keys: list[str], hot: DataFrame, how: str = "inner") -> DataFrame:
    """`rows` joined ("inner" or "left") to `unique`, which has one row per key; `hot` holds the keys to broadcast.

    Same rows and columns as rows.join(unique, keys, how). `rows` and `unique` are read twice: settle what is costly.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unique_join cannot do {how!r}")
    few = hot.select(*keys).distinct()
    marked = rows.join(F.broadcast(few.withColumn(_MARK, F.lit(True))), keys, "left")
    spread = marked.where(F.col(_MARK).isNull()).drop(_MARK).join(unique, keys, how)
    sent = unique.join(F.broadcast(few), keys, "left_semi")
    return spread.unionByName(marked.where(_MARK).drop(_MARK).join(F.broadcast(sent), keys, how))
