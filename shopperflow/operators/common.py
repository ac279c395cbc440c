"""Pieces several reports share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import Moment, elapsed_days_since
from ..schemas import COMPLETED


def completed(transactions: DataFrame) -> DataFrame:
    return transactions.filter(F.col("status") == COMPLETED)


def known(df: DataFrame, key: str = "customer_id") -> DataFrame:
    """Rows that name a customer."""
    return df.filter(F.col(key).isNotNull())


def orders_counted(unique_ids: bool) -> Column:
    """Number of distinct transaction ids.

    Where ids are known to be unique (cleaned tables) a plain count gives the same number
    without moving every id through a shuffle.
    """
    return F.count("transaction_id") if unique_ids else F.count_distinct("transaction_id")


def last_order_age(transactions: DataFrame, snapshot_date: Moment) -> DataFrame:
    """customer_id, days_inactive: elapsed days since the last completed order."""
    kind = transactions.schema["order_date"].dataType
    return (
        known(completed(transactions))
        .groupBy("customer_id")
        .agg(F.max("order_date").alias("last_order"))
        .select("customer_id", elapsed_days_since(F.col("last_order"), kind, snapshot_date).alias("days_inactive"))
    )
