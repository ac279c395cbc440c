"""Cleaning, enrichment and the weekly KPIs."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bands import cut
from ..functions.calendar import Moment, elapsed_days_since, quarter_index, quarter_label
from ..functions.numbers import flag, mean, ratio
from ..plans.copies import one_per_key
from ..schemas import CUSTOMER_CONTRACT, TRANSACTION_CONTRACT
from .common import completed, known, last_order_age

log = logging.getLogger(__name__)

# Right-closed bin edges in days, with their labels.
TENURE_EDGES = (0, 90, 365, 730, float("inf"))
TENURE_LABELS = ("New (<3m)", "Growing (3-12m)", "Established (1-2y)", "Veteran (2y+)")
CHURN_EDGES = (0, 30, 60, 90, float("inf"))
CHURN_LABELS = ("Active", "Cooling", "At Risk", "Churned")


def require_columns(df: DataFrame, columns: Iterable[str], table: str) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{table}: missing required columns {missing}")
    return df


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, null_count; one pass over the table."""
    counts = df.agg(*[F.sum(flag(F.col(c).isNull())).alias(c) for c in columns])
    return counts.fillna(0).unpivot([], list(columns), "column", "null_count")


def warn_about_nulls(df: DataFrame, columns: Sequence[str], table: str) -> dict[str, int]:
    """Logs and returns the required columns that hold nulls."""
    found = {row["column"]: row["null_count"] for row in null_profile(df, columns).filter("null_count > 0").collect()}
    if found:
        log.warning("%s: null values in %s", table, found)
    return found


def positive_amounts(df: DataFrame) -> DataFrame:
    amount = F.col("total_amount")
    positive = amount > 0
    if dict(df.dtypes)["total_amount"] in ("double", "float"):
        positive = positive & ~F.isnan(amount)  # Spark ranks NaN above every number
    return df.filter(positive)


def clean_transactions(df: DataFrame, preference: Sequence[str] = ()) -> DataFrame:
    """One row per id (first by `preference`, then by the other columns), positive amounts only,
    calendar columns added."""
    require_columns(df, TRANSACTION_CONTRACT, "transactions")
    single = one_per_key(df, ["transaction_id"], preference)
    day = F.col("order_date")
    return positive_amounts(single).withColumns(
        {
            "week": F.weekofyear(day),
            "month": F.date_format(day, "yyyy-MM"),
            "quarter": quarter_label(quarter_index(day)),
            "day_of_week": F.date_format(day, "EEEE"),
            "is_weekend": F.weekday(day) >= 5,
        }
    )


def duplicates_removed(df: DataFrame) -> DataFrame:
    """rows_in, rows_kept, removed: what cleaning makes of repeated ids (a null id counts as one id)."""
    copies = df.groupBy("transaction_id").agg(F.count("*").alias("copies"))
    found, kept = F.coalesce(F.sum("copies"), F.lit(0)), F.count("*")
    return copies.agg(found.alias("rows_in"), kept.alias("rows_kept"), (found - kept).alias("removed"))


def with_tenure(customers: DataFrame, snapshot_date: Moment = None, include_lowest: bool = False) -> DataFrame:
    """Adds tenure_days and tenure_band. Someone who joined today has no band unless `include_lowest`."""
    require_columns(customers, CUSTOMER_CONTRACT, "customers")
    kind = customers.schema["signup_date"].dataType
    days = elapsed_days_since(F.col("signup_date"), kind, snapshot_date)
    return customers.withColumn("tenure_days", days).withColumn(
        "tenure_band", cut(F.col("tenure_days"), TENURE_EDGES, TENURE_LABELS, include_lowest)
    )


def enriched(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """Transactions with the customer's segment, tenure_band and country; unknown customers keep NULLs."""
    attributes = customers.select("customer_id", "segment", "tenure_band", "country")
    return transactions.join(attributes, "customer_id", "left")


def weekly_summary(transactions: DataFrame, week: int, year: int | None = None) -> DataFrame:
    """One row of totals for an ISO week number, of every year unless one is given."""
    rows = completed(transactions).filter(F.col("week") == week)
    if year is not None:
        rows = rows.filter(F.expr("extract(yearofweek from order_date)") == year)
    return rows.agg(
        F.lit(week).alias("week"),
        F.coalesce(F.round(F.sum("total_amount"), 2), F.lit(0)).alias("revenue"),
        F.count("*").alias("orders"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.coalesce(ratio(F.sum("total_amount"), F.count("*"), 2), F.lit(0.0)).alias("avg_order_value"),
    )


def category_breakdown(transactions: DataFrame) -> DataFrame:
    return (
        known(completed(transactions), "category")
        .groupBy("category")
        .agg(
            F.sum("total_amount").alias("revenue"),
            F.count("transaction_id").alias("orders"),
            ratio(F.sum("total_amount"), F.count("transaction_id"), 2).alias("avg_order_value"),
        )
        .orderBy(F.desc("revenue"))
    )


def segment_weekly_kpis(transactions: DataFrame, customers: DataFrame | None = None) -> DataFrame:
    """Revenue and customers per week and segment.

    Takes enriched transactions, or plain ones and the customers: then each customer's week is summed
    before the join, so the orders themselves are not shuffled for it.
    """
    done = known(completed(transactions), "week")
    buyers = F.count_distinct("customer_id")
    if customers is not None:
        weeks = known(done).groupBy("week", "customer_id").agg(F.sum("total_amount").alias("total_amount"))
        done = weeks.join(customers.select("customer_id", "segment"), "customer_id")
        buyers = F.count("customer_id")  # one row per week and customer
    return (
        known(done, "segment")
        .groupBy("week", "segment")
        .agg(F.sum("total_amount").alias("revenue"), buyers.alias("customers"))
        .orderBy("week", "segment")
    )


def churn_risk_summary(
    customers: DataFrame, transactions: DataFrame, snapshot_date: Moment = None, include_lowest: bool = False
) -> DataFrame:
    """Customers per inactivity band, empty bands included.

    Give it the full order history: over one week alone nobody can look inactive for long.
    """
    age = last_order_age(transactions, snapshot_date)
    band = cut(F.col("days_inactive"), CHURN_EDGES, CHURN_LABELS, include_lowest)
    counts = (
        customers.select("customer_id")
        .join(age, "customer_id", "left")
        .groupBy(band.alias("churn_risk"))
        .agg(F.count("customer_id").alias("count"))
    )
    return in_label_order(counts, "churn_risk", CHURN_LABELS, "count")


def in_label_order(counts: DataFrame, label: str, labels: Sequence[str], count: str) -> DataFrame:
    """One row per label in the given order, 0 where `counts` has none."""
    rows = [(place, name) for place, name in enumerate(labels)]
    all_labels = counts.sparkSession.createDataFrame(rows, f"__place int, {label} string")
    return (
        all_labels.join(counts, label, "left")
        .select("__place", label, F.coalesce(F.col(count), F.lit(0)).alias(count))
        .orderBy("__place")
        .drop("__place")
    )
