"""Churn status, cohort churn, per-customer warning signals, revenue at risk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bands import ladder
from ..functions.calendar import Moment, calendar_days_since, month_index, month_label
from ..functions.numbers import flag, mean, ratio
from ..schemas import CANCELLED, RETURNED
from .common import completed, orders_counted

# Calendar days without a purchase, and the labels in report order.
STATUS_OVER_DAYS = ((180, "Churned"), (90, "At Risk"), (30, "Cooling Off"))
STATUS_ORDER = ("Active", "Cooling Off", "At Risk", "Churned")
LAPSED_DAYS = 90
CHURNED_SEGMENT = "Churned"


def churn_status_summary(
    transactions: DataFrame, customers: DataFrame, snapshot_date: Moment = None, unique_ids: bool = False
) -> DataFrame:
    """Customers and spend by days since the last completed order."""
    spend = (
        completed(transactions)
        .groupBy("customer_id")
        .agg(
            F.max("order_date").alias("last_order"),
            orders_counted(unique_ids).alias("orders"),
            F.round(F.sum("total_amount"), 2).alias("spent"),
        )
    )
    days = calendar_days_since(F.col("last_order"), snapshot_date)
    label = ladder([(days > limit, name) for limit, name in STATUS_OVER_DAYS], STATUS_ORDER[0])
    place = F.array_position(F.array(*[F.lit(name) for name in STATUS_ORDER]), F.col("churn_label"))
    return (
        spend.join(customers.select("customer_id"), "customer_id")
        .groupBy(label.alias("churn_label"))
        .agg(
            F.count("*").alias("customer_count"),
            mean(F.col("orders"), 1).alias("avg_orders"),
            mean(F.col("spent"), 2).alias("avg_spent"),
            F.round(F.sum("spent"), 2).alias("at_risk_revenue"),
        )
        .orderBy(place)
    )


def cohort_churn_rate(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """Per signup month and order month: how many of the cohort bought. Customers who never
    bought give their cohort a row with no order month."""
    cohorts = customers.select("customer_id", month_index(F.col("signup_date")).alias("cohort"))
    sizes = cohorts.groupBy("cohort").agg(F.count("*").alias("total_customers"))
    # One row per customer and month before the join, however many orders stand behind it.
    active = completed(transactions).select(
        F.col("customer_id").alias("buyer"), month_index(F.col("order_date")).alias("month")
    ).distinct()
    counts = (
        cohorts.join(active, F.col("customer_id") == F.col("buyer"), "left")
        .groupBy("cohort", "month")
        .agg(F.count("buyer").alias("active_customers"))
    )
    bought, all_ = F.col("active_customers"), F.col("total_customers")
    return (
        counts.join(sizes, "cohort")
        .select(
            month_label(F.col("cohort")).alias("cohort_month"),
            "total_customers",
            month_label(F.col("month")).alias("order_month"),
            (F.col("month") - F.col("cohort")).alias("months_since_join"),
            "active_customers",
            ratio(bought * 100, all_, 2).alias("retention_rate"),
            ratio((all_ - bought) * 100, all_, 2).alias("churn_rate"),
        )
        .orderBy("cohort_month", "months_since_join")
    )


def churn_signals(
    transactions: DataFrame,
    customers: DataFrame,
    sessions: DataFrame,
    snapshot_date: Moment = None,
    unique_ids: bool = False,
) -> DataFrame:
    """Per customer: orders of every status, returns, cancellations, session behaviour, risk level."""
    orders = transactions.groupBy("customer_id").agg(
        orders_counted(unique_ids).alias("total_txns"),
        mean(F.col("total_amount"), 2).alias("avg_order_value"),
        F.round(F.sum("total_amount"), 2).alias("total_revenue"),
        F.sum(flag(F.col("status") == RETURNED)).alias("returns"),
        F.sum(flag(F.col("status") == CANCELLED)).alias("cancellations"),
        calendar_days_since(F.max("order_date"), snapshot_date).alias("days_since_last_order"),
    )
    visits = sessions.groupBy("customer_id").agg(
        mean(F.col("session_duration_sec"), 0).alias("avg_session_duration"),
        ratio(F.sum(F.col("bounced").cast("int")) * 100, F.count("bounced"), 1).alias("bounce_rate"),
    )
    idle = F.col("days_since_last_order")
    # Limits of the risk levels. An unknown bounce rate never meets its limit.
    risk = ladder(
        [
            ((idle > 90) & (F.col("returns") > 2), "High Churn Risk"),
            ((idle > 60) & (F.col("cancellations") > 1), "Medium Churn Risk"),
            ((idle > 30) & (F.col("bounce_rate") > 70), "Medium Churn Risk"),
        ],
        "Low Churn Risk",
    )
    return (
        orders.join(customers.select("customer_id", "segment"), "customer_id")
        .join(visits, "customer_id", "left")
        .select(
            "customer_id", "segment", "total_txns", "avg_order_value", "total_revenue", "returns",
            "cancellations", "days_since_last_order", "avg_session_duration", "bounce_rate",
            risk.alias("churn_risk_level"),
        )
        # The id lets a day shared by very many customers be sorted by more than one task.
        .orderBy(idle.desc(), "customer_id")
    )


def revenue_at_risk(transactions: DataFrame, customers: DataFrame, snapshot_date: Moment = None) -> DataFrame:
    """Lifetime value of customers marked churned, or whose last completed order is over 90 days old."""
    lapsed = (
        completed(transactions)
        .groupBy("customer_id")
        .agg(F.max("order_date").alias("last_order"))
        .filter(calendar_days_since(F.col("last_order"), snapshot_date) > LAPSED_DAYS)
        .select("customer_id", F.lit(True).alias("lapsed"))
    )
    tenure = calendar_days_since(F.col("signup_date"), snapshot_date)
    return (
        customers.join(lapsed, "customer_id", "left")
        .filter((F.col("segment") == CHURNED_SEGMENT) | F.col("lapsed"))
        .groupBy("segment")
        .agg(
            F.count_distinct("customer_id").alias("churned_customers"),
            mean(F.col("lifetime_value"), 2).alias("avg_ltv"),
            F.round(F.sum("lifetime_value"), 2).alias("total_revenue_at_risk"),
            ratio(F.sum(tenure), F.count("signup_date") * 365, 1).alias("avg_tenure_years"),
        )
        .orderBy(F.desc("total_revenue_at_risk"))
    )
