"""First-purchase cohorts: retention, order value, categories and lifetime value over time.

All reports start from one row per customer and period (and category). That reduction happens
before the first shuffle, so a customer with a third of all orders weighs no more than its number
of active periods, and the first period is then a window over those few rows per customer rather
than a join of the orders with their own minimum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import month_index, month_label, quarter_index, quarter_label
from ..functions.numbers import ratio, share
from .common import completed, known


def _activity(transactions: DataFrame, period: Column, *by: str, **sums: Column) -> DataFrame:
    """customer_id, cohort, step (periods since the first purchase), `by` columns, `sums`."""
    orders = completed(transactions).groupBy("customer_id", period.alias("period"), *by)
    reduced = orders.agg(*[c.alias(name) for name, c in sums.items()]) if sums else orders.agg(F.count("*").alias("orders"))
    first = F.min("period").over(Window.partitionBy("customer_id"))
    return reduced.withColumn("cohort", first).withColumn("step", F.col("period") - F.col("cohort"))


def _month() -> Column:
    return month_index(F.col("order_date"))


def cohort_retention(transactions: DataFrame, months: int = 12) -> DataFrame:
    """Share of each first-purchase cohort active in months 0..11.

    Orders without a customer count as one member of their cohort's size but are never active.
    """
    counts = _activity(transactions, _month()).groupBy("cohort", "step").agg(
        F.count("*").alias("members"), F.count("customer_id").alias("active_users")
    )
    # Every member is active in month 0, so that row holds the cohort's size.
    size = F.max(F.when(F.col("step") == 0, F.col("members"))).over(Window.partitionBy("cohort"))
    return (
        counts.withColumn("cohort_size", size)
        .filter(F.col("step").between(0, months - 1) & (F.col("active_users") > 0))
        .select(
            month_label(F.col("cohort")).alias("cohort_month"),
            "cohort_size",
            F.col("step").alias("month_number"),
            "active_users",
            ratio(F.col("active_users") * 100, F.col("cohort_size"), 2).alias("retention_pct"),
        )
        .orderBy("cohort_month", "month_number")
    )


def cohort_aov(transactions: DataFrame, unique_ids: bool = False) -> DataFrame:
    """Orders, average order value and revenue per cohort and month."""
    paid = known(transactions)
    if unique_ids:
        rows = _activity(
            paid, _month(),
            amount=F.sum("total_amount"), amounts=F.count("total_amount"), orders=F.count("transaction_id"),
        )
        orders, amounts = F.sum("orders"), F.sum("amounts")
    else:
        # Ids must stay visible to be told apart, so the orders themselves meet their cohort.
        firsts = completed(paid).groupBy("customer_id").agg(F.min(_month()).alias("cohort"))
        rows = (
            completed(paid)
            .select("customer_id", "transaction_id", F.col("total_amount").alias("amount"), _month().alias("period"))
            .join(firsts, "customer_id")
            .withColumn("step", F.col("period") - F.col("cohort"))
        )
        orders, amounts = F.count_distinct("transaction_id"), F.count("amount")
    return (
        rows.groupBy("cohort", "period", "step")
        .agg(
            orders.alias("total_orders"),
            ratio(F.sum("amount"), amounts, 2).alias("avg_order_value"),
            F.round(F.sum("amount"), 2).alias("total_revenue"),
        )
        .select(
            month_label(F.col("cohort")).alias("cohort_month"),
            month_label(F.col("period")).alias("activity_month"),
            F.col("step").alias("month_number"),
            "total_orders", "avg_order_value", "total_revenue",
        )
        .orderBy("cohort_month", "month_number")
    )


def cohort_category(transactions: DataFrame) -> DataFrame:
    """Buyers and revenue per cohort, category and month."""
    return (
        _activity(known(transactions), _month(), "category", amount=F.sum("total_amount"))
        .groupBy("cohort", "category", "step")
        .agg(F.count("*").alias("buyers"), F.round(F.sum("amount"), 2).alias("revenue"))
        .select(
            month_label(F.col("cohort")).alias("cohort_month"),
            "category",
            F.col("step").alias("months_since_join"),
            "buyers", "revenue",
        )
        .orderBy("cohort_month", "months_since_join", F.desc("revenue"))
    )


def _cohort_revenue(transactions: DataFrame) -> DataFrame:
    return (
        _activity(known(transactions), _month(), amount=F.sum("total_amount"))
        .groupBy("cohort", "step")
        .agg(F.sum("amount").alias("revenue"), F.count("*").alias("customers"))
    )


def _revenue_so_far() -> Column:
    steps = Window.partitionBy("cohort").orderBy("step")
    return F.sum("revenue").over(steps.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def cohort_ltv(transactions: DataFrame) -> DataFrame:
    """Monthly and cumulative revenue per cohort."""
    return (
        _cohort_revenue(transactions)
        .select(
            month_label(F.col("cohort")).alias("cohort_month"),
            F.col("step").alias("month_number"),
            F.round("revenue", 2).alias("monthly_revenue"),
            F.round(_revenue_so_far(), 2).alias("cumulative_revenue"),
        )
        .orderBy("cohort_month", "month_number")
    )


def ltv_curve(transactions: DataFrame) -> DataFrame:
    """Cumulative revenue per cohort divided by the cohort's size."""
    size = F.max(F.when(F.col("step") == 0, F.col("customers"))).over(Window.partitionBy("cohort"))
    return (
        _cohort_revenue(transactions)
        .select(
            month_label(F.col("cohort")).alias("cohort_month"),
            F.col("step").alias("month_number"),
            share(_revenue_so_far(), size).alias("cumulative_avg_revenue"),
        )
        .orderBy("cohort_month", "month_number")
    )


def _retained(transactions: DataFrame, period: Column) -> DataFrame:
    counts = _activity(known(transactions), period).groupBy("cohort", "step").agg(F.count("*").alias("active"))
    size = F.max(F.when(F.col("step") == 0, F.col("active"))).over(Window.partitionBy("cohort"))
    return counts.withColumn("size", size)


def retention_matrix(transactions: DataFrame) -> DataFrame:
    """Long form of the monthly retention matrix, all months (percent, of a ratio with 4 places)."""
    return (
        _retained(transactions, _month())
        .select(
            month_label(F.col("cohort")).alias("cohort_month"),
            F.col("step").alias("month_number"),
            ratio(F.col("active") * 100, F.col("size"), 2).alias("retention_pct"),
        )
        .orderBy("cohort_month", "month_number")
    )


def widened(matrix: DataFrame, months: list[int] | None = None) -> DataFrame:
    """The matrix with one column per month number; months nobody was active in stay NULL.

    All months that occur, unless the caller lists those wanted.
    """
    pivot = matrix.groupBy("cohort_month")
    wide = pivot.pivot("month_number", months) if months else pivot.pivot("month_number")
    return wide.agg(F.first("retention_pct")).orderBy("cohort_month")


def as_rows_of_text(wide: DataFrame) -> DataFrame:
    """A wide matrix as cohort_month and one text of its cells, `month:percent` in month order; for exports
    whose columns must not depend on the data."""
    months = sorted((c for c in wide.columns if c != "cohort_month"), key=int)
    cells = [F.concat(F.lit(f"{m}:"), F.col(m).cast("string")) for m in months]  # NULL for an empty cell
    return wide.select("cohort_month", F.concat_ws(" ", *cells).alias("cells"))


def quarterly_retention(transactions: DataFrame, quarters: int = 6) -> DataFrame:
    """Retention over the first quarters; a quarter nobody returned in is NULL, as on the heat map."""
    steps = [str(step) for step in range(quarters)]
    counts = _retained(transactions, quarter_index(F.col("order_date")))
    cells = counts.groupBy("cohort", "size").pivot("step", list(range(quarters))).agg(F.first("active"))
    return (
        cells.unpivot(["cohort", "size"], steps, "period_num", "active")
        .select(
            quarter_label(F.col("cohort")).alias("cohort_quarter"),
            F.col("period_num").cast("int").alias("period_num"),
            ratio(F.col("active") * 100, F.col("size"), 1).alias("retention_pct"),
        )
        .orderBy("cohort_quarter", "period_num")
    )
