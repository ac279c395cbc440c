"""The datasets behind the overview, churn and segmentation dashboards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bands import DASHBOARD_SEGMENTS, ladder
from ..functions.calendar import Moment, month_index, month_label
from ..functions.numbers import flag, mean, ratio, share
from ..plans.durable import settle
from .common import completed, known, last_order_age
from .segmentation import rfm_qcut
from .weekly import in_label_order

# Fixed values.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
INACTIVITY_BUCKETS = ("Active (<30d)", "Cooling (30-60d)", "At Risk (60-90d)", "Churned (90d+)")
INACTIVITY_LIMITS = (30, 60, 90)
CHURN_DAYS = 90
HISTOGRAM_BINS = 30
HISTOGRAM_CEILING = 30
SCATTER_ROWS = 300

def _of_total(count: str) -> Column:
    """Percent of the sum over all rows; only for results of a handful of rows."""
    return ratio(F.col(count) * 100, F.sum(count).over(Window.partitionBy()), 1)


def kpi_overview(transactions: DataFrame) -> DataFrame:
    return completed(transactions).agg(
        F.sum("total_amount").alias("total_revenue"),
        F.count("*").alias("total_orders"),
        F.count_distinct("customer_id").alias("active_customers"),
        mean(F.col("total_amount"), 2).alias("avg_order_value"),
    )


def monthly_revenue(transactions: DataFrame, last: int = 18) -> DataFrame:
    return (
        completed(transactions)
        .groupBy(month_index(F.col("order_date")).alias("period"))
        .agg(F.sum("total_amount").alias("revenue"))
        .filter("period is not null")
        .orderBy(F.desc("period"))
        .limit(last)
        .orderBy("period")
        .select(month_label(F.col("period")).alias("month"), "revenue")
    )


def revenue_by_category(transactions: DataFrame) -> DataFrame:
    return (
        known(completed(transactions), "category")
        .groupBy("category")
        .agg(F.sum("total_amount").alias("revenue"))
        .orderBy("revenue")
    )


def segment_distribution(customers: DataFrame) -> DataFrame:
    counts = known(customers, "segment").groupBy("segment").agg(F.count("*").alias("customers"))
    return counts.withColumn("pct", _of_total("customers")).orderBy(F.desc("customers"))


def orders_by_weekday(transactions: DataFrame) -> DataFrame:
    """Seven rows, Monday first; a day without orders shows 0."""
    name = F.date_format("order_date", "EEEE")
    counts = completed(transactions).groupBy(name.alias("dow")).agg(F.count("*").alias("orders"))
    return in_label_order(counts, "dow", WEEKDAYS, "orders")


def inactivity_buckets(transactions: DataFrame, snapshot_date: Moment = None) -> DataFrame:
    """Customers with completed orders by days inactive; the first bucket takes day 0 and below."""
    days = F.col("days_inactive")
    steps = [(days <= limit, name) for limit, name in zip(INACTIVITY_LIMITS, INACTIVITY_BUCKETS)]
    counts = (
        last_order_age(transactions, snapshot_date)
        .filter(days.isNotNull())
        .groupBy(ladder(steps, INACTIVITY_BUCKETS[-1]).alias("bucket"))
        .agg(F.count("*").alias("customers"))
    )
    return in_label_order(counts, "bucket", INACTIVITY_BUCKETS, "customers").withColumn(
        "pct_of_base", _of_total("customers")
    )


def churn_rate_by_segment(transactions: DataFrame, customers: DataFrame, snapshot_date: Moment = None) -> DataFrame:
    """Percent of a segment's customers inactive over 90 days; no orders counts as not churned."""
    churned = flag(F.col("days_inactive") > CHURN_DAYS)
    return (
        known(customers, "segment").select("customer_id", "segment")
        .join(last_order_age(transactions, snapshot_date), "customer_id", "left")
        .groupBy("segment")
        .agg((share(F.sum(churned), F.count("*")) * 100).alias("churn_rate"))
        .orderBy("churn_rate")
    )


def order_frequency_histogram(transactions: DataFrame) -> DataFrame:
    """30 equal bins over orders per customer (held at 30), with the mean and median of the unheld counts.

    Customers are first counted per order count; everything else follows from that short table.
    """
    per_customer = known(completed(transactions)).groupBy("customer_id").agg(F.count("*").alias("orders"))
    spread = settle(per_customer.groupBy("orders").agg(F.count("*").alias("n")))
    facts = spread.agg(
        F.min("orders").alias("low"),
        F.max("orders").alias("high"),
        share(F.sum(F.col("orders") * F.col("n")), F.sum("n")).alias("mean"),
        F.percentile("orders", F.lit(0.5), F.col("n")).alias("median"),
    ).first()
    if facts["low"] is None:
        low, width = 0.0, 1.0
    else:
        low, high = (min(facts[end], HISTOGRAM_CEILING) for end in ("low", "high"))
        low, width = (low, high - low) if high > low else (low - 0.5, 1.0)
    held = F.least(F.col("orders"), F.lit(HISTOGRAM_CEILING))
    # The last bin is closed on both sides.
    place = F.least(F.floor((held - F.lit(low)) * HISTOGRAM_BINS / F.lit(width)), F.lit(HISTOGRAM_BINS - 1))
    counts = spread.groupBy(place.cast("int").alias("bin")).agg(F.sum("n").alias("customers"))

    def edge(steps: Column) -> Column:
        return (F.lit(float(low * HISTOGRAM_BINS)) + steps * F.lit(float(width))) / HISTOGRAM_BINS

    bins = spread.sparkSession.range(HISTOGRAM_BINS).select(F.col("id").cast("int").alias("bin"))
    return (
        bins.join(counts, "bin", "left")
        .select(
            "bin",
            edge(F.col("bin")).alias("bin_lo"),
            edge(F.col("bin") + 1).alias("bin_hi"),
            F.coalesce("customers", F.lit(0)).alias("customers"),
            F.lit(facts["mean"]).cast("double").alias("mean_orders"),
            F.lit(facts["median"]).cast("double").alias("median_orders"),
        )
        .orderBy("bin")
    )


def dashboard_rfm(transactions: DataFrame, snapshot_date: Moment = None) -> DataFrame:
    """Quantile RFM scores with the dashboards' own segments."""
    return rfm_qcut(transactions, snapshot_date, DASHBOARD_SEGMENTS)


def rfm_scatter_sample(rfm: DataFrame, rows: int = SCATTER_ROWS) -> DataFrame:
    """Up to 300 customers per segment, chosen by the hash of their id, so a rerun picks the same.

    Spark limits each segment before the shuffle as well, so no task receives a whole segment.
    """
    order = Window.partitionBy("segment").orderBy(F.md5(F.col("customer_id").cast("string")), "customer_id")
    return (
        rfm.withColumn("__rank", F.row_number().over(order))
        .filter(F.col("__rank") <= rows)
        .select("segment", "customer_id", "recency", "frequency", "monetary")
    )


def revenue_by_rfm_segment(rfm: DataFrame) -> DataFrame:
    return rfm.groupBy("segment").agg(F.sum("monetary").alias("revenue")).orderBy(F.desc("revenue"))


def conversion_by_source(sessions: DataFrame) -> DataFrame:
    converted = flag(F.col("converted"))
    return (
        known(sessions, "traffic_source")
        .groupBy("traffic_source")
        .agg(
            F.count("session_id").alias("sessions"),
            F.sum(converted).alias("conversions"),
            (share(F.sum(converted), F.count("session_id")) * 100).alias("conversion_rate"),
        )
        .orderBy("conversion_rate")
    )


def device_split(sessions: DataFrame) -> DataFrame:
    counts = known(sessions, "device").groupBy("device").agg(F.count("*").alias("sessions"))
    return counts.withColumn("pct", _of_total("sessions")).orderBy(F.desc("sessions"))


def first_purchase_flag(transactions: DataFrame) -> DataFrame:
    """transaction_id, customer_id, is_first_purchase: the earliest order (then lowest id) of each customer.

    The earliest is an aggregate, reduced before its shuffle, so a customer with very many orders is one
    row per task. It is joined back on the id: give it cleaned transactions (one row per id).
    """
    earliest = F.min(F.struct("order_date", "transaction_id")).alias("__first")
    firsts = known(transactions).groupBy("customer_id").agg(earliest).select(F.col("__first.transaction_id").alias("__id"))
    return transactions.join(firsts, F.col("transaction_id").eqNullSafe(F.col("__id")) & F.col("customer_id").isNotNull(), "left").select(
        "transaction_id", "customer_id", F.col("__id").isNotNull().alias("is_first_purchase")
    )
