"""RFM scoring and the customer-value reports around it."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bands import RFM_SEGMENTS, ScoreBox, ladder, rfm_segment
from ..functions.calendar import Moment, calendar_days_since, elapsed_days_since, month_index, month_label
from ..functions.numbers import mean, ratio
from ..plans.durable import settle
from ..plans.ordering import Ordered, cut_points, ntile_of, ntile_starts, quantile_positions
from .common import completed, known, orders_counted

# Score groups.
BINS = 5

# Monthly spend from which a customer counts as the given tier.
SPEND_TIERS = ((5000, "High Value"), (1000, "Mid Value"), (100, "Low Value"))
LOWEST_TIER = "Minimal"


def rfm_ntile_scores(transactions: DataFrame, snapshot_date: Moment = None, unique_ids: bool = False) -> DataFrame:
    """Per customer: recency_days, frequency, monetary and their fifth (1-5, equal-sized groups).

    Equal values are told apart by customer_id. Only the rows that open each group are looked up
    in the global order; the scores themselves are a per-row comparison with those.
    """
    base = settle(
        completed(transactions)
        .groupBy("customer_id")
        .agg(
            calendar_days_since(F.max("order_date"), snapshot_date).alias("recency_days"),
            orders_counted(unique_ids).alias("frequency"),
            F.round(F.sum("total_amount"), 2).alias("monetary"),
        )
        .withColumn("staleness", -F.col("recency_days"))
    )
    # Long-absent customers come first in the recency order, hence the sign.
    axes = {"r_score": "staleness", "f_score": "frequency", "m_score": "monetary"}
    _, opens = cut_points(base, list(axes.values()), "customer_id", lambda n: ntile_starts(n, BINS))
    tie = F.col("customer_id")
    scores = {name: ntile_of(F.col(key), tie, opens[key].values()) for name, key in axes.items()}
    r, f, m = (F.col(name) for name in axes)
    return base.withColumns(scores).select(
        "customer_id", "recency_days", "frequency", "monetary", *axes,
        F.concat(*[c.cast("string") for c in (r, f, m)]).alias("rfm_code"),
        ratio(r + f + m, F.lit(3), 2).alias("rfm_avg"),
        rfm_segment(r, f, m).alias("rfm_segment"),
    )


def rfm_ntile_summary(transactions: DataFrame, snapshot_date: Moment = None, unique_ids: bool = False) -> DataFrame:
    return (
        rfm_ntile_scores(transactions, snapshot_date, unique_ids)
        .groupBy("rfm_segment")
        .agg(
            F.count("*").alias("customer_count"),
            mean(F.col("recency_days"), 1).alias("avg_recency_days"),
            mean(F.col("frequency"), 1).alias("avg_orders"),
            mean(F.col("monetary"), 2).alias("avg_revenue"),
            F.round(F.sum("monetary"), 2).alias("total_revenue"),
        )
        .orderBy(F.desc("total_revenue"))
    )


def ltv_by_segment(transactions: DataFrame, customers: DataFrame, snapshot_date: Moment = None) -> DataFrame:
    """Lifetime value per segment; avg_orders is over customers who have completed an order."""
    orders = completed(transactions).groupBy("customer_id").agg(F.count("*").alias("order_count"))
    return (
        customers.join(orders, "customer_id", "left")
        .groupBy("segment")
        .agg(
            F.count_distinct("customer_id").alias("customers"),
            mean(F.col("lifetime_value"), 2).alias("avg_ltv"),
            F.round(F.sum("lifetime_value"), 2).alias("total_ltv"),
            mean(calendar_days_since(F.col("signup_date"), snapshot_date), 0).alias("avg_tenure_days"),
            mean(F.col("order_count"), 1).alias("avg_orders"),
        )
        .orderBy(F.desc("avg_ltv"))
    )


def revenue_ranks(transactions: DataFrame, customers: DataFrame, top_n: int | None = None, top_fraction: str = "0.2") -> DataFrame:
    """customer_id, segment, revenue, rank_num, cumulative_revenue, total_revenue, customers: those with the highest revenue.

    Ranks are told apart by customer_id; customers with equal revenue share the cumulative value. A
    customer whose amounts are all unknown has no revenue and ranks last. The revenue of the last rank is found
    without ordering the table, so only customers from there on are ordered; the tail is only summed.
    """
    revenue = settle(
        completed(transactions)
        .groupBy("customer_id")
        .agg(F.round(F.sum("total_amount"), 2).alias("revenue"))
        .join(customers.select("customer_id", "segment"), "customer_id")
    )
    ranked = lambda n: min(int(n * Fraction(top_fraction)) if top_n is None else top_n, n)
    n, cuts = cut_points(revenue, ["revenue"], "customer_id", lambda n: [n - ranked(n)])
    wanted = ranked(n)
    # Peers of the last ranked customer count towards its cumulative value, so they stay in until
    # the ranks are known.
    leading = revenue if wanted > 0 else revenue.limit(0)
    if wanted > 0 and (last := cuts["revenue"][n - wanted][0]) is not None:
        leading = revenue.filter(F.col("revenue") >= F.lit(last))
    ordered = Ordered(leading, F.col("revenue").desc(), F.col("customer_id").asc())
    summed = ordered.running_sums(ordered.rows, "revenue", {"cumulative_revenue": "revenue"}, descending=True)
    return (
        ordered.numbered("rank_num", summed)
        .filter(F.col("rank_num") <= wanted)
        .select(
            "customer_id", "segment", "revenue", "rank_num", "cumulative_revenue",
            F.lit(revenue.agg(F.sum("revenue")).first()[0]).alias("total_revenue"), F.lit(n).cast("long").alias("customers"),
        )
    )


def pareto_customers(
    transactions: DataFrame, customers: DataFrame, top_n: int | None = None, top_fraction: str = "0.2"
) -> DataFrame:
    """The customers with the highest revenue, their share and the cumulative share (see `revenue_ranks`)."""
    total = F.col("total_revenue")
    return (
        revenue_ranks(transactions, customers, top_n, top_fraction)
        .select(
            "customer_id", "segment", "revenue", "rank_num",
            ratio(F.col("revenue") * 100, total, 3).alias("pct_of_total"),
            ratio(F.col("cumulative_revenue") * 100, total, 2).alias("cumulative_pct"),
        )
        .orderBy("rank_num")
    )


def spend_tier_by_month(transactions: DataFrame) -> DataFrame:
    """Customers and spend per month and spend tier."""
    spend = F.col("spend")
    tier = ladder([(spend >= limit, name) for limit, name in SPEND_TIERS], LOWEST_TIER)
    return (
        completed(transactions)
        .groupBy("customer_id", month_index(F.col("order_date")).alias("period"))
        .agg(F.sum("total_amount").alias("spend"))
        # A customer has one row per month here, so counting rows counts customers.
        .groupBy("period", tier.alias("spend_segment"))
        .agg(F.count("customer_id").alias("customer_count"), F.round(F.sum("spend"), 2).alias("total_spend"))
        .select(month_label(F.col("period")).alias("month"), "spend_segment", "customer_count", "total_spend")
        .orderBy("month", "spend_segment")
    )


def _quantile_bin(column: Column, below_edges: Sequence) -> Column:
    """Bin 1..k: one more than the inner edges the value lies above.

    A value is above an interpolated edge exactly when it is above the sorted value at or just
    below that edge, so no interpolation is needed.
    """
    return sum((F.when(column > F.lit(edge), 1).otherwise(0) for edge in below_edges), F.lit(1))


def _reject_equal_edges(name: str, values: dict[int, tuple], n: int, bins: int) -> None:
    """Equal bin edges leave fewer bins than scores; that is an error, not a silent merge."""
    edges = []
    for k, low in enumerate(quantile_positions(n, bins)):
        here = Fraction(values[low][0])
        above = Fraction(values[min(low + 1, n - 1)][0])
        edges.append(here + (above - here) * Fraction((n - 1) * k % bins, bins))
    if len(set(edges)) < len(edges):
        raise ValueError(f"{name}: quantile edges coincide, {bins} scores are not possible")


def rfm_base(transactions: DataFrame, snapshot_date: Moment = None) -> DataFrame:
    """Per customer with a completed order: recency (elapsed days), frequency, monetary."""
    kind = transactions.schema["order_date"].dataType
    return (
        known(completed(transactions))
        .groupBy("customer_id")
        .agg(
            elapsed_days_since(F.max("order_date"), kind, snapshot_date).alias("recency"),
            F.count("transaction_id").alias("frequency"),
            F.coalesce(F.sum("total_amount"), F.lit(0)).alias("monetary"),  # unknown amounts add nothing
        )
    )


def rfm_qcut(
    transactions: DataFrame, snapshot_date: Moment = None, segments: Sequence[ScoreBox] = RFM_SEGMENTS
) -> DataFrame:
    """Quantile scores: recency and monetary by value (equal values share a bin), frequency by
    its first-come rank with customer_id deciding among equals."""
    base = settle(rfm_base(transactions, snapshot_date))
    keys = ["recency", "frequency", "monetary"]

    def needed(n: int) -> list[int]:
        lows = quantile_positions(n, BINS)
        return sorted({*lows, *[low + 1 for low in lows]})

    n, found = cut_points(base, keys, "customer_id", needed)
    if n == 0:
        raise ValueError("no completed orders to score")
    for key in ("recency", "monetary"):
        _reject_equal_edges(key, found[key], n, BINS)
    if n == 1:
        raise ValueError("frequency: quantile edges coincide")
    inner = quantile_positions(n, BINS)[1:-1]
    # Ranks 1..n have no ties: a row is above the edge when it comes after the row at that position.
    after = [found["frequency"][p] for p in inner]
    f, tie = F.col("frequency"), F.col("customer_id")
    later = [(f > F.lit(k)) | ((f == F.lit(k)) & (tie > F.lit(t))) for k, t in after]
    scored = base.withColumns(
        {
            "r": F.lit(BINS + 1) - _quantile_bin(F.col("recency"), [found["recency"][p][0] for p in inner]),
            "f": sum((F.when(c, 1).otherwise(0) for c in later), F.lit(1)),
            "m": _quantile_bin(F.col("monetary"), [found["monetary"][p][0] for p in inner]),
        }
    )
    r, f, m = F.col("r"), F.col("f"), F.col("m")
    return scored.withColumn("rfm_score", r * 100 + f * 10 + m).withColumn("segment", rfm_segment(r, f, m, segments))


def rfm_segment_summary(rfm: DataFrame) -> DataFrame:
    """Averages per segment over a scored table."""
    return (
        rfm.groupBy("segment")
        .agg(
            F.count("customer_id").alias("customers"),
            mean(F.col("recency"), 2).alias("avg_recency"),
            mean(F.col("frequency"), 2).alias("avg_frequency"),
            mean(F.col("monetary"), 2).alias("avg_monetary"),
            F.round(F.sum("monetary"), 2).alias("total_revenue"),
        )
        .orderBy(F.desc("total_revenue"))
    )


def standardised(df: DataFrame, columns: Sequence[str], suffix: str = "_z") -> DataFrame:
    """Adds (x - mean) / population standard deviation; a constant column becomes 0."""
    values = [F.col(c).cast("double") for c in columns]
    moments = df.agg(
        *[F.avg(v).alias(f"mean_{c}") for c, v in zip(columns, values)],
        *[F.stddev_pop(v).alias(f"dev_{c}") for c, v in zip(columns, values)],
    ).first()
    return df.withColumns(
        {
            f"{c}{suffix}": (v - F.lit(moments[f"mean_{c}"])) / F.lit(moments[f"dev_{c}"] or 1.0)
            for c, v in zip(columns, values)
        }
    )


def rfm_scaled(transactions: DataFrame, snapshot_date: Moment = None) -> DataFrame:
    features = ["recency", "frequency", "monetary"]
    scaled = standardised(settle(rfm_base(transactions, snapshot_date)), features)
    return scaled.select("customer_id", *[F.round(f"{c}_z", 6).alias(f"{c}_z") for c in features])
