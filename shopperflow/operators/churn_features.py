"""The churn model's feature table and its train/test split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import Moment, elapsed_days_since
from ..functions.numbers import flag, share
from ..plans.durable import settle
from ..plans.ordering import Ordered
from ..schemas import CANCELLED, COMPLETED, RETURNED
from .common import known

# Days without a purchase after which a customer counts as churned, encoded columns, folds.
CHURN_DAYS = 90
ENCODED = ("gender", "country")
FOLDS = 5


def category_lists(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """The sorted values of each column. They become columns of a model, so they come to the driver."""
    return {c: sorted(row[0] for row in df.select(c).filter(F.col(c).isNotNull()).distinct().collect()) for c in columns}


def one_hot(df: DataFrame, lists: Mapping[str, Sequence[str]]) -> DataFrame:
    """Replaces each listed column by 0/1 columns for its values but the first; NULL and values that are
    not listed give all zeros."""
    for column, values in lists.items():
        df = df.withColumns({f"{column}_{v}": flag(F.col(column) == v) for v in values[1:]}).drop(column)
    return df


def churn_features(
    customers: DataFrame,
    transactions: DataFrame,
    sessions: DataFrame | None = None,
    snapshot_date: Moment = None,
    threshold_days: int = CHURN_DAYS,
    lists: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """customer_features with categories as 0/1 columns: those of `lists`, or those that occur."""
    features = settle(customer_features(customers, transactions, sessions, snapshot_date, threshold_days))
    encoded = one_hot(features.drop("churned"), lists or category_lists(features, ENCODED))
    return encoded.withColumn("churned", flag(F.col("recency_days") > threshold_days))


def customer_features(
    customers: DataFrame,
    transactions: DataFrame,
    sessions: DataFrame | None = None,
    snapshot_date: Moment = None,
    threshold_days: int = CHURN_DAYS,
) -> DataFrame:
    """One row per customer with a completed order, plus the label `churned`.

    Completed-order figures and the return counts come from one pass over the transactions.
    """
    done = F.col("status") == COMPLETED

    def of_completed(column: str):
        return F.when(done, F.col(column))

    day = transactions.schema["order_date"].dataType
    amount = of_completed("total_amount")
    orders = (
        known(transactions)
        .groupBy("customer_id")
        .agg(
            F.sum(flag(done)).alias("completed_rows"),
            F.count(of_completed("transaction_id")).alias("total_orders"),
            F.sum(amount).alias("total_revenue"),
            share(F.sum(amount), F.count(amount)).alias("avg_order_value"),
            F.max(amount).alias("max_order_value"),
            F.count_distinct(of_completed("category")).alias("unique_categories"),
            elapsed_days_since(F.max(of_completed("order_date")), day, snapshot_date).alias("recency_days"),
            elapsed_days_since(F.min(of_completed("order_date")), day, snapshot_date).alias("first_order_days"),
            share(F.sum(of_completed("discount_pct")), F.count(of_completed("discount_pct"))).alias("avg_discount"),
            F.sum(flag(F.col("status") == RETURNED)).alias("returns"),
            F.sum(flag(F.col("status") == CANCELLED)).alias("cancellations"),
        )
        .filter("completed_rows > 0")
        .drop("completed_rows")
    )
    months = F.col("first_order_days") / F.lit(30.0) + 1
    features = orders.withColumns(
        {
            "order_frequency": share(F.col("total_orders"), months),
            "return_rate": share(F.col("returns"), F.greatest(F.col("total_orders"), F.lit(1))),
        }
    )
    joined = customers.schema["signup_date"].dataType
    profile = customers.select(
        "customer_id", "age", *ENCODED, elapsed_days_since(F.col("signup_date"), joined, snapshot_date).alias("tenure_days")
    )
    features = features.join(profile, "customer_id", "left")
    if sessions is not None:
        visits = known(sessions).groupBy("customer_id").agg(
            F.count("session_id").alias("total_sessions"),
            share(F.sum("session_duration_sec"), F.count("session_duration_sec")).alias("avg_session_duration"),
            share(F.sum("pages_viewed"), F.count("pages_viewed")).alias("avg_pages_viewed"),
            share(F.sum(F.col("bounced").cast("int")), F.count("bounced")).alias("bounce_rate"),
            share(F.sum(F.col("converted").cast("int")), F.count("converted")).alias("conversion_rate"),
        )
        features = features.join(visits, "customer_id", "left")
    return features.withColumn("churned", flag(F.col("recency_days") > threshold_days))


def stratified_split(
    features: DataFrame, label: str = "churned", key: str = "customer_id", test_percent: int = 20, folds: int = FOLDS
) -> DataFrame:
    """Adds is_test (a fifth of each class, rounded half up) and, for training rows, a fold 0..4.

    Rows are ranked within their class by the hash of their key, so the split is repeatable and each
    class is spread evenly over the folds.
    """
    hashed = features.withColumn("__hash", F.md5(F.col(key).cast("string")))
    ordered = Ordered(hashed, label, "__hash", key)
    first = 0
    start, test = F.lit(None), F.lit(None)
    for row in sorted(ordered.rows.groupBy(label).count().collect(), key=lambda row: row[label]):
        in_class = F.col(label) == F.lit(row[label])
        start = F.when(in_class, F.lit(first)).otherwise(start)
        test = F.when(in_class, F.lit((2 * row["count"] * test_percent + 100) // 200)).otherwise(test)
        first += row["count"]
    rank = F.col("__position") - start
    split = ordered.numbered("__position").withColumn("is_test", rank <= test)
    fold = F.when(~F.col("is_test"), (rank - test - 1) % folds).cast("int")
    return Ordered.plain(split.withColumn("fold", fold)).drop("__hash", "__position")
