"""One customer holds a third of all orders, one id a third of all copies, one value a third of all customers."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shopperflow.operators import churn_reports, cohorts, dashboards, segmentation, weekly

from .conftest import rows

ROWS = 9000


@pytest.fixture(scope="module")
def lopsided(spark):
    number = F.col("id")
    return spark.range(0, ROWS, 1, 6).select(
        F.format_string("t%05d", number).alias("transaction_id"),
        F.when(number % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (F.xxhash64("id") % 500).cast("string"))).alias("customer_id"),
        F.date_add(F.lit("2023-01-01").cast("date"), F.pmod(F.xxhash64(number, F.lit(1)), F.lit(300)).cast("int")).alias("order_date"),
        F.when(number % 3 == 1, 5).otherwise(F.pmod(F.xxhash64(number, F.lit(2)), F.lit(900)) + 1).cast("decimal(18,2)").alias("total_amount"),
        F.lit("Completed").alias("status"),
        F.lit("Books").alias("category"),
    )


def test_first_purchase(lopsided):
    window = Window.partitionBy("customer_id").orderBy("order_date", "transaction_id")
    expected = lopsided.select("transaction_id", "customer_id", F.row_number().over(window) == 1)
    assert sorted(rows(dashboards.first_purchase_flag(lopsided))) == sorted(rows(expected))


def test_copies_of_one_id(lopsided):
    raw = lopsided.withColumn("transaction_id", F.when(F.col("customer_id") == "hot", "same").otherwise(F.col("transaction_id")))
    kept = weekly.clean_transactions(raw, ["total_amount", "order_date", "customer_id"])
    assert kept.count() == ROWS - ROWS // 3 + 1
    assert weekly.duplicates_removed(raw).first()["removed"] == ROWS // 3 - 1
    least = raw.filter("transaction_id = 'same'").agg(F.min("total_amount")).first()[0]
    assert kept.filter("transaction_id = 'same'").first()["total_amount"] == least


def test_cohorts(lopsided):
    found = rows(cohorts.cohort_ltv(lopsided))
    assert sum(float(r[2]) for r in found) == float(lopsided.agg(F.sum("total_amount")).first()[0])
    sizes = {r[0]: r[1] for r in rows(cohorts.cohort_retention(lopsided))}
    assert sum(sizes.values()) == lopsided.select("customer_id").distinct().count()


def test_pareto_over_a_shared_value(spark, people):
    made = spark.range(900).select(
        F.format_string("t%04d", "id").alias("transaction_id"), F.format_string("c%04d", "id").alias("customer_id"),
        F.lit("2024-01-01").cast("date").alias("order_date"), F.when(F.col("id") % 3 == 0, 50).otherwise(F.col("id") % 100 + 1).cast("decimal(18,2)").alias("total_amount"),
        F.lit("Completed").alias("status"),
    )
    known = made.select("customer_id", F.lit("R").alias("segment"))
    found = rows(segmentation.pareto_customers(made, known, top_fraction="0.6").select("customer_id", "rank_num", "cumulative_pct"))
    spend = made.select("customer_id", "total_amount")
    down = F.col("total_amount").desc()
    expected = spend.select(
        "customer_id",
        F.row_number().over(Window.orderBy(down, "customer_id")).alias("rank"),
        F.round(100 * F.sum("total_amount").over(Window.orderBy(down)) / F.sum("total_amount").over(Window.partitionBy()), 2).cast("double"),
    ).filter("rank <= 540")
    assert sorted(found) == sorted(rows(expected))


def test_distinct_orders_of_a_hot_customer(lopsided):
    known = lopsided.select("customer_id", F.lit("R").alias("segment")).distinct()
    twice = lopsided.union(lopsided)
    found = rows(churn_reports.churn_status_summary(twice, known, "2024-01-01"))
    assert sum(r[1] * r[2] for r in found) == pytest.approx(ROWS, abs=0.05 * sum(r[1] for r in found))


def largest_share(df):
    """Rows of the largest shuffle partition over all rows."""
    sizes = [r[0] for r in df.groupBy(F.spark_partition_id()).count().select("count").collect()]
    return max(sizes) / sum(sizes)


def test_a_shared_value_is_spread_over_tasks(spark, lopsided):
    from shopperflow.plans.ordering import Ordered

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        ordered = Ordered(lopsided.select("total_amount", "transaction_id"), "total_amount", "transaction_id")
        assert largest_share(ordered.rows) < 0.15  # a third of the rows have one value
        reduced = lopsided.groupBy("customer_id", F.spark_partition_id()).count()
        assert reduced.filter("customer_id = 'hot'").count() == lopsided.rdd.getNumPartitions()  # what the hot customer shuffles
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
