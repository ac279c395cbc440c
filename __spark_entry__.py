
from __future__ import annotations

import datetime as dt
import importlib
import importlib.util
import logging
import sys
from collections.abc import Callable
from pathlib import Path
from types import ModuleType

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import duckdb_sql  # noqa: E402
from shopperflow.learning import churn_model, clusters, evaluation  # noqa: E402
from shopperflow.operators import (  # noqa: E402
    churn_features as features,
    churn_reports,
    cohorts,
    dashboards,
    segmentation,
    weekly,
)
from shopperflow.plans.durable import passing_folder, settle  # noqa: E402
from shopperflow.schemas import TRANSACTION_CONTRACT  # noqa: E402
from shopperflow.sources import landing, sinks, tables  # noqa: E402
from shopperflow.sources.star_schema import StarSchema  # noqa: E402
from shopperflow.sql import session as sql_session  # noqa: E402
from shopperflow.sql.statements import STATEMENTS  # noqa: E402

log = logging.getLogger(__name__)

SNAPSHOT = dt.date(2001, 8, 2)
WINDOW = (dt.date(2000, 1, 15), dt.date(2000, 3, 20))
Query = Callable[[SparkSession, str], DataFrame]


def _portable(df: DataFrame) -> DataFrame:
    """Types both engines hand over alike: decimals as doubles, dates as text."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double").alias(field.name)
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string").alias(field.name)
        columns.append(column)
    return df.select(*columns)


def _query(report: Callable[[StarSchema], DataFrame]) -> Query:
    return lambda spark, folder: _portable(report(StarSchema(spark, folder)))


def _people(s: StarSchema) -> DataFrame:
    return weekly.with_tenure(s.customers(with_country=True), SNAPSHOT)


def _clean(s: StarSchema) -> DataFrame:
    return weekly.clean_transactions(s.raw_transactions())


def _enriched(s: StarSchema) -> DataFrame:
    return weekly.enriched(_clean(s), _people(s))


def _window_scan(s: StarSchema) -> DataFrame:
    return s.transactions(start=WINDOW[0], end=WINDOW[1])


def _landed_window(s: StarSchema) -> DataFrame:
    """Lands the transactions by month, then reads the window back."""
    with passing_folder(s.spark, "landed") as folder:
        tables.land_table(s.transactions(), folder, "transactions")
        return settle(tables.landed(s.spark, folder, "transactions", *WINDOW))


def _from_csv(df: DataFrame, table: str, read: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """Writes a table as CSV and reads it back with the declared types."""
    with passing_folder(df.sparkSession, "delivered") as folder:
        df.write.option("header", True).csv(f"{folder}/{table}.csv")
        return settle(read(df.sparkSession, folder))


def _transactions_from_csv(s: StarSchema) -> DataFrame:
    """Order dates with a time of day; whole numbers written 2.0."""
    hour = F.lpad((F.col("customer_id") % 24).cast("string"), 2, "0")
    timed = s.transactions().withColumns(
        {"order_date": F.concat_ws(" ", F.col("order_date").cast("string"), F.concat(hour, F.lit(":30:00"))),
         "quantity": F.concat(F.col("quantity").cast("string"), F.lit(".0"))}
    )
    read = _from_csv(timed, "transactions", tables.read_transactions)
    return read.withColumn("order_date", F.date_format("order_date", "yyyy-MM-dd HH:mm:ss"))


def _bad_cells(s: StarSchema) -> DataFrame:
    """What a delivery with unreadable cells reports: every seventh customer's amounts, every eleventh's dates."""
    key = F.col("customer_id")
    spoilt = s.transactions().withColumns(
        {"total_amount": F.when(key % 7 == 0, "n/a").otherwise(F.col("total_amount").cast("string")),
         "order_date": F.when(key % 11 == 0, "soon").otherwise(F.col("order_date").cast("string"))}
    )
    with passing_folder(s.spark, "delivered") as folder:
        spoilt.write.option("header", True).csv(f"{folder}/transactions.csv")
        return settle(tables.bad_cells(s.spark, folder, "transactions").select("column", "bad_cells"))


def _landing_counts(s: StarSchema) -> DataFrame:
    """The same delivery, landed: nulls and unreadable cells as counted by the pass that lands it."""
    key = F.col("customer_id")
    spoilt = s.transactions().withColumns(
        {"total_amount": F.when(key % 7 == 0, "n/a").otherwise(F.col("total_amount").cast("string")),
         "order_date": F.when(key % 11 == 0, "soon").otherwise(F.col("order_date").cast("string"))}
    )
    with passing_folder(s.spark, "delivered") as folder:
        spoilt.write.option("header", True).csv(f"{folder}/transactions.csv")
        tables._land_one(s.spark, folder, f"{folder}/home", "transactions", strict=False)
        return settle(landing.quality_report(s.spark, f"{folder}/home", "transactions").select("column", "null_count", "bad_cells"))


def _landed_empty(s: StarSchema) -> DataFrame:
    """Customers and a delivery without sessions, landed and read back: nobody has a session."""
    with passing_folder(s.spark, "landed") as folder:
        landing.land_table(s.customers(), folder, "customers")
        landing.land_table(s.sessions().limit(0), folder, "sessions")
        customers, sessions = (landing.landed(s.spark, folder, table) for table in ("customers", "sessions"))
        joined = customers.join(sessions.select("customer_id", "session_id"), "customer_id", "left")
        return settle(joined.groupBy("segment").agg(F.count_distinct("customer_id").alias("customers"), F.count("session_id").alias("sessions")))


#: Orders before it are the first delivery, the others the second, with corrected days of a quarter of old orders.
_SECOND_FROM, _CORRECTED = dt.date(2001, 3, 1), (dt.date(1997, 1, 1), dt.date(1997, 3, 31))


def _landed_upsert(s: StarSchema) -> DataFrame:
    """Two deliveries, the second landed into the first."""
    everything, day = s.transactions(), F.col("order_date")
    moved = everything.filter(day.between(*_CORRECTED) & (F.col("customer_id") % 5 == 0)).withColumn("order_date", F.date_sub(day, 40))
    with passing_folder(s.spark, "landed") as folder:
        landing.upsert(everything.filter(day < F.lit(_SECOND_FROM)), folder, "transactions")
        landing.upsert(everything.filter(day >= F.lit(_SECOND_FROM)).unionByName(moved), folder, "transactions")
        return settle(landing.landed(s.spark, folder, "transactions"))


def _by_statement(name: str) -> Callable[[StarSchema], DataFrame]:
    """A report as its SQL statement says."""
    return lambda s: sql_session.run(s.spark, name, s.customers(), s.transactions(with_category=True), s.sessions(), SNAPSHOT)


def _some_amounts_unknown(s: StarSchema) -> DataFrame:
    """Transactions in which every fourth customer's amounts are NULL."""
    unknown = F.col("customer_id") % 4 == 0
    return s.transactions().withColumn("total_amount", F.when(~unknown, F.col("total_amount")))


def _views(s: StarSchema) -> DataFrame:
    """A report written as SQL over the registered views."""
    tables.register_views(s.customers(with_country=True), s.transactions(), s.sessions())
    return s.spark.sql(
        """SELECT c.country, count(*) AS orders, count(DISTINCT t.customer_id) AS buyers, sum(t.total_amount) AS revenue
        FROM transactions t JOIN customers c ON t.customer_id = c.customer_id
        WHERE t.status = 'Completed' GROUP BY c.country"""
    )


def _report_lines(s: StarSchema) -> DataFrame:
    clean = settle(_clean(s))
    return sinks.weekly_markdown(
        weekly.weekly_summary(clean, duckdb_sql.WEEK),
        weekly.category_breakdown(clean),
        weekly.churn_risk_summary(s.customers(), clean, SNAPSHOT),
        duckdb_sql.WEEK,
        f"{SNAPSHOT} 06:00",
    )


def _inputs(s: StarSchema) -> tuple:
    return s.customers(with_country=True), s.transactions(with_category=True), s.sessions(), SNAPSHOT


def _features(s: StarSchema) -> DataFrame:
    return features.churn_features(*_inputs(s))


def _split(s: StarSchema) -> DataFrame:
    labelled = segmentation.rfm_base(s.transactions(), SNAPSHOT).select(
        "customer_id", (F.col("recency") > features.CHURN_DAYS).cast("int").alias("churned")
    )
    return features.stratified_split(labelled).select("customer_id", "churned", "is_test", "fold")


def _graded(s: StarSchema) -> DataFrame:
    """A fixed score with many ties: the fewer orders, the higher."""
    predictions = segmentation.rfm_base(s.transactions(), SNAPSHOT).select(
        (F.col("recency") > features.CHURN_DAYS).cast("int").alias("churned"),
        (F.lit(1.0) / (1 + F.col("frequency"))).alias("score"),
    )
    return evaluation.binary_metrics(predictions, "churned", "score", float(duckdb_sql.SCORE_THRESHOLD))


def _model(kind: str, cross_validate: bool = False) -> Callable[[StarSchema], churn_model.ChurnModel]:
    return lambda s: churn_model.train(features.customer_features(*_inputs(s)), kind, cross_validate)


def _probabilities(s: StarSchema) -> DataFrame:
    table = settle(features.customer_features(*_inputs(s)))
    return churn_model.train(table, cross_validate=False).probabilities(table)


# Facts about fitted results that SQL can state. They are invariants (who is scored, ranges, sums, sizes), not
# the fitted values themselves.


def _in_unit(column: str) -> Column:
    return F.coalesce(F.col(column).between(0, 1), F.lit(False))


def _reloaded(s: StarSchema) -> DataFrame:
    """Scores by a model that was saved and loaded again, on a table that lacks some of its categories."""
    table = settle(features.customer_features(*_inputs(s)))
    with passing_folder(s.spark, "model") as folder:
        churn_model.train(table, "lr", cross_validate=False).save(folder)
        loaded = churn_model.ChurnModel.load(s.spark, folder)
        scores = settle(loaded.probabilities(table.filter("country <> 'NATION_3'").unionByName(table.filter("country = 'NATION_3'").withColumn("country", F.lit("Elsewhere")))))
    return scores.select("customer_id", _in_unit("churn_probability").alias("in_range"))


def _cluster_facts(s: StarSchema) -> DataFrame:
    labels = clusters.cluster_labels(segmentation.rfm_base(s.transactions(), SNAPSHOT))
    return labels.agg(
        F.count("*").alias("customers"), F.count_distinct("customer_id").alias("distinct_customers"),
        F.count_distinct("cluster").alias("clusters"), F.min("cluster").alias("least"), F.max("cluster").alias("most"),
    )


def _k_search_facts(s: StarSchema) -> DataFrame:
    found = clusters.optimal_k(segmentation.rfm_base(s.transactions(), SNAPSHOT))
    before = F.lag("inertia").over(Window.partitionBy(F.lit(1)).orderBy("k"))  # nine rows
    return found.select(
        "k", F.coalesce(F.col("inertia") <= before * 1.05, F.lit(True)).alias("inertia_does_not_rise"),
        F.col("silhouette").between(-1, 1).alias("silhouette_in_range"),
    )


def _model_facts(kind: str) -> Callable[[StarSchema], DataFrame]:
    def facts(s: StarSchema) -> DataFrame:
        found = _model(kind)(s).metrics()
        kept = F.col("metric").isin("support_0", "support_1")
        ranged = ["roc_auc", "avg_precision", "accuracy", "precision_0", "precision_1", "recall_0", "recall_1", "f1_0", "f1_1"]
        return found.filter(kept | F.col("metric").isin(ranged)).select(
            "metric", F.when(kept, F.col("value")).otherwise(F.lit(-1.0)).alias("size"), (kept | _in_unit("value")).alias("in_range")
        )

    return facts


def _probability_facts(s: StarSchema) -> DataFrame:
    return _probabilities(s).select("customer_id", _in_unit("churn_probability").alias("in_range"))


def _importance_facts(s: StarSchema) -> DataFrame:
    found = _model("gbm")(s).importance()
    return found.agg(
        F.count("*").alias("features"), F.round(F.sum("importance"), 6).alias("total"), F.min(_in_unit("importance")).alias("in_range")
    )


_UNIQUE = {"unique_ids": True}  # transactions() holds one row per id

_REPORTS: dict[str, Callable[[StarSchema], DataFrame]] = {
    "churn_status_summary": lambda s: churn_reports.churn_status_summary(s.transactions(), s.customers(), SNAPSHOT, **_UNIQUE),
    "cohort_churn_rate": lambda s: churn_reports.cohort_churn_rate(s.transactions(), s.customers()),
    "churn_signals": lambda s: churn_reports.churn_signals(s.transactions(), s.customers(), s.sessions(), SNAPSHOT, **_UNIQUE),
    "revenue_at_risk": lambda s: churn_reports.revenue_at_risk(s.transactions(), s.customers(), SNAPSHOT),
    "rfm_ntile_scores": lambda s: segmentation.rfm_ntile_scores(s.transactions(), SNAPSHOT, **_UNIQUE),
    "rfm_ntile_summary": lambda s: segmentation.rfm_ntile_summary(s.transactions(), SNAPSHOT, **_UNIQUE),
    "ltv_by_segment": lambda s: segmentation.ltv_by_segment(s.transactions(), s.customers(), SNAPSHOT),
    "pareto_customers": lambda s: segmentation.pareto_customers(s.transactions(), s.customers()),
    "spend_tier_by_month": lambda s: segmentation.spend_tier_by_month(s.transactions()),
    "cohort_retention": lambda s: cohorts.cohort_retention(s.transactions()),
    "cohort_aov": lambda s: cohorts.cohort_aov(s.transactions(), **_UNIQUE),
    "cohort_category": lambda s: cohorts.cohort_category(s.transactions(with_category=True)),
    "cohort_ltv": lambda s: cohorts.cohort_ltv(s.transactions()),
    "rfm_qcut": lambda s: segmentation.rfm_qcut(s.transactions(), SNAPSHOT),
    "rfm_segment_summary": lambda s: segmentation.rfm_segment_summary(segmentation.rfm_qcut(s.transactions(), SNAPSHOT)),
    "rfm_scaled": lambda s: segmentation.rfm_scaled(s.transactions(), SNAPSHOT),
    "kmeans_clusters": lambda s: clusters.cluster_labels(segmentation.rfm_base(s.transactions(), SNAPSHOT)),
    "kmeans_optimal_k": lambda s: clusters.optimal_k(segmentation.rfm_base(s.transactions(), SNAPSHOT)),
    "retention_matrix_wide": lambda s: cohorts.as_rows_of_text(cohorts.widened(cohorts.retention_matrix(s.transactions()))),
    "retention_matrix": lambda s: cohorts.retention_matrix(s.transactions()),
    "ltv_curve": lambda s: cohorts.ltv_curve(s.transactions()),
    "churn_features": _features,
    "churn_split": _split,
    "churn_model_metrics": lambda s: _model("gbm", cross_validate=True)(s).metrics(),
    "churn_model_metrics_rf": lambda s: _model("rf", cross_validate=True)(s).metrics(),
    "churn_model_metrics_lr": lambda s: _model("lr", cross_validate=True)(s).metrics(),
    "binary_eval_metrics": _graded,
    "churn_proba": _probabilities,
    "churn_feature_importance": lambda s: _model("gbm")(s).importance(),
    "window_scan": _window_scan,
    "landed_window": _landed_window,
    "customers_from_csv": lambda s: _from_csv(s.customers(with_country=True), "customers", tables.read_customers),
    "transactions_from_csv": _transactions_from_csv,
    "sessions_from_csv": lambda s: _from_csv(s.sessions(), "sessions", tables.read_sessions),
    "bad_cells": _bad_cells,
    "landing_counts": _landing_counts,
    "landed_empty": _landed_empty,
    "landed_upsert": _landed_upsert,
    "sql_over_views": _views,
    "rfm_ntile_nulls": lambda s: segmentation.rfm_ntile_scores(_some_amounts_unknown(s), SNAPSHOT, **_UNIQUE),
    "pareto_nulls": lambda s: segmentation.pareto_customers(_some_amounts_unknown(s), s.customers(), top_fraction="0.9"),
    "churn_proba_reloaded": _reloaded,
    "kmeans_facts": _cluster_facts,
    "kmeans_optimal_k_facts": _k_search_facts,
    "churn_model_facts": _model_facts("gbm"),
    "churn_model_facts_rf": _model_facts("rf"),
    "churn_model_facts_lr": _model_facts("lr"),
    "churn_proba_facts": _probability_facts,
    "churn_importance_facts": _importance_facts,
    "weekly_report_lines": _report_lines,
    "etl_clean_transactions": _clean,
    "etl_customers": _people,
    "etl_enriched": _enriched,
    "weekly_summary": lambda s: weekly.weekly_summary(_clean(s), duckdb_sql.WEEK),
    "category_breakdown": lambda s: weekly.category_breakdown(_clean(s)),
    "segment_weekly_kpis": lambda s: weekly.segment_weekly_kpis(_clean(s), s.customers()),
    "churn_risk_summary": lambda s: weekly.churn_risk_summary(s.customers(), s.transactions(), SNAPSHOT),
    "null_profile": lambda s: weekly.null_profile(s.raw_transactions(), TRANSACTION_CONTRACT),
    "duplicates_removed": lambda s: weekly.duplicates_removed(s.raw_transactions()),
    "kpi_overview": lambda s: dashboards.kpi_overview(s.transactions()),
    "monthly_revenue_last18": lambda s: dashboards.monthly_revenue(s.transactions()),
    "revenue_by_category": lambda s: dashboards.revenue_by_category(s.transactions(with_category=True)),
    "segment_distribution": lambda s: dashboards.segment_distribution(s.customers()),
    "orders_by_weekday": lambda s: dashboards.orders_by_weekday(s.transactions()),
    "inactivity_buckets": lambda s: dashboards.inactivity_buckets(s.transactions(), SNAPSHOT),
    "churn_rate_by_segment": lambda s: dashboards.churn_rate_by_segment(s.transactions(), s.customers(), SNAPSHOT),
    "order_frequency_histogram": lambda s: dashboards.order_frequency_histogram(s.transactions()),
    "quarterly_retention": lambda s: cohorts.quarterly_retention(s.transactions()),
    "rfm_scatter_sample": lambda s: dashboards.rfm_scatter_sample(dashboards.dashboard_rfm(s.transactions(), SNAPSHOT)),
    "revenue_by_rfm_segment": lambda s: dashboards.revenue_by_rfm_segment(dashboards.dashboard_rfm(s.transactions(), SNAPSHOT)),
    "conversion_by_source": lambda s: dashboards.conversion_by_source(s.sessions()),
    "device_split": lambda s: dashboards.device_split(s.sessions()),
    "first_purchase_flag": lambda s: dashboards.first_purchase_flag(s.transactions()),
    **{f"sql_{name}": _by_statement(name) for name in STATEMENTS},
}


def _optional(name: str) -> ModuleType | None:
    """A part of the repository that may be left out, or that lacks a package on this machine; then it is not registered."""
    try:
        return importlib.import_module(name)
    except ImportError as problem:
        if importlib.util.find_spec(name.split(".")[0]) and not _left_out(name, problem):
            log.warning("%s is not registered: %s", name, problem)
        return None


def _left_out(name: str, problem: ImportError) -> bool:
    """Whether what is missing is the part itself."""
    return isinstance(problem, ModuleNotFoundError) and problem.name is not None and name.startswith(problem.name)


def entry(spark: SparkSession) -> DataFrame:
    return queries()["rfm_ntile_summary"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    found = {name: _query(report) for name, report in _REPORTS.items()}
    if llm := _optional("shopperflow.llm.queries"):
        found |= llm.QUERIES
        if pipeline := _optional("corpus_pipeline"):
            found["pipeline"] = pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    found = duckdb_sql.all_queries()
    if _optional("shopperflow.llm.queries"):
        found |= importlib.import_module("shopperflow.llm.duckdb_sql").QUERIES
        if (pipeline := _optional("corpus_pipeline")) and pipeline.ORACLE_SQL:
            found["pipeline"] = pipeline.ORACLE_SQL
    return found
