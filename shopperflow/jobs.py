"""The batch jobs: weekly report, segmentation report, churn training, dashboard datasets.

    python -m shopperflow.jobs --data <csv folder> --out <folder> [--weekly] [--segments] [--churn] [--dashboards] [--all]
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from .functions.calendar import Moment
from .learning import churn_model
from .operators import cohorts, dashboards, segmentation, weekly
from .operators.churn_features import customer_features
from .operators.common import completed
from .plans.durable import settle
from .schemas import CUSTOMER_CONTRACT, TRANSACTION_CONTRACT
from .sources import sinks, tables

# Days a weekly report looks back.
LOOKBACK_DAYS = 7


def weekly_report(
    customers: DataFrame,
    history: DataFrame,
    out: str,
    snapshot_date: dt.date | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
    landed: str | None = None,
) -> dict[str, DataFrame]:
    """Cleans the trailing week, computes the KPIs and writes JSON, CSV and Markdown.

    `history` is the full transaction table: the KPIs use the window, churn risk all of it. If the
    tables have been landed, name the folder: the window then reads only the months it touches.
    """
    today = snapshot_date or dt.date.today()
    end = end or today
    start = start or today - dt.timedelta(days=LOOKBACK_DAYS)
    week = today.isocalendar()[1]

    if landed is None:
        recent = tables.within(history, "order_date", start, end)
    else:
        recent = tables.landed(history.sparkSession, landed, "transactions", start, end)
    weekly.warn_about_nulls(weekly.require_columns(recent, TRANSACTION_CONTRACT, "transactions"), TRANSACTION_CONTRACT, "transactions")
    weekly.warn_about_nulls(weekly.require_columns(customers, CUSTOMER_CONTRACT, "customers"), CUSTOMER_CONTRACT, "customers")

    # The three KPI reports share one pass; they need the completed orders and a few columns.
    needed = ["transaction_id", "customer_id", "order_date", "week", "category", "total_amount", "status"]
    orders = settle(completed(weekly.clean_transactions(recent)).select(*needed))
    summary = weekly.weekly_summary(orders, week)
    categories = weekly.category_breakdown(orders)
    segments = weekly.segment_weekly_kpis(orders, customers)
    churn = weekly.churn_risk_summary(customers, weekly.positive_amounts(history), today)

    sinks.write_json(summary, f"{out}/summary_week{week:02d}.json")
    sinks.write_csv(categories, f"{out}/category_breakdown_week{week:02d}.csv")
    sinks.write_csv(segments, f"{out}/segment_kpis_week{week:02d}.csv")
    sinks.write_csv(churn, f"{out}/churn_risk_week{week:02d}.csv")
    generated = dt.datetime.now().strftime("%Y-%m-%d %H:%M")
    report = sinks.weekly_markdown(summary, categories, churn, week, generated)
    sinks.write_lines(report, f"{out}/weekly_report_week{week:02d}.md")
    return {"summary": summary, "category_breakdown": categories, "segment_kpis": segments, "churn_summary": churn}


def segment_report(transactions: DataFrame, out: str, snapshot_date: Moment = None) -> DataFrame:
    summary = segmentation.rfm_segment_summary(segmentation.rfm_qcut(transactions, snapshot_date))
    sinks.write_csv(summary, f"{out}/rfm_segments.csv")
    return summary


def train_churn(
    customers: DataFrame,
    transactions: DataFrame,
    sessions: DataFrame | None,
    out: str,
    kind: str = "gbm",
    snapshot_date: Moment = None,
) -> churn_model.ChurnModel:
    """Builds features, fits, evaluates; saves the model with what it needs to score other tables, and its metrics."""
    model = churn_model.train(customer_features(customers, transactions, sessions, snapshot_date), kind)
    model.save(f"{out}/churn_model_{kind}")
    sinks.write_csv(model.metrics(), f"{out}/churn_metrics_{kind}.csv")
    return model


def dashboard_datasets(
    customers: DataFrame, transactions: DataFrame, sessions: DataFrame, snapshot_date: Moment = None
) -> dict[str, DataFrame]:
    rfm = dashboards.dashboard_rfm(transactions, snapshot_date)
    return {
        "kpi_overview": dashboards.kpi_overview(transactions),
        "monthly_revenue": dashboards.monthly_revenue(transactions),
        "revenue_by_category": dashboards.revenue_by_category(transactions),
        "segment_distribution": dashboards.segment_distribution(customers),
        "orders_by_weekday": dashboards.orders_by_weekday(transactions),
        "inactivity_buckets": dashboards.inactivity_buckets(transactions, snapshot_date),
        "churn_rate_by_segment": dashboards.churn_rate_by_segment(transactions, customers, snapshot_date),
        "order_frequency_histogram": dashboards.order_frequency_histogram(transactions),
        "quarterly_retention": cohorts.quarterly_retention(transactions),
        "rfm_scatter_sample": dashboards.rfm_scatter_sample(rfm),
        "revenue_by_rfm_segment": dashboards.revenue_by_rfm_segment(rfm),
        "conversion_by_source": dashboards.conversion_by_source(sessions),
        "device_split": dashboards.device_split(sessions),
    }


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Customer analytics jobs")
    parser.add_argument("--data", required=True, help="folder with customers.csv, transactions.csv, sessions.csv")
    parser.add_argument("--out", required=True, help="folder for reports and models")
    parser.add_argument("--landed", help="folder for the tables as Parquet (default: landed, in the folder for reports)")
    parser.add_argument("--strict", action="store_true", help="refuse files with cells that cannot be read")
    parser.add_argument("--snapshot", type=dt.date.fromisoformat, help="day to look back from (default today)")
    parser.add_argument("--model", default="gbm", choices=("gbm", "rf", "lr"))
    steps = ("weekly", "segments", "churn", "dashboards")
    for step in (*steps, "all"):
        parser.add_argument(f"--{step}", action="store_true")
    chosen = parser.parse_args(arguments)
    wanted = {step for step in steps if chosen.all or getattr(chosen, step)}
    if not wanted:
        parser.print_help()
        return

    spark = SparkSession.builder.appName("shopperflow").getOrCreate()
    home = chosen.landed or f"{chosen.out}/landed"
    tables.land_news(spark, chosen.data, home, chosen.strict)
    customers, transactions, sessions = (tables.landed(spark, home, table) for table in ("customers", "transactions", "sessions"))
    if "weekly" in wanted:
        weekly_report(customers, transactions, chosen.out, chosen.snapshot, landed=home)
    if "segments" in wanted:
        segment_report(transactions, chosen.out, chosen.snapshot)
    if "churn" in wanted:
        train_churn(customers, transactions, sessions, chosen.out, chosen.model, chosen.snapshot)
    if "dashboards" in wanted:
        for name, dataset in dashboard_datasets(customers, transactions, sessions, chosen.snapshot).items():
            sinks.write_csv(dataset, f"{chosen.out}/dashboards/{name}.csv")


if __name__ == "__main__":
    main()
