"""Writing results: small reports as one file each, tables as many."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The weekly report's headings, metric names and column heads.
REPORT_TITLE = "# Weekly Behavioral Report — Week {week}"
REPORT_STAMP = "*Generated: {generated}*"
METRICS_HEADING, METRICS_COLUMNS = "## 📊 Key Metrics", ("Metric", "Value")
METRIC_NAMES = ("Total Revenue", "Total Orders", "Unique Customers", "Avg Order Value")
CATEGORY_HEADING, CATEGORY_COLUMNS = "## 🛒 Category Breakdown", ("category", "revenue", "orders")
CHURN_HEADING, CHURN_COLUMNS = "## 👥 Customer Churn Risk", ("churn_risk", "count")
CURRENCY = "₹"


def write_json(report: DataFrame, path: str) -> None:
    report.coalesce(1).write.mode("overwrite").json(path)


def write_csv(report: DataFrame, path: str) -> None:
    """One CSV file; for reports of a few rows per category, segment or week."""
    report.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def _amount(column: str) -> Column:
    return F.concat(F.lit(CURRENCY), F.format_number(F.col(column).cast("decimal(28,2)"), 2))


def _row(cells: list[Column]) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))


def _table(df: DataFrame, columns: Sequence[str], section: int) -> DataFrame:
    """Markdown lines of a small table, numbered in its own order."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return df.select(F.lit(section).alias("section"), F.monotonically_increasing_id().alias("line"), _row(cells).alias("value"))


def weekly_markdown(summary: DataFrame, categories: DataFrame, churn: DataFrame, week: int, generated: str) -> DataFrame:
    """The lines of the weekly report in column `value`, in reading order."""

    def lines(section: int, *texts: str) -> DataFrame:
        rows = [(section, number, text) for number, text in enumerate(texts)]
        return summary.sparkSession.createDataFrame(rows, "section int, line bigint, value string")

    def header(names: Sequence[str]) -> tuple[str, str]:
        return "| " + " | ".join(names) + " |", "|" + "|".join("---" for _ in names) + "|"

    values = (
        _amount("revenue"),
        F.format_number(F.col("orders"), 0),
        F.format_number(F.col("unique_customers"), 0),
        _amount("avg_order_value"),
    )
    pairs = F.array(*[_row([F.lit(name), value]) for name, value in zip(METRIC_NAMES, values)])
    figures = summary.select(F.posexplode(pairs).alias("line", "value")).select(
        F.lit(2).alias("section"), F.col("line").cast("bigint"), "value"
    )
    title, stamp = REPORT_TITLE.format(week=week), REPORT_STAMP.format(generated=generated)
    parts = [
        lines(1, title, stamp, "", METRICS_HEADING, *header(METRICS_COLUMNS)),
        figures,
        lines(3, "", CATEGORY_HEADING, *header(CATEGORY_COLUMNS)),
        _table(categories, CATEGORY_COLUMNS, 4),
        lines(5, "", CHURN_HEADING, *header(CHURN_COLUMNS)),
        _table(churn, CHURN_COLUMNS, 6),
        lines(7, ""),
    ]
    return reduce(DataFrame.unionByName, parts).orderBy("section", "line").select("value")


def write_lines(lines: DataFrame, path: str) -> None:
    lines.coalesce(1).write.mode("overwrite").text(path)
