"""What a session needs before the statements of `statements` run: views, a day to look back from, SQL functions.

The functions are defined in SQL, so Catalyst puts their bodies in place of the calls: nothing runs outside the JVM, and
filters, pruned columns and constant folding go through them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.calendar import Moment
from ..operators import segmentation
from ..sources.tables import register_views

# Codes of the date patterns of `date_text`, and what they stand for in Spark's own patterns.
DATE_CODES = (("%Y", "yyyy"), ("%y", "yy"), ("%m", "MM"), ("%c", "M"), ("%M", "MMMM"), ("%b", "MMM"), ("%d", "dd"), ("%e", "d"),
              ("%j", "DDD"), ("%H", "HH"), ("%i", "mm"), ("%s", "ss"), ("%W", "EEEE"), ("%a", "EEE"))


def _pattern() -> str:
    made = "pattern"
    for code, ours in DATE_CODES:
        made = f"replace({made}, '{code}', '{ours}')"
    return made


FUNCTIONS = {
    "date_text(moment TIMESTAMP_NTZ, pattern STRING) RETURNS STRING": f"date_format(moment, {_pattern()})",
    # Months between two periods written 202403; '2024-03' will do as well.
    "period_diff(one STRING, other STRING) RETURNS INT": """
        (CAST(left(one, 4) AS INT) * 12 + CAST(right(one, 2) AS INT)) - (CAST(left(other, 4) AS INT) * 12 + CAST(right(other, 2) AS INT))""",
    # The place of a value in a list of up to eight, from 1; 0 if it is not in it.
    "field(value STRING, a STRING, b STRING DEFAULT NULL, c STRING DEFAULT NULL, d STRING DEFAULT NULL, e STRING DEFAULT NULL, "
    "f STRING DEFAULT NULL, g STRING DEFAULT NULL, h STRING DEFAULT NULL) RETURNS INT": """
        CAST(coalesce(array_position(array(a, b, c, d, e, f, g, h), value), 0) AS INT)""",
    # Ratios rounded to so many places: on decimals, so that a tie is a tie. (Places must be literals inside the body.)
    **{
        f"ratio{places}(part DECIMAL(24,4), whole DECIMAL(24,2)) RETURNS DOUBLE": f"CAST(round(part / nullif(whole, 0), {places}) AS DOUBLE)"
        for places in range(4)
    },
}


def prepare(spark: SparkSession, customers: DataFrame, transactions: DataFrame, sessions: DataFrame, snapshot_date: Moment = None) -> None:
    """Registers customers, transactions, sessions, customer_scores and customer_ranks; sets `today`; defines the functions.

    Scores and ranks are places in an order over all customers. A window over a whole table is one task, so these two
    views come from the distributed order of `plans.ordering` instead; they are computed when a statement reads them.
    """
    register_views(customers, transactions, sessions)
    day = "current_date()" if snapshot_date is None else f"CAST('{snapshot_date}' AS DATE)"
    spark.sql(f"DECLARE OR REPLACE VARIABLE today DATE DEFAULT {day}")
    for head, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")


def run(spark: SparkSession, name: str, customers: DataFrame, transactions: DataFrame, sessions: DataFrame, snapshot_date: Moment = None) -> DataFrame:
    """The report `name`, as its statement says."""
    from .statements import STATEMENTS

    prepare(spark, customers, transactions, sessions, snapshot_date)
    statement = STATEMENTS[name]
    if "customer_scores" in statement:
        segmentation.rfm_ntile_scores(transactions, snapshot_date).createOrReplaceTempView("customer_scores")
    if "customer_ranks" in statement:
        segmentation.revenue_ranks(transactions, customers).createOrReplaceTempView("customer_ranks")
    return spark.sql(statement)
