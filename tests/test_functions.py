import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopperflow.functions import bands, calendar, numbers

from .conftest import rows


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_elapsed_days_round_down(spark):
    midnight = dt.datetime(2024, 3, 10)
    for moment, elapsed, crossed in [
        ("2024-03-09 12:00:00", 0, 1),
        ("2024-03-10 12:00:00", -1, 0),
        ("2024-03-08 00:00:00", 2, 2),
        ("2024-03-10 00:00:00", 0, 0),
    ]:
        column = F.lit(moment).cast("timestamp_ntz")
        assert one(spark, calendar.elapsed_days_since(column, T.TimestampNTZType(), midnight)) == elapsed
        assert one(spark, calendar.calendar_days_since(column, midnight)) == crossed


def test_elapsed_days_of_dates_follow_the_calendar(spark):
    day = F.lit(dt.date(2024, 3, 1))
    for snapshot in (dt.date(2024, 3, 31), "2024-03-31", dt.datetime(2024, 3, 31, 18)):
        assert one(spark, calendar.elapsed_days_since(day, T.DateType(), snapshot)) == 30


def test_snapshot_defaults_to_today(spark):
    assert one(spark, calendar.calendar_days_since(F.current_date(), None)) == 0


@pytest.mark.parametrize("day, month, quarter", [("2024-01-31", "2024-01", "2024Q1"), ("2023-12-01", "2023-12", "2023Q4"), ("2024-06-30", "2024-06", "2024Q2")])
def test_period_labels(spark, day, month, quarter):
    column = F.lit(day).cast("date")
    assert one(spark, calendar.month_label(calendar.month_index(column))) == month
    assert one(spark, calendar.quarter_label(calendar.quarter_index(column))) == quarter


def test_months_between_periods_are_whole(spark):
    first, last = (calendar.month_index(F.lit(d).cast("date")) for d in ("2023-11-30", "2024-02-01"))
    assert one(spark, last - first) == 3


def test_cut_is_right_closed_and_leaves_the_lowest_edge_out(spark):
    edges, labels = (0, 30, 60, 90, float("inf")), ("Active", "Cooling", "At Risk", "Churned")
    values = spark.createDataFrame([(d,) for d in (0, 1, 30, 31, 90, 91, None, -2)], "d int")
    expected = [None, "Active", "Active", "Cooling", "At Risk", "Churned", None, None]
    assert [r[0] for r in rows(values.select(bands.cut(F.col("d"), edges, labels)))] == expected
    closed = [r[0] for r in rows(values.select(bands.cut(F.col("d"), edges, labels, include_lowest=True)))]
    assert closed == ["Active", *expected[1:]]


def test_cut_wants_matching_labels():
    with pytest.raises(ValueError):
        bands.cut(None, (0, 1), ("a", "b"))


def test_every_score_has_one_segment(spark):
    scores = spark.range(125).select(
        (F.col("id") % 5 + 1).alias("r"), (F.floor(F.col("id") / 5) % 5 + 1).alias("f"), (F.floor(F.col("id") / 25) + 1).alias("m")
    )
    found = {tuple(row[:3]): row[3] for row in rows(scores.select("r", "f", "m", bands.rfm_segment(F.col("r"), F.col("f"), F.col("m"))))}
    assert len(found) == 125 and None not in found.values()
    assert found[5, 5, 5] == "Champions"
    assert found[3, 3, 3] == "Loyal Customers"
    assert found[4, 2, 5] == "New Customers"
    assert found[3, 1, 2] == "Potential Loyalists"
    assert found[2, 4, 4] == "At Risk"
    assert found[1, 2, 2] == "Needs Attention"
    assert found[1, 1, 5] == "Lost"
    assert found[2, 1, 1] == "Hibernating"
    assert found[3, 5, 1] == "Hibernating"


def test_dashboard_segments_differ(spark):
    r, f, m = F.lit(3), F.lit(1), F.lit(2)
    assert one(spark, bands.rfm_segment(r, f, m)) == "Potential Loyalists"
    assert one(spark, bands.rfm_segment(r, f, m, bands.DASHBOARD_SEGMENTS)) == "Hibernating"


@pytest.mark.parametrize(
    "n, d, digits, expected",
    [(1, 8, 2, 0.13), (-1, 8, 2, -0.13), (145, 1000, 2, 0.15), (2, 3, 2, 0.67), (1, 0, 2, None), (5, 2, 0, 3.0)],
)
def test_ratio_rounds_ties_away_from_zero(spark, n, d, digits, expected):
    assert one(spark, numbers.ratio(F.lit(n), F.lit(d), digits)) == expected
