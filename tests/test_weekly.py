import datetime as dt
import logging

import pytest
from pyspark.sql import functions as F

from shopperflow.operators import dashboards, weekly
from shopperflow.schemas import TRANSACTION_CONTRACT

from .conftest import rows


def test_cleaning_keeps_one_row_per_id_and_positive_amounts(orders):
    raw = orders(
        ("t1", "a", "2024-01-02", 7, "Completed"), ("t1", "a", "2024-01-01", 9, "Completed"), ("t1", "a", "2024-01-01", 8, "Completed"),
        ("t2", "a", "2024-01-03", 0, "Completed"), ("t3", "a", "2024-01-03", -1, "Completed"), ("t4", "a", "2024-01-03", None, "Completed"),
    )
    (kept,) = weekly.clean_transactions(raw).collect()
    assert (kept["order_date"], float(kept["total_amount"])) == (dt.date(2024, 1, 1), 8.0)
    (kept,) = weekly.clean_transactions(raw, ["total_amount"]).collect()
    assert float(kept["total_amount"]) == 7.0
    assert rows(weekly.duplicates_removed(raw)) == [(6, 4, 2)]


def test_nan_amounts_are_dropped(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (0.0,), (None,)], "total_amount double")
    assert rows(weekly.positive_amounts(df)) == [(1.0,)]


@pytest.mark.parametrize(
    "day, expected",
    [
        ("2021-01-01", (53, "2021-01", "2021Q1", "Friday", False)),
        ("2024-12-30", (1, "2024-12", "2024Q4", "Monday", False)),
        ("2024-06-08", (23, "2024-06", "2024Q2", "Saturday", True)),
        ("2024-06-09", (23, "2024-06", "2024Q2", "Sunday", True)),
    ],
)
def test_calendar_columns(orders, day, expected):
    (row,) = weekly.clean_transactions(orders(("t", "a", day, 1, "Completed"))).collect()
    assert tuple(row[c] for c in ("week", "month", "quarter", "day_of_week", "is_weekend")) == expected


def test_contract(orders, caplog):
    with pytest.raises(ValueError, match="status"):
        weekly.clean_transactions(orders(("t", "a", "2024-01-01", 1, "Completed")).drop("status"))
    with caplog.at_level(logging.WARNING):
        found = weekly.warn_about_nulls(orders(("t", None, "2024-01-01", None, "Completed")), TRANSACTION_CONTRACT, "transactions")
    assert found == {"customer_id": 1, "total_amount": 1} and "transactions" in caplog.text


def test_null_profile_of_an_empty_table(orders):
    empty = orders(("t", "a", "2024-01-01", 1, "Completed")).filter("false")
    assert set(rows(weekly.null_profile(empty, ["status", "customer_id"]))) == {("status", 0), ("customer_id", 0)}


def test_tenure_bands(people):
    days = ["2024-01-31", "2024-01-30", "2023-11-02", "2023-11-01", "2023-01-31", "2022-01-31", "2024-02-01"]
    known = people(*[(f"c{i}", "R", day, 1) for i, day in enumerate(days)])
    found = [(r["tenure_days"], r["tenure_band"]) for r in weekly.with_tenure(known, "2024-01-31").orderBy("customer_id").collect()]
    assert found == [
        (0, None), (1, "New (<3m)"), (90, "New (<3m)"), (91, "Growing (3-12m)"), (365, "Growing (3-12m)"),
        (730, "Established (1-2y)"), (-1, None),
    ]


def test_enrichment_keeps_orders_of_unknown_customers(orders, people):
    made = weekly.clean_transactions(orders(("t1", "a", "2024-01-01", 1, "Completed"), ("t2", "zz", "2024-01-01", 1, "Completed")))
    found = weekly.enriched(made, weekly.with_tenure(people(("a", "R", "2023-01-01", 1)), "2024-01-31"))
    assert {(r["transaction_id"], r["segment"], r["country"]) for r in found.collect()} == {("t1", "R", "India"), ("t2", None, None)}


def test_weekly_summary(orders):
    made = weekly.clean_transactions(orders(
        ("t1", "a", "2024-01-01", "10.00", "Completed"), ("t2", "a", "2024-01-07", "5.05", "Completed"),
        ("t3", "b", "2023-01-02", "1.00", "Completed"), ("t4", "b", "2024-01-02", "1.00", "Returned"), ("t5", "b", "2024-01-08", "1.00", "Completed"),
    ))
    (row,) = rows(weekly.weekly_summary(made, 1))
    assert (row[0], float(row[1]), row[2], row[3], row[4]) == (1, 16.05, 3, 2, 5.35)
    (row,) = rows(weekly.weekly_summary(made, 1, year=2024))
    assert (float(row[1]), row[2], row[3]) == (15.05, 2, 1)
    (row,) = rows(weekly.weekly_summary(made, 30))
    assert (row[0], float(row[1]), row[2], row[3], row[4]) == (30, 0.0, 0, 0, 0.0)


def test_segment_kpis_from_either_form(orders, people):
    made = weekly.clean_transactions(orders(
        ("t1", "a", "2024-01-01", 1, "Completed"), ("t2", "a", "2024-01-02", 2, "Completed"), ("t3", "b", "2024-01-02", 4, "Completed"),
        ("t4", "zz", "2024-01-02", 8, "Completed"), ("t5", "a", "2024-01-09", 16, "Completed"), ("t6", None, "2024-01-02", 32, "Completed"),
    ))
    known = weekly.with_tenure(people(("a", "R", "2023-01-01", 1), ("b", "R", "2023-01-01", 1)), "2024-01-31")
    found = [(r[0], r[1], float(r[2]), r[3]) for r in rows(weekly.segment_weekly_kpis(made, known))]
    assert found == [(1, "R", 7.0, 2), (2, "R", 16.0, 1)]
    assert rows(weekly.segment_weekly_kpis(weekly.enriched(made, known))) == rows(weekly.segment_weekly_kpis(made, known))


def test_churn_risk_counts_every_band(orders, people):
    made = orders(
        ("t1", "a", "2024-01-31", 1, "Completed"), ("t2", "b", "2024-01-30", 1, "Completed"), ("t3", "c", "2023-12-31", 1, "Completed"), ("t4", "d", "2023-01-01", 1, "Completed")
    )
    known = people(*[(c, "R", "2023-01-01", 1) for c in "abcde"])
    expected = [("Active", 1), ("Cooling", 1), ("At Risk", 0), ("Churned", 1)]
    assert rows(weekly.churn_risk_summary(known, made, "2024-01-31")) == expected
    assert rows(weekly.churn_risk_summary(known, made, "2024-01-31", include_lowest=True))[0] == ("Active", 2)


def test_inactivity_buckets_take_day_zero(orders):
    made = orders(("t1", "a", "2024-01-31", 1, "Completed"), ("t2", "b", "2024-02-05", 1, "Completed"), ("t3", "d", "2023-01-01", 1, "Completed"))
    found = rows(dashboards.inactivity_buckets(made, "2024-01-31"))
    assert [r[1] for r in found] == [2, 0, 0, 1] and [r[2] for r in found] == [66.7, 0.0, 0.0, 33.3]


def test_weekdays_without_orders_show_zero(orders):
    found = rows(dashboards.orders_by_weekday(orders(("t1", "a", "2024-06-09", 1, "Completed"))))
    assert found == [(d, int(d == "Sunday")) for d in dashboards.WEEKDAYS]


def test_churn_rate_counts_customers_without_orders_as_staying(orders, people):
    known = people(*[(c, "R", "2023-01-01", 1) for c in "abcd"])
    made = orders(("t1", "a", "2023-01-01", 1, "Completed"), ("t2", "b", "2024-01-30", 1, "Completed"))
    assert rows(dashboards.churn_rate_by_segment(made, known, "2024-01-31")) == [("R", 25.0)]


def test_histogram(orders):
    counts = {"a": 1, "b": 1, "c": 16, "d": 31, "e": 45}
    made = orders(*[(f"{c}{i}", c, "2024-01-01", 1, "Completed") for c, n in counts.items() for i in range(n)])
    found = dashboards.order_frequency_histogram(made).collect()
    assert len(found) == 30 and [r["customers"] for r in found if r["customers"]] == [2, 1, 2]
    assert found[0]["customers"] == 2 and found[15]["customers"] == 1 and found[29]["customers"] == 2
    assert (found[0]["bin_lo"], found[29]["bin_hi"], found[0]["mean_orders"], found[0]["median_orders"]) == (1.0, 30.0, 18.8, 16.0)


def test_histogram_of_one_value(orders):
    found = dashboards.order_frequency_histogram(orders(("t1", "a", "2024-01-01", 1, "Completed"))).collect()
    assert [(r["bin"], r["customers"]) for r in found if r["customers"]] == [(15, 1)]
    assert (found[0]["bin_lo"], found[29]["bin_hi"]) == (0.5, 1.5)


def test_last_months(orders):
    made = orders(*[(f"t{y}{m}", "a", f"{y}-{m:02d}-01", m, "Completed") for y in (2022, 2023) for m in range(1, 13)])
    found = rows(dashboards.monthly_revenue(made))
    assert len(found) == 18 and found[0][0] == "2022-07" and found[-1][0] == "2023-12"


def test_first_purchase(orders):
    made = orders(
        ("t2", "a", "2024-01-01", 1, "Returned"), ("t1", "a", "2024-01-01", 1, "Completed"), ("t0", "a", "2024-01-02", 1, "Completed"),
        ("t9", "b", "2024-01-02", 1, "Completed"), ("t8", None, "2024-01-02", 1, "Completed"),
    )
    assert {r[0] for r in rows(dashboards.first_purchase_flag(made)) if r[2]} == {"t1", "t9"}
    assert dashboards.first_purchase_flag(made).count() == 5


def test_session_splits(visits):
    seen = visits(*[(f"s{i}", "a", "Email" if i % 2 else "Direct", "Mobile" if i else "Tablet", 2, 5, i == 1) for i in range(4)])
    assert rows(dashboards.conversion_by_source(seen)) == [("Direct", 2, 0, 0.0), ("Email", 2, 1, 50.0)]
    assert rows(dashboards.device_split(seen)) == [("Mobile", 3, 75.0), ("Tablet", 1, 25.0)]


def test_scatter_sample_is_bounded_and_repeatable(spark):
    rfm = spark.range(1000).select(
        F.when(F.col("id") < 900, "Lost").otherwise("Loyal").alias("segment"), F.col("id").cast("string").alias("customer_id"),
        *[F.lit(1).alias(c) for c in ("recency", "frequency", "monetary")],
    )
    found = rows(dashboards.rfm_scatter_sample(rfm))
    assert sum(r[0] == "Lost" for r in found) == 300 and sum(r[0] == "Loyal" for r in found) == 100
    assert set(found) == set(rows(dashboards.rfm_scatter_sample(rfm.repartition(7))))
