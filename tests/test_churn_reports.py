from shopperflow.operators import churn_reports

from .conftest import rows

TODAY = "2024-07-01"


def test_status_labels_at_their_limits(orders, people):
    # 30, 31, 90, 91, 180 and 181 days before the snapshot.
    days = {"a": "2024-06-01", "b": "2024-05-31", "c": "2024-04-02", "d": "2024-04-01", "e": "2024-01-03", "f": "2024-01-02"}
    made = orders(*[(f"t{c}", c, day, 10, "Completed") for c, day in days.items()], ("x", "stranger", "2024-06-30", 5, "Completed"))
    known = people(*[(c, "Regular", "2023-01-01", 1) for c in days])
    found = rows(churn_reports.churn_status_summary(made, known, TODAY))
    assert [(r[0], r[1]) for r in found] == [("Active", 1), ("Cooling Off", 2), ("At Risk", 2), ("Churned", 1)]


def test_status_counts_distinct_orders_of_completed_rows(orders, people):
    made = orders(
        ("t1", "a", "2024-06-30", "1.11", "Completed"), ("t1", "a", "2024-06-30", "1.11", "Completed"),
        ("t2", "a", "2024-06-29", "1.12", "Completed"), ("t3", "a", "2024-06-30", "9.00", "Returned"),
    )
    known = people(("a", "Regular", "2023-01-01", 1))
    assert [(float(v) if i else v) for i, v in enumerate(rows(churn_reports.churn_status_summary(made, known, TODAY))[0])] == ["Active", 1, 2.0, 3.34, 3.34]
    assert rows(churn_reports.churn_status_summary(made, known, TODAY, unique_ids=True))[0][2] == 3.0


def test_cohort_churn_keeps_cohorts_without_orders_and_early_orders(orders, people):
    known = people(("a", "R", "2024-02-10", 1), ("b", "R", "2024-02-11", 1), ("c", "R", "2024-03-01", 1))
    made = orders(
        ("t1", "a", "2024-01-05", 1, "Completed"), ("t2", "a", "2024-04-05", 1, "Completed"),
        ("t3", "a", "2024-04-06", 1, "Completed"), ("t4", "b", "2024-04-07", 1, "Cancelled"),
    )
    found = {(r[0], r[2]): r for r in rows(churn_reports.cohort_churn_rate(made, known))}
    assert found["2024-02", "2024-01"][3:] == (-1, 1, 50.0, 50.0)
    assert found["2024-02", "2024-04"][3:] == (2, 1, 50.0, 50.0)
    assert found["2024-02", None][3:] == (None, 0, 0.0, 100.0)
    assert found["2024-03", None][1] == 1


def test_signals_without_sessions_are_kept(orders, people, visits):
    known = people(("a", "Regular", "2023-01-01", 1), ("b", "Premium", "2023-01-01", 1), ("c", "Premium", "2023-01-01", 1))
    made = orders(
        *[(f"r{i}", "a", "2024-03-01", 10, "Returned") for i in range(3)],
        ("k1", "b", "2024-04-25", "0.01", "Cancelled"), ("k2", "b", "2024-04-25", "0.02", "Cancelled"),
        ("o1", "c", "2024-05-20", 5, "Completed"),
    )
    seen = visits(("s1", "c", "Email", "Mobile", 1, 10, False), ("s2", "c", "Email", "Mobile", 1, 11, False), ("s3", "c", "Email", "Mobile", 1, 12, True), ("s4", "c", "Email", "Mobile", 5, 13, True))
    found = {r["customer_id"]: r for r in churn_reports.churn_signals(made, known, seen, TODAY).collect()}
    assert (found["a"]["churn_risk_level"], found["a"]["bounce_rate"], found["a"]["returns"]) == ("High Churn Risk", None, 3)
    assert (found["b"]["churn_risk_level"], found["b"]["avg_order_value"]) == ("Medium Churn Risk", 0.02)
    assert (found["c"]["churn_risk_level"], found["c"]["bounce_rate"], found["c"]["avg_session_duration"]) == ("Medium Churn Risk", 75.0, 12.0)


def test_revenue_at_risk_takes_either_condition(orders, people):
    known = people(
        ("a", "Churned", "2024-06-30", 10), ("b", "Regular", "2023-07-02", 20), ("c", "Regular", "2024-06-30", 40), ("d", "Regular", "2024-06-30", 80)
    )
    made = orders(("t1", "b", "2024-01-01", 1, "Completed"), ("t2", "c", "2024-06-01", 1, "Completed"), ("t3", "d", "2024-01-01", 1, "Returned"))
    found = {r[0]: r[1:] for r in rows(churn_reports.revenue_at_risk(made, known, TODAY))}
    assert {k: (v[0], float(v[2])) for k, v in found.items()} == {"Churned": (1, 10.0), "Regular": (1, 20.0)}
    assert found["Regular"][3] == 1.0
