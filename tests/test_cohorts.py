import pytest

from shopperflow.operators import cohorts

from .conftest import rows


@pytest.fixture(scope="module")
def made(orders):
    return orders(
        ("t1", "a", "2024-01-05", 10, "Completed", "Books"), ("t2", "a", "2024-01-09", 20, "Completed", "Toys"),
        ("t3", "a", "2024-03-01", 30, "Completed", "Books"), ("t4", "b", "2024-01-31", 40, "Completed", "Books"),
        ("t5", "c", "2024-02-01", 50, "Completed", "Toys"), ("t6", "c", "2023-12-01", 60, "Returned", "Toys"),
        ("t7", "b", "2025-01-01", 5, "Completed", "Books"),
    )


def test_retention(made):
    assert rows(cohorts.cohort_retention(made)) == [("2024-01", 2, 0, 2, 100.0), ("2024-01", 2, 2, 1, 50.0), ("2024-02", 1, 0, 1, 100.0)]


def test_retention_matrix_goes_beyond_a_year(made):
    assert ("2024-01", 12, 50.0) in rows(cohorts.retention_matrix(made))
    wide = cohorts.widened(cohorts.retention_matrix(made), [0, 1, 2]).collect()
    assert [tuple(r) for r in wide] == [("2024-01", 100.0, None, 50.0), ("2024-02", 100.0, None, None)]


def test_orders_without_customer_enlarge_a_cohort_only(orders):
    made = orders(("t1", "a", "2024-01-05", 10, "Completed"), ("t2", None, "2024-01-06", 10, "Completed"), ("t3", None, "2024-02-06", 10, "Completed"))
    assert rows(cohorts.cohort_retention(made)) == [("2024-01", 2, 0, 1, 50.0)]
    assert rows(cohorts.retention_matrix(made)) == [("2024-01", 0, 100.0)]


def test_order_value(made):
    found = {(r[0], r[2]): (r[1], r[3], r[4], float(r[5])) for r in rows(cohorts.cohort_aov(made))}
    assert found["2024-01", 0] == ("2024-01", 3, 23.33, 70.0)
    assert found["2024-01", 2] == ("2024-03", 1, 30.0, 30.0)
    assert rows(cohorts.cohort_aov(made)) == rows(cohorts.cohort_aov(made, unique_ids=True))


def test_order_value_counts_a_repeated_id_once(orders):
    made = orders(("t1", "a", "2024-01-05", 10, "Completed"), ("t1", "a", "2024-01-05", 10, "Completed"), ("t1", "b", "2024-01-05", 10, "Completed"))
    assert rows(cohorts.cohort_aov(made))[0][3:5] == (1, 10.0)


def test_category(made):
    found = [(r[0], r[1], r[2], r[3], float(r[4])) for r in rows(cohorts.cohort_category(made))]
    assert ("2024-01", "Books", 0, 2, 50.0) in found and ("2024-01", "Toys", 0, 1, 20.0) in found


def test_cumulative_revenue(made):
    found = [(r[0], r[1], float(r[2]), float(r[3])) for r in rows(cohorts.cohort_ltv(made))]
    assert found == [("2024-01", 0, 70.0, 70.0), ("2024-01", 2, 30.0, 100.0), ("2024-01", 12, 5.0, 105.0), ("2024-02", 0, 50.0, 50.0)]
    assert rows(cohorts.ltv_curve(made)) == [("2024-01", 0, 35.0), ("2024-01", 2, 50.0), ("2024-01", 12, 52.5), ("2024-02", 0, 50.0)]


def test_quarters_nobody_returned_in_are_null(made):
    found = rows(cohorts.quarterly_retention(made))
    assert [r for r in found if r[0] == "2024Q1"] == [("2024Q1", 0, 100.0), *[("2024Q1", q, 33.3 if q == 4 else None) for q in range(1, 6)]]
