import pytest

from shopperflow.operators import segmentation

from .conftest import rows


def spread(orders, n=10):
    """n customers, the later ones more recent, more frequent and of higher value."""
    made = []
    for i in range(1, n + 1):
        made += [(f"t{i}-{j}", f"c{i:02d}", f"2024-01-{i:02d}", 10 * i, "Completed") for j in range(i)]
    return orders(*made, ("back", "c99", "2024-01-20", 5, "Returned"))


def test_ntile_scores(orders):
    found = {r["customer_id"]: r for r in segmentation.rfm_ntile_scores(spread(orders), "2024-02-01").collect()}
    assert "c99" not in found
    assert found["c10"]["rfm_code"] == "555" and found["c10"]["rfm_segment"] == "Champions"
    assert found["c01"]["rfm_code"] == "111" and found["c01"]["rfm_segment"] == "Lost"
    assert (found["c05"]["r_score"], found["c05"]["rfm_avg"], found["c05"]["recency_days"]) == (3, 3.0, 27)


def test_ntile_summary_adds_up(orders):
    found = rows(segmentation.rfm_ntile_summary(spread(orders), "2024-02-01"))
    assert sum(r[1] for r in found) == 10
    assert sum(float(r[5]) for r in found) == sum(10.0 * i * i for i in range(1, 11))


def test_fewer_customers_than_groups(orders):
    found = segmentation.rfm_ntile_scores(spread(orders, 3), "2024-02-01").collect()
    assert sorted(r["m_score"] for r in found) == [1, 2, 3]


def test_no_completed_orders(orders):
    empty = orders(("t", "a", "2024-01-01", 1, "Returned"))
    assert segmentation.rfm_ntile_scores(empty, "2024-02-01").collect() == []
    with pytest.raises(ValueError):
        segmentation.rfm_qcut(empty, "2024-02-01")


def test_qcut_splits_seven_customers_as_pandas_does(orders):
    found = segmentation.rfm_qcut(spread(orders, 7), "2024-02-01").orderBy("customer_id").collect()
    assert [r["f"] for r in found] == [1, 1, 2, 3, 4, 5, 5]
    assert [r["rfm_score"] for r in found][:2] == [111, 111]


def test_qcut_refuses_equal_edges(orders):
    made = [(f"t{i}", f"c{i}", f"2024-01-{i + 1:02d}", amount, "Completed") for i, amount in enumerate([1, 1, 1, 1, 1, 1, 2, 3])]
    with pytest.raises(ValueError, match="monetary"):
        segmentation.rfm_qcut(orders(*made), "2024-02-01")


def test_orders_without_customer_are_left_out_of_quantile_scores(orders):
    made = [(f"t{i}", f"c{i}", f"2024-01-{i + 1:02d}", i + 1, "Completed") for i in range(6)]
    found = segmentation.rfm_qcut(orders(*made, ("t", None, "2024-01-09", 1, "Completed")), "2024-02-01")
    assert found.count() == 6


def test_unknown_amounts_add_nothing(orders):
    made = [(f"t{i}", f"c{i}", f"2024-01-{i + 1:02d}", i + 1, "Completed") for i in range(6)]
    found = segmentation.rfm_qcut(orders(*made, ("t", "c9", "2024-01-09", None, "Completed")), "2024-02-01")
    assert float({r["customer_id"]: r["monetary"] for r in found.collect()}["c9"]) == 0.0


def test_segment_summary(orders):
    summary = segmentation.rfm_segment_summary(segmentation.rfm_qcut(spread(orders), "2024-02-01"))
    found = rows(summary)
    assert sum(r[1] for r in found) == 10
    assert [float(r[5]) for r in found] == sorted((float(r[5]) for r in found), reverse=True)


def test_pareto_shares_cumulative_value_among_equals(orders, people):
    amounts = {"a": 50, "b": 20, "c": 20, "d": 10}
    made = orders(*[(f"t{c}", c, "2024-01-01", v, "Completed") for c, v in amounts.items()])
    known = people(*[(c, "Regular", "2023-01-01", 1) for c in amounts])
    found = rows(segmentation.pareto_customers(made, known, top_n=2))
    assert [(r[0], r[3], r[4], r[5]) for r in found] == [("a", 1, 50.0, 50.0), ("b", 2, 20.0, 90.0)]
    assert len(rows(segmentation.pareto_customers(made, known, top_fraction="0.5"))) == 2
    assert len(rows(segmentation.pareto_customers(made, known, top_n=2000))) == 4
    assert rows(segmentation.pareto_customers(made, known, top_n=0)) == []


def test_spend_tiers_at_their_limits(orders):
    amounts = {"a": "99.99", "b": 100, "c": "999.99", "d": 1000, "e": "4999.99", "f": 5000}
    made = orders(*[(f"t{c}", c, "2024-01-01", v, "Completed") for c, v in amounts.items()])
    found = {r[1]: r[2] for r in rows(segmentation.spend_tier_by_month(made))}
    assert found == {"Minimal": 1, "Low Value": 2, "Mid Value": 2, "High Value": 1}


def test_ltv_average_orders_skips_customers_without(orders, people):
    known = people(("a", "R", "2024-01-01", 10), ("b", "R", "2024-01-03", 20))
    made = orders(("t1", "a", "2024-01-01", 1, "Completed"), ("t2", "a", "2024-01-02", 1, "Completed"))
    (found,) = rows(segmentation.ltv_by_segment(made, known, "2024-01-31"))
    assert found == ("R", 2, 15.0, found[3], 29.0, 2.0) and float(found[3]) == 30.0


def test_scaled_features_have_mean_0_and_deviation_1(orders):
    found = rows(segmentation.rfm_scaled(spread(orders), "2024-02-01"))
    for axis in (1, 2, 3):
        values = [r[axis] for r in found]
        assert abs(sum(values)) < 1e-4
        assert abs(sum(v * v for v in values) / len(values) - 1) < 1e-4


def test_unknown_revenue_ranks_last(orders, people):
    made = orders(*[(f"t{i}", f"c{i}", "2024-01-01", None if i == 3 else 10 * (i + 1), "Completed") for i in range(6)])
    known = people(*[(f"c{i}", "R", "2023-01-01", 1) for i in range(6)])

    def found(**kw):
        return [(r["customer_id"], r["rank_num"]) for r in segmentation.pareto_customers(made, known, **kw).collect()]

    ranked = [("c5", 1), ("c4", 2), ("c2", 3), ("c1", 4), ("c0", 5), ("c3", 6)]
    assert found(top_n=2000) == found(top_n=6) == ranked and found(top_n=5) == ranked[:5] and found(top_n=0) == []


def test_fifths_with_unknown_amounts(orders):
    made = orders(*[(f"t{i}", f"c{i}", "2024-01-01", None if i < 4 else i, "Completed") for i in range(10)])
    scores = segmentation.rfm_ntile_scores(made, "2024-02-01").orderBy("customer_id")
    assert [r["m_score"] for r in scores.collect()] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
