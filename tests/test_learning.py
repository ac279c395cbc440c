import datetime as dt
import math
import random

import pytest
from pyspark.ml import PipelineModel

from shopperflow.learning import churn_model, clusters, evaluation
from shopperflow.operators import churn_features as cf
from shopperflow.operators.segmentation import rfm_base

TODAY = "2023-09-08"
THRESHOLD = 20


@pytest.fixture(scope="module")
def shop(orders, people, visits):
    """60 shoppers in three habits: weekly, monthly, and gone since spring. All values follow from their numbers."""
    made, number = [], 0
    for who in range(60):
        gap, last = ((9, 8 + who % 11), (30, 15 + who % 23), (17, 60 + 2 * (who % 40)))[who % 3]
        for back in range(last, 240, gap + who % 4):
            number += 1
            status = "Returned" if number % 13 == 0 else "Cancelled" if number % 17 == 0 else "Completed"
            day = dt.date.fromisoformat(TODAY) - dt.timedelta(days=back)
            made.append((f"o-{number}", f"shopper-{who}", day.isoformat(), 20 + (37 * number) % 480, status, ("Garden", "Tools", "Paint", "Light")[number % 4], number % 25))
    known = people(*[
        (f"shopper-{who}", ("Gold", "Plain")[who % 2], f"2021-{1 + who % 12:02d}-15", 5 * who, ("F", "M", "X")[who % 5 % 3], ("Peru", "Kenya", "Norway", "Japan")[who % 7 % 4], 20 + who)
        for who in range(60)
    ])
    seen = visits(*[(f"v{i}", f"shopper-{i % 25}", "Direct", "Tablet", 1 + i % 6, 15 * i, i % 5 == 0) for i in range(75)])
    return known, orders(*made), seen


@pytest.fixture(scope="module")
def features(shop):
    return cf.churn_features(*shop, snapshot_date=TODAY, threshold_days=THRESHOLD).cache()


def test_features_of_one_customer(orders, people, visits):
    made = orders(
        ("t1", "a", "2024-01-01", "10.00", "Completed", "Books", 10), ("t2", "a", "2024-01-31", "30.00", "Completed", "Toys", 20),
        ("t3", "a", "2024-02-20", "99.00", "Returned", "Art"), ("t4", "b", "2024-02-01", "5.00", "Cancelled"), ("t5", None, "2024-02-01", "5.00", "Completed"),
        ("t6", "c", "2024-02-20", "7.00", "Completed"),
    )
    known = people(("a", "R", "2024-01-01", 1, "M", "UK", 40), ("b", "R", "2024-01-01", 1, "F", "USA", 41), ("c", "R", "2024-01-01", 1, None, "India", 42))
    seen = visits(("s1", "a", "Email", "Mobile", 1, 10, True), ("s2", "a", "Email", "Mobile", 4, 20, False))
    found = {r["customer_id"]: r.asDict() for r in cf.churn_features(known, made, seen, "2024-03-01", 25).collect()}
    assert set(found) == {"a", "c"}
    a = found["a"]
    assert (a["total_orders"], float(a["total_revenue"]), a["avg_order_value"], float(a["max_order_value"])) == (2, 40.0, 20.0, 30.0)
    assert (a["unique_categories"], a["recency_days"], a["first_order_days"], a["avg_discount"]) == (2, 30, 60, 15.0)
    assert (a["order_frequency"], a["returns"], a["cancellations"], a["return_rate"]) == (2 / 3, 1, 0, 0.5)
    assert (a["total_sessions"], a["avg_session_duration"], a["bounce_rate"], a["conversion_rate"], a["churned"]) == (2, 15.0, 0.5, 0.5, 1)
    # Only M and no other gender is present among these customers, so it is the dropped one.
    assert not [c for c in a if c.startswith("gender_")] and a["country_UK"] == 1 and found["c"]["country_UK"] == 0
    assert found["c"]["total_sessions"] is None and found["c"]["churned"] == 0


def test_one_hot_drops_the_first_value(spark):
    df = spark.createDataFrame([("M",), ("F",), (None,)], "gender string")
    assert [r["gender_M"] for r in cf.one_hot(df, cf.category_lists(df, ["gender"])).collect()] == [1, 0, 0]


def test_one_hot_with_given_lists(spark):
    df = spark.createDataFrame([("M",), ("new",)], "gender string")
    found = cf.one_hot(df, {"gender": ["F", "M", "X"]})
    assert found.columns == ["gender_M", "gender_X"] and [tuple(r) for r in found.collect()] == [(1, 0), (0, 0)]


def test_many_categories_are_kept(spark):
    df = spark.range(2500).selectExpr("cast(id as string) as gender")
    assert len(cf.category_lists(df, ["gender"])["gender"]) == 2500


def test_saved_model_scores_tables_with_other_categories(spark, shop, tmp_path):
    known, made, seen = shop
    table = cf.customer_features(known, made, seen, TODAY, THRESHOLD).cache()
    model = churn_model.train(table, "lr", cross_validate=False)
    model.save(str(tmp_path / "m"))
    loaded = churn_model.ChurnModel.load(spark, str(tmp_path / "m"))
    assert (loaded.kind, loaded.columns, loaded.lists) == (model.kind, model.columns, model.lists)
    expected = {r[0]: r[1] for r in model.probabilities(table).collect()}
    some = table.filter("country = 'Peru'")  # alone, Peru would be the category that is dropped
    assert {r[0]: r[1] for r in loaded.probabilities(some).collect()} == {k: expected[k] for k in [r[0] for r in some.select("customer_id").collect()]}
    elsewhere = table.withColumn("country", cf.F.lit("Atlantis")).drop("age")
    assert all(0 <= r[1] <= 1 for r in loaded.probabilities(elsewhere).collect())
    with pytest.raises(ValueError):
        loaded.metrics()


def test_sessions_are_optional(shop):
    known, made, _ = shop
    assert "total_sessions" not in cf.churn_features(known, made, None, TODAY).columns


def test_split_is_stratified(features):
    split = cf.stratified_split(features).collect()
    assert len(split) == features.count()
    for label in (0, 1):
        group = [r for r in split if r["churned"] == label]
        assert sum(r["is_test"] for r in group) == math.floor(0.2 * len(group) + 0.5)
        folds = [sum(r["fold"] == k for r in group if not r["is_test"]) for k in range(5)]
        assert max(folds) - min(folds) <= 1
    assert all((r["fold"] is None) == r["is_test"] for r in split)


def test_cross_validated_area_comes_from_the_folds(features):
    model = churn_model.train(features, "lr")
    split = cf.stratified_split(features).filter("not is_test")
    areas = []
    for fold in range(5):
        inputs = churn_model._model_input(split, model.columns)
        train, held = inputs.filter(f"fold <> {fold}"), inputs.filter(f"fold = {fold}")
        refit = churn_model.Pipeline(stages=[
            churn_model.VectorAssembler(inputCols=list(model.columns), outputCol="assembled"),
            churn_model.StandardScaler(inputCol="assembled", outputCol="scaled", withMean=True, withStd=True),
            churn_model._estimator("lr", train.count()),
        ]).fit(train)
        scored = refit.transform(held).select("churned", churn_model.vector_to_array("probability")[1].alias("p")).collect()
        areas.append(brute_force([(r["p"], r["churned"]) for r in scored])[0])
    mean = sum(areas) / 5
    spread = (sum((a - mean) ** 2 for a in areas) / 5) ** 0.5
    assert model.cv_areas == pytest.approx((mean, spread), abs=1e-6)


@pytest.mark.parametrize("kind", ["lr", "rf", "gbm"])
def test_models(features, kind, tmp_path):
    model = churn_model.train(features, kind)
    assert "recency_days" not in model.columns
    metrics = {r["metric"]: r["value"] for r in model.metrics().collect()}
    for name in ("roc_auc", "avg_precision", "cv_auc_mean", "accuracy"):
        assert 0 <= metrics[name] <= 1
    assert metrics["support_0"] + metrics["support_1"] == model.test.count()
    scores = [r["churn_probability"] for r in model.probabilities(features).collect()]
    assert len(scores) == features.count() and all(0 <= s <= 1 for s in scores)
    if kind == "lr":
        with pytest.raises(ValueError):
            model.importance()
    else:
        weights = [r["importance"] for r in model.importance().collect()]
        assert abs(sum(weights) - 1) < 1e-9 and weights == sorted(weights, reverse=True)
    model.pipeline.save(str(tmp_path / kind))
    assert len(PipelineModel.load(str(tmp_path / kind)).stages) == 3


def test_large_tables_are_dealt_evenly(spark, monkeypatch):
    wide = churn_model.settle(spark.range(3000).selectExpr("id as customer_id").repartition(3).coalesce(1))
    assert churn_model._dealt(wide) is wide and churn_model._fits_at_once("rf", False) == 6
    monkeypatch.setattr(churn_model, "TASK_ROWS", 100)
    found = [[r[0] for r in part] for part in churn_model._dealt(wide).rdd.glom().collect()]
    assert len(found) == spark.sparkContext.defaultParallelism and max(map(len, found)) < 2 * min(map(len, found))
    assert sorted(sum(found, [])) == list(range(3000)) and all(part == sorted(part) for part in found)
    monkeypatch.setattr(churn_model, "MOST_ROWS", 100)
    assert churn_model._dealt(wide).rdd.getNumPartitions() == 30
    assert [churn_model._fits_at_once(kind, True) for kind in ("rf", "gbm", "lr")] == [1, 6, 6]


def test_dealt_rows_make_a_whole_model(features, monkeypatch):
    monkeypatch.setattr(churn_model, "TASK_ROWS", 10)
    metrics = {r["metric"]: r["value"] for r in churn_model.train(features, "rf").metrics().collect()}
    split = cf.stratified_split(features).filter("is_test")
    assert metrics["support_0"] + metrics["support_1"] == split.count() and 0 <= metrics["cv_auc_mean"] <= 1


def test_forest_with_kept_nodes_is_the_same(features):
    columns = churn_model.numeric_columns(features, churn_model.LEAKING)
    rows = churn_model.VectorAssembler(inputCols=columns, outputCol="scaled").transform(churn_model._model_input(features, columns)).coalesce(2).cache()
    ours = churn_model._estimator("rf", 60)
    assert ours.getCacheNodeIds()
    searched = ours.copy().setCacheNodeIds(False).fit(rows)
    assert ours.fit(rows).toDebugString.split("\n", 1)[1] == searched.toDebugString.split("\n", 1)[1]


def test_the_leaking_input_separates_the_classes(features):
    model = churn_model.train(features, "rf", cross_validate=False, exclude=())
    assert "recency_days" in model.columns
    assert {r["metric"]: r["value"] for r in model.metrics().collect()}["roc_auc"] > 0.95


def test_area_of_very_many_rows(spark):
    """Counts whose product passes the range of a long."""
    df = spark.createDataFrame([(4_000_000_000, 9_000_000_000, 5_000_000_000)], "neg long, tp long, pos long")
    assert int(df.select(evaluation._twice_area("neg", "tp", "pos")).first()[0]) == 4_000_000_000 * 13_000_000_000


def test_unknown_model(features):
    with pytest.raises(ValueError):
        churn_model.train(features, "svm", cross_validate=False)


def brute_force(pairs):
    """Area and average precision over all pairs and all thresholds."""
    pos, neg = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    area = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    steps, before = 0.0, 0.0
    for threshold in sorted({s for s, _ in pairs}, reverse=True):
        said = [y for s, y in pairs if s >= threshold]
        recall = sum(said) / len(pos)
        steps += (recall - before) * sum(said) / len(said)
        before = recall
    return area, steps


@pytest.mark.parametrize("seed", range(4))
def test_ranking_scores_under_ties(spark, seed):
    r = random.Random(seed)
    pairs = [(r.randint(0, 6) / 6, int(r.random() < 0.4)) for _ in range(80)]
    found = evaluation.ranking_scores(spark.createDataFrame(pairs, "s double, y int").repartition(4), "y", "s")
    assert found == pytest.approx(brute_force(pairs))


def test_one_class_has_no_area(spark):
    df = spark.createDataFrame([(0.4, 1), (0.6, 1)], "s double, y int")
    found = {r["metric"]: r["value"] for r in evaluation.binary_metrics(df, "y", "s").collect()}
    assert found["roc_auc"] is None and found["true_positives"] == 1 and found["precision_0"] == 0


def brute_silhouette(groups):
    """Mean over all points, with squared distances over all pairs."""
    def mean_square(p, others):
        return sum(float(((p - o) ** 2).sum()) for o in others) / len(others)

    values = []
    for cluster, members in groups.items():
        for i, p in enumerate(members):
            if len(members) == 1:
                values.append(0.0)
                continue
            inside = mean_square(p, members[:i] + members[i + 1:])
            outside = min(mean_square(p, other) for name, other in groups.items() if name != cluster)
            values.append((outside - inside) / max(inside, outside))
    return sum(values) / len(values)


def test_clusters(shop):
    rfm = rfm_base(shop[1], TODAY)
    model, labelled, silhouette = clusters.fit_clusters(rfm, k=3, restarts=3)
    assert labelled.count() == rfm.count() and -1 <= silhouette <= 1
    assert {r["cluster"] for r in labelled.select("cluster").distinct().collect()} == {0, 1, 2}
    points = {r["customer_id"]: r["scaled"].toArray() for r in clusters.scaled_vectors(rfm).collect()}
    centers = model.clusterCenters()
    cost = 0.0
    for row in labelled.collect():
        squared = [float(((points[row["customer_id"]] - center) ** 2).sum()) for center in centers]
        assert squared[row["cluster"]] == pytest.approx(min(squared))
        cost += min(squared)
    assert model.summary.trainingCost == pytest.approx(cost)
    groups = {}
    for row in labelled.collect():
        groups.setdefault(row["cluster"], []).append(points[row["customer_id"]])
    assert silhouette == pytest.approx(brute_silhouette(groups))
    search = clusters.optimal_k(rfm, range(2, 5), restarts=2).collect()
    assert [r["k"] for r in search] == [2, 3, 4]
    assert all(r["inertia"] > 0 for r in search)
