"""The shared passes of the k search against plain restatements."""

import numpy as np
import pytest

from shopperflow.learning import many_means

AXES = ["a", "b"]


def table(spark, points):
    rows = [(float(x), float(y), hash((i, 7)) & 0x7FFFFFFFFFFFFFFF) for i, (x, y) in enumerate(points)]
    return spark.createDataFrame(rows, "a double, b double, noise long").repartition(5)


def plain(points, centres):
    """Inertia and mean silhouette of squared distances, over all pairs."""
    own = ((points[:, None] - centres[None]) ** 2).sum(2)
    label, values = own.argmin(1), []
    pairs = ((points[:, None] - points[None]) ** 2).sum(2)
    for i, mine in enumerate(label):
        size = (label == mine).sum()
        if size == 1:
            values.append(0.0)
            continue
        inside = pairs[i, label == mine].sum() / (size - 1)
        outside = min(pairs[i, label == other].mean() for other in set(label) - {mine})
        values.append((outside - inside) / max(outside, inside))
    return own.min(1).sum(), np.mean(values)


def test_all_models_at_once(spark):
    rng = np.random.default_rng(3)
    points = np.vstack([rng.normal(at, 0.4, (60, 2)) for at in [(0, 0), (6, 0), (0, 7), (8, 8)]])
    found = many_means.fit(table(spark, points), AXES, [2, 3, 4, 5], [1, 2, 3, 4], 100)
    assert [m.k for m in found] == [2, 3, 4, 5]
    for m in found:
        inertia, silhouette = plain(points, m.centres)
        assert (m.inertia, m.silhouette) == (pytest.approx(inertia), pytest.approx(silhouette))
        nearest = ((points[:, None] - m.centres[None]) ** 2).sum(2).argmin(1)
        assert all(np.allclose(points[nearest == j].mean(0), c, atol=1e-3) for j, c in enumerate(m.centres))
    truth = sum(((part - part.mean(0)) ** 2).sum() for part in np.split(points, 4))
    assert found[2].inertia == pytest.approx(truth) and found[2].silhouette == max(m.silhouette for m in found)
    again = many_means.fit(table(spark, points).repartition(2), AXES, [4], [1, 2, 3, 4], 100)
    assert again[0].inertia == pytest.approx(found[2].inertia)


def test_few_equal_or_no_rows(spark):
    same = many_means.fit(table(spark, [(1, 1)] * 6), AXES, [2], [1], 10)
    assert [(m.k, len(m.centres), m.inertia, m.silhouette) for m in same] == [(2, 1, 0.0, None)]
    two = many_means.fit(table(spark, [(1, 1)] * 5 + [(2, 2)] * 4), AXES, [3], [1, 2], 10)
    assert sorted(map(tuple, two[0].centres)) == [(1, 1), (2, 2)] and (two[0].inertia, two[0].silhouette) == (0.0, 1.0)
    one_each = many_means.fit(table(spark, [(1, 1), (2, 2), (9, 9)]), AXES, [3], [1], 10)
    assert (one_each[0].inertia, one_each[0].silhouette) == (0.0, 0.0)
    none = many_means.fit(table(spark, [(1, 1)]).limit(0), AXES, [2], [1], 10)
    assert [(m.inertia, m.silhouette) for m in none] == [(0.0, None)]
    lacking = spark.createDataFrame([(1.0, None, 1)], "a double, b double, noise long")
    with pytest.raises(Exception, match="a feature is null"):
        many_means.fit(lacking, AXES, [2], [1], 10)


def test_nearest_centres_lie_along_the_rows():
    """Distances are laid out centre by centre, so a pass goes through the rows in long stretches."""
    rng = np.random.default_rng(5)
    points, centres = rng.integers(0, 4, (2, 500)).astype(float), np.array([[1.0, 2.0], [3.0, 0.0], [1.0, 2.0]])
    distances = many_means._distances(points, centres)
    assert distances.shape == (3, 500) and distances.flags.c_contiguous
    nearest, least = many_means._nearest(points, centres)
    own = ((points.T[:, None] - centres[None]) ** 2).sum(2)
    assert (nearest == own.argmin(1)).all() and (least == own.min(1)).all()
    assert 2 not in nearest and (least[(points.T == centres[0]).all(1)] == 0).all()
