import re
from collections import defaultdict

import numpy as np
import pytest
from shopperflow.llm import arrays, ngram_join


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows, percent=80):
    """component by doc_id and size by row, by comparing everything."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[a + 1 :]:
            k = len(x & y)
            if i is not None and j is not None and k and 100 * k >= percent * (len(x) + len(y) - k):
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=str)


def found(df, **kw):
    return sorted((tuple(r) for r in ngram_join.joined(df, **kw).collect()), key=str)


def test_against_all_pairs(varied):
    rows = [(r.doc_id, r.text) for r in varied.collect()]
    assert found(varied) == brute(rows)


@pytest.mark.parametrize("tile", [2, 5])
def test_small_tiles_lose_no_link(varied, monkeypatch, tile):
    monkeypatch.setattr(ngram_join, "TILE", tile)
    rows = [(r.doc_id, r.text) for r in varied.collect()]
    assert found(varied) == brute(rows)


def test_other_threshold(varied):
    rows = [(r.doc_id, r.text) for r in varied.collect()]
    assert found(varied, percent=60) == brute(rows, 60)


def test_exactly_at_the_threshold(docs):
    # 9 and 9 shingles of which 8 are shared: 8 / 10; then 7 of 9 and 9: 7 / 11
    words = [f"w{i}" for i in range(13)]
    df = docs((3, " ".join(words)), (5, " ".join(["x", *words[1:]])), (8, " ".join([*words[:11], "y", "z"])))
    assert [(r.doc_id, r.component_id) for r in ngram_join.joined(df).orderBy("doc_id").collect()] == [(3, 3), (5, 3), (8, 8)]


def test_chain_of_links_is_one_component(docs):
    words = [f"w{i}" for i in range(200)]
    df = docs(*[(100 - i, " ".join(words[4 * i : 4 * i + 100])) for i in range(20)])
    assert found(df) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_members_that_neighbours_do_not_connect(docs):
    """A star: all are like the centre, hardly any like each other, so neighbours by size miss most links."""
    centre = [f"w{i}" for i in range(100)]
    rows = [(1, " ".join(centre))]
    rows += [(10 + i, " ".join(centre[:at] + [f"v{i}"] + centre[at + 1 :])) for i, at in enumerate(range(3, 97, 3))]
    rows += [(100 + i, " ".join(f"u{i}" if k in (a, a + 20) else w for k, w in enumerate(centre))) for i, a in enumerate(range(5, 75, 7))]
    assert found(docs(*rows)) == brute(rows)


def test_empty_table(docs):
    out = ngram_join.joined(docs())
    assert out.collect() == [] and out.columns == ["doc_id", "n_shingles", "component_id"]


def test_one_of_each_keeps_columns(varied):
    kept = ngram_join.one_of_each(varied)
    assert kept.columns == varied.columns
    assert {r.doc_id for r in kept.collect()} == {c for i, _, c in found(varied) if i == c}


def test_bitmap_never_bounds_below_the_overlap():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 4000, int(n)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for n in rng.integers(1, 900, 40)]
    sizes = np.array([len(s) for s in sets])
    one, two = np.triu_indices(len(sets), 1)
    bound = ngram_join.overlap_bounds([ngram_join.signature(s) for s in sets], sizes, one, two)
    true = np.array([len(np.intersect1d(sets[a], sets[b])) for a, b in zip(one, two)])
    assert (bound >= true).all()


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5000, 5000), (7, 400)]
    out = {r.node: r.component for r in arrays.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = defaultdict(set)
    for n, c in out.items():
        want[c].add(n)
    assert want[0] == {*range(301), 400} and want[1000] == {*range(1000, 1050)} and 5000 not in out
    assert arrays.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_bit_set(spark):
    held = arrays.BitSet.of(spark.createDataFrame([(5,), (-1,), (2**40 + 3,), (None,)], "h long"), "h", 12)
    assert held.has(np.array([5, 2**64 - 1, 2**40 + 3, 3], np.uint64)).all()
    assert not held.has(np.array([6, 7], np.uint64)).any()


@pytest.mark.parametrize("n", range(7))
def test_few_words_in_a_partition(docs, n):
    df = docs((1, " ".join("xyzuvwq"[:n]))).coalesce(1)
    assert [tuple(r) for r in ngram_join.joined(df).collect()] == [(1, 0 if n == 0 else max(1, n - 4), 1)]


def test_words_that_sums_alone_would_confuse(docs):
    """The Thue-Morse word of 1,024 letters and its mirror: polynomial sums modulo 2**64 agree on them for any base."""
    one, two = "a", "b"
    for _ in range(10):
        one, two = one + two, two + one
    assert {r.doc_id: r.component_id for r in ngram_join.joined(docs((1, one), (2, two), (3, one))).collect()} == {1: 1, 2: 2, 3: 1}


def test_ids_of_any_type(spark):
    df = spark.createDataFrame([("b", "one two three four five six"), ("a", "ONE two three four five six"), ("c", None), (None, "one two")], "doc_id string, text string")
    assert sorted((str(r.doc_id), r.component_id) for r in ngram_join.joined(df).collect()) == [("None", None), ("a", "a"), ("b", "a"), ("c", "c")]


def test_folded_bitmaps_never_bound_below_the_overlap_either():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 9000, int(n)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for n in rng.integers(1, 4000, 30)]
    sizes = np.array([len(s) for s in sets])
    one, two = np.triu_indices(len(sets), 1)
    small = [ngram_join.folded(s) or s for s in map(ngram_join.signature, sets)]
    assert max(map(len, small)) == ngram_join.TILE_SIGNATURE
    true = np.array([len(np.intersect1d(sets[a], sets[b])) for a, b in zip(one, two)])
    assert (ngram_join.overlap_bounds(small, sizes, one, two) >= true).all()
