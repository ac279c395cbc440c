import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest
from shopperflow.llm import prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows, rebuild=True):
    """Every node from the definition, for (conv_id, turn, role, text) rows without ties of unlike turns."""
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    paths = {}
    for c, mine in own.items():
        heads = zlib.crc32(str(c).encode()) % 6 if rebuild else 0
        paths[c] = own.get(c - int(math.fmod(c, 100)), [])[:heads] + mine[heads:] if rebuild else mine
    members = defaultdict(set)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].add(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = (len(members[node]) - 1) * len(node[-1][1] if node else "") + sum(saved[k] for k in children[node])
    out = []
    for node, who in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in who if len(paths[c]) == len(node)))
        out.append((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(turns, convs, **kw):
    return sorted((tuple(r) for r in prefix_trie.nodes(turns, convs, **kw).select(COLUMNS).collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")


@pytest.fixture(scope="module")
def talks():
    """Shared heads, one first turn of a third, copies, a deep conversation that others share in part, nulls, negative ids."""
    rng = random.Random(3)
    rows = []
    for c in list(range(60)) + list(range(100, 130)) + [250, 300, 305, -7, -200]:
        for t in range(rng.randint(0, 6)):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", "hello" if t == 0 and c % 3 == 0 else f"é{rng.randint(0, 2)}"))
    rows += [(c, t, "user", f"same {t}") for c in range(400, 440) for t in range(3)]
    rows += [(500, t, "user", f"deep {t}") for t in range(150)]
    rows += [(500 + k, t, "user", f"deep {t}") for k in range(1, 6) for t in range(20 * k)] + [(506, t, "user", f"deep {min(t, 120)}") for t in range(140)]
    return rows + [(700, None, None, None), (700, 4, None, "x"), (None, 1, "user", "nobody"), (701, None, "user", None)]


def tree_of(seed, n, deep):
    rng = random.Random(seed)
    parents = [-1] + [max(0, k - 1 - (rng.randint(0, 3) if rng.random() < deep else rng.randint(0, k))) for k in range(1, n)]
    order = sorted(range(n), key=lambda k: depth(parents, k))
    at = {k: i for i, k in enumerate(order)}
    return [-1 if parents[k] < 0 else at[parents[k]] for k in order]


def depth(parents, k):
    n = 0
    while parents[k] >= 0:
        k, n = parents[k], n + 1
    return n


@pytest.mark.parametrize("seed, n, deep", [(1, 1, 0), (2, 2, 0), (3, 50, 0.1), (4, 400, 0.9), (5, 400, 1.0), (6, 300, 0.0)])
def test_centroids_against_sums_from_the_leaves(seed, n, deep):
    parents = tree_of(seed, n, deep)
    rng = random.Random(seed)
    weights = [[rng.randint(0, 9) for _ in range(n)], [1] * n]
    expected = [list(w) for w in weights]
    for node in range(n - 1, 0, -1):
        for sums in expected:
            sums[parents[node]] += sums[node]
    assert prefix_trie.decomposed(parents, expected[1], weights) == expected


def test_long_chains_and_stars_stay_fast():
    n = 20_000
    for parents, sizes in (([-1, *range(n - 1)], list(range(n, 0, -1))), ([-1] + [0] * (n - 1), [n] + [1] * (n - 1))):
        assert prefix_trie.decomposed(parents, sizes, [[1] * n]) == [sizes]


@pytest.mark.parametrize("most", [prefix_trie.MOST_NODES, 60])
def test_rebuilt_against_brute_force(spark, talks, most):
    assert found(*prefix_trie.rebuilt(table(spark, talks)), most=most) == brute(talks)


def test_plain_against_brute_force(spark, talks, monkeypatch):
    monkeypatch.setattr(prefix_trie, "STRETCH", 16)
    assert found(*prefix_trie.plain(table(spark, talks)), most=200) == brute(talks, rebuild=False)


def test_many_ends_are_joined_from_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    rows = [(c, 0, "user", "hi") for c in range(-40, 60)]
    assert found(*prefix_trie.plain(table(spark, rows))) == brute(rows, rebuild=False)


def test_names_and_empty_tables(spark):
    none = spark.createDataFrame([], "conv_id long, turn int, role string, text string, depth int, p int, size int")
    assert prefix_trie.nodes(*prefix_trie.rebuilt(none)).columns == COLUMNS and found(*prefix_trie.rebuilt(none)) == []
    one = spark.createDataFrame([(3, 1, "user", "é!", 3, 4, 5)], none.schema)
    assert [r[:7] for r in found(*prefix_trie.plain(one))] == [(3, 0, None, 1, 1, 1, 0), (3, 1, 3, 1, 0, 1, 0)]
