import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F
from shopperflow.llm import conversation_repair as repair

COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
BLANKS = " \t\n\x0b\x0c\r"
GRAMMAR = re.compile("(s?(ua)+)?")


def faults(rows):
    out = []
    for k, (role, text) in enumerate(rows):
        kept = text.strip(BLANKS)
        out.append("blank" if not kept else "duplicate" if (role, text) in rows[:k] else "truncated" if kept[-1] not in ".!?" else "")
    return out


def exhaustive(rows):
    """All edits of a few rows, with at most two inserts in one place."""
    inserts = [(), ("u",), ("a",), ("u", "a"), ("a", "u")]
    best = None
    kinds = faults(rows)
    options = []
    for (role, _), fault in zip(rows, kinds):
        extra = 3 if fault == "truncated" else 0
        stay = [] if fault in ("blank", "duplicate") else [(extra, "K", role[:1] or "?"), (3 + extra, "R", "u"), (3 + extra, "R", "a")]
        options.append([(4, "D", ""), *stay])
    for chosen in itertools.product(*options):
        for added in itertools.product(inserts, repeat=len(rows) + 1):
            cost, audit, roles = 0, "", ""
            for k in range(len(rows) + 1):
                cost, audit, roles = cost + 3 * len(added[k]), audit + "I" * len(added[k]), roles + "".join(added[k])
                if k < len(rows):
                    cost, audit, roles = cost + chosen[k][0], audit + chosen[k][1], roles + chosen[k][2]
            if GRAMMAR.fullmatch(roles) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def tabled(rows):
    """The cheapest repair by a table over all places and states, forward."""
    kept = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    wanted = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", ())}

    def put(table, state, way):
        if state not in table or way[:2] < table[state][:2]:
            table[state] = way

    def filled(table):
        for _ in range(4):
            for state, (cost, audit, made) in list(table.items()):
                put(table, wanted[state], (cost + 3, audit + "I", (*made, ({"u": "user", "a": "assistant"}[wanted[state]], ""))))
        return table

    for (role, text), fault in zip(rows, faults(rows)):
        after = {}
        for state, (cost, audit, made) in filled(best).items():
            put(after, state, (cost + 4, audit + "D", made))
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                if (state, role[:1]) in kept:
                    put(after, kept[state, role[:1]], (cost + extra, audit + "K", (*made, (role, text))))
                to = wanted[state]
                put(after, to, (cost + 3 + extra, audit + "R", (*made, ({"u": "user", "a": "assistant"}[to], text))))
        best = after
    best = filled(best)
    return min(best[s] for s in ("", "a") if s in best)


def brute(rows):
    """Of (conv_id, turn, role, text) rows after damage: the contract's columns."""
    out = []
    for conv in {r[0] for r in rows}:
        mine = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x, here in rows if c == conv and here]
        mine.sort(key=lambda row: (row[0] is not None, row[0] or 0, row[1].encode(), row[2].encode()))
        pairs = [row[1:] for row in mine]
        kinds, (cost, audit, made) = faults(pairs), tabled(pairs)
        turns = [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[:1] for r, _ in pairs]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        digest = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in made).encode()).hexdigest()
        out.append((conv, gaps, *[kinds.count(k) for k in ("blank", "duplicate", "truncated")], illegal, cost, audit, digest))
    return sorted(out, key=str)


def found(df, **kw):
    return sorted((tuple(r) for r in repair.repaired(df, present=F.col("present"), **kw).select(COLUMNS).collect()), key=str)


def made_up(seed, n):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "well", "so then", "", "  \n", "Fine. ", "é.", "end .\t"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", ""]
    return [(rng.choice(roles), rng.choice(texts) if rng.random() < 0.6 else f"text {rng.randint(0, 99)}.") for _ in range(n)]


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_search_against_all_edits(n):
    for seed in range(60 if n < 3 else 25):
        rows = made_up(seed, n)
        assert repair.cheapest(repair.Segment([None] * n, rows).marks if n else []) == exhaustive(rows)


def test_search_against_a_table():
    for seed in range(120):
        rows = made_up(seed, 1 + seed * 3)
        assert repair.cheapest(repair.Segment([None] * len(rows), rows).marks) == tabled(rows)[:2]


def test_search_stays_short_on_hard_rows():
    for initials in ("a", "u", "s", "ua", "uua", "aus", "uuaa"):
        for fault in (repair.FINE, repair.TRUNCATED):
            marks = [(initials[k % len(initials)], fault) for k in range(2000)]
            cost, audit = repair.cheapest(marks)
            assert len(audit) >= 2000 and cost <= 7 * 2000


@pytest.fixture(scope="module")
def talks(spark):
    rng = random.Random(5)
    rows = []
    for c in range(40):
        turns = made_up(c, rng.randint(1, 12))
        rows += [(c, (t * (1 + c % 3) if c % 7 else None), r if rng.random() < 0.9 else None, x if rng.random() < 0.9 else None, rng.random() < 0.95) for t, (r, x) in enumerate(turns)]
    rows += [(100, t, r, x, True) for t, (r, x) in enumerate(made_up(100, 900))]
    rows += [(101, t // 3, r, x, True) for t, (r, x) in enumerate(made_up(101, 400))]
    rows += [(102, 1, "user", "Same.", True)] * 70 + [(103, 1, "user", "gone", False), (None, 1, "user", "Hm.", True), (None, None, "assistant", None, True)]
    rows += [(104, t, "user" if t % 2 == 0 else "assistant", f"T{t}.", True) for t in range(300)]
    return spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, present boolean"), rows


@pytest.mark.parametrize("segment_rows", [repair.SEGMENT_ROWS, 5])
def test_against_brute_force(talks, segment_rows):
    df, rows = talks
    assert found(df, segment_rows=segment_rows) == brute(rows)


def test_turns_are_what_is_hashed(talks):
    df, _ = talks
    for row in repair.repaired(df, present=F.col("present"), with_turns=True, segment_rows=50).collect():
        text = "\n".join(f"{t.role}:{t.text}" for t in row.turns)
        assert hashlib.sha256(text.encode()).hexdigest() == row.repaired_sha256
        assert GRAMMAR.fullmatch("".join(t.role[0] for t in row.turns))


def test_damage(spark):
    rows = [(c, t, "assistant", "A. b? c!") for c in range(30) for t in range(10)] + [(7, None, None, None), (None, 3, "user", "x.")]
    out = [tuple(r) for r in repair.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()]
    expected = []
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        expected += [(c, t, "user" if kind == 4 else r, x, kind != 0)] * (2 if kind == 3 else 1)
    assert sorted(out, key=str) == sorted(expected, key=str)


def test_names_types_and_empty_tables(spark):
    none = spark.createDataFrame([], "conv_id string, turn int, role string, text string, task int, conv string, `a.b` int")
    assert repair.repaired(none).columns == COLUMNS and repair.repaired(none).count() == 0
    one = spark.createDataFrame([("x", 1, "user", "Hm", 3, "y", 4)], none.schema)
    assert [tuple(r)[:8] for r in repair.repaired(one).collect()] == [("x", 0, 0, 0, 1, 0, 4, "D")]
