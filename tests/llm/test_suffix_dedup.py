import hashlib
from collections import Counter

import pytest
from shopperflow.llm import suffix_dedup

from .conftest import prose


def brute(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[k : k + length] for _, t in texts for k in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = sum(g and not before for g, before in zip(gone, b"\0" + gone))
        out.append((i, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df, **kw):
    rows = suffix_dedup.without_repeats(df, **kw)
    return sorted((tuple(r) for r in rows.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


def test_against_counting_all_strings(varied):
    assert found(varied) == brute([(r.doc_id, r.text) for r in varied.collect()], 400)


@pytest.mark.parametrize("length, gram, step", [(40, 8, 5), (30, 16, 4), (30, 16, 1), (50, 50, 7), (120, 8, 9)])
def test_other_sizes(varied, length, gram, step):
    rows = [(r.doc_id, r.text) for r in varied.collect()]
    assert found(varied, length=length, gram=gram, step=step) == brute(rows, length)


def test_edges_of_a_passage(docs):
    passage = prose(9, 60)
    rows = [(1, "é" * 7 + passage + prose(1, 90)), (2, prose(2, 5) + passage), (3, passage[:399] + prose(3, 90)), (4, prose(4, 20) + passage[-400:]),
            (5, "ab" * 300), (6, prose(6, 30) + "c" * 900), (7, passage + passage)]
    assert found(docs(*rows)) == brute(rows, 400)


def test_repetitive_texts(docs):
    rows = [(i, ("abcdefgh"[: 3 + i % 5] * 60)[i:] + prose(i, 6) + "xyz" * (5 * i)) for i in range(14)]
    for length, gram, step in ((60, 8, 5), (60, 12, 3), (45, 4, 10)):
        assert found(docs(*rows), length=length, gram=gram, step=step) == brute(rows, length)


def test_a_filter_that_says_yes_too_often_changes_nothing(varied):
    assert found(varied, bits=7) == found(varied)


def test_empty_and_short_tables(docs):
    assert found(docs()) == []
    assert found(docs((1, None), (2, "short"), (2, "short"))) == brute([(1, None), (2, "short"), (2, "short")], 400)


def test_kept_bytes_and_columns(docs):
    passage = prose(9, 80)
    out = suffix_dedup.without_repeats(docs((1, "first " + passage), (2, "second " + passage)))
    kept = {r.doc_id: bytes(r.kept) for r in out.collect()}
    assert kept[1].startswith(b"first"[:5]) and len(kept[1]) < 20 and "score" in out.columns


def test_strings_that_sums_alone_would_confuse(docs):
    one, two = "a", "b"
    for _ in range(10):
        one, two = one + two, two + one
    rows = [(1, one), (2, two), (3, "x" + one)]
    assert found(docs(*rows), length=1024) == brute(rows, 1024)
