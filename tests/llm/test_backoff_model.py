import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from shopperflow.llm import backoff_model
from shopperflow.llm.arrays import word_hashes

from .conftest import prose


def tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\v\f\r":
        lower = lower.replace(blank, " ")
    return [w for w in lower.split(" ") if w] + [None]


def learnt(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 7 != 2


def model(rows, order, prior):
    """Counts of n-grams and of contexts, all tokens, and the smoothed probability of a word after a context."""
    grams, total = Counter(), 0
    for i, t in rows:
        if learnt(i):
            held = tokens(t)
            total += len(held)
            for k in range(len(held)):
                grams[(held[k],)] += 1
                for size in range(2, order + 1):
                    if k - size + 1 >= -1:
                        grams[tuple((["<s>"] + held)[k - size + 2 : k + 2])] += 1
    words = sum(len(g) == 1 for g in grams)
    state_of = Counter()
    for g, n in grams.items():
        state_of[g[:-1]] += n

    def weight(context, word):
        if not context:
            return (grams[(word,)] + 1) / (total + words + 1)
        return (grams[(*context, word)] + prior * weight(context[1:], word)) / (state_of[context] + prior)

    return grams, state_of, total, words, weight


def walked(rows, order, prior):
    """A literal automaton: states, arcs and failure arcs in dictionaries, one token after another."""
    grams, state_of, total, words, weight = model(rows, order, prior)
    out = []
    for i, t in rows:
        held, score, state = tokens(t), 0.0, ("<s>",) if order > 1 and state_of[("<s>",)] else ()
        for word in held:
            context = state
            while context and not grams[(*context, word)]:
                score += math.log10(prior / (state_of[context] + prior))
                context = context[1:]
            score += math.log10(weight(context, word))
            state = (*state, word)[-(order - 1) :] if order > 1 else ()
            while state and not state_of[state]:
                state = state[1:]
        base = sum(math.log10((grams[(w,)] + 1) / (total + words + 1)) for w in held)
        out.append((i, len(held), sum(grams[(w,)] > 0 for w in held), total, base, score))
    return sorted(out, key=str)


def found(df, **kw):
    rows = backoff_model.scored(df, backoff_model.trained(), **kw)
    return sorted((tuple(r) for r in rows.select("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()), key=str)


def agree(one, two):
    assert [r[:4] for r in one] == [r[:4] for r in two]
    for a, b in zip(one, two):
        assert a[4:] == pytest.approx(b[4:], rel=1e-9)


@pytest.mark.parametrize("order, slice_bytes, range_bytes", [(1, 1 << 20, 1 << 20), (2, 1 << 20, 1 << 20), (2, 4000, 3000), (3, 9000, 2000), (4, 1, 1 << 20)])
def test_against_a_literal_automaton(varied, tmp_path, order, slice_bytes, range_bytes):
    varied.write.parquet(str(tmp_path / "docs"))
    docs = varied.sparkSession.read.parquet(str(tmp_path / "docs"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    agree(found(docs, order=order, slice_bytes=slice_bytes, range_bytes=range_bytes), walked(rows, order, backoff_model.PRIOR))


def test_probabilities_of_all_next_words_sum_to_one():
    """Over the known words, the end and one unknown word, after contexts that occur and that do not."""
    grams, state_of, _, _, weight = model([(i, prose(i, 30)) for i in range(20)], 3, backoff_model.PRIOR)
    known = [g[0] for g in grams if len(g) == 1]
    for context in [*list(state_of)[:40], ("never", "seen")]:
        assert sum(weight(context, w) for w in [*known, "unknown"]) == pytest.approx(1)


def test_names_types_and_empty_tables(docs, spark):
    none = backoff_model.scored(docs(), backoff_model.trained())
    assert none.columns == ["doc_id", "text", "lang", "n_words", "n_tokens", "n_known", "train_tokens", "base_score", "score"] and none.count() == 0
    clash = docs((1, "a b"), (2, None)).withColumn("size", F.lit(1)).withColumn("task", F.lit("x")).withColumn("a.b", F.lit(2)).withColumn("train", F.lit(0))
    assert backoff_model.scored(clash, F.lit(None).cast("boolean")).where("base_score = 0 and score = 0 and train_tokens = 0 and size = 1 and task = 'x'").count() == 2
    texts = spark.createDataFrame([("x", "a b"), (None, "a b")], "doc_id string, text string")
    assert backoff_model.scored(texts, backoff_model.trained()).count() == 2


def test_rows_that_change_between_readings_are_refused():
    import pyarrow as pa

    distinct = word_hashes([b"a b c"])[0]
    with pytest.raises(ValueError, match="same order"):
        backoff_model._known([], distinct, 1)
    assert pa.array(distinct).type == pa.uint64()


def test_words_of_any_length_are_told_apart():
    even, odd = "a", "b"
    for _ in range(10):
        even, odd = even + odd, odd + even
    for size in (64, 256, 512, 1024):
        one, two = word_hashes([even[:size].encode()])[0], word_hashes([odd[:size].encode()])[0]
        assert one[0] != two[0]
