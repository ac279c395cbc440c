"""Substring dedup by sliding sentence spans.

A text is cut into sentences (after . ! ? and white space, after the full-width marks of scripts without
spaces, and at line feeds; the white space belongs to the sentence before it). Spaces and the case of ASCII
letters do not matter when sentences are compared. From every sentence on, and back from every sentence, the
shortest run of two or more sentences that has LEAST_WORDS words is hashed, however many sentences that
takes; so whatever passage of two or more sentences and so many words is repeated, runs inside it cover
all of it. A single sentence is hashed if it has ALONE_WORDS words. In scripts without spaces, characters
count as parts of words. Runs are joined globally by their hashes. The first place of a run is the one with
the smallest doc_id, and there the earliest; sentences that any other place of a repeated run covers are
removed.

Two passes keep the shuffles small: the first counts 64-bit hashes and leaves a bit set of those that
occur twice (fixed size; a wrong yes costs time only), the second compares 128 bits of what is left. A run
that a large share of all places bear stays where it is: its first place, one row, is sent to them. Texts
that lose nothing are not shuffled.

Defined results: null and empty texts have no sentences and stay as they are; a text shorter than any
run is kept whole; rows equal in id and text count as one document and are treated alike; a null doc_id
comes before all others (ids may have any type that has an order); a run that overlaps its own repeat inside one document loses the later places;
empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.hot_keys import hot_keys, unique_join
from .arrays import U64, BitSet, annotated, folder_of, mapped

LEAST_WORDS = 12
ALONE_WORDS = 48
BITS = 27
_CUT = re.compile(r"(?<=[.!?])\s+|[。！？｡]+[”’」』）】]*\s*|\n\s*")
#: Characters of scripts that set no spaces between words, by how many are about one word.
_UNSPACED = {
    2: re.compile("[\u3041-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]"),
    4: re.compile("[\u0e01-\u0e4e\u0e81-\u0ece\u0f40-\u0fbc\u1000-\u109f\u1780-\u17d3]"),
}


def sentences(text: str | None) -> list[str]:
    """The sentences with the white space after them; joined they are the text."""
    if not text:
        return []
    ends = [m.end() for m in _CUT.finditer(text)]
    return [text[a:b] for a, b in zip([0, *ends], [*ends, len(text)]) if a < b]


def n_words(sentence: str, words: list[str]) -> int:
    """How many words these are: one each, or more where a script sets no spaces."""
    if sentence.isascii() or not any(c.search(sentence) for c in _UNSPACED.values()):
        return len(words)
    return sum(max(1, sum(len(c.findall(w)) // n for n, c in _UNSPACED.items())) for w in words)


def runs(text: str | None, least: int = LEAST_WORDS, alone: int = ALONE_WORDS) -> list[tuple[bytes, int, int]]:
    """(128-bit hash, first sentence, number of sentences) of every run that counts."""
    found = sentences(text)
    words = [s.lower().split() if s.isascii() else s.encode().lower().decode().split() for s in found]
    plain = [" ".join(w).encode() for w in words]
    totals = [0]
    for s, w in zip(found, words):
        totals.append(totals[-1] + n_words(s, w))
    places = {(i, i + 1) for i in range(len(plain)) if totals[i + 1] - totals[i] >= alone}
    j = 0
    for i in range(len(plain)):  # shortest runs from i on
        j = max(j, i + 2)
        while j <= len(plain) and totals[j] - totals[i] < least:
            j += 1
        if j > len(plain):
            break
        places.add((i, j))
    i = 0
    for j in range(2, len(plain) + 1):  # shortest runs that end before j
        while i + 2 < j and totals[j] - totals[i + 1] >= least:
            i += 1
        if totals[j] - totals[i] >= least:
            places.add((i, j))
    return [(hashlib.blake2b(b"\n".join(plain[i:j]), digest_size=16).digest(), i, j - i) for i, j in sorted(places)]


def _named(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, text and two hashes that name the row."""
    d, t = F.col(f"`{doc_id}`"), F.col(f"`{text}`")
    return documents.select(d.alias("doc_id"), t.alias("text"), F.xxhash64(d, t).alias("row"), F.xxhash64(t, d).alias("row2"))


def _later_places(documents: DataFrame, doc_id: str, text: str, least: int, alone: int, bits: int) -> DataFrame:
    """doc_id, row, row2, first, size of the places of repeated runs but the first; rows that repeat repeat them."""
    rows = _named(documents, doc_id, text)

    def hashes(part: pa.RecordBatch) -> dict:
        found = b"".join(h for t in part.column("text").to_pylist() for h, _, _ in runs(t, least, alone))
        return {"h": np.frombuffer(found, np.int64)[::2]}

    counted = mapped(rows.select("text"), "text", hashes, "h long").groupBy("h").agg(F.count("*").alias("n"))
    shared = rows.sparkSession.sparkContext.broadcast(BitSet.of(counted.where("n > 1"), "h", bits))

    def places(part: pa.RecordBatch) -> dict | None:
        columns: list[list] = [[], [], [], [], [], [], []]
        for d, t, r, r2 in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "row", "row2"))):
            found = runs(t, least, alone)
            if found:
                keys = np.frombuffer(b"".join(h for h, _, _ in found), np.int64).reshape(-1, 2)
                for i in np.flatnonzero(shared.value.has(keys[:, 0].view(np.uint64))).tolist():
                    for column, value in zip(columns, (int(keys[i, 0]), int(keys[i, 1]), d, r, r2, found[i][1], found[i][2])):
                        column.append(value)
        return dict(zip(("h", "h2", "doc_id", "row", "row2", "first", "size"), columns)) if columns[0] else None

    kind = rows.schema["doc_id"].dataType.simpleString()
    found = folder_of(mapped(rows, "text", places, f"h long, h2 long, doc_id {kind}, row long, row2 long, first int, size int"))
    place = F.struct("doc_id", "row", "row2", "first")
    of_runs = found.groupBy("h", "h2").agg(F.min(place).alias("least"), F.max(place).alias("most"), F.count("*").alias("n"))
    first = folder_of(of_runs.where("least <> most").drop("most"))
    hot = hot_keys(first, "n", found.count()).select("h", "h2")
    later = unique_join(found, first.drop("n"), ["h", "h2"], hot)
    return later.where(~place.eqNullSafe(F.col("least"))).select("doc_id", "row", "row2", "first", "size")


def repeated(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST_WORDS, alone: int = ALONE_WORDS, bits: int = BITS
) -> DataFrame:
    """doc_id, row, row2 (both name the row), first, size: every place of a repeated run that is not its first place."""
    return _later_places(documents, doc_id, text, least, alone, bits).distinct()


def _unused(documents: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in documents.columns}
    while name in taken:
        name += "_"
    return name


def without_repeats(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST_WORDS, alone: int = ALONE_WORDS, bits: int = BITS
) -> DataFrame:
    """All columns; the text without repeated sentences, and n_sentences, n_removed.

    Texts that lose nothing are not shuffled: a bit set of the others tells them apart.
    """
    row, row2, marked, covered = (_unused(documents, f"__{x}") for x in ("row", "row2", "marked", "covered"))
    places = _later_places(documents, doc_id, text, least, alone, bits)
    cuts = places.groupBy(F.col("row").alias(row), F.col("row2").alias(row2)).agg(F.collect_set(F.struct("first", "size")).alias(covered))
    cuts = folder_of(cuts)
    losing = documents.sparkSession.sparkContext.broadcast(BitSet.of(cuts, row, bits))
    d, t = F.col(f"`{doc_id}`"), F.col(f"`{text}`")
    named = documents.withColumns({row: F.xxhash64(d, t), row2: F.xxhash64(t, d)})
    added = f"`{text}` string, n_sentences long, n_removed long"

    def told_apart(counted: bool):
        def make(part: pa.RecordBatch) -> dict:
            texts, goes_on = part.column("__text"), losing.value.has(part.column(row).to_numpy().view(U64))
            sizes = [len(sentences(t)) if counted and not on else 0 for t, on in zip(texts.to_pylist(), goes_on.tolist())]
            return {text: texts, "n_sentences": sizes, "n_removed": np.zeros(len(sizes), np.int64), row: part.column(row), row2: part.column(row2), marked: goes_on}

        return annotated(named, text, make, f"{added}, `{row}` long, `{row2}` long, `{marked}` boolean", beside=(row, row2))

    def cut(part: pa.RecordBatch) -> dict:
        out: dict[str, list] = {text: [], "n_sentences": [], "n_removed": []}
        for t, c in zip(part.column("__text").to_pylist(), part.column(covered).to_pylist()):
            found = sentences(t)
            gone = {i for place in c or () for i in range(place["first"], place["first"] + place["size"])}
            out[text].append("".join(s for i, s in enumerate(found) if i not in gone) if gone else t)
            out["n_sentences"].append(len(found))
            out["n_removed"].append(len(gone))
        return out

    whole = told_apart(True).where(f"not `{marked}`").drop(row, row2, marked)
    parts = told_apart(False).where(f"`{marked}`").drop(marked).join(cuts, [row, row2], "left").drop(row, row2)
    return whole.unionByName(annotated(parts, text, cut, added, beside=(covered,)))
