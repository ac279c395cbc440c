"""Document fingerprints: Order MinHash, signatures sensitive to edit distance.

A text's k-mers (of code points) are numbered by occurrence, so that a repeated k-mer counts each time.
Every numbered k-mer gets one hash; its high bits deal it to one of `sketches` hash functions, and in
each of them the `tuple_size` smallest hashes are selected, put back into text order, and hashed together.
Texts that share many k-mers in the same order share many of the signatures. The likeness of two
fingerprints is the share of equal signatures among those that at least one text has.

A text with fewer code points than k is one k-mer. A hash function that gets fewer k-mers than
`tuple_size` uses those it gets; one without any has the empty signature 0.

Defined results: null is an empty text; empty texts have the fingerprint of zeros, and likeness 1 with
each other, 0 with others; equal texts have equal fingerprints; the document next to a document comes after
it by descending doc_id (null ids last, equal ids by text), after the last comes the first; a single
document is next to itself; empty tables give no rows.
"""

from __future__ import annotations

import bisect
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import known_to_workers, mix

K = 8
SKETCHES = 64
TUPLE = 2
#: Documents that one task orders at a time.
STRETCH = 2000
_U = np.uint64


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def numbered_kmers(points: np.ndarray, k: int = K) -> np.ndarray:
    """A hash of (k-mer, occurrence) for each k-mer, in text order."""
    n = len(points)
    if not n:
        return np.empty(0, _U)
    k = min(k, n)
    spread = points.astype(_U) * _U(0x9E3779B97F4A7C15)
    grams = spread[: n - k + 1].copy()
    for i in range(1, k):
        grams *= _U(0xD6E8FEB86659FD93)
        grams += spread[i : n - k + 1 + i]
    # The low bits of the sort key hold the place, so an unstable sort keeps text order within equal k-mers.
    bits = max(1, (len(grams) - 1).bit_length())
    mixed = mix(grams)
    keyed = (mixed & ~_U((1 << bits) - 1)) | np.arange(len(grams), dtype=_U)
    keyed.sort()
    place = (keyed & _U((1 << bits) - 1)).astype(np.int64)
    groups = keyed >> _U(bits)
    first = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
    occurrence = np.arange(len(groups)) - np.repeat(first, np.diff(np.append(first, len(groups))))
    repeated = np.flatnonzero(occurrence)
    if len(repeated):
        mixed[place[repeated]] = mix(mixed[place[repeated]] + occurrence[repeated].astype(_U) * _U(0xA0761D6478BD642F))
    return mixed


def fingerprint(points: np.ndarray, k: int = K, sketches: int = SKETCHES, size: int = TUPLE) -> np.ndarray:
    """`sketches` (a power of two) signatures of 64 bits."""
    out = np.zeros(sketches, _U)
    hashes = numbered_kmers(points, k)
    if not len(hashes):
        return out
    shift = _U(64 - max(1, sketches.bit_length() - 1))
    # Smallest first within each function: only hashes that can be among the smallest are sorted.
    low = hashes & _U((1 << int(shift)) - 1)
    most = (1 << int(shift)) * min(1.0, 8 * size * sketches / len(hashes))
    chosen = np.flatnonzero(low <= _U(min(int(most), (1 << int(shift)) - 1)))
    dealt = (hashes[chosen] >> shift).astype(np.int64)
    if len(chosen) < len(hashes) and np.bincount(dealt, minlength=sketches).min() < size:
        chosen = np.arange(len(hashes))
        dealt = (hashes >> shift).astype(np.int64)
    order = np.lexsort((chosen, hashes[chosen]))  # the high bits lead: by function, then by hash
    chosen, dealt = chosen[order], dealt[order]
    starts = np.searchsorted(dealt, np.arange(sketches))
    stops = np.searchsorted(dealt, np.arange(sketches), "right")
    picked = np.full((sketches, size), len(hashes))
    for i in range(size):
        has = starts + i < stops
        picked[has, i] = chosen[starts[has] + i]
    picked.sort(1)
    values = np.append(hashes, _U(0))
    signature = np.full(sketches, 0x27D4EB2F165667C5, _U)
    for i in range(size):
        signature = mix(signature * _U(0x9FB21C651E98DF25) + values[picked[:, i]])
    return np.where(stops > starts, signature, out)


def likeness(one: np.ndarray, two: np.ndarray) -> float:
    some = (one != 0) | (two != 0)
    return float((one == two)[some].mean()) if some.any() else 1.0


def said(signatures: np.ndarray) -> str:
    return signatures.astype(">u8").tobytes().hex()


def edited(text: str, following: str) -> str:
    """The last floor(n/2) code points replaced by as many of the following text (or all it has)."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprinted(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", stretch: int = STRETCH) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Documents are dealt into stretches of the descending order of ids, about `stretch` each. The first
    document of a stretch also goes, marked `ahead`, behind the end of the stretch before, so that each
    document meets its successor in one task. The driver sees cut points and one id per stretch.
    """
    known_to_workers(documents.sparkSession)
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    count = rows.count()
    parts = max(1, -(-count // stretch))
    quantiles = [j / parts for j in range(1, parts)]
    cuts = sorted({int(c) for c in rows.where("doc_id is not null").approxQuantile("doc_id", quantiles, 0.1 / parts)}) if quantiles else []
    last = len(cuts) + 1  # the stretch of null ids

    def place(batches):
        """Stretch number by descending id: 0 holds ids from the highest cut on."""
        for b in batches:
            ids = b.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([last if i is None else len(cuts) - bisect.bisect_right(cuts, i) for i in ids], pa.int32()), *b.columns],
                names=["stretch", *b.schema.names],
            )

    schema = T.StructType([T.StructField("stretch", T.IntegerType())])
    only_ids = rows.select("doc_id").mapInArrow(place, T.StructType(schema.fields + [T.StructField("doc_id", T.LongType())]))
    heads = {r.stretch: r.i for r in only_ids.groupBy("stretch").agg(F.max("doc_id").alias("i")).collect()}  # a row a stretch
    if not heads:
        return documents.sparkSession.createDataFrame([], _RESULT)
    held = sorted(heads)
    before = {s: held[i - 1] for i, s in enumerate(held)}  # the first stretch is read after the last one, too

    def dealt(batches):
        for b in place(batches):
            stretches, ids = b.column(0).to_pylist(), b.column(1).to_pylist()
            again = [i for i, (s, d) in enumerate(zip(stretches, ids)) if d == heads[s]]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([False] * b.num_rows)], names=[*b.schema.names, "ahead"])
            if again:
                extra = b.take(pa.array(again))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([before[stretches[i]] for i in again], pa.int32()), *extra.columns[1:], pa.array([True] * len(again))],
                    names=[*b.schema.names, "ahead"],
                )

    layout = T.StructType(schema.fields + [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("ahead", T.BooleanType())])
    spread = rows.mapInArrow(dealt, layout).repartition(len(held), "stretch")
    spread = spread.sortWithinPartitions("stretch", "ahead", F.desc_nulls_last("doc_id"), "text")
    return spread.mapInArrow(_compared, _RESULT)


_RESULT = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType())]
    + [T.StructField(name, T.StringType()) for name in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    + [T.StructField(name, T.DoubleType()) for name in ("near_edited", "near_next")]
)


def _compared(batches):
    """Each row against the row after it in its stretch; of the rows ahead only the first is met."""
    waiting = None  # stretch, doc_id, text, fingerprint
    for batch in batches:
        out: list[tuple] = []
        columns = [batch.column(c) for c in ("stretch", "doc_id", "text", "ahead")]
        for at in range(batch.num_rows):
            stretch, doc_id, text, ahead = (c[at].as_py() for c in columns)
            if ahead and (waiting is None or waiting[0] != stretch):
                continue  # met already
            own = fingerprint(code_points(text))
            if waiting is not None and waiting[0] == stretch:
                _, d, t, f = waiting
                new = edited(t, text)
                g = fingerprint(code_points(new))
                out.append((d, len(t), hashlib.sha256(new.encode()).hexdigest(), said(f), said(g), likeness(f, g), likeness(f, own)))
            waiting = None if ahead else (stretch, doc_id, text, own)
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()))],
                names=_RESULT.names,
            )
