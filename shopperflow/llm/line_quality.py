"""Quality classifier: a linear-chain CRF labels every line good or bad; a document's quality is the
length-weighted mean of its lines' forward-backward marginals.

Lines are separated by line feeds. Each line is described by its own signs (symbols, capitals, digits,
words, repetition inside the line and of earlier lines) and by those of the lines before and after it.
The label of a training document is the label of each of its lines. Nothing but the text is an input.

Defined results: a null or empty text is one empty line; a document whose lines are all empty weighs
them alike; labels that are null or whose document is missing are not learnt from; of several labels
of one document the lowest counts; without any labelled row every score is 0.5; equal texts have
equal scores; empty tables give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import annotated, mapped, texts_of
from .crf import Chain, fit

THRESHOLD = 0.3
#: Most labelled documents, and lines of theirs, that are learnt from: the first by hash, and of each as many lines
#: as let all of them fit.
MOST_DOCUMENTS = 4000
MOST_LINES = 60_000

_CLASS = np.zeros(256, np.uint8)
_CLASS[[*range(97, 123)]] = 1  # lower case
_CLASS[[*range(65, 91)]] = 2  # capitals
_CLASS[[*range(48, 58)]] = 3
_CLASS[[32, 9]] = 4
_CLASS[[ord(c) for c in ".,;:'\"()-?"]] = 5  # usual in prose
_CLASS[[ord(c) for c in "!#$%&*+/<=>@[\\]^_`{|}~"]] = 6
_CLASS[128:] = 7
SIGNS = 11
BINS = 6


def line_signs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signs of every line, number of lines per text, bytes per line."""
    split = [t.split(b"\n") for t in texts]
    counts = np.array([len(x) for x in split], np.int64)
    lines = [line for x in split for line in x]
    sizes = np.array([len(x) for x in lines], np.int64)
    data = _CLASS[np.frombuffer(b"".join(lines), np.uint8)]
    ends = np.cumsum(sizes)
    tally = np.zeros((8, len(lines)))
    for kind in range(1, 8):
        sums = np.concatenate([[0], np.cumsum(data == kind, dtype=np.int32)])
        tally[kind] = sums[ends] - sums[ends - sizes]
    words, distinct, most, again = (np.zeros(len(lines)) for _ in range(4))
    at = 0
    for x in split:
        seen: set[bytes] = set()
        for line in x:
            w = line.split()
            if w:
                kinds = set(w)
                words[at], distinct[at] = len(w), len(kinds)
                if 2 * len(kinds) < len(w):
                    most[at] = max(map(w.count, kinds)) / len(w) if len(kinds) < 32 else 0
                again[at] = line in seen
                seen.add(line)
            at += 1
    n, w = np.maximum(sizes, 1), np.maximum(words, 1)
    letters = np.maximum(tally[1] + tally[2] + tally[7], 1)
    signs = np.stack(
        [np.log1p(sizes) / 10, tally[6] / n, tally[6] / w, tally[2] / letters, tally[3] / n, tally[5] / n,
         np.log1p(sizes / w) / 4, distinct / w, most, again, words == 0], 1,
    )
    return signs, counts, sizes


@dataclass
class Model:
    chain: Chain
    edges: np.ndarray  # signs x (BINS - 1)

    def features(self, signs: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Own signs, plain and in bins; the plain signs of the lines before and after; 0 beyond the ends."""
        own = (signs[:, :, None] > self.edges).reshape(len(signs), -1)
        ends = np.cumsum(counts)
        before, after = np.roll(signs, 1, 0), np.roll(signs, -1, 0)
        before[ends - counts], after[ends - 1] = 0, 0
        return np.hstack([np.ones((len(signs), 1)), signs, own, before, after])

    def scores(self, texts: list[bytes]) -> np.ndarray:
        signs, counts, sizes = line_signs(texts)
        good = self.chain.marginals(self.features(signs, counts), counts)
        weights = np.where(sizes > 0, sizes, 1e-9)
        starts = np.cumsum(counts) - counts
        out = np.add.reduceat(good * weights, starts) / np.add.reduceat(weights, starts)
        return np.clip(out, 0, 1)


def shared(sizes: np.ndarray, times: np.ndarray, most: int) -> int:
    """The largest number of lines that each document may give so that all together give `most` at most (1 at least).

    `sizes` are the numbers of lines that occur, ascending, `times` how many documents have each.
    """
    left, documents = most, int(times.sum())
    for n, k in zip(sizes.tolist(), times.tolist()):
        if n * documents > left:
            return max(1, left // documents)
        left -= n * k
        documents -= k
    return most


def learn(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
          most_documents: int = MOST_DOCUMENTS, most_lines: int = MOST_LINES) -> Model:
    """From a bounded sample of the labelled documents: the first by the hash of their id.

    Where these have more lines than `most_lines`, the longest give a stretch each, all of one length, placed by
    the hash of the text; no document is left out because it or another one is long.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("d"))
    chosen = known.agg(F.min(label).cast("int").alias("y")).orderBy(F.xxhash64("d"), "d").limit(min(most_documents, most_lines))
    sampled = documents.select(F.col(doc_id).alias("d"), F.coalesce(text, F.lit("")).alias("t")).join(F.broadcast(chosen), "d")
    lengths = F.length("t") - F.length(F.replace("t", F.lit("\n"))) + 1
    sizes = sampled.groupBy(lengths.alias("n")).count().orderBy("n").collect()
    share = shared(np.array([r.n for r in sizes], np.int64), np.array([r["count"] for r in sizes], np.int64), most_lines)

    def make(part: pa.RecordBatch) -> dict:
        signs, counts, _ = line_signs(texts_of(part.column("t")))
        ends, used = np.cumsum(counts), np.minimum(counts, share)
        starts = ends - counts + np.array(part.column("place").to_pylist(), np.int64) % (counts - used + 1)
        return {"d": part.column("d").cast(pa.string()), "y": part.column("y"), "n": used,
                "signs": [signs[at : at + c].astype(np.float32).tobytes() for at, c in zip(starts, used)]}

    placed = sampled.withColumn("place", F.xxhash64("t"))
    described = mapped(placed, "t", make, "d string, y int, n long, signs binary")
    # Only rows that share an id can be more than `most_lines`.
    rows = sorted(described.orderBy(F.xxhash64("d", "signs"), "d", "signs").limit(most_lines).collect(), key=lambda r: (r.d, r.signs))
    if not rows:
        return Model(Chain(np.zeros(1 + SIGNS * (2 + BINS)), np.zeros((2, 2))), np.zeros((SIGNS, BINS - 1)))
    signs = np.concatenate([np.frombuffer(r.signs, np.float32).reshape(-1, SIGNS) for r in rows]).astype(float)
    counts = np.array([r.n for r in rows])
    edges = np.stack([np.quantile(signs[:, i], np.linspace(0, 1, BINS + 1)[1:-1]) for i in range(SIGNS)])
    model = Model(Chain(np.zeros(0), np.zeros((2, 2))), edges)
    model.chain = fit(model.features(signs, counts), np.repeat([int(r.y > 0) for r in rows], counts), counts)
    return model


def scored(documents: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD, passed: list[str] | None = None) -> DataFrame:
    """Adds score (0 to 1, higher is better) and predicted (1 from `threshold` on)."""

    def make(part: pa.RecordBatch) -> dict:
        scores = model.scores(texts_of(part.column("__text")))
        return {"score": scores, "predicted": (scores >= threshold).astype(np.int32)}

    return annotated(documents, text, make, "score double, predicted int", passed)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows no label is learnt from: crc32 of the id as text, modulo 5, is 0 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0
