"""What the operators of this folder share: Arrow batches, hashes of byte strings, bounded bit sets, components.

Strings are compared by 64-bit or 128-bit hashes. 64 bits only ever select candidates or stand for
single words and shingles; whatever decides alone that two texts agree uses 128 bits.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..plans.durable import settle

U64 = np.uint64
#: Text handled at once inside a task; a longer single text is one chunk of its own.
CHUNK_BYTES = 2_000_000

_TABLES = [np.random.default_rng(seed).integers(0, 2**64, 256, dtype=U64) for seed in (11, 12)]
_BASES = [0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93]
_powers: dict[tuple[int, bool], np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, dtype=U64).view(np.int64)


#: Powers that workers keep; longer rows of them are made anew, so that a worker that has seen a long text gives it back.
_KEPT_POWERS = 1 << 16


def power(which: int, inverse: bool, n: int) -> np.ndarray:
    held = _powers.get((which, inverse))
    if held is None or len(held) < n:
        base = _BASES[which] if not inverse else pow(_BASES[which], -1, 2**64)
        held = np.full(max(n, _KEPT_POWERS), base, U64)
        held[0] = 1
        np.multiply.accumulate(held, out=held)
        if n <= _KEPT_POWERS:
            _powers[which, inverse] = held
    return held[:n]


#: Sums modulo 2**64 of strings this long and longer can agree by their build (Thue-Morse), whatever the base.
SAFE_BYTES = 512


class Substrings:
    """Hashes of any substrings of one byte string, from one running sum (`which`: 0 or 1, independent).

    Longer ones than SAFE_BYTES are folded from pieces of that size.
    """

    def __init__(self, data: np.ndarray, which: int = 0):
        self.which = which
        self._sums = np.zeros(len(data) + 1, U64)
        np.cumsum(_TABLES[which][data] * power(which, False, len(data)), out=self._sums[1:])

    def at(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out, begun = self._piece(starts, np.minimum(ends, starts + SAFE_BYTES)), starts + SAFE_BYTES
        while len(more := np.flatnonzero(begun < ends)):
            piece = self._piece(begun[more], np.minimum(begun[more] + SAFE_BYTES, ends[more]))
            out[more] = mix(out[more] * U64(0xD6E8FEB86659FD93) + piece)
            begun = begun + SAFE_BYTES
        return out

    def _piece(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self._sums[ends] - self._sums[starts]) * power(self.which, True, len(self._sums))[starts]
        return mix(raw + (ends - starts).astype(U64) * U64(0xA0761D6478BD642F))

    def all_of(self, size: int) -> np.ndarray:
        """Of every substring of `size` bytes, by start."""
        n = len(self._sums) - size
        if size > SAFE_BYTES:
            starts = np.arange(max(0, n))
            return self.at(starts, starts + size)
        raw = (self._sums[size:] - self._sums[:n]) * power(self.which, True, n)
        return mix(raw + U64(size * 0xA0761D6478BD642F % 2**64))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, one text after another, and the number of words of each; A-Z count as a-z."""
    data = np.frombuffer(b" " + b" ".join(t.lower() for t in texts) + b" ", np.uint8)  # bytes.lower() knows A-Z only
    blank = _SPACE[data]
    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    words = Substrings(data).at(starts, ends)
    text_starts = np.cumsum([1, *(len(t) + 1 for t in texts)])
    return words, np.diff(np.searchsorted(starts, text_starts))


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def chunks(batches: Iterable[pa.RecordBatch], text: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about `most` bytes of text; no text is cut."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(text).cast(pa.binary())
        sizes = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(sizes, int(sizes[start]) + most, "right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


#: Rows that go to a Python worker at once, unless the session says otherwise: texts are long rows.
BATCH_ROWS = 2000


def known_to_workers(spark: SparkSession) -> None:
    """Python workers look for this package where the driver found it (elsewhere, pass it with --py-files), and
    get batches of BATCH_ROWS rows if the session has left their size at Spark's default."""
    environment = spark.sparkContext.environment
    home, paths = str(Path(__file__).resolve().parents[2]), environment.get("PYTHONPATH", "").split(os.pathsep)
    if home not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([home, *filter(None, paths)])
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def mapped(df: DataFrame, text: str, make: Callable[[pa.RecordBatch], dict | None], schema: str) -> DataFrame:
    """`make` turns slices of rows into columns; one Arrow batch in, at most one out."""
    known_to_workers(df.sparkSession)
    fields = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(fields)

    def run(batches):
        for part in chunks(batches, text):
            made = make(part)
            if made is not None:
                yield pa.RecordBatch.from_arrays([_array(made[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, fields)


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, kind)


def annotated(
    df: DataFrame, text: str, make: Callable[[pa.RecordBatch], dict], schema: str,
    passed: list[str] | None = None, beside: tuple[str, ...] = (),
) -> DataFrame:
    """All columns of `df` (or those `passed`) and, for every row, what `make` says; its names win over older ones.

    `make` finds the text as column __text; the columns `beside` keep their names for it and end there.
    """
    known_to_workers(df.sparkSession)
    added = T.StructType.fromDDL(schema)
    names = {f.name for f in added.fields}
    kept = [f for f in df.schema.fields if f.name not in names and f.name not in beside and (passed is None or f.name in passed)]
    carried = [f"__{i}" for i in range(len(kept))]
    rows = df.select(*[F.col(f"`{f.name}`").alias(c) for f, c in zip(kept, carried)], F.col(f"`{text}`").alias("__text"), *beside)
    out = T.StructType([T.StructField(c, f.dataType) for f, c in zip(kept, carried)] + added.fields)
    arrow = to_arrow_schema(added)

    def run(batches):
        for part in chunks(batches, "__text"):
            made = make(part)
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in carried] + [_array(made[f.name], f.type) for f in arrow],
                names=[*carried, *arrow.names],
            )

    made = rows.mapInArrow(run, out)
    return made.select(*[F.col(c).alias(f.name) for f, c in zip(kept, carried)], *added.names)


class BitSet:
    """Which hashes occur, in at most 2**bits bits whatever their number: it may say yes wrongly, never no."""

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.mask = words, U64(2**bits - 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes.astype(U64) & self.mask
        return (self.words[at >> U64(6)] >> (at & U64(63))) & U64(1) > 0

    @staticmethod
    def of(hashes: DataFrame, column: str, bits: int) -> BitSet:
        """Gathers at most 2**(bits - 6) words on the driver: the size depends on `bits` alone."""
        at = F.col(column).bitwiseAND(F.lit(2**bits - 1))
        found = (
            hashes.select(at.alias("at"))
            .where("at is not null")
            .groupBy(F.shiftrightunsigned("at", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("held"))
            .toArrow()
        )
        words = np.zeros(2 ** (bits - 6), U64)
        words[found["word"].to_numpy()] = found["held"].to_numpy().view(U64)
        # Fold while the set stays thin: what is sent to the workers follows the number of hashes.
        while bits > 16 and np.bitwise_count(words).sum(dtype=np.int64) << 6 <= 1 << bits:
            words = words[: len(words) // 2] | words[len(words) // 2 :]
            bits -= 1
        return BitSet(words, bits)


def folder_of(df: DataFrame) -> DataFrame:
    """Write `df` to the shared checkpoint folder and go on from there."""
    return settle(df)


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of the undirected edges (a, b).

    Alternating stars: every round hangs each node's neighbours on its smallest neighbour, so the
    number of rounds grows with the logarithm of the longest path. A node with many neighbours is only
    ever reduced by `min`, never gathered.
    """
    live = folder_of(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(live)
    while state[0]:
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        live = folder_of(small.where("a <> b").distinct())
        before, state = state, _state(live)
        if before == state:
            break
    stars = live.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.coalesce(F.expr("bit_xor(xxhash64(a, b))"), F.lit(0))).first())


def text_hash(*columns: Column | str) -> Column:
    """Names one row among rows that may repeat: equal rows get equal names."""
    return F.xxhash64(*columns)
