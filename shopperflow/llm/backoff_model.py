"""Language-model scores: a weighted backoff automaton over smoothed n-grams, learnt from the documents themselves.

The model. Tokens are the words `[^\\x20\\x09-\\x0D]+` (A-Z as a-z) of a text and one end. The empty context gives
a token (c + 1) / (N + V + 1), with c its count, N all tokens and V the distinct ones of the training texts. A
context h that occurs in them gives (c(hw) + prior * p(w | shorter h)) / (c(h) + prior): hierarchical Dirichlet
smoothing, whose probabilities sum to one over the known words and one unknown word. The first context of a text
is its start; there is no context beyond it.

The automaton. Its states are the contexts that occur in training, from the empty one to order - 1 tokens. An n-gram
that occurs is an arc from its context, with the logarithm above as its weight; a state without an arc for the
next token has a failure arc to the state of the context without its first token, with the weight
prior / (c(h) + prior). After a token the state is the longest context that ends there. So the one traversal
needs only, for every token, whether the n-grams that end at it occur and how often.

How it runs. The model grows with the texts and is never held in one place. Texts are cut, in the order of the scan,
into slices of bounded size, and every slice of the automaton goes to the texts that can reach it:

1. Each slice tells its distinct n-grams, sorted by hash, with their counts in training texts, packed by ranges of
   the hash. An n-gram occurs once a slice, however common it is, so no range is hot.
2. Each range adds up the counts over the slices and answers every slice in the order in which it asked.
3. Each slice, now with its texts, looks up its states and arcs and walks through its texts.

Texts are shuffled once, n-grams once at about six bytes each. Step 3 must see the rows that step 1 saw, in the
same order: read documents from files or a written table. An answer that does not belong to the n-grams of its
slice raises an error.

Defined results: null and empty texts are one end; without training texts every token has probability 1 (N and V
are 0); repeated rows count and are scored each; equal texts have equal scores; documents without id are treated
as an empty id by `trained`; an empty table gives no rows. N-grams are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from .arrays import CHUNK_BYTES, U64, folder_of, known_to_workers, mix, signed, texts_of, word_hashes

ORDER = 2
PRIOR = 20.0
#: Bytes of text of a slice (a longer single text is a slice of its own), and of the text whose n-grams share a range.
SLICE_BYTES = 8 << 20
RANGE_BYTES = 12 << 20
_START, _END = U64(0x243F6A8885A308D3), U64(0x13198A2E03707344)
_PACK = pa.Codec("zstd")


def trained(doc_id: str = "doc_id") -> Column:
    """Documents that are learnt from: crc32 of the id as text, modulo 7, is not 2 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 7 != 2


def packed(numbers: np.ndarray) -> bytes:
    """Numbers by planes of their bytes, compressed: sorted or small ones take few bytes."""
    planes = np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, numbers.itemsize).T)
    return _PACK.compress(planes.tobytes(), asbytes=True)


def unpacked(held: bytes, n: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(_PACK.decompress(held, n * size, asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).reshape(-1).view(kind)


def _in_chunks(texts: list[bytes]) -> Iterator[list[bytes]]:
    """At least one list; each of about CHUNK_BYTES, as hashing takes many times its text."""
    ends = np.cumsum([len(t) for t in texts] or [0])
    cuts = np.flatnonzero(np.diff(ends // CHUNK_BYTES)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)]):
        yield texts[a:b]


class Tokens:
    """The tokens of some texts and, by number of tokens, the n-grams that end at each."""

    def __init__(self, texts: list[bytes], order: int):
        parts = [word_hashes(part) for part in _in_chunks(texts)]
        words, counts = (np.concatenate(x) for x in zip(*parts))
        self.sizes = counts + 1
        ends = np.cumsum(self.sizes) - 1
        self.starts = ends - counts
        tokens = np.empty(len(words) + len(texts), U64)
        tokens[np.arange(len(words)) + np.repeat(np.arange(len(texts)), counts)] = words
        tokens[ends] = _END
        place = np.arange(len(tokens)) - np.repeat(self.starts, self.sizes)
        self.grams = [tokens]
        #: Where an n-gram of each size ends: from two tokens on, the start counts as one.
        self.exists = [np.ones(len(tokens), bool)]
        for size in range(2, order + 1):
            before = np.append(_START, self.grams[-1][:-1])
            if size == 2:
                before[self.starts] = _START
            self.grams.append(mix(before * U64(0x9FB21C651E98DF25) + tokens))
            self.exists.append(place >= size - 2)


def _slices(batches, most: int) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """Rows in the order they come, cut before `most` bytes of text (the last column) are passed."""
    held, size, number = [], 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.num_columns - 1).cast(pa.binary())
        sizes = np.diff(np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1])
        start = 0
        for i, n in enumerate(sizes.tolist()):
            if size and size + n > most:
                if i > start:
                    held.append(batch.slice(start, i - start))
                yield number, held
                held, size, start, number = [], 0, i, number + 1
            size += n + 1
        held.append(batch.slice(start))
    if held:
        yield number, held


def _texts(parts: list[pa.RecordBatch]) -> list[bytes]:
    return [t for part in parts for t in texts_of(part.column(part.num_columns - 1))]


def _layout(**columns: pa.DataType) -> pa.Schema:
    return pa.schema(list(columns.items()))


_INT, _LONG, _BYTES = pa.int32(), pa.int64(), pa.binary()
_ASKED = _layout(size=_INT, range=_INT, task=_INT, slice=_INT, n=_INT, grams=_BYTES, counts=_BYTES)
_ANSWERED = _layout(task=_INT, slice=_INT, size=_INT, range=_INT, n=_INT, sign=_LONG, counts=_BYTES, tokens=_LONG, words=_LONG)


def _asking(order: int, bits: int, slice_bytes: int):
    def run(batches):
        task = TaskContext.get().partitionId()
        for number, parts in _slices(batches, slice_bytes):
            learnt = np.concatenate([p.column("train").to_numpy(zero_copy_only=False) for p in parts]).astype(bool)
            tokens = Tokens(_texts(parts), order)
            counted = np.repeat(learnt, tokens.sizes)
            for size, (grams, exists) in enumerate(zip(tokens.grams, tokens.exists), 1):
                distinct, at = np.unique(grams[exists], return_inverse=True)
                counts = np.bincount(at, weights=counted[exists], minlength=len(distinct)).astype(np.uint32)
                ranges = (distinct >> U64(64 - bits)).astype(np.int32) if bits else np.zeros(len(distinct), np.int32)
                cuts = np.flatnonzero(np.append(True, ranges[1:] != ranges[:-1])) if len(distinct) else []
                rows = [
                    (size, int(ranges[a]), task, number, b - a, packed(distinct[a:b]), packed(counts[a:b]))
                    for a, b in zip(cuts, [*cuts[1:], len(distinct)])
                ]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), _ASKED)], schema=_ASKED)

    return run


def _answering(table: pa.Table) -> pa.Table:
    """One range: counts added up over the slices, for every slice in the order of its own n-grams."""
    rows = table.sort_by([("task", "ascending"), ("slice", "ascending")]).to_pylist()
    grams = [unpacked(r["grams"], r["n"], U64) for r in rows]
    counts = np.concatenate([unpacked(r["counts"], r["n"], np.uint32) for r in rows])
    _, at = np.unique(np.concatenate(grams), return_inverse=True)
    sums = np.bincount(at, weights=counts).astype(np.uint64)
    totals = sums[at]
    words = rows[0]["size"] == 1
    out, start = [], 0
    for r, own in zip(rows, grams):
        held = totals[start : start + r["n"]]
        start += r["n"]
        kind = np.uint32 if int(held.max()) < 2**32 else U64
        sign = int(signed(np.bitwise_xor.reduce(own, keepdims=True))[0])
        out.append((r["task"], r["slice"], r["size"], r["range"], r["n"], sign, bytes([kind == U64]) + packed(held.astype(kind)), 0, 0))
    if words:  # the range's part of N and V, told once
        out.append((-1, -1, 1, rows[0]["range"], 0, 0, b"", int(sums.sum()), int(np.count_nonzero(sums))))
    return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), _ANSWERED)], schema=_ANSWERED)


def _known(rows: list[dict], distinct: np.ndarray, size: int) -> np.ndarray:
    """Counts of the distinct n-grams of one slice, from the answers of all ranges."""
    mine = sorted((r for r in rows if r["size"] == size), key=lambda r: r["range"])
    sign = 0
    for r in mine:
        sign ^= r["sign"]
    own = int(signed(np.bitwise_xor.reduce(distinct, keepdims=True))[0]) if len(distinct) else 0
    if sum(r["n"] for r in mine) != len(distinct) or sign != own:
        raise ValueError("The documents were not read in the same order twice: read them from files or a written table.")
    held = [unpacked(r["counts"][1:], r["n"], U64 if r["counts"][0] else np.uint32) for r in mine]
    return np.concatenate(held).astype(np.float64) if held else np.empty(0)


class Automaton:
    """The states and arcs that some texts can reach, by the counts of their n-grams."""

    def __init__(self, tokens: Tokens, counts: list[np.ndarray], texts_learnt: float, total: int, words: int, prior: float):
        """`counts`: by size, of the n-gram that ends at each token (0 where there is none)."""
        self.tokens, self.counts = tokens, counts
        self.root = np.log10((counts[0] + 1) / (total + words + 1))
        weights, arc = 10.0**self.root, self.root
        self.arcs, self.failures = [self.root], []
        for size in range(2, len(counts) + 1):
            state = np.append(0.0, counts[size - 2][:-1])  # how often the context before each token occurs
            if size == 2:
                state[tokens.starts] = texts_learnt
            state[~tokens.exists[size - 1]] = 0
            weights = (counts[size - 1] + prior * weights) / (state + prior)
            arc = np.log10(weights)
            self.arcs.append(arc)
            self.failures.append(np.log10(prior / (state + prior)))

    def walked(self) -> np.ndarray:
        """Log-probability of each text: at each token the arc of the longest context that has one, after the failure
        arcs that lead there; a context that does not occur is no state, so nothing is paid for leaving it."""
        taken = self.arcs[0].copy()
        for size in range(2, len(self.arcs) + 1):
            taken = np.where(self.counts[size - 1] > 0, self.arcs[size - 1], self.failures[size - 2] + taken)
        return _summed(taken, self.tokens)


def _summed(values: np.ndarray, tokens: Tokens) -> np.ndarray:
    return np.add.reduceat(values, tokens.starts) if len(tokens.starts) else np.empty(0)


def scored(
    documents: DataFrame, train: Column, text: str = "text", passed: list[str] | None = None, order: int = ORDER,
    prior: float = PRIOR, slice_bytes: int = SLICE_BYTES, range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """The columns of `documents` (or those `passed`) with n_tokens, n_known, train_tokens, base_score and score.

    `train` says which rows are learnt from (null: not). New names win over older ones.
    """
    known_to_workers(documents.sparkSession)
    added = T.StructType.fromDDL("n_tokens long, n_known long, train_tokens long, base_score double, score double")
    kept = [f for f in documents.schema.fields if f.name not in added.names and (passed is None or f.name in passed)]
    carried = [f"__{i}" for i in range(len(kept))]
    body = F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b"")).alias("__text")
    learnt = F.coalesce(train, F.lit(False)).alias("train")
    # Both readings select the same rows of the same scan, so their tasks are cut alike.
    plain = documents.select(learnt, body)
    whole = documents.select(*[F.col(f"`{f.name}`").alias(c) for f, c in zip(kept, carried)], learnt, body)

    size = documents.agg(F.sum(F.octet_length(f"`{text}`"))).first()[0] or 0
    bits = max(0, (int(size) // range_bytes).bit_length())
    asked = plain.mapInArrow(_asking(order, bits, slice_bytes), from_arrow_schema(_ASKED))
    answers = folder_of(asked.groupBy("size", "range").applyInArrow(_answering, from_arrow_schema(_ANSWERED)))
    total, words = answers.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()

    placed_fields = T.StructType(
        [T.StructField("task", T.IntegerType()), T.StructField("slice", T.IntegerType()), T.StructField("row", T.IntegerType())]
        + [T.StructField(c, f.dataType) for f, c in zip(kept, carried)] + [T.StructField("__text", T.BinaryType())]
    )

    names = placed_fields.names

    def placed(batches):
        task = TaskContext.get().partitionId()
        for number, parts in _slices(batches, slice_bytes):
            row = 0
            for part in parts:
                n = part.num_rows
                ids = [pa.array(np.full(n, x, np.int32)) for x in (task, number)] + [pa.array(np.arange(row, row + n, dtype=np.int32))]
                yield pa.RecordBatch.from_arrays([*ids, *[part.column(c) for c in carried], part.column("__text")], names=names)
                row += n

    made_kinds = to_arrow_schema(added)
    out = T.StructType([T.StructField(c, f.dataType) for f, c in zip(kept, carried)] + added.fields)

    def walked(rows: pa.Table, answered: pa.Table) -> pa.Table:
        rows = rows.sort_by("row")
        answered = answered.to_pylist()
        tokens = Tokens(texts_of(rows.column("__text").combine_chunks()), order)
        counts, texts_learnt = [], 0.0
        for size, (grams, exists) in enumerate(zip(tokens.grams, tokens.exists), 1):
            distinct, at = np.unique(grams[exists], return_inverse=True)
            known = _known(answered, distinct, size)
            if size == 1 and len(distinct):
                texts_learnt = known[np.searchsorted(distinct, _END)]
            held = np.zeros(len(exists))
            held[exists] = known[at]
            counts.append(held)
        automaton = Automaton(tokens, counts, texts_learnt, total, words, prior)
        made = [
            tokens.sizes, _summed((counts[0] > 0).astype(np.int64), tokens), np.full(rows.num_rows, total, np.int64),
            _summed(automaton.root, tokens), automaton.walked(),
        ]
        return pa.Table.from_arrays(
            [rows.column(c) for c in carried] + [pa.array(x, f.type) for x, f in zip(made, made_kinds)],
            names=[*carried, *added.names],
        )

    texts = whole.mapInArrow(placed, placed_fields)
    made = texts.groupBy("task", "slice").cogroup(answers.where("task >= 0").groupBy("task", "slice")).applyInArrow(walked, out)
    return made.select(*[F.col(c).alias(f.name) for f, c in zip(kept, carried)], *added.names)
