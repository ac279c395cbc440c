"""Benchmark decontamination: one Aho-Corasick automaton over normalised benchmark windows.

A-Z become a-z and every other ASCII character but digits and letters separates words; characters
outside ASCII belong to words. A window is `size` consecutive words of an item, or the whole item if
it has fewer (but not none). The automaton holds every distinct window, framed by separators, and
reads each document once (a benchmark beyond PART_BYTES goes in parts, each its own automaton and scan); the separators before a match tell which words it covers, and the places of
those words in the original text tell which characters.

Defined results: null or empty texts have no words and no hits; items without words have no window;
repeated items and windows count once per item_id; a null item_id names no item (its words still
hit); repeated documents are judged each for itself; empty tables give no hits or no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import annotated, folder_of, mapped, texts_of

#: A-z and 0-9 stay, A-Z are lowered, other ASCII separates, bytes over 0x7F stay.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c > 127 else 32 for c in range(256)
)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
SIZE = 10
#: Text of items that go into one automaton (windows of them take about ten times as much, their automaton
#: about a hundred bytes for a byte of its windows); of a larger benchmark, the parts are scanned one by one.
PART_BYTES = 1 << 19
#: Windows of one piece of a long item.
PIECE_WINDOWS = 2000


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def windows_of(words: list[bytes], size: int = SIZE) -> set[bytes]:
    if not words:
        return set()
    return {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


class Automata:
    """The windows of all items. Built once per worker process from the plain windows."""

    def __init__(self, windows: dict[bytes, tuple[int, list[str]]]):
        """windows: text -> number of words, ids of the items that have it."""
        self.windows = windows
        self._made: ahocorasick.Automaton | None = None

    def __getstate__(self):
        return {"windows": self.windows, "_made": None}

    def made(self) -> ahocorasick.Automaton:
        if self._made is None:
            self._made = ahocorasick.Automaton()
            for number, (window, (length, _)) in enumerate(self.windows.items()):
                self._made.add_word(f" {window.decode('latin-1')} ", (number, length))
            self._made.make_automaton()
            self._items = [items for _, items in self.windows.values()]
        return self._made

    def scan(self, text: bytes) -> tuple[int, np.ndarray | None, set[str]]:
        """Number of words, which of them are hit (None: none), the items found."""
        words = words_of(text)
        if not words:
            return 0, None, set()
        line = " " + b" ".join(words).decode("latin-1") + " "  # one character a byte
        ends, lengths, found = [], [], set()
        automaton = self.made()
        for end, (number, length) in automaton.iter(line) if self.windows else ():
            ends.append(end)
            lengths.append(length)
            found.add(number)
        if not ends:
            return len(words), None, set()
        spaces = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
        last = np.searchsorted(spaces, np.array(ends))  # the match ends with the space after word last - 1
        steps = np.zeros(len(words) + 1, np.int64)
        np.add.at(steps, last - np.array(lengths), 1)
        np.add.at(steps, last, -1)
        return len(words), np.cumsum(steps[:-1]) > 0, {i for n in found for i in self._items[n]}


def spans(text: bytes, hit: np.ndarray | None) -> list[tuple[int, int]]:
    """Byte ranges of the original text that hit words cover, neighbouring words joined."""
    if hit is None:
        return []
    out: list[tuple[int, int]] = []
    for i, m in enumerate(_WORD.finditer(text)):
        if hit[i]:
            out[-1:] = [(out[-1][0], m.end())] if i and hit[i - 1] else [*out[-1:], m.span()]
    return out


class Parts:
    """The automata of a benchmark, each built when its turn comes: the driver holds the windows of one part."""

    def __init__(self, pieces: DataFrame, parts: int, size: int):
        """pieces: i (item id), t (its words, or a stretch of them)."""
        self.pieces, self.parts, self.size = pieces, parts, size

    def __len__(self) -> int:
        return self.parts

    def __iter__(self) -> Iterator[Automata]:
        part = F.pmod(F.xxhash64("i", "t"), F.lit(self.parts))
        for n in range(self.parts):
            yield _automata(self.pieces.where(part == n).collect(), self.size)


def pieces_of(words: list[bytes], size: int = SIZE, windows: int = PIECE_WINDOWS) -> list[bytes]:
    """Stretches of the words that have so many windows each; every window is in one."""
    return [b" ".join(words[i : i + windows + size - 1]) for i in range(0, max(1, len(words) - size + 1), windows)] if words else []


def automata(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", size: int = SIZE) -> Parts:
    """Of the benchmark's distinct windows: one, or if the items have more than PART_BYTES of text one for
    each part of them, dealt by hash. Long items are cut into pieces that overlap by `size` - 1 words."""
    items = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(text).alias("t"))

    def cut(part: pa.RecordBatch) -> dict:
        found = [(i, p) for i, t in zip(part.column("i").to_pylist(), texts_of(part.column("t"))) for p in pieces_of(words_of(t), size)]
        return {"i": [i for i, _ in found], "t": [p for _, p in found]}

    pieces = folder_of(mapped(items, "t", cut, "i string, t binary").distinct())
    held = pieces.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    return Parts(pieces, max(1, -(-held // PART_BYTES)), size)


def _automata(rows: list, size: int) -> Automata:
    held: dict[bytes, tuple[int, set[str]]] = {}
    for row in rows:
        words = words_of(bytes(row.t))
        for window in windows_of(words, size):
            held.setdefault(window, (min(size, len(words)), set()))[1].update([row.i] if row.i is not None else [])
    return Automata({w: (n, sorted(items)) for w, (n, items) in sorted(held.items())})


SCHEMA = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, hit_spans array<struct<start:long,stop:long>>"


def _columns(texts: list[bytes], scans: list[tuple[int, np.ndarray | None, set[str]]]) -> dict:
    out: dict[str, list] = {k: [] for k in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "hit_spans")}
    for t, (n, hit, items) in zip(texts, scans):
        hits = 0 if hit is None else int(hit.sum())
        digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        places = [{"start": s, "stop": e} for s, e in spans(t, hit)]
        for k, v in zip(out, (n, hits, len(items), digest, hits > 0, places)):
            out[k].append(v)
    return out


def contaminated(documents: DataFrame, found: Parts, text: str = "text", passed: list[str] | None = None) -> DataFrame:
    """Adds n_words, n_hit, n_items, items_sha256, contaminated and the byte ranges hit_spans."""
    if len(found) > 1:
        return _by_parts(documents, found, text, passed)
    shared = documents.sparkSession.sparkContext.broadcast(next(iter(found)))  # PART_BYTES of items at most

    def make(part: pa.RecordBatch) -> dict:
        texts = texts_of(part.column("__text"))
        return _columns(texts, [shared.value.scan(t) for t in texts])

    return annotated(documents, text, make, SCHEMA, passed)


def _by_parts(documents: DataFrame, found: Parts, text: str, passed: list[str] | None) -> DataFrame:
    """One scan of the texts for each part; only hits are kept, and brought together by the hash of the text."""
    spark = documents.sparkSession
    key = F.struct(F.xxhash64(text).alias("a"), F.md5(text).alias("b"))
    keyed = documents.select(F.col(text).alias("text"), key.alias("key"))
    hits = []
    for one in found:
        shared = spark.sparkContext.broadcast(one)
        del one

        def make(part: pa.RecordBatch, shared=shared) -> dict | None:
            scans = [shared.value.scan(t) for t in texts_of(part.column("text"))]
            at = [i for i, (_, hit, _) in enumerate(scans) if hit is not None]
            return {"key": part.column("key").take(pa.array(at)), "hit": [np.flatnonzero(scans[i][1]) for i in at],
                    "items": [sorted(scans[i][2]) for i in at]} if at else None

        hits.append(folder_of(mapped(keyed, "text", make, "key struct<a:long,b:string>, hit array<int>, items array<string>")))
        shared.destroy()
    together = reduce(DataFrame.unionByName, hits).distinct().groupBy(F.col("key").alias("__key"))
    together = together.agg(F.flatten(F.collect_list("hit")).alias("__hit"), F.flatten(F.collect_list("items")).alias("__items"))
    joined = documents.withColumn("__key", key).join(together, "__key", "left").drop("__key")

    def whole(part: pa.RecordBatch) -> dict:
        texts, scans = texts_of(part.column("__text")), []
        for t, at, items in zip(texts, part.column("__hit").to_pylist(), part.column("__items").to_pylist()):
            n = len(words_of(t))
            hit = np.zeros(n, bool)
            hit[at or []] = True
            scans.append((n, hit if at else None, set(items or ())))
        return _columns(texts, scans)

    return annotated(joined, text, whole, SCHEMA, passed, beside=("__hit", "__items"))
