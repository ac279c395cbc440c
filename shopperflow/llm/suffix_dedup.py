"""Substring dedup by minimizer anchors and hash counts, in place of suffix sorting by bucket-pointer refinement.

Removed is every byte covered by a string of `length` bytes that also starts anywhere else. Sorting all
suffixes would settle that; but a suffix is needed only where its first q bytes, its initial bucket, occur
again, and of all the suffixes in a window of length - q + 1 places one will do: the one whose q-gram
has the smallest hash, which is the same in equal windows. Each start of a string so belongs to one
anchor inside it. Nothing is sorted and no bucket is refined over doubling offsets; hashes are counted at three
fixed levels:

1. q-gram buckets of all anchors; an anchor alone in its bucket settles all its strings as unique.
2. For the rest, the starts at each distance from the anchor are taken in steps of `STEP`: the bytes common to
   the strings of a step are the next identifier. If all bytes that the step's strings touch occur again
   in one piece, the step is settled as repeated, and if the common bytes occur nowhere else, as unique.
3. Strings of the unsettled steps are compared whole.

Identifiers are hashes from running sums, so any offset costs the same and nothing is moved but numbers:
64 bits where a coincidence costs only time, two times 64 bits (for a step of its core and its hull) where it
decides. Counting is a plain aggregation, so
a passage that a third of all texts share is reduced before it is shuffled. Of texts that are equal as a
whole only one takes part; the others are found by counting texts (named by 64 bits).

Defined results: a null text is empty; texts shorter than `length` lose nothing; matches never cross
documents but may overlap inside one; rows with equal texts are copies of each other and lose everything
(if long enough); a null doc_id is an id like others; empty tables give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import U64, BitSet, Substrings, annotated, folder_of, mapped, signed, texts_of

LENGTH = 400
GRAM = 128
STEP = 39
BITS = 27


class Anchors:
    """Of one text: the places `at` of its anchors, their q-gram hashes, and the string starts first..last each settles."""

    def __init__(self, text: bytes, length: int, gram: int):
        self.data = np.frombuffer(text, np.uint8)
        self.one = Substrings(self.data, 0)
        grams = self.one.all_of(gram)
        n, span = len(grams), length - gram + 1
        # Smallest hash first, then the leftmost place.
        key = (grams & U64(0xFFFFFFFF00000000)) | np.arange(n, dtype=U64)
        blocks = np.full(-(-n // span) * span, U64(2**64 - 1))
        blocks[:n] = key
        blocks = blocks.reshape(-1, span)
        ahead = np.minimum.accumulate(blocks, 1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
        least = (np.minimum(behind[: n - span + 1], ahead[span - 1 : n]) & U64(0xFFFFFFFF)).astype(np.int64)
        self.first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        self.last = np.append(self.first[1:], len(least)) - 1
        self.at = least[self.first]
        self.bucket = grams[self.at]

    def kept(self, rows: np.ndarray) -> None:
        self.first, self.last, self.at, self.bucket = (x[rows] for x in (self.first, self.last, self.at, self.bucket))

    def second(self) -> Substrings:
        """Identifiers independent of those in `one`."""
        if not hasattr(self, "_second"):
            self._second = Substrings(self.data, 1)
        return self._second

    def steps(self, length: int, step: int) -> dict[str, np.ndarray]:
        """For each anchor and step: core (identifier of the common bytes), hull (of all bytes; 0 where they
        would leave the text), lo..hi (the string starts)."""
        least, most = (self.at - self.last) // step, (self.at - self.first) // step
        count = most - least + 1
        owner = np.repeat(np.arange(len(self.at)), count)
        k = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + least[owner]
        near = self.at[owner] - step * k  # the latest start of the step
        # Two anchors may share a step, which is then one place, not two.
        near, same = np.unique(near, return_inverse=True)
        lo, hi = np.full(len(near), len(self.data)), np.full(len(near), -1)
        np.minimum.at(lo, same, self.first[owner])
        np.maximum.at(hi, same, self.last[owner])
        far = near - step + 1
        core = self.one.at(near, far + length)
        inside = (far >= 0) & (near + length <= len(self.data))
        hull = np.zeros(len(near), U64)
        if inside.any():
            hull[inside] = self.second().at(far[inside], near[inside] + length)
        return {
            "core": core, "hull": hull,
            "lo": np.maximum(lo, far), "hi": np.minimum(hi, near),
        }


def _collected(parts: list[dict[str, np.ndarray]]) -> dict | None:
    if not parts:
        return None
    whole = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
    return {k: signed(v) if v.dtype == U64 else v for k, v in whole.items()}


def _text_key(text: str):
    return F.xxhash64(text)


def spans(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, step: int = STEP, bits: int = BITS) -> DataFrame:
    """key (hash of the text), lo, hi: starts of repeated strings, in ranges that may overlap.

    Of equal texts one takes part; that they are repeated whole is seen by counting texts, which
    `without_repeats` does.
    """
    spark = documents.sparkSession
    rows = documents.where(F.octet_length(text) >= length).select(
        F.col(text).alias("text"), _text_key(text).alias("key"), F.xxhash64(doc_id, text).alias("row")
    )
    speakers = rows.groupBy("key").agg(F.min("row").alias("row"))
    # Should the set let a copy through, it is one more occurrence of what is repeated anyway.
    speaking = spark.sparkContext.broadcast(BitSet.of(speakers, "row", bits))

    def read(part: pa.RecordBatch):
        speaks = speaking.value.has(part.column("row").to_numpy().view(U64))
        for t, key, yes in zip(texts_of(part.column("text")), part.column("key").to_pylist(), speaks.tolist()):
            if yes:
                yield key, Anchors(t, length, gram)

    def buckets(part: pa.RecordBatch) -> dict | None:
        return _collected([{"bucket": found.bucket} for _, found in read(part)])

    grams = mapped(rows, "text", buckets, "bucket long").groupBy("bucket").agg(F.count("*").alias("n"))
    shared = spark.sparkContext.broadcast(BitSet.of(grams.where("n > 1"), "bucket", bits))

    def live(part: pa.RecordBatch):
        for key, found in read(part):
            again = shared.value.has(found.bucket)
            if again.any():
                found.kept(again)
                yield key, found, found.steps(length, step)

    def steps(part: pa.RecordBatch) -> dict | None:
        return _collected([held | {"key": np.full(len(held["lo"]), key, np.int64)} for key, _, held in live(part)])

    refined = folder_of(mapped(rows, "text", steps, "core long, hull long, key long, lo int, hi int"))
    stated = refined.groupBy("core", "hull").agg(F.count("*").alias("n")).withColumn("settled", F.expr("n > 1 and hull <> 0"))
    cores = stated.groupBy("core").agg(F.sum("n").alias("n"), F.every("settled").alias("settled")).where("n > 1")
    stated = folder_of(stated.join(cores.select("core", F.col("settled").alias("core_settled")), "core"))
    name = F.col("core").bitwiseXOR(F.col("hull")).alias("name")
    # Settled as repeated: their hull occurs again.
    settled = stated.where("settled").select("core", "hull", name)
    whole = _within(refined.withColumn("name", name), "name", BitSet.of(settled, "name", bits))
    whole = whole.join(settled.drop("name"), ["core", "hull"], "left_semi").select("key", "lo", "hi")
    # Unsettled: strings of every step with such a core are compared, those of settled steps only to be met.
    unsettled = stated.where("not core_settled")
    cores_set = spark.sparkContext.broadcast(BitSet.of(unsettled, "core", bits))
    names = unsettled.where("not settled").select(name)
    names_set = spark.sparkContext.broadcast(BitSet.of(names, "name", bits))

    def strings(part: pa.RecordBatch) -> dict | None:
        out = []
        for key, found, held in live(part):
            at = np.flatnonzero(cores_set.value.has(held["core"]))
            if not len(at):
                continue
            count = held["hi"][at] - held["lo"][at] + 1
            start = np.repeat(held["lo"][at] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            asked = np.repeat(names_set.value.has((held["core"] ^ held["hull"])[at]), count)
            start, same = np.unique(start, return_inverse=True)  # each start once, whatever steps name it
            wanted = np.bincount(same, asked) > 0
            one, two = found.one.at(start, start + length), found.second().at(start, start + length)
            out.append({"s1": one, "s2": two, "key": np.full(len(start), key, np.int64), "lo": start, "wanted": wanted})
        return _collected(out)

    compared = folder_of(mapped(rows, "text", strings, "s1 long, s2 long, key long, lo int, wanted boolean"))
    again = compared.groupBy("s1", "s2").agg(F.count("*").alias("n"), F.max("wanted").alias("wanted")).where("n > 1 and wanted")
    again = folder_of(again.select("s1", "s2"))
    single = _within(compared.where("wanted"), "s1", BitSet.of(again, "s1", bits)).join(again, ["s1", "s2"], "left_semi")
    return whole.unionByName(single.select("key", "lo", F.col("lo").alias("hi")))


def _within(rows: DataFrame, column: str, held: BitSet) -> DataFrame:
    """The rows whose hash may be in the set: fewer rows for the join that decides."""
    known = rows.sparkSession.sparkContext.broadcast(held)

    def keep(batches):
        for batch in batches:
            yield batch.filter(pa.array(known.value.has(batch.column(column).to_numpy().view(U64))))

    return rows.mapInArrow(keep, rows.schema)


def without_repeats(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, step: int = STEP,
    bits: int = BITS, with_kept: bool = True,
) -> DataFrame:
    """All columns but the text; n_bytes, n_removed, n_spans, kept_sha256 and, if wanted, kept (the remaining bytes).

    Texts without any repeated string are not shuffled: a bit set of the others tells them apart.
    """
    found = spans(documents, doc_id, text, length, gram, step, bits)
    found = found.groupBy("key").agg(F.collect_list(F.expr("shiftleft(cast(lo as long), 32) | hi")).alias("__spans"))
    # A text that occurs twice is repeated whole.
    long = documents.where(F.octet_length(text) >= length).select(_text_key(text).alias("key"))
    twice = long.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key", F.lit(True).alias("__twice"))
    marks = folder_of(found.join(twice, "key", "full").withColumnRenamed("key", "__key"))
    marked = documents.sparkSession.sparkContext.broadcast(BitSet.of(marks, "__key", bits))

    def told_apart(part: pa.RecordBatch) -> dict:
        """Texts that lose nothing are done; of the others the text goes on."""
        key, texts = part.column("__key"), texts_of(part.column("__text"))
        goes_on = marked.value.has(key.to_numpy().view(U64))
        return {
            "__key": key, "__marked": goes_on, "__bytes": [t if on else None for t, on in zip(texts, goes_on)],
            "n_bytes": [len(t) for t in texts], "n_removed": np.zeros(len(texts), np.int64), "n_spans": np.zeros(len(texts), np.int64),
            "kept_sha256": [None if on else hashlib.sha256(t).hexdigest() for t, on in zip(texts, goes_on)], "kept": texts,
        }

    schema = "n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_kept else "")
    others = [c for c in documents.columns if c != text]
    keyed = documents.withColumn("__key", _text_key(text))
    keyed = annotated(keyed, text, told_apart, f"{schema}, __key long, __marked boolean, __bytes binary", passed=others, beside=("__key",))
    plain = keyed.where("not __marked").drop("__key", "__marked", "__bytes")
    both = keyed.where("__marked").drop("__marked").join(marks, "__key", "left").drop("__key")

    def make(part: pa.RecordBatch) -> dict:
        out: dict[str, list] = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept", "kept_sha256")}
        lists = part.column("__spans")
        held, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        begin = 0
        for t, end, twice in zip(texts_of(part.column("__text")), ends.tolist(), part.column("__twice").to_pylist()):
            ranges, begin = held[begin:end], end
            kept, runs = t, 0
            if twice and len(t) >= length:
                kept, runs = b"", 1
            elif len(ranges):
                steps = np.zeros(len(t) + 1, np.int64)
                np.add.at(steps, ranges >> 32, 1)
                np.add.at(steps, (ranges & 0xFFFFFFFF) + length, -1)
                gone = np.cumsum(steps[:-1]) > 0
                runs = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
                kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
            for k, v in zip(out, (len(t), len(t) - len(kept), runs, kept, hashlib.sha256(kept).hexdigest())):
                out[k].append(v)
        return out

    cut = annotated(both, "__bytes", make, schema, passed=others, beside=("__spans", "__twice"))
    return plain.unionByName(cut)
