"""Repair of conversations: the cheapest edits after which the roles alternate and nothing blank or repeated is left.

A row's first fault counts: blank (nothing but white space `[\\x20\\x09-\\x0D]`), duplicate (role and text occur
earlier in the conversation), truncated (its last other character is not `.`, `!` or `?`). Edits: Keep costs 0, Rerole
to user or assistant 3, Insert of an empty user or assistant turn 3, Delete 4; blank and duplicate rows must be
deleted, a truncated row that stays costs 3 more. The first letters of the roles must then read `(s?(ua)+)?`. Of
several cheapest repairs that whose audit (the edits' first letters, in order) is least counts.

Method: depth-first branch and bound. A node is a place in the rows and a state of the role grammar, reached by a
prefix of edits. An explicit stack holds the open prefixes, the most promising on top. A prefix is given up if its
cost and the lower bound of what is left exceed the incumbent (cost, audit), if they equal it and its audit can only
be greater, or if the dominance table of its node holds a prefix that is no worse; when the stack is empty, the
incumbent is optimal. The lower bound of a place and state is the cheapest completion if a conversation might end
in any state. Two prefixes of one node go on alike, and neither audit begins the other unless it costs less, so the
better one stays better.

How it runs. Rows are range-partitioned by conversation and turn, so that a conversation with a third of all rows is
dealt over many tasks, and cut into segments of bounded size. A conversation that is one segment is done at once. Of
the others, each segment is searched for every state it may be entered and left in, which is a table of at most ten
repairs; the tables of a conversation are folded in order, with four prefixes held, and its segments are hashed in
order. Only the hash of the repaired text, one stream by its nature, reads a long conversation in one task, a
segment at a time.

Defined results: null roles and texts are one space; rows are ordered by turn (null first), then role, then text; a
null conversation id is one conversation of its own; a role's initial is its first character (none for an empty
role); rows that are not `present` only name their conversation; a conversation without rows has zeros, an empty
audit and the hash of the empty string; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .arrays import folder_of, known_to_workers

#: Rows and characters of a segment (a longer single text is a segment of its own).
SEGMENT_ROWS = 512
SEGMENT_CHARS = 1 << 20
_BLANKS = " \t\n\x0b\x0c\r"
REROLE, INSERT, DELETE, CUT_OFF = 3, 3, 4, 3
FINE, MUST_GO, TRUNCATED = 0, 1, 2

# The grammar (s?(ua)+)? as states: 0 nothing yet, 1 after s, 2 after u, 3 after a.
_KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_WANTED = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
_REACHES = {0: {0, 1, 2, 3}, 1: {1, 2, 3}, 2: {2, 3}, 3: {2, 3}}
_WHOLE = (0, 3)  # where a conversation may end

Mark = tuple[str, int]  # a row's initial (s, u, a or empty) and FINE, MUST_GO or TRUNCATED


def edits(mark: Mark, state: int) -> list[tuple[int, str, int]]:
    """What may be done with a row in a state: (cost, letter, next state)."""
    initial, fault = mark
    found = [(DELETE, "D", state)]
    if fault != MUST_GO:
        extra = CUT_OFF if fault == TRUNCATED else 0
        if (state, initial) in _KEPT:
            found.append((extra, "K", _KEPT[state, initial]))
        found.append((REROLE + extra, "R", _WANTED[state][1]))
    return found


_EDITS = {(i, f): [edits((i, f), s) for s in range(4)] for i in ("s", "u", "a", "") for f in (FINE, MUST_GO, TRUNCATED)}


def lower_bounds(marks: list[Mark], allowed: set[int]) -> list[list[float]]:
    """By place and state, the cheapest completion that may end in any of the `allowed` states."""
    never = float("inf")
    after = [0.0 if s in allowed else never for s in range(4)]
    bounds = [after]
    for mark in reversed(marks):
        here = [min(cost + after[to] for cost, _, to in _EDITS[mark][s]) if s in allowed else never for s in range(4)]
        for _ in range(2):  # inserts lead through two further states at most
            here = [min(x, INSERT + here[_WANTED[s][1]]) if s in allowed else never for s, x in enumerate(here)]
        bounds.append(here)
        after = here
    bounds.reverse()
    return bounds


def cheapest(marks: list[Mark], entry: int = 0, exits: Iterable[int] = _WHOLE) -> tuple[int, str] | None:
    """Least (cost, audit) that leads from `entry` to one of `exits` over all rows; None if nothing does."""
    exits = set(exits)
    allowed = {s for s in range(4) if _REACHES[s] & exits}
    if entry not in allowed or exits == {1} and entry == 0 and ("s", FINE) not in marks and ("s", TRUNCATED) not in marks:
        return None
    bounds, end = lower_bounds(marks, allowed), len(marks)
    incumbent: tuple[float, str] = (float("inf"), "")
    reached: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, entry, 0, "")]
    while stack:
        place, state, cost, audit = stack.pop()
        least = cost + bounds[place][state]
        if least > incumbent[0] or least == incumbent[0] and audit > incumbent[1][: len(audit)]:
            continue
        best = reached.get((place, state))
        if best is not None and best <= (cost, audit):
            continue
        reached[place, state] = (cost, audit)
        if place == end and state in exits:
            incumbent = min(incumbent, (cost, audit))
        branches = [(INSERT, "I", _WANTED[state][1], place)]
        if place < end:
            branches += [(c, letter, to, place + 1) for c, letter, to in _EDITS[marks[place]][state]]
        branches = [b for b in branches if b[2] in allowed]
        branches.sort(key=lambda b: (b[0] + bounds[b[3]][b[2]], b[1]), reverse=True)
        stack += [(to_place, to, cost + c, audit + letter) for c, letter, to, to_place in branches]
    return None if incumbent[0] == float("inf") else (int(incumbent[0]), incumbent[1])


def applied(rows: Iterable[tuple[str, str]], audit: Iterator[str], state: int) -> Iterator[tuple[str, str, int]]:
    """role, text and state of every repaired turn, row by row; inserts that no row follows stay in `audit`."""
    for role, text in rows:
        for letter in audit:
            if letter == "I":
                wanted, state = _WANTED[state]
                yield wanted, "", state
                continue
            if letter == "K":
                state = _KEPT[state, role[:1]]
                yield role, text, state
            elif letter == "R":
                wanted, state = _WANTED[state]
                yield wanted, text, state
            break


def appended(audit: Iterator[str], state: int) -> Iterator[tuple[str, str, int]]:
    """The inserts at the end."""
    for _ in audit:
        wanted, state = _WANTED[state]
        yield wanted, "", state


class _Repaired:
    """The repaired turns of one conversation as they come: their hash and, if wanted, the turns themselves."""

    def __init__(self, audit: str, with_turns: bool):
        self._audit, self._state, self._any = iter(audit), 0, False
        self._hash, self.turns = hashlib.sha256(), [] if with_turns else None

    def add(self, rows: Iterable[tuple[str, str]]) -> None:
        self._take(applied(rows, self._audit, self._state))

    def _take(self, made: Iterable[tuple[str, str, int]]) -> None:
        for role, text, self._state in made:
            self._hash.update(f"{chr(10) if self._any else ''}{role}:{text}".encode())
            self._any = True
            if self.turns is not None:
                self.turns.append({"role": role, "text": text})

    def done(self) -> str:
        self._take(appended(self._audit, self._state))
        return self._hash.hexdigest()


def _key(role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()


class Segment:
    """Rows of one conversation that follow each other: their faults, and what joins them to their neighbours."""

    def __init__(self, turns: list, rows: list[tuple[str, str]], earlier: Iterable[bytes] = ()):
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.marks: list[Mark] = []
        seen = set(earlier)
        for role, text in rows:
            kept = text.rstrip(_BLANKS)
            key = _key(role, text)
            fault = FINE
            if not kept:
                self.blank += 1
                fault = MUST_GO
            elif key in seen:
                self.duplicate += 1
                fault = MUST_GO
            elif kept[-1] not in ".!?":
                self.truncated += 1
                fault = TRUNCATED
            seen.add(key)
            initial = role[:1]
            self.marks.append((initial if initial in ("s", "u", "a") else "", fault))
        initials = [role[:1] for role, _ in rows]
        self.illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        self.first, self.last = initials[0], initials[-1]
        known = [t for t in turns if t is not None]
        self.low, self.high = (known[0], known[-1]) if known else (None, None)
        self.distinct = len(set(known))

    def table(self) -> list[dict]:
        """For every state to enter and to leave in, the cheapest repair."""
        found = [(e, x, cheapest(self.marks, e, (x,))) for e in range(4) for x in sorted(_REACHES[e])]
        return [{"entry": e, "exit": x, "cost": best[0], "audit": best[1]} for e, x, best in found if best is not None]


def repaired(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    present: Column | None = None, with_turns: bool = False, segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """One row a conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost (longs), audit, repaired_sha256
    (of the repaired `role:text`, joined by line feeds) and, if asked for, turns (the repaired roles and texts).

    Further columns are left out. `turn` must be a whole number.
    """
    known_to_workers(conversations.sparkSession)
    turns_kind = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))
    kind = conversations.select(F.col(f"`{conv_id}`")).schema[0].dataType
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    out = T.StructType(
        [T.StructField("conv_id", kind), *[T.StructField(n, T.LongType()) for n in numbers], T.StructField("audit", T.StringType()),
         T.StructField("repaired_sha256", T.StringType()), T.StructField("turns", turns_kind)]
    )
    cut = T.StructType(
        [T.StructField("conv_id", kind), T.StructField("task", T.IntegerType()), T.StructField("number", T.IntegerType()),
         T.StructField("row_turns", T.ArrayType(T.LongType())), T.StructField("roles", T.ArrayType(T.StringType())), T.StructField("texts", T.ArrayType(T.StringType()))]
    )
    packed = T.StructType([*out.fields, *cut.fields[1:]])
    packed_arrow, out_arrow = to_arrow_schema(packed), to_arrow_schema(out)

    there = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    blank = F.lit(" ")
    rows = conversations.select(
        F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), blank).alias("role"), F.coalesce(F.col(f"`{text}`"), blank).alias("text"), there.alias("present"),
    )
    order = ["conv_id", "turn", "role", "text"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def finished(conv, turns: list, found: list[tuple[str, str]]) -> dict:
        row = dict.fromkeys(packed.names) | {"conv_id": conv}
        if not found:
            mended = _Repaired("", with_turns)
            return row | dict.fromkeys(numbers, 0) | {"audit": "", "repaired_sha256": mended.done(), "turns": mended.turns}
        segment = Segment(turns, found)
        cost, audit = cheapest(segment.marks)
        mended = _Repaired(audit, with_turns)
        mended.add(found)
        gaps = 0 if segment.low is None else segment.high - segment.low + 1 - segment.distinct
        return row | {
            "gaps": gaps, "blank": segment.blank, "duplicate": segment.duplicate, "truncated": segment.truncated,
            "illegal": segment.illegal, "cost": cost, "audit": audit, "repaired_sha256": mended.done(), "turns": mended.turns,
        }

    def packing(batches):
        task, number, first = TaskContext.get().partitionId(), 0, True
        conv, turns, found, size, open_ = None, [], [], 0, True

        def segment():
            nonlocal number
            number += 1
            row = dict.fromkeys(packed.names) | {"conv_id": conv, "task": task, "number": number}
            return row | {"row_turns": turns, "roles": [r for r, _ in found], "texts": [t for _, t in found]}

        for batch in batches:
            done = []
            for c, t, r, x, here in zip(*(column.to_pylist() for column in batch.columns)):
                if first or c != conv:
                    # What a task begins with may have begun in the task before; what it ends with may go on.
                    if not first:
                        done.append(segment() if open_ else finished(conv, turns, found))
                    conv, turns, found, size, open_, first = c, [], [], 0, first, False
                elif len(found) >= segment_rows or size + len(x) > SEGMENT_CHARS and found:
                    done.append(segment())
                    turns, found, size, open_ = [], [], 0, True
                if here:
                    turns.append(t)
                    found.append((r, x))
                    size += len(x)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=packed_arrow)
        if not first:
            yield pa.RecordBatch.from_pylist([segment()], schema=packed_arrow)

    made = folder_of(rows.mapInArrow(packing, packed))
    whole = made.where("task is null").select(*out.names)
    parts = made.where("task is not null").select("conv_id", "task", "number", "row_turns", "roles", "texts")
    both = whole.unionByName(_long_ones(parts, out, out_arrow, with_turns))
    return both if with_turns else both.drop("turns")


def _long_ones(parts: DataFrame, out: T.StructType, out_arrow: pa.Schema, with_turns: bool) -> DataFrame:
    """Conversations in several segments."""
    counts = ["blank", "duplicate", "truncated", "illegal", "low", "high", "distinct"]
    step = T.StructType([T.StructField(n, T.StringType() if n == "audit" else T.LongType()) for n in ("entry", "exit", "cost", "audit")])
    summary = T.StructType(
        [*parts.schema.fields[:3], *[T.StructField(n, T.LongType()) for n in ("n", *counts)], T.StructField("first", T.StringType()),
         T.StructField("last", T.StringType()), T.StructField("steps", T.ArrayType(step))]
    )
    summary_arrow = to_arrow_schema(summary)

    # Rows whose like occurs in an earlier segment, by segment: a key counts once a segment.
    def keys(batches):
        for batch in batches:
            for row in batch.to_pylist():
                held = list({_key(r, t) for r, t in zip(row["roles"], row["texts"])})
                if held:
                    n = len(held)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["conv_id"]] * n, keys_arrow.field(0).type), pa.array([row["task"]] * n, pa.int32()), pa.array([row["number"]] * n, pa.int32()), pa.array(held)],
                        names=keys_arrow.names,
                    )

    keys_kind = T.StructType([*parts.schema.fields[:3], T.StructField("key", T.BinaryType())])
    keys_arrow = to_arrow_schema(keys_kind)
    held = parts.mapInArrow(keys, keys_kind).withColumn("at", F.struct("task", "number")).withColumn("conv", F.struct("conv_id"))
    firsts = held.groupBy("conv", "key").agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    again = held.join(firsts, ["conv", "key"]).where("at <> first").groupBy("task", "number").agg(F.collect_list("key").alias("earlier"))
    known = parts.join(again, ["task", "number"], "left").select(*parts.columns, "earlier")

    def searched(batches):
        for batch in batches:
            for row in batch.to_pylist():
                found = list(zip(row["roles"], row["texts"]))
                made = dict.fromkeys(summary.names) | {k: row[k] for k in ("conv_id", "task", "number")} | {"n": len(found)}
                if found:
                    s = Segment(row["row_turns"], found, row["earlier"] or ())
                    made |= {k: getattr(s, k) for k in (*counts, "first", "last")}
                    made["steps"] = s.table()
                yield pa.RecordBatch.from_pylist([made], schema=summary_arrow)

    # Nulls are one conversation, so they are spread and sorted like any other id.
    searched_parts = known.mapInArrow(searched, summary).repartition("conv_id").sortWithinPartitions("conv_id", "task", "number")

    def folded(batches):
        held: _Fold | None = None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if held is None or held.conv_id != row["conv_id"]:
                    if held is not None:
                        done.append(held.row(out.names))
                    held = _Fold(row["conv_id"])
                held.add(row)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=out_arrow)
        if held is not None:
            yield pa.RecordBatch.from_pylist([held.row(out.names)], schema=out_arrow)

    results = folder_of(searched_parts.mapInArrow(folded, out))

    # The audit first, then the segments in order: one stream a conversation.
    nothing = {f.name: F.lit(None).cast(f.dataType) for f in parts.schema.fields[3:]}
    ahead = results.withColumns({"task": F.lit(-1), "number": F.lit(0), **nothing})
    behind = parts.withColumns({f.name: F.lit(None).cast(f.dataType) for f in out.fields[1:]})
    stream = ahead.unionByName(behind).repartition("conv_id").sortWithinPartitions("conv_id", "task", "number")

    def hashed(batches):
        held, mended = None, None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if row["task"] == -1:
                    if held is not None:
                        done.append(held | {"repaired_sha256": mended.done(), "turns": mended.turns})
                    held, mended = {k: row[k] for k in out.names}, _Repaired(row["audit"], with_turns)
                else:
                    mended.add(zip(row["roles"], row["texts"]))
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=out_arrow)
        if held is not None:
            yield pa.RecordBatch.from_pylist([held | {"repaired_sha256": mended.done(), "turns": mended.turns}], schema=out_arrow)

    return stream.mapInArrow(hashed, out)


class _Fold:
    """The segments of one conversation, in order: sums, and for every state the best prefix so far."""

    def __init__(self, conv_id):
        self.conv_id, self.last = conv_id, None
        self.sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "distinct"), 0)
        self.low = self.high = None
        self.best: dict[int, tuple[int, str]] = {0: (0, "")}

    def add(self, part: dict) -> None:
        if not part["n"]:
            return
        for k in self.sums:
            self.sums[k] += part[k]
        if self.last is not None and self.last + part["first"] not in ("su", "ua", "au"):
            self.sums["illegal"] += 1
        self.last = part["last"]
        if part["low"] is not None:
            self.sums["distinct"] -= part["low"] == self.high  # a turn that goes on over the cut
            self.low, self.high = part["low"] if self.low is None else self.low, part["high"]
        best: dict[int, tuple[int, str]] = {}
        for step in part["steps"]:
            if step["entry"] in self.best:
                cost, audit = self.best[step["entry"]]
                way = (cost + step["cost"], audit + step["audit"])
                best[step["exit"]] = min(best.get(step["exit"], way), way)
        self.best = best

    def row(self, names: list[str]) -> dict:
        cost, audit = min(self.best[s] for s in _WHOLE if s in self.best)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.sums["distinct"]
        return dict.fromkeys(names) | {"conv_id": self.conv_id, "gaps": gaps, "cost": cost, "audit": audit} | {
            k: self.sums[k] for k in ("blank", "duplicate", "truncated", "illegal")
        }


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, present: rows spoilt by a hash of their id and turn, for trying the repair out.

    Of 20 rows one is dropped (not present), one emptied, one loses its `.`, `!` and `?`, one is repeated, one's role
    becomes user.
    """
    part = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        (F.crc32(F.concat_ws(":", *part).cast("binary")) % 20).alias("kind"),
    )
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        (F.col("kind") != 0).alias("present"), F.explode(times).alias("time"),
    ).drop("time")
