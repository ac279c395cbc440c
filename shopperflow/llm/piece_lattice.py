"""SentencePiece encoding and decoding with the N best segmentations.

The vocabulary is read from a public model file; nothing is trained. Each text is a lattice of pieces
whose score is the sum of the pieces' scores in the file (whole numbers here, so sums are exact). A
forward Viterbi pass gives the best score from the start to each place. The N best paths are then found
backwards by A*: what a path has gathered from the end, plus the forward score of where it stands, is
exactly the best it can become, so finished paths leave the queue best first.

No piece runs from a character on into a space or over a line feed, so the lattice falls apart into units
(spaces and the characters after them; a line feed). The forward pass runs over all new units of a chunk
at once and also tells how much the second best path of a unit loses. In the N best of a text only the
N - 1 units that lose least can differ from their best; A* lists the N best of these, and then runs over
their chain.

Characters without a piece cost `_UNKNOWN` less than the rarest piece and become their UTF-8 bytes. A
space is put before the text, as the model does; decoding takes it off again and gives back any text.

Ties: of segmentations with equal scores, the one whose queue entry stands nearer the start of the
text first, then the one entered first; the same on every run.

Defined results: null and empty texts have no pieces, score 0 and one segmentation (decoding to the
empty text); very long texts are taken whole; repeated rows are treated alike; empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrays import Substrings, annotated, mix, power

N_BEST = 4
SPACE = "▁"
_UNKNOWN = 10
_UNIT = re.compile("\n| *[^ \n]+| +")
#: Distinct units a worker remembers; longer units than _LONG are searched one by one.
_KEPT = 200_000
_LONG = 64
_NONE = 1 << 30
_U = np.uint64


class _Numbers(dict):
    """Numbers units as they are met; `new` are those numbered since it was emptied."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        self[unit] = number = len(self)
        self.new.append(unit)
        return number


def _laid_out(texts: list[str], joined: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts, start and size of each."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    return np.frombuffer(joined.encode("utf-32-le"), np.uint32), np.cumsum(sizes) - sizes, sizes


class _Sums(Substrings):
    """Hashes of runs of code points."""

    def __init__(self, points: np.ndarray):
        self.which = 0
        self._sums = np.zeros(len(points) + 1, _U)
        np.cumsum(mix(points.astype(_U) + _U(1)) * power(0, False, len(points)), out=self._sums[1:])


class Pieces:
    """A vocabulary, and what a task has found out about units so far."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        names = [model.id_to_piece(i) for i in range(model.vocab_size())]
        byte = {i: int(names[i][1:-1], 16) for i in range(len(names)) if model.is_byte(i)}
        self.bytes = {b: i for i, b in byte.items()}
        special = {i for i in range(len(names)) if model.is_control(i) or model.is_unknown(i)} | set(byte)
        self.ids = {name: (i, round(model.get_score(i))) for i, name in enumerate(names) if i not in special}
        if any(SPACE in name.lstrip(SPACE) or "\n" in name for name in self.ids):
            raise ValueError("pieces that run on into a space or over a line are not supported")
        self.unknown = min(score for _, score in self.ids.values() if score > -1_000_000) - _UNKNOWN
        self.surfaces = [bytes([byte[i]]) if i in byte else name.replace(SPACE, " ").encode() for i, name in enumerate(names)]
        # Which lengths a piece can have that ends with a given character, as bits.
        self.ends = np.zeros(0x110000, np.uint32)
        for name in self.ids:
            self.ends[ord(name[-1])] |= 1 << len(name)
        self.longest = max(map(len, self.ids))
        # Characters that have a piece or are one byte; a literal U+2581 is no space and is none of them.
        self._alone = np.zeros(0x110000, bool)
        self._alone[:128] = True
        self._alone[[ord(name) for name in self.ids if len(name) == 1 and name != SPACE]] = True
        self._ascii = np.array([self.bytes[b] for b in range(256)])
        self._index_pieces()
        self._forget()
        self._lists: dict[str, list[tuple[int, tuple[int, ...]]]] = {}

    # --- all new units of a chunk at once: the best path and how much the second best loses

    def _index_pieces(self) -> None:
        """Two tables from hash to piece: the first takes what it can, the second the rest."""
        found = list(self.ids.items())
        points, starts, sizes = _laid_out([name for name, _ in found], "".join(name for name, _ in found))
        self._keys = _Sums(points).at(starts, starts + sizes)
        self._piece = np.array([i for _, (i, _) in found], np.int64)
        self._score = np.array([score for _, (_, score) in found], np.int64)
        self._first, self._second = np.full(1 << 20, -1, np.int32), np.full(1 << 20, -1, np.int32)
        for n, key in enumerate(self._keys.tolist()):
            for table, at in ((self._first, key >> 44), (self._second, key & 0xFFFFF)):
                if table[at] < 0:
                    table[at] = n
                    break
            else:
                raise ValueError("two pieces share both places")

    def _looked_up(self, keys: np.ndarray) -> np.ndarray:
        found = self._first[keys >> _U(44)]
        other = self._second[keys & _U(0xFFFFF)]
        return np.where((found >= 0) & (self._keys[found] == keys), found, np.where((other >= 0) & (self._keys[other] == keys), other, -1))

    def _forget(self) -> None:
        self._at = _Numbers()
        empty = np.empty(0, np.int64)
        self._best, self._loss, self._sizes, self._offsets, self._ids = empty, empty, empty, empty, np.empty(0, np.int32)

    def _learn(self) -> None:
        """Solves the units numbered since the last call."""
        units, self._at.new = self._at.new, []
        if not units:
            return
        joined = "".join(units)
        points, starts, sizes = _laid_out(units, joined)
        slow = sizes > _LONG
        if not joined.isascii():
            wide = np.flatnonzero(~self._alone[points])
            slow[np.searchsorted(starts, wide, "right") - 1] = True
        quick = np.flatnonzero(~slow)
        best, loss, count, offset = (np.zeros(len(units), np.int64) for _ in range(4))
        ids = [self._ids]
        if len(quick):
            kept = [units[i] for i in quick] if slow.any() else units
            found = self._solve(kept)
            best[quick], loss[quick], count[quick] = found[:3]
            offset[quick] = len(self._ids) + np.cumsum(found[2]) - found[2]
            ids.append(found[3])
        held = sum(map(len, ids))
        for i in np.flatnonzero(slow).tolist():
            found = self.unit(units[i], 2)
            best[i], loss[i] = found[0][0], found[0][0] - found[1][0] if len(found) > 1 else _NONE
            count[i], offset[i] = len(found[0][1]), held
            ids.append(np.array(found[0][1], np.int32))
            held += len(ids[-1])
        self._best, self._loss = np.concatenate([self._best, best]), np.concatenate([self._loss, loss])
        self._sizes, self._offsets = np.concatenate([self._sizes, count]), np.concatenate([self._offsets, offset])
        self._ids = np.concatenate(ids, dtype=np.int32)

    def _solve(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Best score, loss of the second best, number of ids, and the ids in a row, of short plain units."""
        points, starts, sizes = _laid_out(units, "".join(units).replace(" ", SPACE))
        sums, total = _Sums(points), len(points)
        place = np.arange(total) - np.repeat(starts, sizes) + 1  # 1: the first character of its unit
        node = np.arange(total) + np.repeat(np.arange(len(units)), sizes) + 1  # a node before each unit and after each character
        can, groups, single = self.ends[points], {}, np.zeros(total, bool)
        for length in range(1, self.longest + 1):
            stop = np.flatnonzero((can >> np.uint32(length) & np.uint32(1) > 0) & (place >= length))
            if not len(stop):
                continue
            piece = self._looked_up(sums.at(stop + 1 - length, stop + 1))
            stop, piece = stop[piece >= 0], piece[piece >= 0]
            if length == 1:
                single[stop] = True
                alone = np.flatnonzero(~single)  # characters without a piece, all of one byte
                stop, score = np.concatenate([stop, alone]), np.concatenate([self._score[piece], np.full(len(alone), self.unknown)])
                ids = np.concatenate([self._piece[piece], self._ascii[np.minimum(points[alone], 255)]])
            else:
                score, ids = self._score[piece], self._piece[piece]
            order = np.argsort(place[stop], kind="stable")
            stop, score, ids = stop[order], score[order], ids[order]
            where, first = np.unique(place[stop], return_index=True)
            for p, lo, hi in zip(where.tolist(), first, [*first[1:], len(stop)]):
                groups[p, length] = node[stop[lo:hi]], score[lo:hi], ids[lo:hi]
        best, second = np.zeros(total + len(units), np.int64), np.full(total + len(units), -_NONE, np.int64)
        best[node] = -_NONE
        back, taken = np.zeros(len(best), np.int32), np.zeros(len(best), np.int32)
        for (_, length), (to, score, ids) in sorted(groups.items(), key=lambda g: g[0]):
            one, two = best[to - length] + score, second[to - length] + score
            old = best[to]
            second[to] = np.maximum(np.minimum(old, one), np.maximum(second[to], two))
            won = one >= old  # of equal ones the longer piece
            best[to[won]], back[to[won]], taken[to[won]] = one[won], length, ids[won]
        ends = starts + np.arange(len(units)) + sizes
        # Backwards along the best paths of all units at once.
        at, alive, steps = ends.copy(), np.arange(len(units)), []
        begin = starts + np.arange(len(units))
        while len(alive):
            steps.append((alive, taken[at]))
            at = at - back[at]
            going = at > begin[alive]
            alive, at = alive[going], at[going]
        who, ids = np.concatenate([a for a, _ in steps]), np.concatenate([i for _, i in steps])
        turn = np.repeat(-np.arange(len(steps)), [len(a) for a, _ in steps])
        order = np.lexsort((turn, who))
        loss = np.minimum(best[ends] - second[ends], _NONE)
        return best[ends], loss, np.bincount(who, minlength=len(units)), ids[order]

    # --- one unit

    def unit(self, raw: str, n: int) -> list[tuple[int, tuple[int, ...]]]:
        """Scores and ids of the N best segmentations of spaces and the characters after them, by A*."""
        # A literal U+2581 is no space: it matches no piece and becomes bytes.
        form = raw.replace(SPACE, "\0").replace(" ", SPACE)
        get, size = self.ids.get, len(form)
        into: list[list[tuple[int, int, tuple[int, ...]]]] = [[]]  # per end: start, score, ids
        best = [0]
        for stop in range(1, size + 1):
            steps = []
            for start in range(max(0, stop - self.longest), stop):
                found = get(form[start:stop])
                if found:
                    steps.append((start, found[1], (found[0],)))
            if not steps or steps[-1][0] != stop - 1:  # the character itself has no piece
                steps.append((stop - 1, self.unknown, tuple(self.bytes[b] for b in raw[stop - 1].encode())))
            into.append(steps)
            best.append(max(best[start] + score for start, score, _ in steps))
        out: list[tuple[int, tuple[int, ...]]] = []
        queue = [(-best[size], size, 0, 0, None)]
        entered = 0
        while queue and len(out) < n:
            below, at, _, gathered, path = heapq.heappop(queue)
            if not at:
                ids = []
                while path:
                    ids.append(path[0])
                    path = path[1]
                out.append((-below, tuple(chain.from_iterable(ids))))
                continue
            for start, score, ids in into[at]:
                entered += 1
                heapq.heappush(queue, (-(gathered + score + best[start]), start, entered, gathered + score, (ids, path)))
        return out

    def _listed(self, raw: str, n: int) -> list[tuple[int, tuple[int, ...]]]:
        held = self._lists.get(raw)
        if held is None or len(held) < n:
            if len(self._lists) >= _KEPT // 8:
                self._lists.clear()
            held = self._lists[raw] = self.unit(raw, n)
        return held[:n]

    # --- texts

    def best(self, texts: list[str | None], n: int = N_BEST) -> list[tuple[np.ndarray, list[int], list[list[tuple[int, tuple[int, ...]]]]]]:
        """Of each text: ids of the best segmentation, scores of the N best, for each of these the units
        (by number) that differ from the best and their ids."""
        split = [_UNIT.findall(" " + t) if t else [] for t in texts]
        if len(self._at) >= _KEPT:
            self._forget()
        number = self._at.__getitem__
        at = [np.fromiter(map(number, units), np.int64, len(units)) for units in split]
        self._learn()
        out = []
        for units, own in zip(split, at):
            count = self._sizes[own]
            stops = np.cumsum(count)
            total = int(stops[-1]) if len(own) else 0
            chosen = self._ids[np.repeat(self._offsets[own] - (stops - count), count) + np.arange(total)]
            out.append((chosen, *self._chain(units, int(self._best[own].sum()), self._loss[own], n)))
        return out

    def _chain(self, units: list[str], total: int, losses: np.ndarray, n: int) -> tuple[list[int], list]:
        """The same search over the chain of units: only the N - 1 that lose least can differ in the N best."""
        keys = losses * (1 << 31) + np.arange(len(units))
        if len(keys) > n - 1:
            keys = np.partition(keys, n - 2)[: n - 1] if n > 1 else keys[:0]
        open_units = sorted(int(k) % (1 << 31) for k in keys if k < _NONE * (1 << 31))
        lists = [self._listed(units[i], n) for i in open_units]
        ahead = [0]
        for held in lists:
            ahead.append(ahead[-1] + held[0][0])
        rest = total - ahead[-1]
        scores, choices = [], []
        queue = [(-ahead[-1], len(lists), 0, 0, None)]
        entered = 0
        while queue and len(scores) < n:
            below, at, _, gathered, path = heapq.heappop(queue)
            if not at:
                changed, number = [], 0
                while path:
                    if path[0]:
                        changed.append((open_units[number], lists[number][path[0]][1]))
                    path, number = path[1], number + 1
                scores.append(rest - below)
                choices.append(changed)
                continue
            for choice, (score, _) in enumerate(lists[at - 1]):
                entered += 1
                heapq.heappush(queue, (-(gathered + score + ahead[at - 1]), at - 1, entered, gathered + score, (choice, path)))
        return scores, choices

    def n_best(self, text: str | None, n: int = N_BEST) -> list[tuple[int, list[int]]]:
        """(score, ids) of the N best segmentations, best first."""
        units = _UNIT.findall(" " + text) if text else []
        _, scores, choices = self.best([text], n)[0]
        out = []
        for score, changed in zip(scores, choices):
            other = dict(changed)
            out.append((score, list(chain.from_iterable(other.get(i) or self.unit(u, 1)[0][1] for i, u in enumerate(units)))))
        return out

    def decode(self, ids) -> str:
        """The text that was encoded: the pieces joined, without the space put before it."""
        whole = b"".join(map(self.surfaces.__getitem__, ids))
        return whole[1:].decode("utf-8", "replace") if whole else ""


@lru_cache(maxsize=4)
def pieces(model_file: str) -> Pieces:
    return Pieces(model_file)


def _made(model_file: str, n: int, with_ids: bool):
    def make(part: pa.RecordBatch) -> dict:
        model = pieces(model_file)
        out: dict[str, list] = {k: [] for k in ("n_pieces", "best_score", "scores", "n_best", "ids_sha256", "alternatives_sha256", "decoded_sha256")}
        all_ids = []
        for ids, scores, choices in model.best(part.column("__text").to_pylist(), n):
            out["n_pieces"].append(len(ids))
            out["best_score"].append(scores[0])
            out["scores"].append(scores)
            out["n_best"].append(len(scores))
            out["ids_sha256"].append(hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest())
            said = ";".join(",".join(f"{i}:{other}" for i, other in changed) for changed in choices)
            out["alternatives_sha256"].append(hashlib.sha256(said.encode()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(model.decode(ids.tolist()).encode()).hexdigest())
            all_ids.append(ids)
        if with_ids:
            sizes = np.concatenate([[0], np.cumsum([len(x) for x in all_ids])]).astype(np.int32)
            out["ids"] = pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate(all_ids)))
        return out

    return make


SCHEMA = "n_pieces long, best_score long, scores array<long>, n_best int, ids_sha256 string, alternatives_sha256 string, decoded_sha256 string"


def encoded(documents: DataFrame, model_file: str, text: str = "text", n: int = N_BEST, with_ids: bool = True, passed: list[str] | None = None) -> DataFrame:
    """Adds ids (if wanted) of the best segmentation, the scores of the N best, and digests.

    `alternatives_sha256` stands for where and how the N best differ from the best; `decoded_sha256` is of
    the text decoded from the ids. The model file must be at that path on every machine.
    """
    schema = SCHEMA + (", ids array<int>" if with_ids else "")
    return annotated(documents, text, _made(model_file, n, with_ids), schema, passed)


def decoded(rows: DataFrame, model_file: str, ids: str = "ids") -> DataFrame:
    """Adds decoded, the text of an array of ids; null ids give an empty text."""
    from pyspark.sql import functions as F

    return rows.withColumn("decoded", F.pandas_udf(lambda s: s.map(lambda x: "" if x is None else pieces(model_file).decode(x)), "string")(ids))
