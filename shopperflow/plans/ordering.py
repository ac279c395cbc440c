"""Positions, order statistics and running sums over a whole table without a one-task window.

`row_number() over (order by x)` moves every row into one task. Here the rows are range-partitioned
and sorted on the full ordering instead, so each task holds one contiguous stretch of the global
order, and what tasks must know of each other is one summary row per partition. Put a unique column
last in the ordering: then a value shared by a third of all rows is still split over many tasks.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .durable import settle

_SEAT = "__seat"
_PARTITION = "__partition"
# monotonically_increasing_id keeps the partition number above this bit and the row within it below.
_ROW_BITS = 33


class Ordered:
    """A table laid out in one global order, with the number of rows in each stretch known."""

    def __init__(self, df: DataFrame, *order: str | Column):
        seated = (
            df.repartitionByRange(*order)
            .sortWithinPartitions(*order)
            .withColumn(_SEAT, F.monotonically_increasing_id())
        )
        # The range boundaries come from a sample, so a second evaluation could cut elsewhere:
        # the seats must be written down before anything is counted.
        self._rows = settle(seated).withColumn(_PARTITION, F.shiftright(_SEAT, _ROW_BITS).cast("int"))
        self._spark = df.sparkSession
        found = self._rows.groupBy(_PARTITION).count().collect()
        self._partitions = sorted((row[_PARTITION], row["count"]) for row in found)
        self._starts = []
        total = 0
        for _, size in self._partitions:
            self._starts.append(total)
            total += size
        self.total = total

    def _seat_at(self, position: int) -> int:
        stretch = bisect_right(self._starts, position) - 1
        partition = self._partitions[stretch][0]
        return (partition << _ROW_BITS) + position - self._starts[stretch]

    def rows_at(self, positions: Iterable[int]) -> dict[int, Row]:
        """The rows at a few 0-based positions."""
        wanted = {self._seat_at(position): position for position in positions}
        found = self._rows.filter(F.col(_SEAT).isin(list(wanted))).collect()
        return {wanted[row[_SEAT]]: row for row in found}

    @property
    def rows(self) -> DataFrame:
        """All rows, still distributed, with the layout's own columns."""
        return self._rows

    def numbered(self, name: str, rows: DataFrame | None = None) -> DataFrame:
        """Adds the 1-based position; `rows` may be a subset obtained from this object."""
        starts = self._spark.createDataFrame(
            [(partition, start) for (partition, _), start in zip(self._partitions, self._starts)],
            f"{_PARTITION} int, __start bigint",
        )
        within = F.col(_SEAT) - F.shiftleft(F.col(_PARTITION).cast("bigint"), _ROW_BITS)
        return (
            (self._rows if rows is None else rows)
            .join(F.broadcast(starts), _PARTITION)  # one row per partition of this table
            .withColumn(name, F.col("__start") + within + 1)
            .drop("__start")
        )

    def running_sums(self, rows: DataFrame, key: str, sums: Mapping[str, str], descending: bool = False) -> DataFrame:
        """Adds running sums over the order of `key`; rows with equal keys share the value.

        `key` must lead the ordering this object was made with. `sums` maps new names to columns.
        `rows` is what gets the new columns: all rows, or a subset that keeps a leading stretch of keys whole.
        """
        measures = list(sums.values())
        summaries = self._rows.groupBy(_PARTITION).agg(
            F.min_by(key, _SEAT).alias("head"),
            F.max_by(key, _SEAT).alias("tail"),
            *[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures],
        )
        stretches = sorted(summaries.collect(), key=lambda row: row[_PARTITION])  # one row per partition
        notes = self._edge_notes(stretches, key, measures)
        sum_type = {m: summaries.schema[m].dataType for m in measures}
        layout = T.StructType(
            [T.StructField(_PARTITION, T.IntegerType()), T.StructField("__last", rows.schema[key].dataType)]
            + [T.StructField(f"__before_{m}", sum_type[m]) for m in measures]
            + [T.StructField(f"__peers_{m}", sum_type[m]) for m in measures]
        )
        ordering = F.col(key).desc() if descending else F.col(key).asc()
        window = Window.partitionBy(_PARTITION).orderBy(ordering)
        # One stretch per task; hashing the partition numbers would put several into some.
        local = rows.repartitionById(self._partitions[-1][0] + 1, F.col(_PARTITION)) if stretches else rows
        for measure in measures:
            local = local.withColumn(f"__local_{measure}", F.coalesce(F.sum(measure).over(window), F.lit(0)))
        edges = self._spark.createDataFrame(notes, layout)  # again one row per partition
        joined = local.join(F.broadcast(edges), _PARTITION)
        for name, m in sums.items():
            following = F.when(F.col(key).eqNullSafe(F.col("__last")), F.col(f"__peers_{m}")).otherwise(F.lit(0))
            joined = joined.withColumn(name, F.col(f"__before_{m}") + F.col(f"__local_{m}") + following)
        spare = [f"__{kind}_{m}" for kind in ("local", "before", "peers") for m in measures]
        return joined.drop("__last", *spare)

    def _edge_notes(self, stretches: Sequence[Row], key: str, measures: Sequence[str]) -> list[tuple]:
        """Per partition: its last key, the sums ahead of it, and what peers of that key follow it."""
        if not stretches:
            return []
        nothing = {m: stretches[0][m] * 0 for m in measures}  # zero of the column's own type
        # Keys that go on in the next partition, and what each partition holds of them.
        shared = {here["tail"] for here, after in zip(stretches, stretches[1:]) if here["tail"] == after["head"]}
        held = {}
        if shared:
            wanted = F.col(key).isin([value for value in shared if value is not None])
            if None in shared:
                wanted = F.col(key).isNull() | wanted
            parts = self._rows.filter(wanted).groupBy(_PARTITION, F.col(key).alias("__key"))
            found = parts.agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures]).collect()
            held = {(row[_PARTITION], row["__key"]): row for row in found}
        peers = [nothing]
        for here, after in reversed(list(zip(stretches, stretches[1:]))):
            following = nothing
            if here["tail"] == after["head"]:
                part = held[after[_PARTITION], after["head"]]
                beyond = peers[-1] if after["head"] == after["tail"] else nothing
                following = {m: part[m] + beyond[m] for m in measures}
            peers.append(following)
        peers.reverse()
        before, notes = nothing, []
        for stretch, after in zip(stretches, peers):
            sums = [before[m] for m in measures] + [after[m] for m in measures]
            notes.append((stretch[_PARTITION], stretch["tail"], *sums))
            before = {m: before[m] + stretch[m] for m in measures}
        return notes

    @staticmethod
    def plain(df: DataFrame) -> DataFrame:
        """Drops the layout's own columns."""
        return df.drop(_SEAT, _PARTITION)


Cut = tuple  # (key, tie)


#: Rows of a sample, splitters tried around each wanted position, and rows of a stretch that are simply fetched.
SAMPLE = 2000
SPLITTERS = 16
FEW = 2000


class _Search:
    """One position of one key's order, and the stretch of rows it is known to lie in: from `low` to before `high`."""

    def __init__(self, key: str, position: int, n: int):
        self.key, self.position = key, position
        self.low: Cut | None = None
        self.high: Cut | None = None
        self.before, self.size = 0, n  # rows below the stretch, and in it
        self.tried: list[Cut] = []
        self.found: Cut | None = None

    def holds(self, tie: str) -> Column:
        key, other = F.col(self.key), F.col(tie)
        inside = F.lit(True)
        if self.low is not None:
            inside = inside & _reached(key, other, self.low)
        return inside if self.high is None else inside & ~_reached(key, other, self.high)

    def splitters(self, sample: list[Cut]) -> list[Cut]:
        """Sampled rows around where the position should be: evenly over six standard errors, and the nearest."""
        if not sample:
            return []
        share = (self.position - self.before) / self.size
        middle, error = share * len(sample), 3 * (len(sample) ** 0.5) / 2 + 2
        places = {round(middle + error * (2 * i / (SPLITTERS - 1) - 1)) for i in range(SPLITTERS)} | {int(middle)}
        return [sample[i] for i in sorted(places) if 0 <= i < len(sample)]

    def narrow(self, splitters: list[Cut], below: list[int]) -> None:
        """`below`: rows of the whole table that come before each splitter."""
        end = self.before + self.size
        for cut, rows in zip(splitters, below):
            if rows <= self.position:
                self.low, self.before = cut, rows
            else:
                self.high, end = cut, rows
                break
        self.size = end - self.before


def _rank(value) -> tuple:
    """Spark's ascending order on the driver: NULL, numbers or texts, NaN."""
    return (0,) if value is None else (2,) if value != value else (1, value)


def cut_points(
    df: DataFrame, keys: Sequence[str], tie: str, positions: Callable[[int], Sequence[int]]
) -> tuple[int, dict[str, dict[int, Cut]]]:
    """Exact (key, tie) values at chosen positions of each key's ascending order; `tie` must be unique.

    No row is shuffled. In each round a bounded sample brackets every position, one aggregate counts the rows below
    the splitters, and the search goes on in the stretch that holds the position, which a round makes some two
    hundred times smaller; a stretch of a few rows is fetched. A value shared by a third of all rows is split by `tie`.
    `df` is read in every round: settle it. Returns the row count and, per key, position -> values.
    """
    n = df.count()
    chosen = [p for p in positions(n) if 0 <= p < n]
    searches = [_Search(key, p, n) for key in keys for p in sorted(set(chosen))]
    round_ = 0
    while open_ := [s for s in searches if s.found is None]:
        fetched = {id(s): s.size <= FEW for s in open_}
        rows = _picked(df, open_, fetched, tie, round_)
        for search in open_:
            mine = sorted({(_rank(k), _rank(t), k, t) for i, k, t in rows if open_[i] is search}, key=lambda r: r[:2])
            if fetched[id(search)]:
                search.found = mine[search.position - search.before][2:]
            else:
                search.tried = search.splitters([r[2:] for r in mine])
        _count(df, [s for s in open_ if s.found is None], tie)
        round_ += 1
    return n, {key: {s.position: s.found for s in searches if s.key == key} for key in keys}


def _picked(df: DataFrame, searches: list[_Search], whole: dict[int, bool], tie: str, round_: int) -> list[tuple]:
    """(number of the search, key, tie): all rows of short stretches, about SAMPLE rows of the others."""
    parts = []
    for i, search in enumerate(searches):
        taken = search.holds(tie)
        if not whole[id(search)]:
            taken = taken & (F.pmod(F.xxhash64(F.lit(round_), F.col(tie)), F.lit(search.size // SAMPLE + 1)) == 0)
        kind = F.struct(F.lit(i).alias("i"), F.col(search.key).alias("k"), F.col(tie).alias("t"))
        parts.append((search.key, F.when(taken, kind)))
    out = []
    for key in dict.fromkeys(k for k, _ in parts):  # keys may have unlike types
        found = df.select(F.explode(F.array_compact(F.array(*[c for k, c in parts if k == key]))).alias("r")).select("r.*")
        out += [tuple(row) for row in found.collect()]  # at most about SAMPLE or FEW rows a position
    return out


def _count(df: DataFrame, searches: list[_Search], tie: str) -> None:
    tries = [(s, cut) for s in searches for cut in s.tried]
    if not tries:
        return
    below = df.agg(*[F.count_if(~_reached(F.col(s.key), F.col(tie), cut)).alias(str(i)) for i, (s, cut) in enumerate(tries)]).first()
    for search in searches:
        search.narrow(search.tried, [below[i] for i, (s, _) in enumerate(tries) if s is search])


def ntile_starts(n: int, tiles: int) -> list[int]:
    """0-based first position of tiles 2..k: the first n mod k tiles hold one row more."""
    base, extra = divmod(n, tiles)
    return [tile * base + min(tile, extra) for tile in range(1, tiles) if tile * base + min(tile, extra) < n]


def _after(column: Column, value) -> Column:
    """Whether the column comes after `value` in ascending order, where NULL comes first."""
    return column.isNotNull() if value is None else F.coalesce(column > F.lit(value), F.lit(False))


def _same(column: Column, value) -> Column:
    return column.isNull() if value is None else column.eqNullSafe(F.lit(value))


def _reached(key: Column, tie: Column, cut: Cut) -> Column:
    """Whether a row is at or after the cut."""
    first_key, first_tie = cut
    return _after(key, first_key) | (_same(key, first_key) & (_after(tie, first_tie) | _same(tie, first_tie)))


def ntile_of(key: Column, tie: Column, starts: Iterable[Cut]) -> Column:
    """Tile number of a row, given the (key, tie) that opens each later tile; NULL comes first."""
    tile = F.lit(1)
    for cut in starts:
        tile = tile + F.when(_reached(key, tie, cut), 1).otherwise(0)
    return tile


def quantile_positions(n: int, bins: int) -> list[int]:
    """0-based positions at or just below the bin edges of n sorted values, both ends included."""
    return [(n - 1) * k // bins for k in range(bins + 1)]
