"""Landed tables: Parquet in versions, named by a manifest that is written last.

    <folder>/<table>/version=<v>/month_start=<m>/part-*.parquet   dated tables, a folder per month
    <folder>/<table>/version=<v>/part-*.parquet                   other tables
    <folder>/<table>/_ids/version=<v>/                            which ids each month may hold
    <folder>/<table>/_manifests/<number>.json                     what a reader goes by: the highest number

A manifest says in which version each month is, and the schema. So a reader never sees a table half written, an empty
table has its columns, a failed landing changes nothing, and a change of a few months rewrites only these. One writer
at a time: a second one that publishes the same number is refused.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import json
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.copies import one_per_key
from ..plans.durable import names_in, publish_text, read_text, remove_folder, settle

Day = dt.date | str | None

#: table -> date column it is laid out by, and id
DATED = {"transactions": ("order_date", "transaction_id"), "sessions": ("session_date", "session_id")}
KEYS = {"customers": "customer_id", "transactions": "transaction_id", "sessions": "session_id"}
UNDATED, WHOLE = "none", "all"
_MONTH, _VERSION = "month_start", "version"
#: Bits for each id of a month's filter: about one in sixteen months is looked through in vain for an id.
BITS_PER_ID = 16
_BITMAP_BITS = 32768  # of one row of a filter, fixed by Spark's bitmap functions


@dataclasses.dataclass(frozen=True)
class Manifest:
    """What a landed table is made of."""

    number: int
    #: Of the rows; date columns that are stored as moments are dates here.
    schema: dict
    #: month (or WHOLE) -> version that holds its rows
    parts: dict[str, str]
    #: Rows of each month.
    rows: dict[str, int]
    #: When the file it was landed from was last changed (milliseconds); None if there was none.
    source_modified: int | None = None
    #: Whether each id occurs once.
    unique: bool = False
    #: What was found while landing: rows, null_count and bad_cells by column, an example of each bad cell.
    quality: dict = dataclasses.field(default_factory=dict)

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(self.schema)


def _home(folder: str, table: str) -> str:
    return f"{folder.rstrip('/')}/{table}"


def manifest(spark: SparkSession, folder: str, table: str) -> Manifest | None:
    """The newest manifest; None if the table has never been landed."""
    home = f"{_home(folder, table)}/_manifests"
    names = [n for n in names_in(spark, home) if n.endswith(".json")]
    return Manifest(**json.loads(read_text(spark, f"{home}/{names[-1]}"))) if names else None


def _publish(spark: SparkSession, folder: str, table: str, made: Manifest) -> Manifest:
    text = json.dumps(dataclasses.asdict(made), sort_keys=True)
    publish_text(spark, f"{_home(folder, table)}/_manifests/{made.number:010d}.json", text)
    return made


def _month(day: str) -> Column:
    return F.trunc(F.col(day).cast("date"), "MM")


def _write(df: DataFrame, folder: str, table: str, version: str) -> None:
    """A new version; nobody reads it before a manifest names it.

    Rows go to a task per month, and Spark cuts months that are large and joins small ones (REBALANCE), without
    reading the input for a sample first.
    """
    path = f"{_home(folder, table)}/{_VERSION}={version}"
    if table in DATED:
        df.write.mode("error").partitionBy(_MONTH).parquet(path)
    else:
        df.write.mode("error").parquet(path)


def _dealt(df: DataFrame, table: str) -> DataFrame:
    return df.withColumn(_MONTH, _month(DATED[table][0])).hint("rebalance", _MONTH) if table in DATED else df


def _parts_of(df: DataFrame, table: str) -> dict[str, int]:
    """Rows by month of a version that has been written: Parquet's own counts, no column is read."""
    if table not in DATED:
        n = df.count()
        return {WHOLE: n} if n else {}
    found = df.groupBy(_MONTH).count().collect()  # one row a month
    return {UNDATED if r[_MONTH] is None else str(r[_MONTH]): r["count"] for r in found}


def _stored(spark: SparkSession, folder: str, table: str, schema: T.StructType, parts: dict[str, str]) -> DataFrame:
    """The rows of some months as they are stored, with their month."""
    home = _home(folder, table)
    fields = T.StructType([*schema.fields, *([T.StructField(_MONTH, T.DateType())] if table in DATED else []), T.StructField(_VERSION, T.StringType())])
    if not parts:
        return spark.createDataFrame([], fields).drop(_VERSION)
    names = {UNDATED: "__HIVE_DEFAULT_PARTITION__"}
    paths = [f"{home}/{_VERSION}={v}" + (f"/{_MONTH}={names.get(m, m)}" if table in DATED else "") for m, v in sorted(parts.items())]
    return spark.read.schema(fields).option("basePath", home).parquet(*paths).drop(_VERSION)


def _file_schema(made: Manifest) -> T.StructType:
    """As in the files: dates of tables that came from text are stored as moments."""
    return T.StructType([T.StructField(f.name, T.TimestampNTZType() if f.name in made.quality.get("stored_as_moments", ()) else f.dataType) for f in made.struct])


def within(df: DataFrame, column: str, start: Day = None, end: Day = None) -> DataFrame:
    """Rows from `start` to `end`, both included, either open.

    The conditions are plain comparisons, so a Parquet scan receives them.
    """
    if start is not None:
        df = df.filter(F.col(column) >= F.lit(start).cast(df.schema[column].dataType))
    if end is not None:
        df = df.filter(F.col(column) <= F.lit(end).cast(df.schema[column].dataType))
    return df


def landed(spark: SparkSession, folder: str, table: str, start: Day = None, end: Day = None) -> DataFrame:
    """A landed table; a date window reads only the month folders it touches."""
    made = manifest(spark, folder, table)
    if made is None:
        raise FileNotFoundError(f"{_home(folder, table)} has never been landed")
    return _as_declared(_windowed(spark, folder, table, made, start, end), made)


def _windowed(spark: SparkSession, folder: str, table: str, made: Manifest, start: Day, end: Day) -> DataFrame:
    parts = made.parts
    if table not in DATED:
        return _stored(spark, folder, table, _file_schema(made), parts)
    low, high = (None if x is None else str(x)[:10] for x in (start, end))
    if low is not None or high is not None:
        parts = {m: v for m, v in parts.items() if m != UNDATED and (low is None or m[:7] >= low[:7]) and (high is None or m <= high)}
    df = _stored(spark, folder, table, _file_schema(made), parts)
    if low is not None:
        df = df.filter(F.col(_MONTH) >= F.trunc(F.lit(start).cast("date"), "MM"))
    if high is not None:
        df = df.filter(F.col(_MONTH) <= F.lit(end).cast("date"))
    return within(df, DATED[table][0], start, end).drop(_MONTH)


def _as_declared(df: DataFrame, made: Manifest) -> DataFrame:
    kinds = dict(zip(df.columns, [f.dataType for f in df.schema]))
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if kinds[f.name] != f.dataType else F.col(f"`{f.name}`") for f in made.struct])


def land_table(df: DataFrame, folder: str, table: str, source_modified: int | None = None, unique: bool = False) -> Manifest:
    """Lands a table anew, a dated one in a folder per month; `unique` keeps one row of each id, as `upsert` needs."""
    spark, version = df.sparkSession, uuid.uuid4().hex
    before = manifest(spark, folder, table)
    schema = df.schema
    kept = one_per_key(df, [KEYS[table]]) if unique else df
    _write(_dealt(kept, table), folder, table, version)
    return _landed_as(spark, folder, table, version, schema, before, source_modified, unique, {})


def _landed_as(spark, folder, table, version, schema, before, source_modified, unique, quality, declared=None) -> Manifest:
    kind = T.StructType([*schema.fields, *([T.StructField(_MONTH, T.DateType())] if table in DATED else [])])
    written = spark.read.schema(kind).parquet(f"{_home(folder, table)}/{_VERSION}={version}")
    rows = _parts_of(written, table)
    if unique:
        _write_filters(written, folder, table, version, rows)
    number = 1 if before is None else before.number + 1
    struct = json.loads((declared or schema).json())
    return _publish(spark, folder, table, Manifest(number, struct, dict.fromkeys(rows, version), rows, source_modified, unique, quality))


# Landing text, with its counts, in one pass over the file.


def apart(spark: SparkSession) -> SparkSession:
    """A session like this one, for `land_text`: a session that has observed a query holds objects that Spark cannot
    send to tasks, and fitting a model in it would fail."""
    other = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key) and other.conf.get(key, None) != value:
            other.conf.set(key, value)
    return other


def land_text(
    text: DataFrame, kinds: dict[str, T.DataType], value, folder: str, table: str, source_modified: int | None = None, strict: bool = False
) -> Manifest:
    """Lands a table of text cells (read in a session of its own, see `apart`) as their declared types, and counts
    what it loses on the way.

    `kinds` are the declared types of the columns that are not text, `value(column, kind)` reads a cell. The file is read
    once: dates are stored as moments, and the manifest says whether any cell had a time of day. The counts are
    taken by the tasks that write, of which each counts once however often executors are lost. With `strict`, a table
    with cells that cannot be read is not published.
    """
    spark, version = text.sparkSession, uuid.uuid4().hex
    before = manifest(spark, folder, table)
    days = [c for c, kind in kinds.items() if isinstance(kind, T.DateType)]
    stored = {c: T.TimestampNTZType() if c in days else kind for c, kind in kinds.items()}

    def cell(c: str) -> Column:
        return F.trim(F.col(f"`{c}`"))

    values = [(value(c, stored[c]) if c in stored else F.col(f"`{c}`")).alias(c) for c in text.columns]
    lost = [F.when((cell(c) != "") & value(c, stored[c]).isNull(), F.col(f"`{c}`")).alias(f"__bad_{c}") for c in kinds]
    widths = [F.length(cell(c)).alias(f"__width_{c}") for c in days]
    schema = text.select(values).schema
    spare = [*[f"__bad_{c}" for c in kinds], *[f"__width_{c}" for c in days]]

    seen = Observation()
    counts = [F.count(F.lit(1)).alias("rows")]
    counts += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{c}") for c in text.columns]
    counts += [e for c in kinds for e in (F.count(f"`__bad_{c}`").alias(f"bad_{c}"), F.min(f"`__bad_{c}`").alias(f"example_{c}"))]
    counts += [F.max(f"`__width_{c}`").alias(f"width_{c}") for c in days]
    rows = text.select(*values, *lost, *widths)
    dealt = _dealt(rows, table) if table not in DATED or DATED[table][0] in text.columns else rows.withColumn(_MONTH, F.lit(None).cast("date"))
    _write(dealt.observe(seen, *counts).drop(*spare), folder, table, version)

    told = seen.get
    bad = {c: told[f"bad_{c}"] for c in kinds if told[f"bad_{c}"]}
    if strict and bad:
        remove_folder(spark, f"{_home(folder, table)}/{_VERSION}={version}")
        raise ValueError(f"{table}: unreadable cells in {bad}")
    quality = {
        "rows": told["rows"],
        "null_count": {c: told[f"null_{c}"] for c in text.columns},
        "bad_cells": {c: told[f"bad_{c}"] for c in kinds},
        "examples": {c: told[f"example_{c}"] for c in bad},
        "stored_as_moments": days,
    }
    timed = {c for c in days if (told[f"width_{c}"] or 0) > len("2000-01-01")}
    declared = T.StructType([T.StructField(f.name, kinds[f.name] if f.name in days and f.name not in timed else f.dataType) for f in schema])
    return _landed_as(spark, folder, table, version, schema, before, source_modified, False, quality, declared)


def quality_report(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """column, null_count, bad_cells (null for text), example: what was counted when the table was landed from text."""
    found = manifest(spark, folder, table).quality
    rows = [(c, n, found["bad_cells"].get(c), found["examples"].get(c)) for c, n in found["null_count"].items()]
    return spark.createDataFrame(rows, "column string, null_count long, bad_cells long, example string").orderBy("column")


# New deliveries into a landed table of unique ids.


def _hash(key: str) -> Column:
    return F.xxhash64(F.col(f"`{key}`"))


def _write_filters(written: DataFrame, folder: str, table: str, version: str, rows: dict[str, int]) -> None:
    """Per month a bit set of the ids' hashes, in rows of 4 KB; its width follows the month's number of ids."""
    month = F.coalesce(F.col(_MONTH).cast("string"), F.lit(UNDATED)) if table in DATED else F.lit(WHOLE)
    widths = [(m, max(_BITMAP_BITS, 1 << (BITS_PER_ID * n - 1).bit_length())) for m, n in rows.items()]
    sized = written.sparkSession.createDataFrame(widths, "month string, width long")
    place = F.pmod(_hash(KEYS[table]), F.col("width"))
    bits = written.select(month.alias("month"), F.col(KEYS[table])).join(F.broadcast(sized), "month").withColumn("place", place)
    bits = bits.groupBy("month", "width", F.floor(F.col("place") / _BITMAP_BITS).alias("bucket"))
    made = bits.agg(F.bitmap_construct_agg(F.col("place") % _BITMAP_BITS).alias("bits"))
    made.write.mode("error").parquet(f"{_home(folder, table)}/_ids/{_VERSION}={version}")


def _filters(spark: SparkSession, folder: str, table: str, made: Manifest) -> DataFrame:
    paths = [f"{_home(folder, table)}/_ids/{_VERSION}={v}" for v in sorted(set(made.parts.values()))]
    held = spark.read.schema(f"month string, width long, bucket long, bits binary, {_VERSION} string").option("basePath", f"{_home(folder, table)}/_ids")
    current = spark.createDataFrame([(m, v) for m, v in made.parts.items()], f"month string, {_VERSION} string")
    # A version also holds months that newer versions have replaced.
    if not paths:
        return spark.createDataFrame([], "month string, width long, bucket long, bits binary")
    return held.parquet(*paths).join(F.broadcast(current), ["month", _VERSION], "left_semi").drop(_VERSION)


def may_hold(ids: DataFrame, key: str, filters: DataFrame) -> DataFrame:
    """key, month: every month whose filter has the id; none that holds it is missing."""
    widths = [F.lit(r["width"]) for r in filters.select("width").distinct().collect()]  # powers of two, a few dozen at most
    asked = ids.select(key).distinct().withColumn("width", F.explode(F.array(*widths).cast("array<long>"))).withColumn("place", F.pmod(_hash(key), F.col("width")))
    asked = asked.withColumn("bucket", F.floor(F.col("place") / _BITMAP_BITS)).withColumn("bit", (F.col("place") % _BITMAP_BITS).cast("int"))
    byte = F.conv(F.hex(F.expr("substring(bits, bit div 8 + 1, 1)")), 16, 10).cast("int")
    held = F.expr("shiftright(byte, bit % 8) & 1") == 1
    return asked.join(filters, ["width", "bucket"]).withColumn("byte", byte).where(held).select(key, "month")


@dataclasses.dataclass(frozen=True)
class Change:
    """What a delivery changed: ids that are new, ids whose row it replaced, ids it left, months that were rewritten."""

    new: int
    replaced: int
    left: int
    months: list[str]


def upsert(delivery: DataFrame, folder: str, table: str) -> Change:
    """Adds a delivery to a landed table of unique ids: the same table as landing all deliveries at once.

    Of several rows of an id the one that `one_per_key` prefers stays. Ids are compared only with the ids of months
    whose filter may hold them, and only months that lose or gain a row are written anew.
    """
    spark, key = delivery.sparkSession, KEYS[table]
    before = manifest(spark, folder, table)
    if before is None:
        made = land_table(delivery, folder, table, unique=True)
        return Change(sum(made.rows.values()), 0, 0, sorted(made.parts))
    if not before.unique:
        raise ValueError(f"{table} was not landed with one row per id")
    schema = before.struct
    if sorted(delivery.columns) != sorted(schema.names):
        raise ValueError(f"{table}: columns {sorted(delivery.columns)}, landed with {sorted(schema.names)}")
    columns = schema.names
    dated = table in DATED
    month = (F.coalesce(_month(DATED[table][0]).cast("string"), F.lit(UNDATED)) if dated else F.lit(WHOLE)).alias("__month")
    typed = delivery.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])
    news = settle(one_per_key(typed, [key]))

    # Rows that are there already, sought only where the filters allow them.
    places = settle(may_hold(news, key, _filters(spark, folder, table, before)))
    wanted = {r["month"]: before.parts[r["month"]] for r in places.select("month").distinct().collect()}
    there = _stored(spark, folder, table, schema, wanted).select(*columns, month)
    asked = places.select(F.col(key).alias("__key"), F.col("month").alias("__in"))
    olds = there.join(asked, (F.col(key).eqNullSafe(F.col("__key"))) & (F.col("__month") == F.col("__in")), "left_semi")

    rest = [c for c in columns if c != key]
    both = news.select(*columns, F.lit(None).cast("string").alias("__month"), F.lit(1).alias("__new"))
    both = both.unionByName(olds.withColumn("__new", F.lit(0)))
    row = F.struct(*[F.col(f"`{c}`") for c in rest], F.col("__new").alias("__new"))
    judged = both.groupBy(key).agg(F.min(row).alias("best"), F.max("__month").alias("was_in"), F.max("__new").alias("delivered"))
    judged = settle(judged.where("delivered = 1").select(key, "best.*", "was_in"))
    counts = judged.agg(
        F.count_if(F.col("was_in").isNull()), F.count_if(F.col("was_in").isNotNull() & (F.col("__new") == 1)), F.count_if(F.col("__new") == 0)
    ).first()
    winners = judged.where("__new = 1").select(*columns, month, "was_in")
    touched = {r[0] for r in winners.select(F.explode(F.array_compact(F.array("__month", "was_in")))).distinct().collect()}
    change = Change(*counts, sorted(touched))
    if not touched:
        return change

    # The months that change: what they held, without what is replaced, and the rows that win.
    version = uuid.uuid4().hex
    held = _stored(spark, folder, table, schema, {m: v for m, v in before.parts.items() if m in touched}).select(*columns)
    gone = winners.where("was_in is not null").select(F.col(key).alias("__key"))
    left = held.join(gone, F.col(key).eqNullSafe(F.col("__key")), "left_anti")
    _write(_dealt(left.unionByName(winners.select(*columns)), table), folder, table, version)
    kind = T.StructType([*schema.fields, *([T.StructField(_MONTH, T.DateType())] if dated else [])])
    written = spark.read.schema(kind).parquet(f"{_home(folder, table)}/{_VERSION}={version}")
    rows = _parts_of(written, table)
    _write_filters(written, folder, table, version, rows)
    parts = {m: v for m, v in before.parts.items() if m not in touched} | dict.fromkeys(rows, version)
    sizes = {m: n for m, n in before.rows.items() if m not in touched} | rows
    _publish(spark, folder, table, dataclasses.replace(before, number=before.number + 1, parts=parts, rows=sizes, quality={}))
    return change


def drop_old(spark: SparkSession, folder: str, table: str, keep: int = 2) -> list[str]:
    """Removes versions that none of the last `keep` manifests names (readers may still hold the last but one)."""
    home = _home(folder, table)
    names = [n for n in names_in(spark, f"{home}/_manifests") if n.endswith(".json")]
    read = [Manifest(**json.loads(read_text(spark, f"{home}/_manifests/{n}"))) for n in names[-keep:]]
    named = {f"{_VERSION}={v}" for m in read for v in m.parts.values()}
    old = [n for n in names_in(spark, home) if n.startswith(f"{_VERSION}=") and n not in named]
    for name in _both(old):
        remove_folder(spark, f"{home}/{name}")
    for name in names[:-keep]:
        remove_folder(spark, f"{home}/_manifests/{name}")
    return old


def _both(names: Iterable[str]) -> list[str]:
    return [n for name in names for n in (name, f"_ids/{name}")]
