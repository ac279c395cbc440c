"""Reading the three tables: CSV as delivered, Parquet once landed."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.durable import modified
from ..schemas import CUSTOMERS, SESSIONS, TRANSACTIONS
from . import landing
from .landing import Day, within

log = logging.getLogger(__name__)


def _text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).csv(path)


def _value(column: str, kind: T.DataType) -> Column:
    """A cell as its declared type, NULL if it cannot be read as that; whole numbers may be written 2.0."""
    cell = F.trim(F.col(f"`{column}`"))
    if isinstance(kind, T.IntegerType):
        number = cell.try_cast("decimal(30,6)")
        return F.when(number == F.floor(number), number).try_cast("int")
    if isinstance(kind, T.DateType):
        return cell.try_cast("date")
    return cell.try_cast(kind)


def _declared(text: DataFrame, schema: T.StructType) -> dict[str, T.DataType]:
    """Declared types of the columns a file has, other than text."""
    return {f.name: f.dataType for f in schema.fields if f.name in text.columns and not isinstance(f.dataType, T.StringType)}


def _kinds(text: DataFrame, schema: T.StructType) -> dict[str, T.DataType]:
    """The same, but a date column that holds times of day is a timestamp, which takes a look at its cells."""
    kinds = _declared(text, schema)
    days = [name for name, kind in kinds.items() if isinstance(kind, T.DateType)]
    if days:
        longest = text.agg(*[F.max(F.length(F.trim(F.col(f"`{d}`")))).alias(d) for d in days]).first()
        kinds.update({d: T.TimestampNTZType() for d in days if (longest[d] or 0) > len("2000-01-01")})
    return kinds


def _csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    # Columns are matched to the header by name, as files may lack or reorder columns.
    text = _text(spark, path)
    kinds = _kinds(text, schema)
    return text.select(*[(_value(c, kinds[c]) if c in kinds else F.col(f"`{c}`")).alias(c) for c in text.columns])


def bad_cells(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """column, bad_cells, example: cells of a CSV table that hold something, but not of the declared type."""
    text = _text(spark, f"{folder}/{table}.csv")
    kinds = _kinds(text, _SCHEMAS[table])

    def lost(name: str) -> Column:
        return (F.trim(F.col(f"`{name}`")) != "") & _value(name, kinds[name]).isNull()

    pairs = [F.struct(F.lit(n).alias("column"), F.when(lost(n), F.col(f"`{n}`")).alias("cell")) for n in kinds]
    cells = text.select(F.explode(F.array(*pairs)).alias("c")).select("c.*")
    found = cells.groupBy("column").agg(F.count("cell").alias("bad_cells"), F.min("cell").alias("example"))
    return found.orderBy("column")


def warn_about_bad_cells(spark: SparkSession, folder: str, table: str, strict: bool = False) -> dict[str, int]:
    """Logs how many cells of each column become NULL because they cannot be read; raises if `strict`."""
    found = {r["column"]: r["bad_cells"] for r in bad_cells(spark, folder, table).filter("bad_cells > 0").collect()}
    if found and strict:
        raise ValueError(f"{table}: unreadable cells in {found}")
    if found:
        log.warning("%s: unreadable cells, read as NULL, in %s", table, found)
    return found


def read_customers(spark: SparkSession, folder: str) -> DataFrame:
    return _csv(spark, f"{folder}/customers.csv", CUSTOMERS)


def read_transactions(spark: SparkSession, folder: str, start: Day = None, end: Day = None) -> DataFrame:
    return within(_csv(spark, f"{folder}/transactions.csv", TRANSACTIONS), "order_date", start, end)


def read_sessions(spark: SparkSession, folder: str, start: Day = None, end: Day = None) -> DataFrame:
    """Sessions are optional: without the file the table is empty."""
    path = f"{folder}/sessions.csv"
    try:
        sessions = _csv(spark, path, SESSIONS)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("%s not found, going on without session data", path)
        return spark.createDataFrame([], SESSIONS)
    return within(sessions, "session_date", start, end)


_SCHEMAS = {"customers": CUSTOMERS, "transactions": TRANSACTIONS, "sessions": SESSIONS}
land_table, landed = landing.land_table, landing.landed
_READERS = {"customers": read_customers, "transactions": read_transactions, "sessions": read_sessions}
_OPTIONAL = ("sessions",)


def land(spark: SparkSession, csv_folder: str, parquet_folder: str, strict: bool = False) -> None:
    """Lands all three CSV tables; cells that cannot be read are logged, or refused if `strict`."""
    for table in _READERS:
        _land_one(spark, csv_folder, parquet_folder, table, strict)


def _land_one(spark: SparkSession, csv_folder: str, parquet_folder: str, table: str, strict: bool) -> None:
    path = f"{csv_folder}/{table}.csv"
    changed = modified(spark, path)
    if changed is None and table in _OPTIONAL:
        landing.land_table(_READERS[table](spark, csv_folder), parquet_folder, table)
        return
    text = _text(landing.apart(spark), path)
    made = landing.land_text(text, _declared(text, _SCHEMAS[table]), _value, parquet_folder, table, changed, strict)
    lost = {c: n for c, n in made.quality["bad_cells"].items() if n}
    if lost:
        log.warning("%s: unreadable cells, read as NULL, in %s", table, lost)


def land_news(spark: SparkSession, csv_folder: str, parquet_folder: str, strict: bool = False) -> list[str]:
    """Lands the tables whose CSV is not the one that has been landed, and names them.

    Without a file of sessions an empty table is landed, also if there was one before; other files must be there.
    """
    news = []
    for table in _READERS:
        before = landing.manifest(spark, parquet_folder, table)
        if before is None or before.source_modified != modified(spark, f"{csv_folder}/{table}.csv"):
            _land_one(spark, csv_folder, parquet_folder, table, strict)
            news.append(table)
    return news


def register_views(customers: DataFrame, transactions: DataFrame, sessions: DataFrame | None = None) -> None:
    """Makes the tables available to spark.sql under their own names."""
    customers.createOrReplaceTempView("customers")
    transactions.createOrReplaceTempView("transactions")
    if sessions is not None:
        sessions.createOrReplaceTempView("sessions")
