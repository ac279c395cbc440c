"""The three logical tables out of an order-management star schema (orders, line items, events).

Each order line is a transaction. Lines are reduced to one per (order, line number) before the
joins, on the line table alone; the joins to orders and parts are outer joins on their primary
keys, so the part join is simply left out when no caller needs the category (and the nation join
when none needs the country).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.bands import ladder
from ..plans.copies import one_per_key
from ..schemas import CANCELLED, COMPLETED, RETURNED

LINE_KEY = ("l_orderkey", "l_linenumber")
# Which copy of a line counts: a total order, so the choice does not depend on file order.
LINE_PREFERENCE = (
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
)

# Device and traffic-source names, segment names.
DEVICES = {3: "Desktop", 4: "Tablet"}
TRAFFIC_SOURCES = ("Organic Search", "Paid Search", "Social Media", "Email", "Direct", "Referral")
SEGMENTS = {"BUILDING": "Premium", "AUTOMOBILE": "Regular", "MACHINERY": "Occasional", "HOUSEHOLD": "At-Risk"}


@dataclass(frozen=True)
class StarSchema:
    spark: SparkSession
    folder: str

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def lines(self) -> DataFrame:
        """Every order line, copies included."""
        return self._table("lineitem")

    def single_lines(self, orders: DataFrame | None = None) -> DataFrame:
        """One row per line; given some orders, only lines of those, chosen before copies are reduced.

        The order is part of a line's key, so the copy that is kept is the same.
        """
        lines = self.lines().select(*LINE_KEY, *LINE_PREFERENCE)
        if orders is not None:
            lines = lines.join(orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
        return one_per_key(lines, LINE_KEY, LINE_PREFERENCE)

    def _as_transactions(self, lines: DataFrame, with_category: bool, orders: DataFrame | None = None) -> DataFrame:
        price = F.col("l_extendedprice").cast("decimal(12,2)")
        discount = F.col("l_discount").cast("decimal(4,2)")
        orders = self._table("orders") if orders is None else orders
        joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey, "left")
        columns = [
            F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("transaction_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("l_quantity").cast("int").alias("quantity"),
            (discount * 100).cast("decimal(5,1)").alias("discount_pct"),
            F.round(price * (1 - discount), 2).cast("decimal(18,2)").alias("total_amount"),
            ladder([(F.col("l_returnflag") == "N", COMPLETED), (F.col("l_returnflag") == "R", RETURNED)], CANCELLED).alias("status"),
        ]
        if with_category:
            part = self._table("part").select("p_partkey", F.col("p_type").alias("category"))
            joined = joined.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
            columns.append(F.col("category"))
        return joined.select(*columns)

    def raw_transactions(self) -> DataFrame:
        """Transactions before cleaning: an id can occur more than once."""
        return self._as_transactions(self.lines(), with_category=True)

    def transactions(self, with_category: bool = False, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
        """One row per transaction_id, of orders from `start` to `end` (both included, either open)."""
        if start is None and end is None:
            return self._as_transactions(self.single_lines(), with_category)
        day = F.col("o_orderdate").cast("date")
        orders = self._table("orders")
        if start is not None:
            orders = orders.filter(day >= F.lit(start))
        if end is not None:
            orders = orders.filter(day <= F.lit(end))
        return self._as_transactions(self.single_lines(orders), with_category, orders)

    def customers(self, with_country: bool = False) -> DataFrame:
        key = F.col("c_custkey")
        people = self._table("customer")
        columns = [
            key.alias("customer_id"),
            F.date_add(F.lit("1994-01-01").cast("date"), (key % 2400).cast("int")).alias("signup_date"),
            (18 + key % 52).cast("int").alias("age"),
            ladder([(key % 3 == 0, "Male"), (key % 3 == 1, "Female")], "Other").alias("gender"),
            ladder([(F.col("c_mktsegment") == k, v) for k, v in SEGMENTS.items()], "Churned").alias("segment"),
            F.col("c_acctbal").cast("decimal(18,2)").alias("lifetime_value"),
        ]
        if with_country:
            nation = self._table("nation").select("n_nationkey", F.col("n_name").alias("country"))
            people = people.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            columns.append(F.col("country"))
        return people.select(*columns)

    def sessions(self) -> DataFrame:
        key = F.col("event_id")
        pages = 1 + F.regexp_extract("props", "([0-9]+)", 1).cast("int") % 10
        sources = [(key % 6 == i, name) for i, name in enumerate(TRAFFIC_SOURCES)]
        return self._table("events").select(
            key.alias("session_id"),
            F.col("user_id").alias("customer_id"),
            F.col("ts").cast("date").alias("session_date"),
            ladder([(key % 5 == i, name) for i, name in DEVICES.items()], "Mobile").alias("device"),
            ladder(sources[:-1], TRAFFIC_SOURCES[-1]).alias("traffic_source"),
            pages.alias("pages_viewed"),
            (10 + F.floor("value")).cast("int").alias("session_duration_sec"),
            (pages == 1).alias("bounced"),
            (F.col("event_type") == "purchase").alias("converted"),
        )
