"""Declared schemas of the three logical tables, and the columns each job insists on."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


CUSTOMERS = _schema(
    ("customer_id", T.StringType()),
    ("name", T.StringType()),
    ("email", T.StringType()),
    ("city", T.StringType()),
    ("country", T.StringType()),
    ("signup_date", T.DateType()),
    ("age", T.IntegerType()),
    ("gender", T.StringType()),
    ("segment", T.StringType()),
    ("lifetime_value", MONEY),
)

TRANSACTIONS = _schema(
    ("transaction_id", T.StringType()),
    ("customer_id", T.StringType()),
    ("order_date", T.DateType()),
    ("category", T.StringType()),
    ("product_name", T.StringType()),
    ("quantity", T.IntegerType()),
    ("unit_price", MONEY),
    ("discount_pct", T.DecimalType(5, 1)),
    ("total_amount", MONEY),
    ("payment_method", T.StringType()),
    ("status", T.StringType()),
    ("is_first_purchase", T.BooleanType()),
)

SESSIONS = _schema(
    ("session_id", T.StringType()),
    ("customer_id", T.StringType()),
    ("session_date", T.DateType()),
    ("device", T.StringType()),
    ("traffic_source", T.StringType()),
    ("pages_viewed", T.IntegerType()),
    ("session_duration_sec", T.IntegerType()),
    ("bounced", T.BooleanType()),
    ("converted", T.BooleanType()),
)

# Columns without which the cleaning jobs refuse a table.
TRANSACTION_CONTRACT = ("transaction_id", "customer_id", "order_date", "total_amount", "status")
CUSTOMER_CONTRACT = ("customer_id", "signup_date", "segment")

# Order statuses.
COMPLETED = "Completed"
RETURNED = "Returned"
CANCELLED = "Cancelled"
