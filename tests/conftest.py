import datetime as dt
import sys
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shopperflow.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("checkpoints")
    return local_session(8, "tests", **{"spark.checkpoint.dir": str(folder), "spark.sql.shuffle.partitions": "4"})


@pytest.fixture(scope="session")
def sf_dir():
    if not Path(SF).exists():
        pytest.skip("no test tables here")
    return SF


@pytest.fixture(scope="session")
def orders(spark):
    """Builds a transactions table from (id, customer, day, amount, status[, category[, discount]])."""

    def build(*rows):
        full = []
        for row in rows:
            key, customer, day, amount, status, *rest = row
            category = rest[0] if rest else "Books"
            discount = Decimal(str(rest[1])) if len(rest) > 1 else Decimal("0.0")
            amount = None if amount is None else Decimal(str(amount))
            full.append((key, customer, None if day is None else dt.date.fromisoformat(day), amount, status, category, discount))
        return spark.createDataFrame(
            full,
            "transaction_id string, customer_id string, order_date date, total_amount decimal(18,2), "
            "status string, category string, discount_pct decimal(5,1)",
        )

    return build


@pytest.fixture(scope="session")
def people(spark):
    """Builds a customers table from (id, segment, signup day, lifetime value[, gender[, country[, age]]])."""

    def build(*rows):
        full = []
        for key, segment, day, value, *rest in rows:
            gender, country, age = (list(rest) + ["F", "India", 30][len(rest):])[:3]
            full.append((key, segment, dt.date.fromisoformat(day), Decimal(str(value)), gender, country, age))
        return spark.createDataFrame(
            full,
            "customer_id string, segment string, signup_date date, lifetime_value decimal(18,2), "
            "gender string, country string, age int",
        )

    return build


@pytest.fixture(scope="session")
def visits(spark):
    """Builds a sessions table from (id, customer, source, device, pages, seconds, converted)."""

    def build(*rows):
        full = [(key, who, source, device, pages, seconds, pages == 1, bought) for key, who, source, device, pages, seconds, bought in rows]
        return spark.createDataFrame(
            full,
            "session_id string, customer_id string, traffic_source string, device string, pages_viewed int, "
            "session_duration_sec int, bounced boolean, converted boolean",
        )

    return build


def rows(df):
    return [tuple(row) for row in df.collect()]
