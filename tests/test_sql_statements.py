import datetime as dt

import pytest

import __spark_entry__ as registry
from checks.duckdb_sql import STATED
from shopperflow.sql import session
from shopperflow.sql.statements import STATEMENTS

from .conftest import rows


def test_every_statement_is_registered():
    assert set(STATED) == set(STATEMENTS) and {f"sql_{n}" for n in STATED} <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_statement_equals_its_function(spark, sf_dir, name):
    queries = registry.queries()
    stated, made = queries[f"sql_{name}"](spark, sf_dir), queries[name](spark, sf_dir)
    assert sorted(stated.columns) == sorted(made.columns)
    assert dict(stated.dtypes) == dict(made.dtypes)
    assert sorted(rows(stated.select(made.columns)), key=str) == sorted(rows(made), key=str)
    # No one-task window over a table, no Python, no cross join.
    plan = stated._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.fixture(scope="module")
def prepared(spark):
    nobody = spark.createDataFrame([], "customer_id string")
    session.prepare(spark, nobody, nobody, nobody, "2024-02-29")
    return spark


def one(spark, expression):
    return spark.sql(f"SELECT {expression}").first()[0]


def test_functions(prepared):
    assert one(prepared, "date_text(TIMESTAMP_NTZ '2024-03-05 07:08:09', '%Y-%m-%d %H:%i:%s')") == "2024-03-05 07:08:09"
    assert one(prepared, "date_text(DATE '2024-03-05', '%e %M %y, %W')") == "5 March 24, Tuesday"
    assert one(prepared, "date_text(NULL, '%Y')") is None
    assert one(prepared, "period_diff('202401', '202311')") == 2 and one(prepared, "period_diff('2023-11', '2024-01')") == -2
    assert one(prepared, "period_diff(202401, 202401)") == 0 and one(prepared, "period_diff('202401', NULL)") is None
    assert one(prepared, "field('b', 'a', 'b', 'c')") == 2 and one(prepared, "field('z', 'a')") == 0 and one(prepared, "field(NULL, 'a')") == 0
    assert one(prepared, "ratio2(1, 8)") == 0.13 and one(prepared, "ratio2(-1, 8)") == -0.13 and one(prepared, "ratio1(1, 0)") is None
    assert one(prepared, "today") == dt.date(2024, 2, 29)


def test_today_is_the_clock_unless_pinned(spark):
    nobody = spark.createDataFrame([], "customer_id string")
    session.prepare(spark, nobody, nobody, nobody)
    assert one(spark, "today = current_date()") is True


def test_filters_reach_the_scan(spark, sf_dir, tmp_path):
    """The functions are SQL text, so a condition on one is a condition on its body."""
    rows_ = spark.range(10).selectExpr("id AS transaction_id", "id AS customer_id", "date_add(DATE '2024-01-01', cast(id * 20 as int)) AS order_date", "'Completed' AS status")
    rows_.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    session.prepare(spark, table, table, table, "2024-07-01")
    found = spark.sql("SELECT transaction_id FROM transactions WHERE status = 'Completed' AND order_date < today - INTERVAL 90 DAYS")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "LessThan(order_date,2024-04" in plan and "Python" not in plan
