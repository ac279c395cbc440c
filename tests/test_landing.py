import datetime as dt
import json
from decimal import Decimal
from pathlib import Path

import pytest

from shopperflow import jobs
from shopperflow.operators import weekly
from shopperflow.plans.copies import one_per_key
from shopperflow.schemas import SESSIONS, TRANSACTION_CONTRACT
from shopperflow.sources import landing, tables

from .test_sources_and_jobs import BAD, CUSTOMERS, SESSIONS as SESSION_ROWS, TRANSACTIONS, folder  # noqa: F401


def made(spark, *rows):
    """Transactions from (id, customer, day or None, amount)."""
    full = [(i, c, None if d is None else dt.date.fromisoformat(d), Decimal(a)) for i, c, d, a in rows]
    return spark.createDataFrame(full, "transaction_id string, customer_id string, order_date date, total_amount decimal(18,2)")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_empty_tables_are_readable(spark, tmp_path):
    out = str(tmp_path)
    landing.land_table(spark.createDataFrame([], SESSIONS), out, "sessions")
    found = landing.landed(spark, out, "sessions", "2024-01-01", "2024-02-01")
    assert found.schema.simpleString() == SESSIONS.simpleString() and found.count() == 0
    with pytest.raises(FileNotFoundError):
        landing.landed(spark, out, "customers")


def test_jobs_without_sessions(spark, folder, tmp_path):  # noqa: F811
    Path(folder, "sessions.csv").unlink()
    out = tmp_path / "out"
    jobs.main(["--data", folder, "--out", str(out), "--snapshot", "2024-01-31", "--weekly", "--dashboards"])
    assert (out / "summary_week05.json").exists() and (out / "dashboards" / "device_split.csv").exists()
    assert landing.landed(spark, str(out / "landed"), "sessions").count() == 0
    assert tables.land_news(spark, folder, str(out / "landed")) == []


def test_sessions_that_come_and_go(spark, folder, tmp_path):  # noqa: F811
    out, path = str(tmp_path / "home"), Path(folder, "sessions.csv")
    tables.land_news(spark, folder, out)
    path.unlink()
    assert tables.land_news(spark, folder, out) == ["sessions"] and landing.landed(spark, out, "sessions").count() == 0
    path.write_text(SESSION_ROWS)
    assert tables.land_news(spark, folder, out) == ["sessions"] and landing.landed(spark, out, "sessions").count() == 2


def test_failed_landing_changes_nothing(spark, folder, tmp_path):  # noqa: F811
    out = str(tmp_path / "home")
    tables.land(spark, folder, out)
    before = rows(landing.landed(spark, out, "transactions"))
    Path(folder, "transactions.csv").write_text(BAD)
    with pytest.raises(ValueError, match="total_amount"):
        tables.land_news(spark, folder, out, strict=True)
    assert rows(landing.landed(spark, out, "transactions")) == before
    broken = landing.landed(spark, out, "transactions").selectExpr("* except(total_amount)", "cast(raise_error('lost') as decimal(18,2)) AS total_amount")
    with pytest.raises(Exception, match="lost"):
        landing.land_table(broken, out, "transactions")
    assert rows(landing.landed(spark, out, "transactions")) == before


def test_a_reader_keeps_the_table_it_began_with(spark, tmp_path):
    out = str(tmp_path)
    landing.land_table(made(spark, ("a", "c", "2024-01-01", 1)), out, "transactions")
    held = landing.landed(spark, out, "transactions")
    landing.land_table(made(spark, ("b", "c", "2024-01-01", 1)), out, "transactions")
    assert [r.transaction_id for r in held.collect()] == ["a"]
    assert [r.transaction_id for r in landing.landed(spark, out, "transactions").collect()] == ["b"]
    assert len(landing.drop_old(spark, out, "transactions", keep=1)) == 1
    assert [r.transaction_id for r in landing.landed(spark, out, "transactions").collect()] == ["b"]


def test_two_writers_of_one_number(spark, tmp_path):
    first = landing.land_table(made(spark, ("a", "c", "2024-01-01", 1)), str(tmp_path), "transactions")
    with pytest.raises(FileExistsError):
        landing._publish(spark, str(tmp_path), "transactions", first)
    assert [p.name for p in (tmp_path / "transactions" / "_manifests").iterdir() if p.suffix == ".json"] == ["0000000001.json"]


def test_text_is_landed_and_counted_in_one_scan(spark, tmp_path, monkeypatch):
    (tmp_path / "transactions.csv").write_text(BAD)
    plans = []
    write = landing._write

    def noted(df, *rest):
        plans.append(df._jdf.queryExecution().toString().split("== Physical Plan ==")[1])
        write(df, *rest)

    monkeypatch.setattr(landing, "_write", noted)
    monkeypatch.setattr(tables, "_kinds", lambda *_: pytest.fail("looked at the cells first"))
    tables._land_one(spark, str(tmp_path), str(tmp_path / "out"), "transactions", False)
    assert len(plans) == 1 and plans[0].count("FileScan csv") == 1 and "rangepartitioning" not in plans[0]
    monkeypatch.undo()
    counted = {r["column"]: (r["bad_cells"], r["example"]) for r in landing.quality_report(spark, str(tmp_path / "out"), "transactions").collect() if r["bad_cells"]}
    assert counted == {r["column"]: (r["bad_cells"], r["example"]) for r in tables.bad_cells(spark, str(tmp_path), "transactions").collect() if r["bad_cells"]}
    read = tables.read_transactions(spark, str(tmp_path))
    nulls = {r["column"]: r["null_count"] for r in landing.quality_report(spark, str(tmp_path / "out"), "transactions").collect()}
    profile = {r["column"]: r["null_count"] for r in weekly.null_profile(read, [c for c in TRANSACTION_CONTRACT if c in read.columns]).collect()}
    assert {c: nulls[c] for c in profile} == profile
    found = landing.landed(spark, str(tmp_path / "out"), "transactions")
    assert found.schema == read.schema and rows(found) == rows(read)


def test_dates_stay_dates_unless_a_cell_has_a_time(spark, folder, tmp_path):  # noqa: F811
    tables.land(spark, folder, str(tmp_path / "out"))
    assert dict(landing.landed(spark, str(tmp_path / "out"), "transactions").dtypes)["order_date"] == "date"
    assert rows(landing.landed(spark, str(tmp_path / "out"), "customers")) == rows(tables.read_customers(spark, folder))


FIRST = [(f"t{i:03d}", f"c{i % 7}", f"2024-{1 + i % 6:02d}-{1 + i % 28:02d}", i) for i in range(120)] + [("x1", "c1", None, 5), (None, "c1", "2024-02-02", 5)]
SECOND = [
    ("t001", "c1", "2024-02-02", 1), ("t002", "c0", "2024-03-03", 2), ("t003", "zz", "2024-04-04", 9), ("n1", "c1", "2024-06-07", 5),
    ("n1", "c1", "2024-06-08", 5), ("t004", "b", "2023-01-01", 9), ("x1", "a", "2024-06-01", 1), (None, "a", "2024-02-03", 5), ("n2", "q", None, 1),
]


def test_upserts_equal_landing_everything_at_once(spark, tmp_path):
    out, both = str(tmp_path / "step"), str(tmp_path / "once")
    assert landing.upsert(made(spark, *FIRST), out, "transactions").new == 122
    before = landing.manifest(spark, out, "transactions")
    change = landing.upsert(made(spark, *SECOND), out, "transactions")
    landing.land_table(made(spark, *FIRST, *SECOND), both, "transactions", unique=True)
    assert rows(landing.landed(spark, out, "transactions")) == rows(landing.landed(spark, both, "transactions"))
    assert rows(landing.landed(spark, out, "transactions")) == rows(one_per_key(made(spark, *FIRST, *SECOND), ["transaction_id"]))
    after = landing.manifest(spark, out, "transactions")
    assert {m for m in set(before.parts) | set(after.parts) if before.parts.get(m) != after.parts.get(m)} == set(change.months)
    assert change.new == 2 and "2024-01-01" not in change.months and before.parts["2024-01-01"] == after.parts["2024-01-01"]
    assert after.rows == {r: n for r, n in landing.manifest(spark, both, "transactions").rows.items()}
    again = landing.upsert(made(spark, *SECOND), out, "transactions")
    assert (again.new, again.replaced, again.months) == (0, 0, []) and landing.manifest(spark, out, "transactions") == after


def test_filters_name_every_month_that_holds_an_id(spark, tmp_path):
    out = str(tmp_path)
    landing.land_table(made(spark, *FIRST), out, "transactions", unique=True)
    made_by = landing.manifest(spark, out, "transactions")
    places = landing.may_hold(made(spark, *FIRST, *SECOND), "transaction_id", landing._filters(spark, out, "transactions", made_by))
    named = {(r["transaction_id"], r["month"]) for r in places.collect()}
    truth = {(r["transaction_id"], "none" if r["order_date"] is None else str(r["order_date"])[:8] + "01") for r in landing.landed(spark, out, "transactions").collect()}
    assert truth <= named and len(named) < len(truth) + 40


def test_upsert_refuses_what_it_cannot_add_to(spark, tmp_path):
    out = str(tmp_path)
    landing.land_table(made(spark, *FIRST), out, "transactions")
    with pytest.raises(ValueError, match="one row per id"):
        landing.upsert(made(spark, *SECOND), out, "transactions")
    landing.land_table(made(spark, *FIRST), out, "transactions", unique=True)
    with pytest.raises(ValueError, match="columns"):
        landing.upsert(made(spark, *SECOND).drop("total_amount"), out, "transactions")


def test_manifest_is_one_small_readable_file(spark, tmp_path):
    landing.land_table(made(spark, *FIRST), str(tmp_path), "transactions")
    told = json.loads((tmp_path / "transactions" / "_manifests" / "0000000001.json").read_text())
    assert told["rows"]["2024-01-01"] == 20 and told["rows"]["none"] == 1 and len(set(told["parts"].values())) == 1
    assert CUSTOMERS and TRANSACTIONS
