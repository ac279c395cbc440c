import datetime as dt
import json
import os
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException

from shopperflow import jobs
from shopperflow.sources import tables

CUSTOMERS = """customer_id,name,email,city,country,signup_date,age,gender,segment,lifetime_value
c1,Ann,a@x.org,Pune,India,2023-01-01,30,Female,Premium,10.50
c2,Bob,b@x.org,Rome,Italy,2024-01-20,31,Male,Regular,20.00
"""
TRANSACTIONS = """transaction_id,customer_id,order_date,category,product_name,quantity,unit_price,discount_pct,total_amount,payment_method,status,is_first_purchase
t1,c1,2024-01-02,Books,A Book,1,10.00,0.0,1234.56,Card,Completed,True
t2,c1,2024-01-31,Toys,"Big, red ball",2,5.00,10.0,9.00,Cash,Completed,False
t2,c1,2024-01-31,Toys,"Big, red ball",2,5.00,10.0,9.00,Cash,Completed,False
t3,c2,2024-01-30,Books,A Book,1,20.00,0.0,20.00,Card,Completed,True
t4,c2,2024-01-30,Books,A Book,1,20.00,0.0,20.00,Card,Returned,False
t5,c1,2023-06-01,Books,A Book,1,5.00,0.0,5.00,Card,Completed,False
"""
SESSIONS = """session_id,customer_id,session_date,device,traffic_source,pages_viewed,session_duration_sec,bounced,converted
s1,c1,2024-01-05,Mobile,Email,1,20,True,False
s2,c1,2024-02-05,Desktop,Direct,4,200,False,True
"""
TODAY = dt.date(2024, 1, 31)


@pytest.fixture
def folder(tmp_path):
    for name, text in (("customers", CUSTOMERS), ("transactions", TRANSACTIONS), ("sessions", SESSIONS)):
        (tmp_path / f"{name}.csv").write_text(text)
    return str(tmp_path)


def text_of(path):
    return "".join(part.read_text() for part in sorted(Path(path).glob("part-*")))


def test_csv_types(spark, folder):
    row = tables.read_transactions(spark, folder).filter("transaction_id = 't1'").first()
    assert (row["order_date"], str(row["total_amount"]), row["quantity"], row["is_first_purchase"]) == (dt.date(2024, 1, 2), "1234.56", 1, True)
    assert tables.read_sessions(spark, folder).filter("bounced").count() == 1


def test_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "customers.csv").write_text("segment,extra,customer_id,signup_date\nPremium,x,c1,2023-01-01\n")
    assert tuple(tables.read_customers(spark, str(tmp_path)).first()) == ("Premium", "x", "c1", dt.date(2023, 1, 1))


def test_window_includes_both_ends(spark, folder):
    found = tables.read_transactions(spark, folder, "2024-01-02", "2024-01-30").collect()
    assert sorted(r["transaction_id"] for r in found) == ["t1", "t3", "t4"]
    assert tables.read_transactions(spark, folder, start=dt.date(2024, 1, 31)).count() == 2
    assert tables.read_sessions(spark, folder, end="2024-01-31").count() == 1


def test_missing_files(spark, tmp_path):
    assert tables.read_sessions(spark, str(tmp_path)).count() == 0
    with pytest.raises(AnalysisException):
        tables.read_transactions(spark, str(tmp_path))


def test_landed_tables_are_pruned_by_month(spark, folder, tmp_path):
    out = str(tmp_path / "landed")
    tables.land(spark, folder, out)
    everything = tables.landed(spark, out, "transactions")
    assert sorted(map(tuple, everything.select("transaction_id", "total_amount").collect())) == sorted(
        map(tuple, tables.read_transactions(spark, folder).select("transaction_id", "total_amount").collect())
    )
    window = tables.landed(spark, out, "transactions", "2024-01-15", "2024-01-31")
    assert sorted(r["transaction_id"] for r in window.collect()) == ["t2", "t2", "t3", "t4"]
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_start" in plan and "GreaterThanOrEqual(order_date" in plan
    assert tables.landed(spark, out, "customers").count() == 2


def test_views(spark, folder):
    tables.register_views(tables.read_customers(spark, folder), tables.read_transactions(spark, folder), tables.read_sessions(spark, folder))
    joined = spark.sql("SELECT count(*) FROM transactions JOIN customers USING (customer_id) WHERE status = 'Completed'")
    assert joined.first()[0] == 5


def test_weekly_report_files(spark, folder, tmp_path):
    out = tmp_path / "reports"
    jobs.weekly_report(tables.read_customers(spark, folder), tables.read_transactions(spark, folder), str(out), TODAY)
    summary = json.loads(text_of(out / "summary_week05.json"))
    assert summary == {"week": 5, "revenue": 29.0, "orders": 2, "unique_customers": 2, "avg_order_value": 14.5}
    assert text_of(out / "category_breakdown_week05.csv").splitlines() == ["category,revenue,orders,avg_order_value", "Books,20.00,1,20.0", "Toys,9.00,1,9.0"]
    assert text_of(out / "segment_kpis_week05.csv").splitlines()[1:] == ["5,Premium,9.00,1", "5,Regular,20.00,1"]
    # c1's last order is on the day itself and so in no band.
    assert text_of(out / "churn_risk_week05.csv").splitlines() == ["churn_risk,count", "Active,1", "Cooling,0", "At Risk,0", "Churned,0"]
    report = text_of(out / "weekly_report_week05.md").splitlines()
    assert report[0] == "# Weekly Behavioral Report — Week 5" and report[1].startswith("*Generated: ")
    assert "| Total Revenue | ₹29.00 |" in report and "| Books | 20.00 | 1 |" in report
    assert report.index("| Books | 20.00 | 1 |") < report.index("| Toys | 9.00 | 1 |") < report.index("| Active | 1 |") < report.index("| Churned | 0 |")


def test_command_line(spark, folder, tmp_path, capsys):
    out = tmp_path / "out"
    jobs.main(["--data", folder, "--out", str(out), "--snapshot", "2024-01-31", "--weekly"])
    assert (out / "summary_week05.json").exists()
    jobs.main(["--data", folder, "--out", str(out)])
    assert "--dashboards" in capsys.readouterr().out


def test_segment_and_dashboard_jobs(spark, orders, people, visits, tmp_path):
    made = orders(*[(f"t{i}-{j}", f"c{i:02d}", f"2024-01-{i:02d}", 10 * i, "Completed") for i in range(1, 11) for j in range(i)])
    jobs.segment_report(made, str(tmp_path), "2024-02-01")
    assert text_of(tmp_path / "rfm_segments.csv").startswith("segment,customers,avg_recency")
    data = jobs.dashboard_datasets(people(("c01", "R", "2023-01-01", 1)), made, visits(("s", "c01", "Email", "Mobile", 1, 1, True)), "2024-02-01")
    assert len(data) == 13 and all(df.count() for df in data.values())


def test_churn_job(spark, orders, people, tmp_path):
    made = orders(*[(f"t{i}-{j}", f"c{i:02d}", f"2024-0{1 + i % 6}-01", 10 + i, "Completed") for i in range(60) for j in range(1 + i % 3)])
    known = people(*[(f"c{i:02d}", "R", "2023-01-01", 1, "FM"[i % 2], "India", 20 + i) for i in range(60)])
    model = jobs.train_churn(known, made, None, str(tmp_path), "lr", "2024-07-01")
    assert (tmp_path / "churn_model_lr").exists() and "roc_auc" in text_of(tmp_path / "churn_metrics_lr.csv")
    assert model.kind == "lr"


BAD = """transaction_id,customer_id,order_date,quantity,total_amount,status
t1,c1,2024-01-01 13:00:00,2.0,10.50,Completed
t2,c1,01/02/2024,1.5,abc,Completed
t3,c2,2024-01-03 00:00:00,,,Completed
t4,c2,,3,5,Completed
"""


def test_bad_cells_are_counted(spark, tmp_path, caplog):
    (tmp_path / "transactions.csv").write_text(BAD)
    found = {r["column"]: (r["bad_cells"], r["example"]) for r in tables.bad_cells(spark, str(tmp_path), "transactions").collect()}
    assert found == {"order_date": (1, "01/02/2024"), "quantity": (1, "1.5"), "total_amount": (1, "abc")}
    with caplog.at_level("WARNING"):
        assert tables.warn_about_bad_cells(spark, str(tmp_path), "transactions") == {"order_date": 1, "quantity": 1, "total_amount": 1}
    assert "unreadable" in caplog.text
    with pytest.raises(ValueError, match="total_amount"):
        tables.warn_about_bad_cells(spark, str(tmp_path), "transactions", strict=True)


def test_times_of_day_are_kept(spark, tmp_path):
    (tmp_path / "transactions.csv").write_text(BAD)
    rows = {r["transaction_id"]: r for r in tables.read_transactions(spark, str(tmp_path)).collect()}
    assert rows["t1"]["order_date"] == dt.datetime(2024, 1, 1, 13) and rows["t1"]["quantity"] == 2
    assert rows["t2"]["order_date"] is None and rows["t2"]["quantity"] is None and rows["t4"]["quantity"] == 3


def test_only_newer_files_are_landed_again(spark, folder, tmp_path):
    out = str(tmp_path / "home")
    assert tables.land_news(spark, folder, out) == ["customers", "transactions", "sessions"]
    assert tables.land_news(spark, folder, out) == []
    path = Path(folder) / "customers.csv"
    path.write_text(CUSTOMERS + "c3,Cem,c@x.org,Rome,Italy,2024-01-21,32,Male,Regular,2.00\n")
    os.utime(path, (path.stat().st_mtime + 5,) * 2)
    assert tables.land_news(spark, folder, out) == ["customers"] and tables.landed(spark, out, "customers").count() == 3


def test_job_reads_the_landed_months(spark, folder, tmp_path, monkeypatch):
    out, plans = tmp_path / "out", []
    within = tables.landed

    def noted(*args, **kw):
        df = within(*args, **kw)
        if len(args) > 3:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(tables, "landed", noted)
    jobs.main(["--data", folder, "--out", str(out), "--snapshot", "2024-01-31", "--weekly"])
    assert len(plans) == 1 and "PartitionFilters: [isnotnull(month_start" in plans[0]
    assert json.loads(text_of(out / "summary_week05.json"))["revenue"] == 29.0


def test_nothing_is_left_behind(spark, sf_dir):
    import __spark_entry__ as registry
    from shopperflow.plans import durable

    durable.ensure_checkpoint_dir(spark)
    home = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    for name in ("landed_window", "customers_from_csv", "churn_proba_reloaded"):
        assert registry.queries()[name](spark, sf_dir).count() > 0
    assert not [p.name for p in home.iterdir() if p.name.startswith(("landed-", "delivered-", "model-"))]


def test_work_folder_is_in_the_warehouse_unless_named():
    text = Path(jobs.__file__).parent.joinpath("plans/durable.py").read_text()
    assert "tempfile" not in text and "spark.sql.warehouse.dir" in text
