"""The registered queries as DuckDB SQL over the same Parquet tables.

Averages and percentages are rounded with whole numbers here (`half_up`): DuckDB rounds doubles,
where a tie such as 0.145 is not a tie.
"""

from __future__ import annotations

SNAPSHOT = "DATE '2001-08-02'"
WEEK = 31
SCORE_THRESHOLD = "0.06"

SINGLE_LINES = """single_lines AS (
  SELECT * FROM lineitem
  QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag) = 1)"""


def _transactions(name: str, lines: str) -> str:
    return f"""{name} AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_id,
    o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
    CAST(l_quantity AS INTEGER) AS quantity,
    CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS DECIMAL(5,1)) AS discount_pct,
    CAST(ROUND(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(18,2)) AS total_amount,
    CASE l_returnflag WHEN 'N' THEN 'Completed' WHEN 'R' THEN 'Returned' ELSE 'Cancelled' END AS status,
    p_type AS category
  FROM {lines}
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN part ON l_partkey = p_partkey)"""


RAW = _transactions("raw_transactions", "lineitem")
TRANSACTIONS = SINGLE_LINES + ",\n" + _transactions("transactions", "single_lines")
DONE = "done AS (SELECT * FROM transactions WHERE status = 'Completed')"
CUSTOMERS = """customers AS (
  SELECT c_custkey AS customer_id, n_name AS country,
    DATE '1994-01-01' + CAST(c_custkey % 2400 AS INTEGER) AS signup_date,
    CAST(18 + c_custkey % 52 AS INTEGER) AS age,
    CASE c_custkey % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' ELSE 'Other' END AS gender,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'Premium' WHEN 'AUTOMOBILE' THEN 'Regular'
      WHEN 'MACHINERY' THEN 'Occasional' WHEN 'HOUSEHOLD' THEN 'At-Risk' ELSE 'Churned' END AS segment,
    CAST(c_acctbal AS DECIMAL(18,2)) AS lifetime_value
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""
SESSIONS = """sessions AS (
  SELECT event_id AS session_id, user_id AS customer_id,
    CASE event_id % 5 WHEN 3 THEN 'Desktop' WHEN 4 THEN 'Tablet' ELSE 'Mobile' END AS device,
    CASE event_id % 6 WHEN 0 THEN 'Organic Search' WHEN 1 THEN 'Paid Search' WHEN 2 THEN 'Social Media'
      WHEN 3 THEN 'Email' WHEN 4 THEN 'Direct' ELSE 'Referral' END AS traffic_source,
    1 + CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) % 10 AS pages_viewed,
    10 + CAST(FLOOR(value) AS INTEGER) AS session_duration_sec,
    CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) % 10 = 0 AS bounced,
    event_type = 'purchase' AS converted
  FROM events)"""


def query(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def half_up(numerator: str, denominator: str, digits: int) -> str:
    """Whole-number ratio rounded half away from zero, as a double."""
    n, d, scale = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)", 10**digits
    return f"(CAST(SIGN({n}) * ((2 * ABS({n}) * {scale} + {d}) // (2 * {d})) AS DOUBLE) / {float(scale)})"


def mean(column: str, digits: int) -> str:
    return half_up(f"SUM({column})", f"COUNT({column})", digits)


def money_mean(column: str, digits: int = 2) -> str:
    return half_up(f"SUM({column}) * 100", f"COUNT({column}) * 100", digits)


def money(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def month(day: str) -> str:
    return f"strftime({day}, '%Y-%m')"


def month_number(day: str) -> str:
    return f"(EXTRACT(year FROM {day}) * 12 + EXTRACT(month FROM {day}))"


def label_of_month(number: str) -> str:
    return f"strftime(make_date(CAST(({number} - 1) // 12 AS BIGINT), CAST(({number} - 1) % 12 + 1 AS BIGINT), 1), '%Y-%m')"


def days_since(day: str) -> str:
    return f"CAST(date_diff('day', {day}, {SNAPSHOT}) AS INTEGER)"


RFM = f"""rfm AS (
  SELECT customer_id, {days_since('MAX(order_date)')} AS recency, COUNT(DISTINCT transaction_id) AS frequency,
    SUM(total_amount) AS monetary
  FROM done GROUP BY customer_id)"""


def quantile_bin(rank: str) -> str:
    """Bin of a value with `rank` - 1 values below it: one more than the inner edges it is above."""
    return "1 + " + " + ".join(
        f"CASE WHEN {rank} - 1 > ((SELECT COUNT(*) FROM rfm) - 1) * {k} // 5 THEN 1 ELSE 0 END" for k in range(1, 5)
    )


RANKED = f"""ranked AS (
  SELECT *, RANK() OVER (ORDER BY recency) AS rr, ROW_NUMBER() OVER (ORDER BY frequency, customer_id) AS fr,
    RANK() OVER (ORDER BY monetary) AS mr FROM rfm),
binned AS (
  SELECT *, 6 - ({quantile_bin('rr')}) AS r, {quantile_bin('fr')} AS f, {quantile_bin('mr')} AS m FROM ranked)"""


def segment_case(r: str, f: str, m: str) -> str:
    return f"""CASE
    WHEN LEAST({r}, {f}, {m}) >= 4 THEN 'Champions'
    WHEN LEAST({r}, {f}, {m}) >= 3 THEN 'Loyal Customers'
    WHEN {r} >= 4 AND {f} < 3 THEN 'New Customers'
    WHEN {r} >= 3 AND {m} >= 2 THEN 'Potential Loyalists'
    WHEN {r} < 3 AND LEAST({f}, {m}) >= 4 THEN 'At Risk'
    WHEN {r} < 3 AND LEAST({f}, {m}) >= 2 THEN 'Needs Attention'
    WHEN {r} = 1 AND {f} = 1 THEN 'Lost'
    ELSE 'Hibernating' END"""


SCORED = f"scored AS (SELECT *, {segment_case('r', 'f', 'm')} AS segment FROM binned)"
DASHBOARD_SCORED = """scored AS (SELECT *, CASE
    WHEN LEAST(r, f, m) >= 4 THEN 'Champions'
    WHEN LEAST(r, f, m) >= 3 THEN 'Loyal'
    WHEN r >= 4 AND f < 3 THEN 'New'
    WHEN r < 3 AND LEAST(f, m) >= 4 THEN 'At Risk'
    WHEN r < 3 AND LEAST(f, m) >= 2 THEN 'Needs Attention'
    WHEN r = 1 AND f = 1 THEN 'Lost'
    ELSE 'Hibernating' END AS segment FROM binned)"""

# One row per completed order with its month number, and the customer's first month.
COHORT = f"""dated AS (
  SELECT *, {month_number('order_date')} AS mon,
    MIN({month_number('order_date')}) OVER (PARTITION BY customer_id) AS born FROM done)"""

LAST_ORDER = f"last_order AS (SELECT customer_id, {days_since('MAX(order_date)')} AS idle FROM done GROUP BY customer_id)"


def in_given_order(labels: list[str]) -> str:
    rows = ", ".join(f"({i}, '{label}')" for i, label in enumerate(labels))
    return f"(VALUES {rows}) AS l(place, label)"


def churn_reports() -> dict[str, str]:
    status = query(
        [TRANSACTIONS, DONE, CUSTOMERS, f"""spend AS (
  SELECT customer_id, {days_since('MAX(order_date)')} AS idle, COUNT(DISTINCT transaction_id) AS orders, SUM(total_amount) AS spent
  FROM done GROUP BY customer_id)"""],
        f"""SELECT CASE WHEN idle <= 30 THEN 'Active' WHEN idle <= 90 THEN 'Cooling Off' WHEN idle <= 180 THEN 'At Risk' ELSE 'Churned' END AS churn_label,
  COUNT(*) AS customer_count, {mean('orders', 1)} AS avg_orders, {money_mean('spent')} AS avg_spent, {money('SUM(spent)')} AS at_risk_revenue
FROM spend WHERE customer_id IN (SELECT customer_id FROM customers) GROUP BY 1""",
    )
    cohort_churn = query(
        [TRANSACTIONS, DONE, CUSTOMERS,
         f"joined AS (SELECT customer_id, {month_number('signup_date')} AS born FROM customers)",
         "sizes AS (SELECT born, COUNT(*) AS total FROM joined GROUP BY born)",
         f"""seen AS (SELECT j.born, {month_number('o.order_date')} AS mon, COUNT(DISTINCT o.customer_id) AS active
  FROM joined j LEFT JOIN done o USING (customer_id) GROUP BY 1, 2)"""],
        f"""SELECT {label_of_month('born')} AS cohort_month, total AS total_customers, {label_of_month('mon')} AS order_month,
  CAST(mon - born AS INTEGER) AS months_since_join, active AS active_customers,
  {half_up('100 * active', 'total', 2)} AS retention_rate, {half_up('100 * (total - active)', 'total', 2)} AS churn_rate
FROM seen JOIN sizes USING (born)""",
    )
    signals = query(
        [TRANSACTIONS, CUSTOMERS, SESSIONS,
         f"""visits AS (SELECT customer_id, {mean('session_duration_sec', 0)} AS avg_session_duration,
  {half_up('100 * COUNT(*) FILTER (WHERE bounced)', 'COUNT(bounced)', 1)} AS bounce_rate FROM sessions GROUP BY customer_id)""",
         f"""signals AS (SELECT customer_id, COUNT(DISTINCT transaction_id) AS total_txns, {money_mean('total_amount')} AS avg_order_value,
  {money('SUM(total_amount)')} AS total_revenue, COUNT(*) FILTER (WHERE status = 'Returned') AS returns,
  COUNT(*) FILTER (WHERE status = 'Cancelled') AS cancellations, {days_since('MAX(order_date)')} AS days_since_last_order
  FROM transactions GROUP BY customer_id)"""],
        """SELECT s.*, c.segment, v.avg_session_duration, v.bounce_rate,
  CASE WHEN days_since_last_order > 90 AND returns > 2 THEN 'High Churn Risk'
    WHEN (days_since_last_order > 60 AND cancellations > 1) OR (days_since_last_order > 30 AND bounce_rate > 70) THEN 'Medium Churn Risk'
    ELSE 'Low Churn Risk' END AS churn_risk_level
FROM signals s JOIN customers c USING (customer_id) LEFT JOIN visits v USING (customer_id)""",
    )
    at_risk = query(
        [TRANSACTIONS, DONE, CUSTOMERS, LAST_ORDER],
        f"""SELECT segment, COUNT(DISTINCT customer_id) AS churned_customers, {money_mean('lifetime_value')} AS avg_ltv,
  {money('SUM(lifetime_value)')} AS total_revenue_at_risk, {half_up('SUM(' + days_since('signup_date') + ')', 'COUNT(*) * 365', 1)} AS avg_tenure_years
FROM customers LEFT JOIN last_order USING (customer_id) WHERE segment = 'Churned' OR idle > 90 GROUP BY segment""",
    )
    return {
        "churn_status_summary": status,
        "cohort_churn_rate": cohort_churn,
        "churn_signals": signals,
        "revenue_at_risk": at_risk,
    }


NTILES = """tiles AS (
  SELECT *, NTILE(5) OVER (ORDER BY recency DESC, customer_id) AS r, NTILE(5) OVER (ORDER BY frequency, customer_id) AS f,
    NTILE(5) OVER (ORDER BY monetary, customer_id) AS m FROM rfm)"""


def segmentation() -> dict[str, str]:
    named = f"named AS (SELECT *, {segment_case('r', 'f', 'm')} AS segment FROM tiles)"
    return {
        "rfm_ntile_scores": query(
            [TRANSACTIONS, DONE, RFM, NTILES, named],
            f"""SELECT customer_id, recency AS recency_days, frequency, {money('monetary')} AS monetary, CAST(r AS INTEGER) AS r_score,
  CAST(f AS INTEGER) AS f_score, CAST(m AS INTEGER) AS m_score, CONCAT(r, f, m) AS rfm_code,
  {half_up('r + f + m', '3', 2)} AS rfm_avg, segment AS rfm_segment FROM named""",
        ),
        "rfm_ntile_summary": query(
            [TRANSACTIONS, DONE, RFM, NTILES, named],
            f"""SELECT segment AS rfm_segment, COUNT(*) AS customer_count, {mean('recency', 1)} AS avg_recency_days,
  {mean('frequency', 1)} AS avg_orders, {money_mean('monetary')} AS avg_revenue, {money('SUM(monetary)')} AS total_revenue
FROM named GROUP BY segment""",
        ),
        "ltv_by_segment": query(
            [TRANSACTIONS, DONE, CUSTOMERS, "per AS (SELECT customer_id, COUNT(*) AS orders FROM done GROUP BY customer_id)"],
            f"""SELECT segment, COUNT(DISTINCT customer_id) AS customers, {money_mean('lifetime_value')} AS avg_ltv,
  {money('SUM(lifetime_value)')} AS total_ltv, {mean(days_since('signup_date'), 0)} AS avg_tenure_days, {mean('orders', 1)} AS avg_orders
FROM customers LEFT JOIN per USING (customer_id) GROUP BY segment""",
        ),
        "pareto_customers": query(
            [TRANSACTIONS, DONE, CUSTOMERS,
             """earned AS (SELECT customer_id, SUM(total_amount) AS revenue FROM done
  WHERE customer_id IN (SELECT customer_id FROM customers) GROUP BY customer_id)""",
             """placed AS (SELECT *, ROW_NUMBER() OVER (ORDER BY revenue DESC, customer_id) AS rank_num, COUNT(*) OVER () AS everyone,
  SUM(revenue) OVER () AS total, SUM(revenue) OVER (ORDER BY revenue DESC) AS running FROM earned)"""],
            f"""SELECT customer_id, segment, {money('revenue')} AS revenue, rank_num,
  {half_up('100 * revenue * 100', 'total * 100', 3)} AS pct_of_total, {half_up('100 * running * 100', 'total * 100', 2)} AS cumulative_pct
FROM placed JOIN customers USING (customer_id) WHERE rank_num <= everyone * 2 // 10""",
        ),
        "spend_tier_by_month": query(
            [TRANSACTIONS, DONE,
             f"monthly AS (SELECT customer_id, {month('order_date')} AS month, SUM(total_amount) AS spend FROM done GROUP BY 1, 2)"],
            f"""SELECT month, CASE WHEN spend < 100 THEN 'Minimal' WHEN spend < 1000 THEN 'Low Value' WHEN spend < 5000 THEN 'Mid Value' ELSE 'High Value' END AS spend_segment,
  COUNT(DISTINCT customer_id) AS customer_count, {money('SUM(spend)')} AS total_spend FROM monthly GROUP BY 1, 2""",
        ),
        "rfm_qcut": query(
            [TRANSACTIONS, DONE, RFM, RANKED, SCORED],
            f"""SELECT customer_id, recency, frequency, {money('monetary')} AS monetary, CAST(r AS INTEGER) AS r, CAST(f AS INTEGER) AS f,
  CAST(m AS INTEGER) AS m, CAST(100 * r + 10 * f + m AS INTEGER) AS rfm_score, segment FROM scored""",
        ),
        "rfm_segment_summary": query(
            [TRANSACTIONS, DONE, RFM, RANKED, SCORED],
            f"""SELECT segment, COUNT(*) AS customers, {mean('recency', 2)} AS avg_recency, {mean('frequency', 2)} AS avg_frequency,
  {money_mean('monetary')} AS avg_monetary, {money('SUM(monetary)')} AS total_revenue FROM scored GROUP BY segment""",
        ),
        "rfm_scaled": query(
            [TRANSACTIONS, DONE, RFM],
            "SELECT customer_id, " + ", ".join(
                f"ROUND((CAST({c} AS DOUBLE) - AVG(CAST({c} AS DOUBLE)) OVER ()) / STDDEV_POP(CAST({c} AS DOUBLE)) OVER (), 6) AS {c}_z"
                for c in ("recency", "frequency", "monetary")
            ) + " FROM rfm",
        ),
    }


def cohorts() -> dict[str, str]:
    first = [TRANSACTIONS, DONE, COHORT]
    active = "active AS (SELECT born, mon - born AS step, COUNT(DISTINCT customer_id) AS users FROM dated GROUP BY 1, 2)"
    sizes = "sizes AS (SELECT born, COUNT(DISTINCT customer_id) AS size FROM dated GROUP BY born)"
    earned = "earned AS (SELECT born, mon - born AS step, SUM(total_amount) AS revenue FROM dated GROUP BY 1, 2)"
    name = f"{label_of_month('born')} AS cohort_month"
    step = "CAST(step AS INTEGER)"
    running = "SUM(revenue) OVER (PARTITION BY born ORDER BY step)"
    quarter = "(EXTRACT(year FROM order_date) * 4 + EXTRACT(quarter FROM order_date) - 1)"
    return {
        "cohort_retention": query(
            [*first, active, sizes],
            f"""SELECT {name}, size AS cohort_size, {step} AS month_number, users AS active_users, {half_up('100 * users', 'size', 2)} AS retention_pct
FROM active JOIN sizes USING (born) WHERE step <= 11""",
        ),
        "cohort_aov": query(
            first,
            f"""SELECT {name}, {label_of_month('mon')} AS activity_month, CAST(mon - born AS INTEGER) AS month_number,
  COUNT(DISTINCT transaction_id) AS total_orders, {money_mean('total_amount')} AS avg_order_value, {money('SUM(total_amount)')} AS total_revenue
FROM dated GROUP BY born, mon""",
        ),
        "cohort_category": query(
            first,
            f"""SELECT {name}, category, CAST(mon - born AS INTEGER) AS months_since_join, COUNT(DISTINCT customer_id) AS buyers,
  {money('SUM(total_amount)')} AS revenue FROM dated GROUP BY born, mon, category""",
        ),
        "cohort_ltv": query(
            [*first, earned],
            f"SELECT {name}, {step} AS month_number, {money('revenue')} AS monthly_revenue, {money(running)} AS cumulative_revenue FROM earned",
        ),
        "retention_matrix": query(
            [*first, active, sizes],
            f"SELECT {name}, {step} AS month_number, {half_up('100 * users', 'size', 2)} AS retention_pct FROM active JOIN sizes USING (born)",
        ),
        "retention_matrix_wide": query(
            [*first, active, sizes],
            f"""SELECT {name}, string_agg(CAST({step} AS VARCHAR) || ':' || CAST({half_up('100 * users', 'size', 2)} AS VARCHAR), ' ' ORDER BY step) AS cells
FROM active JOIN sizes USING (born) GROUP BY born""",
        ),
        "ltv_curve": query(
            [*first, earned, sizes],
            f"""SELECT {name}, {step} AS month_number, {money(running)} / CAST(size AS DOUBLE) AS cumulative_avg_revenue
FROM earned JOIN sizes USING (born)""",
        ),
        "quarterly_retention": query(
            [TRANSACTIONS, DONE,
             f"placed AS (SELECT customer_id, {quarter} AS q, MIN({quarter}) OVER (PARTITION BY customer_id) AS born FROM done)",
             "counts AS (SELECT born, q - born AS step, COUNT(DISTINCT customer_id) AS users FROM placed GROUP BY 1, 2)",
             "cells AS (SELECT born, users AS size, UNNEST(range(0, 6)) AS step FROM counts WHERE step = 0)"],
            f"""SELECT CAST(born // 4 AS VARCHAR) || 'Q' || CAST(born % 4 + 1 AS VARCHAR) AS cohort_quarter, CAST(step AS INTEGER) AS period_num,
  {half_up('100 * users', 'size', 1)} AS retention_pct FROM cells LEFT JOIN counts USING (born, step)""",
        ),
    }


CALENDAR = """CAST(EXTRACT(week FROM order_date) AS INTEGER) AS week, strftime(order_date, '%Y-%m') AS month,
  CAST(EXTRACT(year FROM order_date) AS VARCHAR) || 'Q' || CAST(EXTRACT(quarter FROM order_date) AS VARCHAR) AS quarter,
  dayname(order_date) AS day_of_week, EXTRACT(isodow FROM order_date) >= 6 AS is_weekend"""
ORDER_COLUMNS = """transaction_id, customer_id, CAST(order_date AS VARCHAR) AS order_date, category, quantity,
  CAST(discount_pct AS DOUBLE) AS discount_pct, CAST(total_amount AS DOUBLE) AS total_amount, status"""
CLEAN = f"""cleaned AS (
  SELECT *, {CALENDAR} FROM (
    SELECT * FROM raw_transactions
    QUALIFY ROW_NUMBER() OVER (PARTITION BY transaction_id
      ORDER BY customer_id, order_date, quantity, discount_pct, total_amount, status, category) = 1)
  WHERE total_amount > 0)"""
TENURE = f"""people AS (
  SELECT *, days AS tenure_days,
    CASE WHEN days <= 0 THEN NULL WHEN days <= 90 THEN 'New (<3m)' WHEN days <= 365 THEN 'Growing (3-12m)'
      WHEN days <= 730 THEN 'Established (1-2y)' ELSE 'Veteran (2y+)' END AS tenure_band
  FROM (SELECT *, {days_since('signup_date')} AS days FROM customers))"""


def thousands(number: str, places: int) -> str:
    return f"format('{{:,.{places}f}}', CAST({number} AS DOUBLE))"


def report_lines() -> str:
    fixed = [
        f"# Weekly Behavioral Report — Week {WEEK}", "*Generated: 2001-08-02 06:00*", "", "## 📊 Key Metrics", "| Metric | Value |", "|---|---|",
        "", "## 🛒 Category Breakdown", "| category | revenue | orders |", "|---|---|---|", "", "## 👥 Customer Churn Risk",
        "| churn_risk | count |", "|---|---|", "",
    ]
    texts = ", ".join(f"('{line}')" for line in fixed)
    figures = {
        "Total Revenue": "'₹' || " + thousands("SUM(total_amount)", 2),
        "Total Orders": thousands("COUNT(*)", 0),
        "Unique Customers": thousands("COUNT(DISTINCT customer_id)", 0),
        "Avg Order Value": "'₹' || " + thousands(money_mean("total_amount"), 2),
    }
    parts = [f"SELECT value FROM (VALUES {texts}) AS t(value)"]
    parts += [f"SELECT '| {name} | ' || {value} || ' |' FROM sold WHERE week = {WEEK}" for name, value in figures.items()]
    parts.append("SELECT '| ' || category || ' | ' || CAST(SUM(total_amount) AS VARCHAR) || ' | ' || COUNT(*) || ' |' FROM sold GROUP BY category")
    parts.append(
        f"""SELECT '| ' || label || ' | ' || COUNT(customer_id) || ' |' FROM {in_given_order(['Active', 'Cooling', 'At Risk', 'Churned'])}
LEFT JOIN (customers JOIN idle USING (customer_id))
  ON place = CASE WHEN days <= 0 THEN -1 WHEN days <= 30 THEN 0 WHEN days <= 60 THEN 1 WHEN days <= 90 THEN 2 ELSE 3 END GROUP BY label"""
    )
    sold = "sold AS (SELECT * FROM cleaned WHERE status = 'Completed')"
    idle = f"idle AS (SELECT customer_id, {days_since('MAX(order_date)')} AS days FROM sold GROUP BY customer_id)"
    return query([RAW, CLEAN, CUSTOMERS, sold, idle], "\nUNION ALL ".join(parts))


def sources() -> dict[str, str]:
    window = query(
        [TRANSACTIONS],
        """SELECT transaction_id, customer_id, CAST(order_date AS VARCHAR) AS order_date, quantity, CAST(discount_pct AS DOUBLE) AS discount_pct,
  CAST(total_amount AS DOUBLE) AS total_amount, status FROM transactions WHERE order_date BETWEEN DATE '2000-01-15' AND DATE '2000-03-20'""",
    )
    return {
        "window_scan": window,
        "landed_window": window,
        "customers_from_csv": query(
            [CUSTOMERS],
            """SELECT CAST(customer_id AS VARCHAR) AS customer_id, CAST(signup_date AS VARCHAR) AS signup_date, age, gender, segment,
  CAST(lifetime_value AS DOUBLE) AS lifetime_value, country FROM customers""",
        ),
        "weekly_report_lines": report_lines(),
    }


def weekly() -> dict[str, str]:
    cleaned = [RAW, CLEAN]
    weeks = f"SELECT * FROM cleaned WHERE week = {WEEK} AND status = 'Completed'"
    contract = ("transaction_id", "customer_id", "order_date", "total_amount", "status")
    return {
        "etl_clean_transactions": query(
            cleaned, f"SELECT {ORDER_COLUMNS}, week, month, quarter, day_of_week, is_weekend FROM cleaned"
        ),
        "etl_customers": query(
            [CUSTOMERS, TENURE],
            """SELECT customer_id, country, CAST(signup_date AS VARCHAR) AS signup_date, age, gender, segment,
  CAST(lifetime_value AS DOUBLE) AS lifetime_value, tenure_days, tenure_band FROM people""",
        ),
        "etl_enriched": query(
            [*cleaned, CUSTOMERS, TENURE],
            f"""SELECT {ORDER_COLUMNS}, week, month, quarter, day_of_week, is_weekend, segment, tenure_band, country
FROM cleaned LEFT JOIN (SELECT customer_id, segment, tenure_band, country FROM people) USING (customer_id)""",
        ),
        "weekly_summary": query(
            [*cleaned, f"w AS ({weeks})"],
            f"""SELECT {WEEK} AS week, COALESCE({money('SUM(total_amount)')}, 0) AS revenue, COUNT(*) AS orders,
  COUNT(DISTINCT customer_id) AS unique_customers, {money_mean('total_amount')} AS avg_order_value FROM w""",
        ),
        "category_breakdown": query(
            cleaned,
            f"""SELECT category, {money('SUM(total_amount)')} AS revenue, COUNT(*) AS orders, {money_mean('total_amount')} AS avg_order_value
FROM cleaned WHERE status = 'Completed' GROUP BY category""",
        ),
        "segment_weekly_kpis": query(
            [*cleaned, CUSTOMERS],
            f"""SELECT week, segment, {money('SUM(total_amount)')} AS revenue, COUNT(DISTINCT customer_id) AS customers
FROM cleaned JOIN customers USING (customer_id) WHERE status = 'Completed' GROUP BY week, segment""",
        ),
        "churn_risk_summary": query(
            [TRANSACTIONS, DONE, CUSTOMERS, LAST_ORDER],
            f"""SELECT label AS churn_risk, COUNT(customer_id) AS count FROM {in_given_order(['Active', 'Cooling', 'At Risk', 'Churned'])}
LEFT JOIN (customers JOIN last_order USING (customer_id))
  ON place = CASE WHEN idle <= 0 THEN -1 WHEN idle <= 30 THEN 0 WHEN idle <= 60 THEN 1 WHEN idle <= 90 THEN 2 ELSE 3 END
GROUP BY label""",
        ),
        "null_profile": query(
            [RAW],
            "\nUNION ALL ".join(
                f"SELECT '{c}' AS \"column\", COUNT(*) - COUNT({c}) AS null_count FROM raw_transactions" for c in contract
            ),
        ),
        "duplicates_removed": query(
            [RAW],
            "SELECT COUNT(*) AS rows_in, COUNT(DISTINCT transaction_id) AS rows_kept, COUNT(*) - COUNT(DISTINCT transaction_id) AS removed FROM raw_transactions",
        ),
    }


def dashboards() -> dict[str, str]:
    buckets = ["Active (<30d)", "Cooling (30-60d)", "At Risk (60-90d)", "Churned (90d+)"]
    days = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    return {
        "kpi_overview": query(
            [TRANSACTIONS, DONE],
            f"""SELECT {money('SUM(total_amount)')} AS total_revenue, COUNT(*) AS total_orders,
  COUNT(DISTINCT customer_id) AS active_customers, {money_mean('total_amount')} AS avg_order_value FROM done""",
        ),
        "monthly_revenue_last18": query(
            [TRANSACTIONS, DONE],
            f"""SELECT {month('order_date')} AS month, {money('SUM(total_amount)')} AS revenue FROM done GROUP BY 1 ORDER BY 1 DESC LIMIT 18""",
        ),
        "revenue_by_category": query(
            [TRANSACTIONS, DONE], f"SELECT category, {money('SUM(total_amount)')} AS revenue FROM done GROUP BY category"
        ),
        "segment_distribution": query(
            [CUSTOMERS, "counts AS (SELECT segment, COUNT(*) AS customers FROM customers GROUP BY segment)"],
            f"SELECT segment, customers, {half_up('100 * customers', '(SELECT SUM(customers) FROM counts)', 1)} AS pct FROM counts",
        ),
        "orders_by_weekday": query(
            [TRANSACTIONS, DONE],
            f"""SELECT label AS dow, COUNT(transaction_id) AS orders FROM {in_given_order(days)}
LEFT JOIN done ON place = EXTRACT(isodow FROM order_date) - 1 GROUP BY label""",
        ),
        "inactivity_buckets": query(
            [TRANSACTIONS, DONE, LAST_ORDER,
             f"""counts AS (SELECT label AS bucket, COUNT(customer_id) AS customers FROM {in_given_order(buckets)}
  LEFT JOIN last_order ON place = CASE WHEN idle <= 30 THEN 0 WHEN idle <= 60 THEN 1 WHEN idle <= 90 THEN 2 ELSE 3 END GROUP BY label)"""],
            f"SELECT bucket, customers, {half_up('100 * customers', '(SELECT SUM(customers) FROM counts)', 1)} AS pct_of_base FROM counts",
        ),
        "churn_rate_by_segment": query(
            [TRANSACTIONS, DONE, CUSTOMERS, LAST_ORDER],
            """SELECT segment, CAST(COUNT(*) FILTER (WHERE idle > 90) AS DOUBLE) / COUNT(*) * 100 AS churn_rate
FROM customers LEFT JOIN last_order USING (customer_id) GROUP BY segment""",
        ),
        "order_frequency_histogram": query(
            [TRANSACTIONS, DONE,
             "per AS (SELECT customer_id, COUNT(*) AS orders FROM done GROUP BY customer_id)",
             "held AS (SELECT LEAST(orders, 30) AS x FROM per)",
             "span AS (SELECT MIN(x) AS low, MAX(x) - MIN(x) AS width FROM held)",
             "counts AS (SELECT LEAST((x - low) * 30 // width, 29) AS bin, COUNT(*) AS n FROM held, span GROUP BY 1)"],
            """SELECT CAST(b AS INTEGER) AS bin, CAST(low * 30 + b * width AS DOUBLE) / 30 AS bin_lo, CAST(low * 30 + (b + 1) * width AS DOUBLE) / 30 AS bin_hi,
  COALESCE(n, 0) AS customers, (SELECT CAST(SUM(orders) AS DOUBLE) / COUNT(*) FROM per) AS mean_orders,
  (SELECT CAST(MEDIAN(orders) AS DOUBLE) FROM per) AS median_orders
FROM (SELECT UNNEST(range(0, 30)) AS b) CROSS JOIN span LEFT JOIN counts ON b = bin""",
        ),
        "rfm_scatter_sample": query(
            [TRANSACTIONS, DONE, RFM, RANKED, DASHBOARD_SCORED],
            f"""SELECT segment, customer_id, recency, frequency, {money('monetary')} AS monetary FROM scored
QUALIFY ROW_NUMBER() OVER (PARTITION BY segment ORDER BY md5(CAST(customer_id AS VARCHAR)), customer_id) <= 300""",
        ),
        "revenue_by_rfm_segment": query(
            [TRANSACTIONS, DONE, RFM, RANKED, DASHBOARD_SCORED],
            f"SELECT segment, {money('SUM(monetary)')} AS revenue FROM scored GROUP BY segment",
        ),
        "conversion_by_source": query(
            [SESSIONS],
            """SELECT traffic_source, COUNT(*) AS sessions, COUNT(*) FILTER (WHERE converted) AS conversions,
  CAST(COUNT(*) FILTER (WHERE converted) AS DOUBLE) / COUNT(*) * 100 AS conversion_rate FROM sessions GROUP BY traffic_source""",
        ),
        "device_split": query(
            [SESSIONS, "counts AS (SELECT device, COUNT(*) AS sessions FROM sessions GROUP BY device)"],
            f"SELECT device, sessions, {half_up('100 * sessions', '(SELECT SUM(sessions) FROM counts)', 1)} AS pct FROM counts",
        ),
        "first_purchase_flag": query(
            [TRANSACTIONS],
            """SELECT transaction_id, customer_id,
  ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY order_date, transaction_id) = 1 AS is_first_purchase FROM transactions""",
        ),
    }


def churn_model() -> dict[str, str]:
    # The driver's 25 nations, sorted as text; the first of each list has no column.
    countries = sorted(f"NATION_{n}" for n in range(25))[1:]
    flags = [f"CAST(COALESCE(country = '{c}', FALSE) AS INTEGER) AS \"country_{c}\"" for c in countries]
    flags += [f"CAST(COALESCE(gender = '{g}', FALSE) AS INTEGER) AS \"gender_{g}\"" for g in ("Male", "Other")]
    bought = f"""bought AS (
  SELECT customer_id, COUNT(*) AS total_orders, SUM(total_amount) AS revenue, MAX(total_amount) AS top,
    COUNT(DISTINCT category) AS unique_categories, SUM(discount_pct) AS discounts,
    {days_since('MAX(order_date)')} AS recency_days, {days_since('MIN(order_date)')} AS first_order_days
  FROM done GROUP BY customer_id)"""
    undone = """undone AS (
  SELECT customer_id, COUNT(*) FILTER (WHERE status = 'Returned') AS returns, COUNT(*) FILTER (WHERE status = 'Cancelled') AS cancellations
  FROM transactions GROUP BY customer_id)"""
    visits = """visits AS (
  SELECT customer_id, COUNT(*) AS total_sessions, CAST(SUM(session_duration_sec) AS DOUBLE) / COUNT(*) AS avg_session_duration,
    CAST(SUM(pages_viewed) AS DOUBLE) / COUNT(*) AS avg_pages_viewed, CAST(COUNT(*) FILTER (WHERE bounced) AS DOUBLE) / COUNT(*) AS bounce_rate,
    CAST(COUNT(*) FILTER (WHERE converted) AS DOUBLE) / COUNT(*) AS conversion_rate
  FROM sessions GROUP BY customer_id)"""
    labelled = "labelled AS (SELECT customer_id, CAST(idle > 90 AS INTEGER) AS churned FROM last_order)"
    ranked = """ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY churned ORDER BY md5(CAST(customer_id AS VARCHAR)), customer_id) AS rn,
    (COUNT(*) OVER (PARTITION BY churned) * 40 + 100) // 200 AS cut FROM labelled)"""
    graded = f"""graded AS (
  SELECT CAST(recency > 90 AS INTEGER) AS y, CAST(1 AS DOUBLE) / (1 + frequency) AS score,
    CAST(CAST(1 AS DOUBLE) / (1 + frequency) > {SCORE_THRESHOLD} AS INTEGER) AS said FROM rfm),
per_score AS (SELECT score, SUM(y) AS pos, SUM(1 - y) AS neg FROM graded GROUP BY score),
curve AS (SELECT *, SUM(pos) OVER (ORDER BY score DESC) AS tp, SUM(neg) OVER (ORDER BY score DESC) AS fp FROM per_score),
cells AS (SELECT COUNT(*) FILTER (WHERE y = 0 AND said = 0) AS tn, COUNT(*) FILTER (WHERE y = 0 AND said = 1) AS fp,
  COUNT(*) FILTER (WHERE y = 1 AND said = 0) AS fn, COUNT(*) FILTER (WHERE y = 1 AND said = 1) AS tp FROM graded),
d AS (SELECT CAST(tn AS DOUBLE) AS tn, CAST(fp AS DOUBLE) AS fp, CAST(fn AS DOUBLE) AS fn, CAST(tp AS DOUBLE) AS tp FROM cells),
s AS (SELECT *, COALESCE(tn / NULLIF(tn + fn, 0), 0) AS p0, COALESCE(tp / NULLIF(tp + fp, 0), 0) AS p1, COALESCE(tn / NULLIF(tn + fp, 0), 0) AS r0,
  COALESCE(tp / NULLIF(tp + fn, 0), 0) AS r1, COALESCE(2 * tn / NULLIF(2 * tn + fn + fp, 0), 0) AS f0, COALESCE(2 * tp / NULLIF(2 * tp + fn + fp, 0), 0) AS f1,
  tn + fp AS n0, tp + fn AS n1 FROM d)"""
    values = {
        "precision_0": "p0", "recall_0": "r0", "f1_0": "f0", "support_0": "n0",
        "precision_1": "p1", "recall_1": "r1", "f1_1": "f1", "support_1": "n1",
        "accuracy": "(tn + tp) / (n0 + n1)",
        "macro_precision": "(p0 + p1) / 2", "macro_recall": "(r0 + r1) / 2", "macro_f1": "(f0 + f1) / 2",
        "weighted_precision": "(p0 * n0 + p1 * n1) / (n0 + n1)", "weighted_recall": "(r0 * n0 + r1 * n1) / (n0 + n1)",
        "weighted_f1": "(f0 * n0 + f1 * n1) / (n0 + n1)",
        "true_negatives": "tn", "false_positives": "fp", "false_negatives": "fn", "true_positives": "tp",
    }
    selects = [
        """SELECT 'roc_auc' AS metric, ROUND(CAST(SUM(neg * (2 * (tp - pos) + pos)) AS DOUBLE) / (2.0 * SUM(pos) * SUM(neg)), 4) AS value FROM curve""",
        "SELECT 'avg_precision', ROUND(SUM(pos * (CAST(tp AS DOUBLE) / (tp + fp))) / SUM(pos), 4) FROM curve",
        *[f"SELECT '{name}', ROUND({value}, 6) FROM s" for name, value in values.items()],
    ]
    return {
        "churn_features": query(
            [TRANSACTIONS, DONE, CUSTOMERS, SESSIONS, bought, undone, visits],
            f"""SELECT customer_id, total_orders, {money('revenue')} AS total_revenue, {money('revenue')} / total_orders AS avg_order_value,
  {money('top')} AS max_order_value, unique_categories, recency_days, first_order_days,
  CAST(discounts AS DOUBLE) / total_orders AS avg_discount, total_orders / (first_order_days / CAST(30 AS DOUBLE) + 1) AS order_frequency,
  returns, cancellations, CAST(returns AS DOUBLE) / total_orders AS return_rate, age, {days_since('signup_date')} AS tenure_days,
  total_sessions, avg_session_duration, avg_pages_viewed, bounce_rate, conversion_rate,
  {', '.join(flags)}, CAST(recency_days > 90 AS INTEGER) AS churned
FROM bought JOIN undone USING (customer_id) LEFT JOIN customers USING (customer_id) LEFT JOIN visits USING (customer_id)""",
        ),
        "churn_split": query(
            [TRANSACTIONS, DONE, LAST_ORDER, labelled, ranked],
            "SELECT customer_id, churned, rn <= cut AS is_test, CASE WHEN rn > cut THEN CAST((rn - cut - 1) % 5 AS INTEGER) END AS fold FROM ranked",
        ),
        "binary_eval_metrics": query([TRANSACTIONS, DONE, RFM, graded], "\nUNION ALL ".join(selects)),
    }


UNKNOWN_AMOUNTS = """done AS (SELECT * REPLACE (CASE WHEN customer_id % 4 = 0 THEN NULL ELSE total_amount END AS total_amount)
  FROM transactions WHERE status = 'Completed')"""


def unknown_amounts() -> dict[str, str]:
    """NULL comes first in ascending and last in descending order."""
    tiles = NTILES.replace("ORDER BY monetary,", "ORDER BY monetary NULLS FIRST,")
    named = f"named AS (SELECT *, {segment_case('r', 'f', 'm')} AS segment FROM tiles)"
    return {
        "rfm_ntile_nulls": query(
            [TRANSACTIONS, UNKNOWN_AMOUNTS, RFM, tiles, named],
            f"""SELECT customer_id, recency AS recency_days, frequency, {money('monetary')} AS monetary, CAST(r AS INTEGER) AS r_score,
  CAST(f AS INTEGER) AS f_score, CAST(m AS INTEGER) AS m_score, CONCAT(r, f, m) AS rfm_code,
  {half_up('r + f + m', '3', 2)} AS rfm_avg, segment AS rfm_segment FROM named""",
        ),
        "pareto_nulls": query(
            [TRANSACTIONS, UNKNOWN_AMOUNTS, CUSTOMERS,
             """earned AS (SELECT customer_id, SUM(total_amount) AS revenue FROM done
  WHERE customer_id IN (SELECT customer_id FROM customers) GROUP BY customer_id)""",
             """placed AS (SELECT *, ROW_NUMBER() OVER (ORDER BY revenue DESC NULLS LAST, customer_id) AS rank_num, COUNT(*) OVER () AS everyone,
  SUM(revenue) OVER () AS total, SUM(revenue) OVER (ORDER BY revenue DESC NULLS LAST) AS running FROM earned)"""],
            f"""SELECT customer_id, segment, {money('revenue')} AS revenue, rank_num,
  {half_up('100 * revenue * 100', 'total * 100', 3)} AS pct_of_total, {half_up('100 * running * 100', 'total * 100', 2)} AS cumulative_pct
FROM placed JOIN customers USING (customer_id) WHERE rank_num <= everyone * 9 // 10""",
        ),
    }


def deliveries() -> dict[str, str]:
    return {
        "transactions_from_csv": query(
            [TRANSACTIONS],
            """SELECT transaction_id, CAST(customer_id AS VARCHAR) AS customer_id,
  strftime(order_date, '%Y-%m-%d') || ' ' || lpad(CAST(customer_id % 24 AS VARCHAR), 2, '0') || ':30:00' AS order_date, quantity,
  CAST(discount_pct AS DOUBLE) AS discount_pct, CAST(total_amount AS DOUBLE) AS total_amount, status FROM transactions""",
        ),
        "sessions_from_csv": query(
            [SESSIONS],
            """SELECT CAST(session_id AS VARCHAR) AS session_id, CAST(customer_id AS VARCHAR) AS customer_id,
  CAST(CAST(e.ts AS DATE) AS VARCHAR) AS session_date, device, traffic_source, pages_viewed, session_duration_sec, bounced, converted
FROM sessions JOIN events e ON session_id = e.event_id""",
        ),
        "bad_cells": query(
            [TRANSACTIONS],
            """SELECT "column", bad_cells FROM (
  SELECT 'total_amount' AS "column", COUNT(*) FILTER (WHERE customer_id % 7 = 0) AS bad_cells FROM transactions
  UNION ALL SELECT 'order_date', COUNT(*) FILTER (WHERE customer_id % 11 = 0) FROM transactions
  UNION ALL SELECT 'quantity', 0 UNION ALL SELECT 'discount_pct', 0)""",
        ),
        "landing_counts": query(
            [TRANSACTIONS],
            """SELECT "column", null_count, bad_cells FROM (
  SELECT 'total_amount' AS "column", COUNT(*) FILTER (WHERE customer_id % 7 = 0 OR total_amount IS NULL) AS null_count,
    COUNT(*) FILTER (WHERE customer_id % 7 = 0) AS bad_cells FROM transactions
  UNION ALL SELECT 'order_date', COUNT(*) FILTER (WHERE customer_id % 11 = 0 OR order_date IS NULL), COUNT(*) FILTER (WHERE customer_id % 11 = 0) FROM transactions
  UNION ALL SELECT 'quantity', COUNT(*) FILTER (WHERE quantity IS NULL), 0 FROM transactions
  UNION ALL SELECT 'discount_pct', COUNT(*) FILTER (WHERE discount_pct IS NULL), 0 FROM transactions
  UNION ALL SELECT 'transaction_id', COUNT(*) FILTER (WHERE transaction_id IS NULL), NULL FROM transactions
  UNION ALL SELECT 'customer_id', COUNT(*) FILTER (WHERE customer_id IS NULL), NULL FROM transactions
  UNION ALL SELECT 'status', COUNT(*) FILTER (WHERE status IS NULL), NULL FROM transactions)""",
        ),
        "landed_empty": query([CUSTOMERS], "SELECT segment, COUNT(*) AS customers, CAST(0 AS BIGINT) AS sessions FROM customers GROUP BY segment"),
        "landed_upsert": query(
            [TRANSACTIONS,
             """moved AS (SELECT * REPLACE (CASE WHEN order_date BETWEEN DATE '1997-01-01' AND DATE '1997-03-31' AND customer_id % 5 = 0
    THEN order_date - 40 ELSE order_date END AS order_date) FROM transactions)"""],
            """SELECT transaction_id, customer_id, CAST(order_date AS VARCHAR) AS order_date, quantity, CAST(discount_pct AS DOUBLE) AS discount_pct,
  CAST(total_amount AS DOUBLE) AS total_amount, status FROM moved""",
        ),
        "sql_over_views": query(
            [TRANSACTIONS, DONE, CUSTOMERS],
            f"""SELECT country, COUNT(*) AS orders, COUNT(DISTINCT customer_id) AS buyers, {money('SUM(total_amount)')} AS revenue
FROM done JOIN customers USING (customer_id) GROUP BY country""",
        ),
    }


def fitted_facts() -> dict[str, str]:
    """Invariants of fitted results: who is scored, ranges, sums and sizes; not the fitted values."""
    scored = query([TRANSACTIONS, DONE], "SELECT DISTINCT customer_id, TRUE AS in_range FROM done")
    labelled = "labelled AS (SELECT customer_id, CAST(idle > 90 AS INTEGER) AS churned FROM last_order)"
    sizes = "sizes AS (SELECT churned, (COUNT(*) * 40 + 100) // 200 AS n FROM labelled GROUP BY churned)"
    ranged = ("roc_auc", "avg_precision", "accuracy", "precision_0", "precision_1", "recall_0", "recall_1", "f1_0", "f1_1")
    metrics = query(
        [TRANSACTIONS, DONE, LAST_ORDER, labelled, sizes],
        "SELECT 'support_' || churned AS metric, CAST(n AS DOUBLE) AS size, TRUE AS in_range FROM sizes"
        + "".join(f" UNION ALL SELECT '{name}', CAST(-1 AS DOUBLE), TRUE" for name in ranged),
    )
    return {
        "churn_proba_reloaded": scored,
        "churn_proba_facts": scored,
        "churn_model_facts": metrics,
        "churn_model_facts_rf": metrics,
        "churn_model_facts_lr": metrics,
        "kmeans_facts": query(
            [TRANSACTIONS, DONE],
            """SELECT COUNT(DISTINCT customer_id) AS customers, COUNT(DISTINCT customer_id) AS distinct_customers,
  CAST(5 AS BIGINT) AS clusters, CAST(0 AS INTEGER) AS least, CAST(4 AS INTEGER) AS most FROM done""",
        ),
        "kmeans_optimal_k_facts": "SELECT CAST(k AS INTEGER) AS k, TRUE AS inertia_does_not_rise, TRUE AS silhouette_in_range FROM range(2, 11) AS t(k)",
        # 18 figures without recency_days, 24 countries and 2 genders.
        "churn_importance_facts": "SELECT CAST(44 AS BIGINT) AS features, CAST(1 AS DOUBLE) AS total, TRUE AS in_range",
    }


#: Reports that there are as Spark SQL statements too, under the name sql_...: one and the same result.
STATED = (
    "churn_status_summary", "cohort_churn_rate", "churn_signals", "revenue_at_risk", "cohort_retention", "cohort_aov", "cohort_category",
    "cohort_ltv", "rfm_ntile_summary", "ltv_by_segment", "pareto_customers", "spend_tier_by_month",
)


def statements() -> dict[str, str]:
    known = {**churn_reports(), **segmentation(), **cohorts()}
    return {f"sql_{name}": known[name] for name in STATED}


def all_queries() -> dict[str, str]:
    return {**statements(), **churn_reports(), **segmentation(), **cohorts(), **sources(), **weekly(), **dashboards(), **churn_model(), **unknown_amounts(), **deliveries(), **fitted_facts()}
