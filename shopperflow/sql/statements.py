"""Twelve reports over the views customers, transactions, sessions, customer_scores and customer_ranks.

`today` is a session variable. The statements say the same as the functions of `operators`, whose names they have, and
reduce orders per customer before they join.
"""

from __future__ import annotations

# Fixed values in all of them: labels, limits in days, amounts and scores.

CHURN_STATUS_SUMMARY = """
WITH spend AS (
  SELECT customer_id, datediff(today, max(order_date)) AS days, count(DISTINCT transaction_id) AS orders, sum(total_amount) AS spent
  FROM transactions WHERE status = 'Completed' GROUP BY customer_id),
labelled AS (
  SELECT spend.*, CASE WHEN days > 180 THEN 'Churned' WHEN days > 90 THEN 'At Risk' WHEN days > 30 THEN 'Cooling Off' ELSE 'Active' END AS churn_label
  FROM spend JOIN customers USING (customer_id)),
-- A function of SQL text is not allowed in ORDER BY itself.
reported AS (
  SELECT churn_label, count(*) AS customer_count, ratio1(sum(orders), count(orders)) AS avg_orders,
    ratio2(sum(spent), count(spent)) AS avg_spent, round(sum(spent), 2) AS at_risk_revenue
  FROM labelled GROUP BY churn_label),
placed AS (SELECT *, field(churn_label, 'Active', 'Cooling Off', 'At Risk', 'Churned') AS place FROM reported)
SELECT * EXCEPT (place) FROM placed ORDER BY place
"""

COHORT_CHURN_RATE = """
WITH cohorts AS (SELECT customer_id, date_text(signup_date, '%Y-%m') AS cohort_month FROM customers),
sizes AS (SELECT cohort_month, count(*) AS total_customers FROM cohorts GROUP BY cohort_month),
active AS (SELECT DISTINCT customer_id AS buyer, date_text(order_date, '%Y-%m') AS order_month FROM transactions WHERE status = 'Completed'),
counts AS (
  SELECT cohort_month, order_month, count(buyer) AS active_customers
  FROM cohorts LEFT JOIN active ON customer_id = buyer GROUP BY cohort_month, order_month)
SELECT cohort_month, total_customers, order_month, period_diff(order_month, cohort_month) AS months_since_join, active_customers,
  ratio2(100 * active_customers, total_customers) AS retention_rate,
  ratio2(100 * (total_customers - active_customers), total_customers) AS churn_rate
FROM counts JOIN sizes USING (cohort_month) ORDER BY cohort_month, months_since_join
"""

CHURN_SIGNALS = """
WITH orders AS (
  SELECT customer_id, count(DISTINCT transaction_id) AS total_txns,
    ratio2(sum(total_amount), count(total_amount)) AS avg_order_value, round(sum(total_amount), 2) AS total_revenue,
    count_if(status = 'Returned') AS returns, count_if(status = 'Cancelled') AS cancellations, datediff(today, max(order_date)) AS days_since_last_order
  FROM transactions GROUP BY customer_id),
visits AS (
  SELECT customer_id, ratio0(sum(session_duration_sec), count(session_duration_sec)) AS avg_session_duration,
    ratio1(100 * sum(CAST(bounced AS INT)), count(bounced)) AS bounce_rate
  FROM sessions GROUP BY customer_id)
SELECT customer_id, segment, total_txns, avg_order_value, total_revenue, returns, cancellations, days_since_last_order,
  avg_session_duration, bounce_rate,
  CASE WHEN days_since_last_order > 90 AND returns > 2 THEN 'High Churn Risk'
    WHEN days_since_last_order > 60 AND cancellations > 1 THEN 'Medium Churn Risk'
    WHEN days_since_last_order > 30 AND bounce_rate > 70 THEN 'Medium Churn Risk' ELSE 'Low Churn Risk' END AS churn_risk_level
FROM orders JOIN customers USING (customer_id) LEFT JOIN visits USING (customer_id)
ORDER BY days_since_last_order DESC, customer_id
"""

REVENUE_AT_RISK = """
WITH lapsed AS (
  SELECT customer_id FROM transactions WHERE status = 'Completed' GROUP BY customer_id HAVING datediff(today, max(order_date)) > 90)
SELECT segment, count(DISTINCT customer_id) AS churned_customers,
  ratio2(sum(lifetime_value), count(lifetime_value)) AS avg_ltv, round(sum(lifetime_value), 2) AS total_revenue_at_risk,
  ratio1(sum(datediff(today, signup_date)), count(signup_date) * 365) AS avg_tenure_years
FROM customers WHERE segment = 'Churned' OR customer_id IN (SELECT customer_id FROM lapsed)
GROUP BY segment ORDER BY total_revenue_at_risk DESC
"""

_FIRST = """bought AS (
  SELECT customer_id, date_text(order_date, '%Y-%m') AS activity_month, {columns}
  FROM transactions WHERE status = 'Completed'{known} GROUP BY customer_id, date_text(order_date, '%Y-%m'){more}),
placed AS (SELECT *, min(activity_month) OVER (PARTITION BY customer_id) AS cohort_month FROM bought)"""

COHORT_RETENTION = f"""
WITH {_FIRST.format(columns="count(*) AS orders", known="", more="")},
counts AS (
  SELECT cohort_month, period_diff(activity_month, cohort_month) AS month_number, count(*) AS members, count(customer_id) AS active_users
  FROM placed GROUP BY ALL),
sized AS (SELECT *, max(CASE WHEN month_number = 0 THEN members END) OVER (PARTITION BY cohort_month) AS cohort_size FROM counts)
SELECT cohort_month, cohort_size, month_number, active_users, ratio2(100 * active_users, cohort_size) AS retention_pct
FROM sized WHERE month_number BETWEEN 0 AND 11 AND active_users > 0 ORDER BY cohort_month, month_number
"""

_ORDERS = "sum(total_amount) AS amount, count(total_amount) AS amounts, count(DISTINCT transaction_id) AS orders"
_NAMED = " AND customer_id IS NOT NULL"

COHORT_AOV = f"""
WITH {_FIRST.format(columns=_ORDERS, known=_NAMED, more="")}
SELECT cohort_month, activity_month, period_diff(activity_month, cohort_month) AS month_number, sum(orders) AS total_orders,
  ratio2(sum(amount), sum(amounts)) AS avg_order_value, round(sum(amount), 2) AS total_revenue
FROM placed GROUP BY cohort_month, activity_month, month_number ORDER BY cohort_month, month_number
"""

COHORT_CATEGORY = f"""
WITH {_FIRST.format(columns="category, sum(total_amount) AS amount", known=_NAMED, more=", category")}
SELECT cohort_month, category, period_diff(activity_month, cohort_month) AS months_since_join, count(*) AS buyers, round(sum(amount), 2) AS revenue
FROM placed GROUP BY cohort_month, category, months_since_join ORDER BY cohort_month, months_since_join, revenue DESC
"""

COHORT_LTV = f"""
WITH {_FIRST.format(columns="sum(total_amount) AS amount", known=_NAMED, more="")},
monthly AS (SELECT cohort_month, period_diff(activity_month, cohort_month) AS month_number, sum(amount) AS revenue FROM placed GROUP BY ALL)
SELECT cohort_month, month_number, round(revenue, 2) AS monthly_revenue,
  round(sum(revenue) OVER (PARTITION BY cohort_month ORDER BY month_number ROWS UNBOUNDED PRECEDING), 2) AS cumulative_revenue
FROM monthly ORDER BY cohort_month, month_number
"""

RFM_NTILE_SUMMARY = """
WITH named AS (
  SELECT *, CASE WHEN least(r_score, f_score, m_score) >= 4 THEN 'Champions' WHEN least(r_score, f_score, m_score) >= 3 THEN 'Loyal Customers'
    WHEN r_score >= 4 AND f_score <= 2 THEN 'New Customers' WHEN r_score >= 3 AND m_score >= 2 THEN 'Potential Loyalists'
    WHEN r_score <= 2 AND f_score >= 4 AND m_score >= 4 THEN 'At Risk' WHEN r_score <= 2 AND f_score >= 2 AND m_score >= 2 THEN 'Needs Attention'
    WHEN r_score = 1 AND f_score = 1 THEN 'Lost' ELSE 'Hibernating' END AS named_segment
  FROM customer_scores)
SELECT named_segment AS rfm_segment, count(*) AS customer_count, ratio1(sum(recency_days), count(recency_days)) AS avg_recency_days,
  ratio1(sum(frequency), count(frequency)) AS avg_orders,
  ratio2(sum(monetary), count(monetary)) AS avg_revenue, round(sum(monetary), 2) AS total_revenue
FROM named GROUP BY named_segment ORDER BY total_revenue DESC
"""

LTV_BY_SEGMENT = """
WITH orders AS (SELECT customer_id, count(*) AS order_count FROM transactions WHERE status = 'Completed' GROUP BY customer_id)
SELECT segment, count(DISTINCT customer_id) AS customers, ratio2(sum(lifetime_value), count(lifetime_value)) AS avg_ltv,
  round(sum(lifetime_value), 2) AS total_ltv,
  ratio0(sum(datediff(today, signup_date)), count(signup_date)) AS avg_tenure_days,
  ratio1(sum(order_count), count(order_count)) AS avg_orders
FROM customers LEFT JOIN orders USING (customer_id) GROUP BY segment ORDER BY avg_ltv DESC
"""

PARETO_CUSTOMERS = """
SELECT customer_id, segment, revenue, rank_num, ratio3(100 * revenue, total_revenue) AS pct_of_total,
  ratio2(100 * cumulative_revenue, total_revenue) AS cumulative_pct
FROM customer_ranks WHERE rank_num <= customers * 2 DIV 10 ORDER BY rank_num
"""

SPEND_TIER_BY_MONTH = """
WITH monthly AS (
  SELECT customer_id, date_text(order_date, '%Y-%m') AS month, sum(total_amount) AS spend
  FROM transactions WHERE status = 'Completed' GROUP BY customer_id, date_text(order_date, '%Y-%m'))
SELECT month, CASE WHEN spend >= 5000 THEN 'High Value' WHEN spend >= 1000 THEN 'Mid Value' WHEN spend >= 100 THEN 'Low Value' ELSE 'Minimal' END AS spend_segment,
  count(customer_id) AS customer_count, round(sum(spend), 2) AS total_spend
FROM monthly GROUP BY ALL ORDER BY month, spend_segment
"""

STATEMENTS = {
    "churn_status_summary": CHURN_STATUS_SUMMARY,
    "cohort_churn_rate": COHORT_CHURN_RATE,
    "churn_signals": CHURN_SIGNALS,
    "revenue_at_risk": REVENUE_AT_RISK,
    "cohort_retention": COHORT_RETENTION,
    "cohort_aov": COHORT_AOV,
    "cohort_category": COHORT_CATEGORY,
    "cohort_ltv": COHORT_LTV,
    "rfm_ntile_summary": RFM_NTILE_SUMMARY,
    "ltv_by_segment": LTV_BY_SEGMENT,
    "pareto_customers": PARETO_CUSTOMERS,
    "spend_tier_by_month": SPEND_TIER_BY_MONTH,
}
