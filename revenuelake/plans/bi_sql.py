"""The dashboard query pack as SQL with bound parameters, for tools that send text.

``publish_dashboard`` registers the tables as views, ``run_sql`` runs a query of ``BI_SQL`` over them. Values reach a query as
named parameters (``:as_of``), never as parts of its text. Each query gives the rows of the function of the same name in
``plans.bi``; averages and shares are doubles, as there.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from revenuelake.operators.staging import stg_payments
from revenuelake.sources.writers import publish_views

VIEW_NAMES = (
    "revenue_dashboard_metrics", "fraud_detection_alerts", "taxpayer_360", "payments", "paye_returns", "vat_returns", "taxpayers",
    "revenue_forecasts",
)

MONTH = "CAST(trunc(:as_of, 'MM') AS DATE)"
YEAR_BACK = "CAST(trunc(add_months(:as_of, -12), 'MM') AS DATE)"


def _share(numerator: str, denominator: str) -> str:
    return f"CAST({numerator} AS DOUBLE) / nullif(CAST({denominator} AS DOUBLE), 0D)"


BI_SQL: dict[str, str] = {
    "bi_latest_month_by_type": f"""
SELECT tax_type, sum(revenue_amount) AS total_revenue, count(DISTINCT unique_taxpayers) AS distinct_payer_counts,
    avg({_share('revenue_amount', 'transaction_count')}) AS avg_transaction
FROM revenue_dashboard_metrics
WHERE metric_type = 'monthly_revenue'
    AND metric_date = (SELECT max(metric_date) FROM revenue_dashboard_metrics WHERE metric_type = 'monthly_revenue')
GROUP BY tax_type ORDER BY total_revenue DESC NULLS FIRST, tax_type""",
    "bi_revenue_trend_12m": f"""
SELECT metric_date, tax_type, revenue_amount FROM revenue_dashboard_metrics
WHERE metric_type = 'monthly_revenue' AND metric_date >= {YEAR_BACK} ORDER BY metric_date, tax_type""",
    "bi_regional_heatmap": f"""
SELECT region, sum(revenue_amount) AS total_revenue, count(DISTINCT unique_taxpayers) AS distinct_payer_counts
FROM revenue_dashboard_metrics WHERE metric_type = 'regional_revenue' AND metric_date = {MONTH}
GROUP BY region ORDER BY total_revenue DESC NULLS FIRST, region""",
    "bi_target_vs_actual": f"""
SELECT tax_type, revenue_amount AS performance_percentage FROM revenue_dashboard_metrics
WHERE metric_type = 'target_vs_actual' AND metric_date = {MONTH}""",
    "bi_yoy": f"""
SELECT tax_type, metric_date, revenue_amount AS yoy_growth_percentage FROM revenue_dashboard_metrics
WHERE metric_type = 'yoy_growth' AND metric_date >= {YEAR_BACK} ORDER BY metric_date DESC, tax_type""",
    "bi_channel_distribution": f"""
WITH totals AS (
    SELECT payment_channel, sum(revenue_amount) AS total_revenue, count(DISTINCT unique_taxpayers) AS distinct_payer_counts
    FROM revenue_dashboard_metrics WHERE metric_type = 'channel_revenue' AND metric_date = {MONTH} GROUP BY payment_channel
)
SELECT *, {_share('total_revenue', '(SELECT sum(total_revenue) FROM totals)')} * 100 AS percentage
FROM totals ORDER BY total_revenue DESC NULLS FIRST, payment_channel""",
    "bi_alerts_by_priority": """
SELECT alert_priority, count(*) AS alert_count, avg(fraud_score) AS avg_risk_score,
    sum(CAST(potential_revenue_impact AS DECIMAL(28,6))) AS total_impact
FROM fraud_detection_alerts WHERE status = 'Open' GROUP BY alert_priority
ORDER BY CASE alert_priority WHEN 'Critical' THEN 1 WHEN 'High' THEN 2 WHEN 'Medium' THEN 3 ELSE 4 END""",
    "bi_top20_risk": """
SELECT taxpayer_name, alert_type, fraud_score, potential_revenue_impact, recommended_action
FROM (SELECT * FROM fraud_detection_alerts WHERE status = 'Open' ORDER BY alert_id LIMIT 20) ORDER BY alert_id""",
    "bi_alerts_by_type": """
SELECT alert_type, count(*) AS count, avg(fraud_score) AS avg_score, sum(CAST(potential_revenue_impact AS DECIMAL(28,6))) AS total_impact
FROM fraud_detection_alerts WHERE status = 'Open' GROUP BY alert_type ORDER BY count DESC, alert_type""",
    "bi_risk_by_sector": f"""
WITH flagged AS (SELECT DISTINCT taxpayer_id, 1 AS flag FROM fraud_detection_alerts WHERE status = 'Open'), counted AS (
    SELECT business_sector, count(p.taxpayer_id) AS total_taxpayers, count(flag) AS flagged_taxpayers
    FROM taxpayer_360 p LEFT JOIN flagged f ON p.taxpayer_id = f.taxpayer_id WHERE business_sector IS NOT NULL GROUP BY business_sector
)
SELECT *, {_share('flagged_taxpayers', 'total_taxpayers')} * 100 AS risk_percentage FROM counted ORDER BY risk_percentage DESC, business_sector""",
    "bi_taxpayer_profile": """
SELECT name, tin, taxpayer_type, region || ', ' || district AS location, business_sector, business_subsector, years_registered,
    employee_count, annual_turnover, filing_compliance_rate * 100 AS compliance_percentage, total_tax_paid, risk_category_calculated,
    engagement_score * 100 AS engagement_percentage
FROM taxpayer_360 WHERE taxpayer_id = :taxpayer_id""",
    "bi_payment_history": """
SELECT payment_date, tax_type, amount, payment_channel, payment_provider
FROM payments WHERE taxpayer_id = :taxpayer_id AND status = 'Completed' ORDER BY payment_date DESC NULLS FIRST, payment_id LIMIT 50""",
    "bi_compliance_timeline": """
WITH p AS (SELECT * FROM paye_returns WHERE taxpayer_id = :taxpayer_id), v AS (SELECT * FROM vat_returns WHERE taxpayer_id = :taxpayer_id)
SELECT coalesce(p.period_year, v.period_year) AS year, coalesce(p.period_month, v.period_quarter * 3) AS period,
    CASE WHEN p.return_id IS NOT NULL THEN 'PAYE' WHEN v.return_id IS NOT NULL THEN 'VAT' END AS tax_type,
    coalesce(p.status, v.status) AS status, coalesce(p.filing_date, v.filing_date) AS filing_date, coalesce(p.due_date, v.due_date) AS due_date,
    CASE WHEN coalesce(p.filing_date, v.filing_date) > coalesce(p.due_date, v.due_date) THEN 'Late' ELSE 'On Time' END AS filing_status
FROM p FULL OUTER JOIN v ON p.period_year = v.period_year ORDER BY year DESC, period DESC""",
    "bi_peer_comparison": """
SELECT p.name, p.total_tax_paid, p.filing_compliance_rate * 100 AS compliance_rate, p.employee_count, p.annual_turnover
FROM taxpayer_360 p JOIN (
    SELECT business_sector, business_size_category, total_tax_paid AS own_tax_paid FROM taxpayer_360 WHERE taxpayer_id = :taxpayer_id
) own ON p.business_sector = own.business_sector AND p.business_size_category = own.business_size_category
WHERE p.taxpayer_id <> :taxpayer_id ORDER BY abs(p.total_tax_paid - own_tax_paid), p.taxpayer_id LIMIT 10""",
    "bi_revenue_by_sector": f"""
WITH paid AS (
    SELECT taxpayer_id, tax_type, sum(amount) AS amount, count(amount) AS amounts
    FROM stg_payments WHERE payment_date BETWEEN :start AND :end GROUP BY taxpayer_id, tax_type
)
SELECT business_sector, tax_type, sum(amount) AS total_revenue, count(*) AS taxpayers, {_share('sum(amount)', 'sum(amounts)')} AS avg_payment
FROM paid JOIN taxpayers USING (taxpayer_id) WHERE business_sector IS NOT NULL
GROUP BY business_sector, tax_type ORDER BY total_revenue DESC NULLS FIRST, business_sector, tax_type""",
    "bi_compliance_by_region": """
SELECT region, avg(filing_compliance_rate) * 100 AS avg_compliance_rate, count(*) AS taxpayer_count, count_if(chronic_late_filer) AS chronic_late_filers
FROM taxpayer_360 GROUP BY region ORDER BY avg_compliance_rate DESC NULLS FIRST, region""",
    "bi_payment_delays": f"""
WITH paid AS (
    SELECT reference_number, payment_date, tax_type, count(*) AS payments FROM stg_payments
    WHERE payment_date >= {YEAR_BACK} AND reference_number IS NOT NULL GROUP BY reference_number, payment_date, tax_type
), due AS (
    SELECT return_id, coalesce(max(paye_due), max(vat_due)) AS due_date FROM (
        SELECT return_id, due_date AS paye_due, CAST(NULL AS DATE) AS vat_due FROM paye_returns
        UNION ALL SELECT return_id, NULL, due_date FROM vat_returns
    ) GROUP BY return_id
)
SELECT CAST(trunc(payment_date, 'MM') AS DATE) AS month, tax_type,
    {_share('sum(datediff(payment_date, due_date) * payments)', 'sum(payments)')} AS avg_delay_days, sum(payments) AS payment_count
FROM paid JOIN due ON reference_number = return_id WHERE due_date IS NOT NULL GROUP BY 1, 2 ORDER BY month DESC, tax_type""",
    "bi_forecast_30d": """
SELECT forecast_date, tax_type, predicted_revenue, lower_bound, upper_bound FROM revenue_forecasts
WHERE forecast_date BETWEEN :as_of AND date_add(:as_of, 30) ORDER BY forecast_date, tax_type""",
    "bi_forecast_vs_actual": """
WITH actual AS (
    SELECT payment_date, tax_type, sum(amount) AS amount FROM stg_payments
    WHERE payment_date >= date_add(:as_of, -30) AND payment_date < :as_of GROUP BY payment_date, tax_type
), compared AS (
    SELECT f.forecast_date, f.tax_type, f.predicted_revenue, coalesce(CAST(a.amount AS DOUBLE), 0D) AS actual_revenue,
        CAST(f.predicted_revenue AS DOUBLE) AS predicted
    FROM revenue_forecasts f LEFT JOIN actual a ON a.payment_date = f.forecast_date AND a.tax_type = f.tax_type
    WHERE f.forecast_date >= date_add(:as_of, -30) AND f.forecast_date < :as_of
)
SELECT forecast_date, tax_type, predicted_revenue, actual_revenue, actual_revenue - predicted AS variance,
    CASE WHEN predicted > 0 THEN (actual_revenue - predicted) / predicted * 100 ELSE 0D END AS variance_percentage
FROM compared ORDER BY forecast_date DESC, tax_type""",
}


def publish_dashboard(**tables: DataFrame) -> None:
    """Register the given tables (of ``VIEW_NAMES``) as views; payments bring the view of staged payments along."""
    unknown = sorted(set(tables) - set(VIEW_NAMES))
    if unknown:
        raise ValueError(f"unknown tables {unknown}")
    staged = {"stg_payments": stg_payments(tables["payments"])} if "payments" in tables else {}
    publish_views({**tables, **staged})


def run_sql(spark: SparkSession, name: str, **parameters: dt.date | str) -> DataFrame:
    """A query of the pack over the published views; a parameter that it does not have is an error."""
    text = BI_SQL[name]
    strange = sorted(p for p in parameters if f":{p}" not in text)
    if strange:
        raise ValueError(f"{name} has no parameters {strange}")
    return spark.sql(text, args=parameters)
