"""DuckDB text for every query that SQL can express.

The texts are written in the plain form (self-joins, ordered text aggregation, one global row number), so
that they check the rewrites the operators use. Named parts are added in front of a query as needed.
"""

from __future__ import annotations

import re

from revenuelake import constants as C
from revenuelake.checks.queries import ANOMALY_MONTHS, AS_OF, BI_SQL_INPUTS, RANGE, SEARCH, TAXPAYER
from revenuelake.operators.insights import feature_columns
from revenuelake.operators.quality import ACCEPTED_VALUES, NOT_NULL, RELATIONSHIPS, UNIQUE
from revenuelake.schemas import SCHEMAS
from revenuelake.sources.adapter import REALTIME_TAX_TYPES, VIEWS, view_sql
from revenuelake.sources.writers import CSV_TABLES

DAY = f"DATE '{AS_OF}'"
MONTH = f"DATE '{AS_OF.replace(day=1)}'"
YEAR_BACK = f"cast(date_trunc('month', {DAY} - INTERVAL 12 MONTH) AS date)"
BETWEEN = f"BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'"


def num(expression: str) -> str:
    """A number as the queries report it: double with four places."""
    return f"floor(cast({expression} AS double) * 1e4 + 0.5) / 1e4"


def text1(expression: str) -> str:
    return f"cast(cast(round({expression}, 1) AS decimal(20,1)) AS varchar)"


def month(column: str) -> str:
    return f"cast(date_trunc('month', {column}) AS date)"


def columns(table: str, prefix: str = "", skip: tuple[str, ...] = ()) -> str:
    listed = []
    for f in SCHEMAS[table].fields:
        if f.name not in skip:
            decimal = f.dataType.typeName() == "decimal"
            listed.append(f"{num(prefix + f.name)} AS {f.name}" if decimal else prefix + f.name)
    return ", ".join(listed)


ALERT = f"alert_id, taxpayer_id, alert_date, alert_type, {num('risk_score')} AS risk_score, description, status"
STATUS = "CASE WHEN filing_date IS NULL THEN 'Not Filed' WHEN filing_date > due_date THEN 'Late' ELSE 'On Time' END"
PRIORITY = "CASE WHEN {s} >= 0.8 THEN 'Critical' WHEN {s} >= 0.6 THEN 'High' WHEN {s} >= 0.4 THEN 'Medium' ELSE 'Low' END"
SIZE = (
    "CASE WHEN annual_turnover < 1000000 THEN 'Small' WHEN annual_turnover < 10000000 THEN 'Medium' "
    "WHEN annual_turnover < 100000000 THEN 'Large' ELSE 'Very Large' END"
)
YEARS = f"cast(date_part('year', age({DAY}, registration_date)) AS int)"
BAND = "CASE WHEN {p} <= 0 THEN NULL WHEN {p} <= 0.3 THEN 'Low' WHEN {p} <= 0.6 THEN 'Medium' WHEN {p} <= 0.8 THEN 'High' ELSE 'Critical' END"

PARTS: dict[str, str] = {name: view_sql(name) for name in VIEWS}
PARTS |= {
    "t_completed": "SELECT * FROM payments WHERE status = 'Completed'",
    # compliance
    "t_paye": f"""
SELECT taxpayer_id, count(*) AS expected, count(*) FILTER (status = 'Filed') AS filed,
  count(*) FILTER (filing_date <= due_date) AS punctual,
  avg(date_diff('day', due_date, filing_date)) FILTER (filing_date > due_date) AS delay
FROM paye_returns GROUP BY taxpayer_id""",
    "t_vat": f"""
SELECT taxpayer_id, count(*) AS expected, count(*) FILTER (status = 'Filed') AS filed,
  count(*) FILTER (filing_date <= due_date) AS punctual,
  avg(date_diff('day', due_date, filing_date)) FILTER (filing_date > due_date) AS delay
FROM vat_returns GROUP BY taxpayer_id""",
    "t_behavior": """
SELECT c.taxpayer_id, count(DISTINCT c.payment_id) AS total_payments, sum(c.amount) AS total_amount_paid,
  count(DISTINCT c.payment_channel) AS payment_channels_used,
  count(*) FILTER (c.payment_date <= coalesce(w.due_date, s.due_date)) AS on_time_payments
FROM t_completed c LEFT JOIN paye_returns w ON w.return_id = c.reference_number
  LEFT JOIN vat_returns s ON s.return_id = c.reference_number
GROUP BY c.taxpayer_id""",
    "t_filing": """
SELECT taxpayer_id, coalesce(p.expected, 0) AS total_paye_returns_expected, coalesce(p.filed, 0) AS paye_returns_filed,
  coalesce(p.punctual, 0) AS paye_on_time, coalesce(p.delay, 0) AS avg_paye_days_late,
  coalesce(v.expected, 0) AS total_vat_returns_expected, coalesce(v.filed, 0) AS vat_returns_filed,
  coalesce(v.punctual, 0) AS vat_on_time, coalesce(v.delay, 0) AS avg_vat_days_late,
  coalesce((coalesce(p.filed, 0) + coalesce(v.filed, 0))::double / nullif(coalesce(p.expected, 0) + coalesce(v.expected, 0), 0), 0) AS filing_compliance_rate,
  coalesce(p.delay, 0) > 30 OR coalesce(v.delay, 0) > 30 AS chronic_late_filer,
  2 * (coalesce(p.filed, 0) + coalesce(v.filed, 0)) < coalesce(p.expected, 0) + coalesce(v.expected, 0) AS low_filing_rate
FROM taxpayers LEFT JOIN t_paye p USING (taxpayer_id) LEFT JOIN t_vat v USING (taxpayer_id)""",
    # profile
    "t_paid": f"""
SELECT taxpayer_id, coalesce(sum(amount) FILTER (tax_type = 'PAYE'), 0) AS total_paye_paid,
  coalesce(sum(amount) FILTER (tax_type = 'VAT'), 0) AS total_vat_paid,
  coalesce(sum(amount) FILTER (tax_type = 'Corporate Tax'), 0) AS total_corporate_tax_paid,
  sum(amount) AS total_tax_paid, min(payment_date) AS first_payment_date, max(payment_date) AS last_payment_date,
  count(DISTINCT strftime(payment_date, '%Y-%m')) AS active_payment_months
FROM t_completed GROUP BY taxpayer_id""",
    "t_assets": """
SELECT taxpayer_id,
  (SELECT count(DISTINCT company_reg_no) FROM companies_registry c WHERE c.taxpayer_id = t.taxpayer_id) AS companies_owned,
  (SELECT count(DISTINCT vehicle_reg_no) FROM vehicle_registry v WHERE v.taxpayer_id = t.taxpayer_id) AS vehicles_owned,
  (SELECT count(DISTINCT property_id) FROM land_registry l WHERE l.taxpayer_id = t.taxpayer_id) AS properties_owned,
  (SELECT sum(purchase_value) FROM vehicle_registry v WHERE v.taxpayer_id = t.taxpayer_id) AS total_vehicle_value,
  (SELECT sum(valuation) FROM land_registry l WHERE l.taxpayer_id = t.taxpayer_id) AS total_property_value
FROM taxpayers t""",
    "t_flags": """
SELECT taxpayer_id, count(*) AS fraud_alert_count, max(risk_score) AS max_fraud_risk_score,
  string_agg(alert_type, '; ' ORDER BY alert_type) AS fraud_alert_types
FROM fraud_alerts WHERE status <> 'Closed' GROUP BY taxpayer_id""",
    "t_profile": f"""
SELECT taxpayer_id, tin, name, taxpayer_type, registration_date, {YEARS} AS years_registered, email, phone, district,
  region, business_sector, business_subsector, employee_count, annual_turnover, t_filing.* EXCLUDE (taxpayer_id),
  coalesce(total_paye_paid, 0) AS total_paye_paid, coalesce(total_vat_paid, 0) AS total_vat_paid,
  coalesce(total_corporate_tax_paid, 0) AS total_corporate_tax_paid, coalesce(total_tax_paid, 0) AS total_tax_paid,
  first_payment_date, last_payment_date, coalesce(active_payment_months, 0) AS active_payment_months,
  companies_owned, vehicles_owned, properties_owned, coalesce(total_vehicle_value, 0) AS total_vehicle_value,
  coalesce(total_property_value, 0) AS total_property_value, coalesce(fraud_alert_count, 0) AS fraud_alert_count,
  coalesce(max_fraud_risk_score, 0) AS fraud_risk_score, fraud_alert_types,
  CASE WHEN max_fraud_risk_score > 0.7 THEN 'Critical' WHEN chronic_late_filer OR low_filing_rate THEN 'High'
    WHEN filing_compliance_rate < 0.5 THEN 'Medium' WHEN filing_compliance_rate < 0.8 THEN 'Low' ELSE 'Very Low'
  END AS risk_category_calculated,
  {SIZE} AS business_size_category,
  if(email IS NULL, 0.0, 0.2)::double + if(active_payment_months > 12, 0.3, active_payment_months * 0.025)::double
    + filing_compliance_rate * 0.5::double AS engagement_score
FROM taxpayers JOIN t_filing USING (taxpayer_id) JOIN t_assets USING (taxpayer_id)
  LEFT JOIN t_paid USING (taxpayer_id) LEFT JOIN t_flags USING (taxpayer_id)""",
    # revenue
    "t_months": f"""
SELECT {month('payment_date')} AS metric_date, tax_type, sum(amount) AS revenue, count(DISTINCT taxpayer_id) AS payers, count(*) AS n
FROM t_completed GROUP BY ALL""",
    "t_region_months": f"""
SELECT {month('payment_date')} AS metric_date, tax_type, region, sum(amount) AS revenue, count(DISTINCT taxpayer_id) AS payers, count(*) AS n
FROM t_completed JOIN taxpayers USING (taxpayer_id) GROUP BY ALL""",
    "t_channel_months": f"""
SELECT {month('payment_date')} AS metric_date, tax_type, payment_channel, sum(amount) AS revenue, count(DISTINCT taxpayer_id) AS payers, count(*) AS n
FROM t_completed GROUP BY ALL""",
    "t_days": f"""
SELECT payment_date AS metric_date, tax_type, sum(amount) AS revenue, count(DISTINCT taxpayer_id) AS payers, count(*) AS n
FROM t_completed WHERE payment_date >= {DAY} - INTERVAL 24 MONTH GROUP BY ALL""",
    "t_ytd": """
SELECT a.metric_date, a.tax_type, (SELECT sum(b.revenue) FROM t_months b WHERE b.tax_type = a.tax_type
  AND year(b.metric_date) = year(a.metric_date) AND b.metric_date <= a.metric_date) AS revenue FROM t_months a""",
    "t_yoy": """
SELECT a.metric_date, a.tax_type, (a.revenue::double - b.revenue::double) / b.revenue::double * 100 AS revenue
FROM t_months a LEFT JOIN t_months b ON b.tax_type = a.tax_type AND b.metric_date + INTERVAL 1 YEAR = a.metric_date""",
    "t_goal": f"""
SELECT tax_type, sum(revenue)::double * 1.15 AS goal FROM t_months
WHERE metric_date >= {DAY} - INTERVAL 1 YEAR AND metric_date < {DAY} GROUP BY tax_type""",
    "t_share": f"""
SELECT metric_date, tax_type, revenue::double / (goal / 12) * 100 AS revenue FROM t_months JOIN t_goal USING (tax_type)
WHERE year(metric_date) = year({DAY})""",
    "t_metrics": """
SELECT metric_date, 'daily_revenue' AS metric_type, tax_type, NULL::varchar AS region, NULL::varchar AS payment_channel,
  revenue::double AS revenue_amount, payers AS unique_taxpayers, n AS transaction_count FROM t_days
UNION ALL SELECT metric_date, 'monthly_revenue', tax_type, NULL, NULL, revenue::double, payers, n FROM t_months
UNION ALL SELECT metric_date, 'regional_revenue', tax_type, region, NULL, revenue::double, payers, n FROM t_region_months
UNION ALL SELECT metric_date, 'channel_revenue', tax_type, NULL, payment_channel, revenue::double, payers, n FROM t_channel_months
UNION ALL SELECT metric_date, 'ytd_revenue', tax_type, NULL, NULL, revenue::double, NULL, NULL FROM t_ytd
UNION ALL SELECT metric_date, 'yoy_growth', tax_type, NULL, NULL, revenue, NULL, NULL FROM t_yoy
UNION ALL SELECT metric_date, 'target_vs_actual', tax_type, NULL, NULL, revenue, NULL, NULL FROM t_share""",
    # rules: the self-join forms
    "t_vat_drop": """
SELECT n.taxpayer_id, n.period_year, n.period_quarter, n.total_sales AS current_sales,
  sum(o.total_sales)::double / count(o.total_sales) AS avg_previous_sales,
  (n.total_sales::double - avg_previous_sales) / nullif(avg_previous_sales, 0) * 100 AS sales_change_pct
FROM vat_returns n JOIN vat_returns o ON o.taxpayer_id = n.taxpayer_id
  AND (n.period_year - o.period_year) * 4 + n.period_quarter - o.period_quarter BETWEEN 1 AND 4
WHERE n.status = 'Filed' GROUP BY n.taxpayer_id, n.period_year, n.period_quarter, n.total_sales
HAVING count(o.return_id) > 1""",
    "t_salaries": """
SELECT taxpayer_id, period_year, sum(gross_salaries) AS annual_salaries, any_value(annual_turnover) AS annual_turnover,
  sum(gross_salaries)::double / any_value(annual_turnover)::double * 100 AS salary_to_revenue_ratio
FROM paye_returns JOIN taxpayers USING (taxpayer_id)
WHERE status = 'Filed' AND annual_turnover > 0 AND taxpayer_type = 'Corporate' GROUP BY taxpayer_id, period_year""",
    "t_spread": f"""
SELECT taxpayer_id, count(DISTINCT payment_channel) AS channel_switches,
  stddev_samp(amount::double) / nullif((sum(amount)::double / count(amount)), 0) AS payment_variance,
  count(*) FILTER (hour(created_at) < 8 OR hour(created_at) > 18) AS odd_hour_payments
FROM t_completed WHERE payment_date >= {DAY} - INTERVAL {ANOMALY_MONTHS} MONTH GROUP BY taxpayer_id""",
    "t_peers": """
SELECT a.taxpayer_id, a.business_sector, a.business_size_category, a.total_tax_paid,
  sum(b.total_tax_paid)::double / count(b.total_tax_paid) AS peer_avg_tax,
  (a.total_tax_paid::double - peer_avg_tax) / nullif(peer_avg_tax, 0) * 100 AS variance_from_peers
FROM t_profile a JOIN t_profile b ON a.business_sector = b.business_sector
  AND a.business_size_category = b.business_size_category AND a.taxpayer_id <> b.taxpayer_id
WHERE a.total_tax_paid > 0 GROUP BY a.taxpayer_id, a.business_sector, a.business_size_category, a.total_tax_paid
HAVING count(*) >= 5""",
    "t_a_vat": f"""
SELECT taxpayer_id, name AS taxpayer_name, '{C.VAT_DROP_TYPE}' AS alert_type,
  'VAT sales dropped by ' || {text1('abs(sales_change_pct)')} || '% in Q' || period_quarter || ' ' || period_year AS alert_description,
  least(abs(sales_change_pct) / 100, 1.0::double) AS fraud_score,
  (avg_previous_sales - current_sales::double) * 0.15::double AS potential_revenue_impact, '{C.VAT_DROP_ACTION}' AS recommended_action
FROM t_vat_drop JOIN taxpayers USING (taxpayer_id) WHERE sales_change_pct < -30""",
    "t_a_paye": f"""
SELECT taxpayer_id, name AS taxpayer_name, '{C.PAYE_MISMATCH_TYPE}' AS alert_type,
  'Salary to revenue ratio is ' || {text1('salary_to_revenue_ratio')} || '% - industry average is 25-40%' AS alert_description,
  (CASE WHEN salary_to_revenue_ratio >= 15 THEN 0.4 WHEN salary_to_revenue_ratio >= 10 THEN 0.6 ELSE 0.8 END)::double AS fraud_score,
  annual_salaries::double * 0.1::double AS potential_revenue_impact, '{C.PAYE_MISMATCH_ACTION}' AS recommended_action
FROM t_salaries JOIN taxpayers USING (taxpayer_id) WHERE NOT salary_to_revenue_ratio BETWEEN 20 AND 80""",
    "t_a_payment": f"""
SELECT taxpayer_id, name AS taxpayer_name, '{C.PAYMENT_TYPE}' AS alert_type,
  concat('High payment variance (', {text1('payment_variance * 100')}, '%) with ', channel_switches, ' channel switches') AS alert_description,
  least(payment_variance + channel_switches * 0.1::double, 1.0::double) AS fraud_score,
  total_tax_paid::double * 0.05::double AS potential_revenue_impact, '{C.PAYMENT_ACTION}' AS recommended_action
FROM t_spread JOIN t_profile USING (taxpayer_id) WHERE payment_variance > 2 OR channel_switches > 3""",
    "t_a_peer": f"""
SELECT p.taxpayer_id, name AS taxpayer_name, '{C.PEER_TYPE}' AS alert_type,
  'Paying ' || {text1('abs(variance_from_peers)')} || '% less than similar businesses in ' || p.business_sector AS alert_description,
  least(abs(variance_from_peers) / 100, 1.0::double) AS fraud_score,
  peer_avg_tax - p.total_tax_paid::double AS potential_revenue_impact, '{C.PEER_ACTION}' AS recommended_action
FROM t_peers p JOIN taxpayers t ON t.taxpayer_id = p.taxpayer_id WHERE variance_from_peers < -50""",
    "t_a_filing": f"""
SELECT taxpayer_id, name AS taxpayer_name, '{C.NONCOMPLIANCE_TYPE}' AS alert_type,
  concat('Filing compliance rate only ', {text1('filing_compliance_rate * 100')}, '% with ', fraud_alert_count, ' previous alerts') AS alert_description,
  greatest(1 - filing_compliance_rate, fraud_risk_score::double) AS fraud_score,
  total_tax_paid::double * 0.2::double AS potential_revenue_impact, '{C.NONCOMPLIANCE_ACTION}' AS recommended_action
FROM t_profile WHERE filing_compliance_rate < 0.5 OR fraud_alert_count >= 3""",
    "t_alerts": f"""
SELECT row_number() OVER (ORDER BY round(fraud_score, 6) DESC, taxpayer_id, alert_type, alert_description, potential_revenue_impact) AS alert_id, *,
  {PRIORITY.format(s='fraud_score')} AS alert_priority, {DAY} AS created_date, 'Open' AS status
FROM (FROM t_a_vat UNION ALL FROM t_a_paye UNION ALL FROM t_a_payment UNION ALL FROM t_a_peer UNION ALL FROM t_a_filing)
WHERE fraud_score >= 0.4""",
    # stand-in forecasts and scores
    "t_forecast30": """
SELECT payment_date + 30 AS forecast_date, tax_type, cast(sum(amount) * 0.9 AS decimal(15,2)) AS predicted_revenue,
  cast(sum(amount) * 0.8 AS decimal(15,2)) AS lower_bound, cast(sum(amount) * 1.1 AS decimal(15,2)) AS upper_bound
FROM t_completed GROUP BY payment_date, tax_type""",
    "t_forecast20": """
SELECT payment_date + 20 AS forecast_date, tax_type, cast(sum(amount) * 0.9 AS decimal(15,2)) AS predicted_revenue,
  cast(sum(amount) * 0.8 AS decimal(15,2)) AS lower_bound, cast(sum(amount) * 1.1 AS decimal(15,2)) AS upper_bound
FROM t_completed GROUP BY payment_date, tax_type""",
    "t_scores": """
SELECT taxpayer_id, round(1 - compliance_score::double, 2) AS p FROM taxpayers
WHERE taxpayer_type IN ('Corporate', 'Partnership')""",
    "t_ml_alerts": f"""
SELECT taxpayer_id, {DAY} AS alert_date, '{C.ML_ALERT_TYPE}' AS alert_type, round(p, 2)::double AS risk_score,
  concat('Fraud probability: ', cast(round(p * 100, 2)::decimal(20,2) AS varchar), '%. ',
    if(missing_paye > 0, concat(missing_paye, ' missing PAYE returns. '), NULL),
    if(missing_vat > 0, concat(missing_vat, ' missing VAT returns. '), NULL)) AS description, 'Open' AS status
FROM (SELECT taxpayer_id, p,
    (SELECT count(*) FROM paye_returns r WHERE r.taxpayer_id = s.taxpayer_id AND r.status = 'Overdue' AND r.due_date >= {DAY} - INTERVAL 6 MONTH) AS missing_paye,
    (SELECT count(*) FROM vat_returns r WHERE r.taxpayer_id = s.taxpayer_id AND r.status = 'Overdue' AND r.due_date >= {DAY} - INTERVAL 6 MONTH) AS missing_vat
  FROM t_scores s WHERE p > 0.7)""",
    # features
    "t_weekly": f"""
SELECT t.taxpayer_id, taxpayer_type, business_sector, annual_turnover, employee_count, compliance_score, risk_category,
  {YEARS} AS years_active, if(risk_category = 'High' AND compliance_score < 0.5, 1, 0) AS is_fraud,
  coalesce(w.n, 0) AS paye_returns_count, coalesce(w.late, 0) AS paye_late_rate, coalesce(v.n, 0) AS vat_returns_count,
  coalesce(v.late, 0) AS vat_late_rate, coalesce(v.mean, 0) AS avg_vat_sales, coalesce(v.spread, 0) AS vat_sales_stddev,
  coalesce(v.lowest, 0) AS min_vat_sales, coalesce(v.highest, 0) AS max_vat_sales, coalesce(p.n, 0) AS payment_count,
  p.mean AS avg_payment_amount, p.spread AS payment_amount_stddev, coalesce(p.channels, 0) AS payment_channels_used
FROM taxpayers t
LEFT JOIN (SELECT taxpayer_id, count(*) AS n, (count(*) FILTER (filing_date > due_date)) / count(*)::double AS late
  FROM paye_returns GROUP BY 1) w USING (taxpayer_id)
LEFT JOIN (SELECT taxpayer_id, count(*) AS n, (count(*) FILTER (filing_date > due_date)) / count(*)::double AS late,
    (sum(total_sales)::double / count(total_sales)) AS mean, stddev_samp(total_sales::double) AS spread, min(total_sales) AS lowest, max(total_sales) AS highest
  FROM vat_returns GROUP BY 1) v USING (taxpayer_id)
LEFT JOIN (SELECT taxpayer_id, count(*) AS n, (sum(amount)::double / count(amount)) AS mean, stddev_samp(amount::double) AS spread,
    count(DISTINCT payment_channel) AS channels FROM payments GROUP BY 1) p USING (taxpayer_id)
WHERE taxpayer_type IN ('Corporate', 'Partnership') AND (w.n > 0 OR v.n > 0)""",
    "t_extended": f"""
SELECT t.taxpayer_id, annual_turnover, coalesce(employee_count, 0) AS employee_count, compliance_score, {YEARS} AS years_active,
  coalesce(p.n, 0) AS total_payments, coalesce(p.channels, 0) AS payment_channels, p.mean AS avg_payment,
  p.spread AS payment_stddev, p.highest AS max_payment, coalesce(w.n, 0) AS paye_returns,
  coalesce(w.delay, 0) AS avg_paye_delay, coalesce(v.n, 0) AS vat_returns,
  if((risk_category = 'High' AND compliance_score < 0.5) OR EXISTS (FROM fraud_alerts f
    WHERE f.taxpayer_id = t.taxpayer_id AND f.risk_score > 0.7), 1, 0) AS is_fraud
FROM taxpayers t
LEFT JOIN (SELECT taxpayer_id, count(*) AS n, avg(coalesce(greatest(date_diff('day', due_date, filing_date), 0), 0)) AS delay
  FROM paye_returns GROUP BY 1) w USING (taxpayer_id)
LEFT JOIN (SELECT taxpayer_id, count(*) AS n FROM vat_returns GROUP BY 1) v USING (taxpayer_id)
LEFT JOIN (SELECT taxpayer_id, count(*) AS n, (sum(amount)::double / count(amount)) AS mean, stddev_samp(amount::double) AS spread,
    max(amount) AS highest, count(DISTINCT payment_channel) AS channels FROM payments GROUP BY 1) p USING (taxpayer_id)
WHERE taxpayer_type IN ('Corporate', 'Partnership')""",
    # transactions
    "t_checked": """
SELECT *, ts::date AS tx_date, count(*) OVER (PARTITION BY ts::date, taxpayer_id, amount, tax_type) > 1 AS is_duplicate,
  amount::double > quantile_cont(amount::double, 0.95) OVER (PARTITION BY ts::date, tax_type) AS is_high
FROM realtime_transactions""",
    "t_tx": "SELECT *, hour(ts) AS tx_hour, isodow(ts) > 5 AS off_day FROM realtime_transactions",
}


def oracle(sql: str) -> str:
    """The query with the parts it names, directly or through other parts, in front."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in PARTS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(PARTS[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    head = ",\n".join(f"{name} AS ({PARTS[name]})" for name in needed)
    return f"WITH {head}\n{sql}" if needed else sql


def _metric(part: str, kind: str, region: str = "NULL::varchar", channel: str = "NULL::varchar", counted: bool = True) -> str:
    payers, n = ("payers", "n") if counted else ("NULL::bigint", "NULL::bigint")
    return (
        f"SELECT metric_date, '{kind}' AS metric_type, tax_type, {region} AS region, {channel} AS payment_channel, "
        f"{num('revenue')} AS revenue_amount, {payers} AS unique_taxpayers, {n} AS transaction_count FROM {part}"
    )


def _alerts(part: str) -> str:
    return (
        f"SELECT taxpayer_id, taxpayer_name, alert_type, alert_description, {num('fraud_score')} AS fraud_score, "
        f"{num('potential_revenue_impact')} AS potential_revenue_impact, recommended_action FROM {part}"
    )


def _staged(table: str, extra: str = "") -> str:
    return (
        f"SELECT {columns(table)}, {STATUS} AS filing_status, "
        f"cast(date_diff('day', due_date, filing_date) AS int) AS days_late{extra} FROM {table}"
    )


def _compliance(tax: str) -> str:
    return (
        f"SELECT taxpayer_id, expected AS total_{tax}_returns_expected, filed AS {tax}_returns_filed, "
        f"punctual AS {tax}_on_time, {num('delay')} AS avg_{tax}_days_late FROM t_{tax}"
    )


FILING = (
    f"{num('filing_compliance_rate')} AS filing_compliance_rate, total_paye_returns_expected, paye_returns_filed, paye_on_time, "
    f"{num('avg_paye_days_late')} AS avg_paye_days_late, total_vat_returns_expected, vat_returns_filed, vat_on_time, "
    f"{num('avg_vat_days_late')} AS avg_vat_days_late, chronic_late_filer, low_filing_rate"
)
PAID = ", ".join(f"{num(c)} AS {c}" for c in ("total_paye_paid", "total_vat_paid", "total_corporate_tax_paid", "total_tax_paid"))
PROFILE_SELECT = f"""SELECT taxpayer_id, tin, name, taxpayer_type, registration_date, years_registered, email, phone, district,
  region, business_sector, business_subsector, employee_count, {num('annual_turnover')} AS annual_turnover, {FILING}, {PAID},
  first_payment_date, last_payment_date, active_payment_months, companies_owned, vehicles_owned, properties_owned,
  {num('total_vehicle_value')} AS total_vehicle_value, {num('total_property_value')} AS total_property_value, fraud_alert_count,
  {num('fraud_risk_score')} AS fraud_risk_score, fraud_alert_types, risk_category_calculated, business_size_category,
  {num('engagement_score')} AS engagement_score, timestamp '{AS_OF} 00:00:00' AS last_updated FROM t_profile"""

SUMMARY = f"""SELECT payment_date AS date, tax_type, payment_channel, region, {num('sum(amount)')} AS total_amount,
  count(*) AS transaction_count, count(DISTINCT taxpayer_id) AS unique_taxpayers
FROM payments JOIN taxpayers USING (taxpayer_id) GROUP BY ALL"""

WEEKLY_NUMBERS = [
    "annual_turnover", "compliance_score", "paye_late_rate", "vat_late_rate", "avg_vat_sales", "vat_sales_stddev",
    "min_vat_sales", "max_vat_sales", "avg_payment_amount", "payment_amount_stddev",
]
EXTENDED_NUMBERS = [
    "annual_turnover", "compliance_score", "avg_payment", "payment_stddev", "max_payment", "avg_paye_delay",
]


def _rounded(names: list[str], fill: bool = False) -> str:
    return ", ".join(f"{num(f'coalesce({n}, 0)' if fill else n)} AS {n}" for n in names)


def _one_hot() -> str:
    flags = [(f"channel_{c.lower().replace(' ', '_')}", "payment_channel", c) for c in C.PAYMENT_CHANNELS]
    flags += [(f"type_{t}", "tax_type", t) for t in REALTIME_TAX_TYPES]
    assert [f[0] for f in flags] == feature_columns(tax_types=REALTIME_TAX_TYPES)[4:]
    return ", ".join(f"cast({column} = '{value}' AS int) AS {name}" for name, column, value in flags)


def _checks() -> str:
    """Failures of every declared check of the four tables, counted with plain subqueries."""
    rows = []
    given = ("taxpayers", "paye_returns", "vat_returns", "payments")
    for table, column in UNIQUE:
        rows.append(("unique", table, column, f"SELECT count(*) FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"))
    for table, column in [c for c in NOT_NULL if c[0] in given]:
        rows.append(("not_null", table, column, f"SELECT count(*) FROM {table} WHERE {column} IS NULL"))
    for table, column in [c for c in RELATIONSHIPS if c[0] in given]:
        rows.append(("relationships", table, column, f"SELECT count(*) FROM {table} WHERE {column} NOT IN (SELECT taxpayer_id FROM taxpayers)"))
    for table, column, accepted in ACCEPTED_VALUES:
        if table != "corporate_tax":
            values = ", ".join(f"'{v}'" for v in accepted)
            rows.append(("accepted_values", table, column, f"SELECT count(*) FROM {table} WHERE {column} NOT IN ({values})"))
    return "\nUNION ALL ".join(
        f"SELECT '{check}' AS \"check\", '{table}' AS \"table\", '{column}' AS \"column\", ({count}) AS failures"
        for check, table, column, count in rows
    )


TX_CHECKED = f"""SELECT transaction_id, taxpayer_id, ts, payment_channel, {num('amount')} AS amount, tax_type,
  if(is_high OR is_duplicate, 'Under Review', 'Completed') AS status, risk_flag, tx_date,
  CASE WHEN is_high THEN '{C.HIGH_AMOUNT_WARNING}' WHEN is_duplicate THEN '{C.DUPLICATE_WARNING}' ELSE '{C.VALID}' END AS validation_status,
  is_duplicate AND (is_high OR is_duplicate) AS is_duplicate FROM t_checked"""

PAYMENT_COLUMNS = columns("payments")

_PLAIN: dict[str, str] = {
    "read_csv_table": f"SELECT {columns('taxpayers')} FROM taxpayers",
    "copy_csv_load": "\nUNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in CSV_TABLES),
    "copy_csv_rejects": f"""SELECT payment_id, CASE right(payment_id, 2) WHEN '07' THEN 'malformed payment_date' WHEN '13' THEN 'malformed amount'
  WHEN '29' THEN 'malformed period_year; missing amount' END AS reason,
  if(right(payment_id, 2) IN ('07', '13', '29'), NULL, {num('amount')}) AS amount,
  if(right(payment_id, 2) IN ('07', '13', '29'), NULL, payment_date) AS payment_date FROM payments""",
    "overwrite_table": f"SELECT {columns('vat_returns')} FROM vat_returns",
    "read_table": f"SELECT {columns('payments', skip=('created_at',))} FROM payments",
    "write_csv": f"SELECT {ALERT} FROM fraud_alerts",
    "materialize_summary": SUMMARY,
    "publish_views": f"SELECT {STATUS} AS filing_status, count(*) AS n_returns, {num('sum(gross_salaries)')} AS gross_salaries FROM paye_returns GROUP BY 1",
    "region_districts": "SELECT r_regionkey AS region_id, r_name AS region_name, n_name AS district FROM nation JOIN region ON r_regionkey = n_regionkey",
    "upsert_forecasts": f"""SELECT forecast_date, tax_type, {num('predicted_revenue')} AS predicted_revenue, {num('lower_bound')} AS lower_bound,
  {num('upper_bound')} AS upper_bound, stamp AS created_at
FROM (SELECT *, timestamp '{AS_OF} 00:00:00' AS stamp FROM t_forecast20 UNION ALL SELECT *, timestamp '2001-07-01 00:00:00' FROM t_forecast30)
QUALIFY row_number() OVER (PARTITION BY forecast_date, tax_type ORDER BY stamp DESC) = 1""",
    "upsert_stored_forecasts": f"""SELECT forecast_date, tax_type, {num('predicted_revenue')} AS predicted_revenue, {num('lower_bound')} AS lower_bound,
  {num('upper_bound')} AS upper_bound, stamp AS created_at
FROM (SELECT *, timestamp '{AS_OF} 00:00:00' AS stamp FROM (SELECT * FROM t_forecast20 EXCEPT SELECT * FROM t_forecast30)
  UNION ALL SELECT *, timestamp '2001-07-01 00:00:00' FROM t_forecast30)
QUALIFY row_number() OVER (PARTITION BY forecast_date, tax_type ORDER BY stamp DESC) = 1""",
    "update_compliance_scores": f"""SELECT {columns('taxpayers', skip=('compliance_score', 'updated_at'))},
  {num("cast(greatest(least((paye_returns_filed + vat_returns_filed)::double / nullif(total_paye_returns_expected + total_vat_returns_expected, 0), 0.95), 0.1) AS decimal(3,2))")} AS compliance_score,
  timestamp '{AS_OF} 00:00:00' AS updated_at FROM taxpayers JOIN t_filing USING (taxpayer_id)""",
    "apply_fraud_scores": f"""SELECT {columns('taxpayers', skip=('compliance_score', 'updated_at', 'risk_category'))},
  if(p IS NULL, risk_category, {BAND.format(p='p')}) AS risk_category,
  {num("if(p IS NULL, compliance_score, cast(least(greatest(1 - p, 0.1), 0.95) AS decimal(3,2)))")} AS compliance_score,
  if(p IS NULL, updated_at, timestamp '{AS_OF} 00:00:00') AS updated_at FROM taxpayers LEFT JOIN t_scores USING (taxpayer_id)""",
    "close_open_alerts": f"SELECT {ALERT.removesuffix('status')} if(status = 'Open', 'Closed', status) AS status FROM fraud_alerts",
    "redate_old_alerts": f"SELECT {ALERT.replace('alert_date,', '')}, CASE WHEN alert_date < DATE '2001-01-01' THEN DATE '2001-07-01' ELSE alert_date END AS alert_date FROM fraud_alerts",
    "append_alerts": f"SELECT {ALERT} FROM fraud_alerts UNION ALL SELECT (SELECT coalesce(max(alert_id), 0) FROM fraud_alerts) + row_number() OVER (ORDER BY taxpayer_id, alert_type, description), taxpayer_id, alert_date, alert_type, risk_score, description, status FROM t_ml_alerts",
    "touch_updated_at": f"SELECT {columns('taxpayers', skip=('updated_at',))}, if(risk_category = 'High', timestamp '{AS_OF} 00:00:00', updated_at) AS updated_at FROM taxpayers",
    "stg_taxpayers": f"SELECT {columns('taxpayers')} FROM taxpayers",
    "stg_paye_returns": _staged("paye_returns"),
    "stg_vat_returns": _staged("vat_returns", f", {num('coalesce(output_vat::double / nullif(greatest(total_sales, 0), 0)::double, 0)')} AS vat_rate_effective"),
    "stg_payments": f"SELECT {PAYMENT_COLUMNS}, cast(year(payment_date) AS int) AS payment_year, cast(month(payment_date) AS int) AS payment_month, cast(quarter(payment_date) AS int) AS payment_quarter FROM t_completed",
    "paye_compliance": _compliance("paye"),
    "vat_compliance": _compliance("vat"),
    "payment_behavior": f"SELECT taxpayer_id, total_payments, {num('total_amount_paid')} AS total_amount_paid, payment_channels_used, on_time_payments FROM t_behavior",
    "taxpayer_compliance": f"""SELECT taxpayer_id, name, taxpayer_type, risk_category, {num('compliance_score')} AS original_compliance_score, {FILING},
  coalesce(total_payments, 0) AS total_payments, {num('coalesce(total_amount_paid, 0)')} AS total_amount_paid,
  coalesce(payment_channels_used, 0) AS payment_channels_used, coalesce(on_time_payments, 0) AS on_time_payments
FROM taxpayers JOIN t_filing USING (taxpayer_id) LEFT JOIN t_behavior USING (taxpayer_id)""",
    "filing_summary_simple": "SELECT taxpayer_id, expected AS total_paye_returns, filed AS paye_returns_filed, punctual AS paye_on_time FROM t_paye",
    "filing_summary_simple_vat": "SELECT taxpayer_id, expected AS total_vat_returns, filed AS vat_returns_filed, punctual AS vat_on_time FROM t_vat",
    "revenue_daily": f"SELECT payment_date, tax_type, payment_channel, {num('sum(amount)')} AS daily_amount, count(DISTINCT taxpayer_id) AS unique_taxpayers, count(*) AS transaction_count FROM t_completed GROUP BY ALL",
    "revenue_monthly": f"SELECT {month('payment_date')} AS revenue_month, tax_type, {num('sum(amount)')} AS monthly_amount, count(DISTINCT taxpayer_id) AS unique_taxpayers, count(*) AS transaction_count, {num('(sum(amount)::double / count(amount))')} AS avg_payment_amount FROM t_completed GROUP BY ALL",
    "revenue_regional": f"SELECT region, district, tax_type, {month('payment_date')} AS revenue_month, {num('sum(amount)')} AS amount, count(DISTINCT taxpayer_id) AS unique_taxpayers FROM t_completed JOIN taxpayers USING (taxpayer_id) GROUP BY ALL",
    "revenue_sector": f"""SELECT business_sector, business_subsector, tax_type, cast(date_trunc('quarter', payment_date) AS date) AS revenue_quarter,
  {num('sum(amount)')} AS amount, count(DISTINCT taxpayer_id) AS unique_taxpayers, {num('(sum(amount)::double / count(amount))')} AS avg_payment
FROM t_completed JOIN taxpayers USING (taxpayer_id) WHERE business_sector IS NOT NULL GROUP BY ALL""",
    "revenue_aggregations": f"""WITH joined AS (SELECT c.*, region, district, business_sector, business_subsector,
    {month('payment_date')} AS m, cast(date_trunc('quarter', payment_date) AS date) AS q FROM t_completed c JOIN taxpayers USING (taxpayer_id))
SELECT 'daily' AS aggregation_level, payment_date AS period_date, NULL::date AS period_month, NULL::date AS period_quarter, tax_type, payment_channel,
  NULL AS region, NULL AS district, NULL AS business_sector, {num('sum(amount)')} AS amount, count(DISTINCT taxpayer_id) AS unique_taxpayers,
  count(*) AS transaction_count, NULL::double AS avg_payment_amount FROM t_completed GROUP BY payment_date, tax_type, payment_channel
UNION ALL SELECT 'monthly', m, m, NULL, tax_type, NULL, NULL, NULL, NULL, {num('sum(amount)')}, count(DISTINCT taxpayer_id), count(*), {num('(sum(amount)::double / count(amount))')}
  FROM (SELECT *, {month('payment_date')} AS m FROM t_completed) GROUP BY m, tax_type
UNION ALL SELECT 'regional', m, m, NULL, tax_type, NULL, region, district, NULL, {num('sum(amount)')}, count(DISTINCT taxpayer_id), NULL, NULL
  FROM joined GROUP BY m, tax_type, region, district
UNION ALL SELECT 'sector', q, NULL, q, tax_type, NULL, NULL, NULL, business_sector, {num('sum(amount)')}, count(DISTINCT taxpayer_id), NULL, {num('(sum(amount)::double / count(amount))')}
  FROM joined WHERE business_sector IS NOT NULL GROUP BY q, tax_type, business_sector, business_subsector""",
    "metric_daily": _metric("t_days", "daily_revenue"),
    "metric_monthly": _metric("t_months", "monthly_revenue"),
    "metric_regional": _metric("t_region_months", "regional_revenue", region="region"),
    "metric_channel": _metric("t_channel_months", "channel_revenue", channel="payment_channel"),
    "metric_ytd": _metric("t_ytd", "ytd_revenue", counted=False),
    "metric_yoy": _metric("t_yoy", "yoy_growth", counted=False),
    "yearly_targets": f"SELECT cast(date_trunc('year', metric_date) AS date) AS target_year, tax_type, {num('sum(revenue)::double * 1.15')} AS annual_target FROM t_months WHERE metric_date >= {DAY} - INTERVAL 1 YEAR AND metric_date < {DAY} GROUP BY 1, 2",
    "metric_target_vs_actual": _metric("t_share", "target_vs_actual", counted=False),
    "revenue_dashboard_metrics": f"SELECT * REPLACE ({num('revenue_amount')} AS revenue_amount) FROM t_metrics",
    "revenue_dashboard_simple": f"SELECT * REPLACE ({num('revenue_amount')} AS revenue_amount) FROM t_metrics WHERE metric_type IN ('monthly_revenue', 'regional_revenue', 'channel_revenue')",
    "revenue_summary": SUMMARY,
    "revenue_contribution": f"SELECT taxpayer_id, {PAID}, first_payment_date, last_payment_date, active_payment_months FROM t_paid",
    "external_assets": f"SELECT taxpayer_id, companies_owned, vehicles_owned, properties_owned, {num('total_vehicle_value')} AS total_vehicle_value, {num('total_property_value')} AS total_property_value FROM t_assets",
    "fraud_indicators": f"SELECT taxpayer_id, fraud_alert_count, {num('max_fraud_risk_score')} AS max_fraud_risk_score, fraud_alert_types FROM t_flags",
    "taxpayer_360": PROFILE_SELECT,
    "taxpayer_360_simple": f"""WITH open_flags AS (SELECT taxpayer_id, count(*) AS n, max(risk_score) AS top, string_agg(alert_type, '; ' ORDER BY alert_type) AS types
    FROM fraud_alerts WHERE status = 'Open' GROUP BY 1),
  used AS (SELECT taxpayer_id, count(DISTINCT payment_channel) AS channels FROM t_completed GROUP BY 1)
SELECT {columns('taxpayers')}, {num('coalesce(total_paye_paid, 0)')} AS total_paye_paid, {num('coalesce(total_vat_paid, 0)')} AS total_vat_paid,
  {num('coalesce(total_tax_paid, 0)')} AS total_tax_paid, coalesce(channels, 0) AS payment_channels_used, first_payment_date, last_payment_date,
  total_paye_returns_expected AS total_paye_returns, paye_returns_filed, paye_on_time, total_vat_returns_expected AS total_vat_returns,
  vat_returns_filed, vat_on_time, {num('filing_compliance_rate')} AS filing_compliance_rate, coalesce(n, 0) AS fraud_alert_count,
  {num('coalesce(top, 0)')} AS fraud_risk_score, types AS fraud_alert_types, {YEARS} AS years_registered
FROM taxpayers JOIN t_filing USING (taxpayer_id) LEFT JOIN t_paid USING (taxpayer_id) LEFT JOIN used USING (taxpayer_id) LEFT JOIN open_flags USING (taxpayer_id)""",
    "risk_category": "SELECT taxpayer_id, risk_category_calculated FROM t_profile",
    "size_category": f"SELECT {SIZE} AS business_size_category, count(*) AS n_taxpayers FROM taxpayers GROUP BY 1",
    "engagement_score": f"SELECT taxpayer_id, {num('engagement_score')} AS engagement_score FROM t_profile",
    "vat_drop": f"SELECT taxpayer_id, period_year, period_quarter, {num('current_sales')} AS current_sales, {num('avg_previous_sales')} AS avg_previous_sales, {num('sales_change_pct')} AS sales_change_pct FROM t_vat_drop",
    "paye_revenue_mismatch": f"SELECT taxpayer_id, period_year, {num('annual_salaries')} AS annual_salaries, {num('annual_turnover')} AS annual_turnover, {num('salary_to_revenue_ratio')} AS salary_to_revenue_ratio FROM t_salaries",
    "payment_anomalies": f"SELECT taxpayer_id, channel_switches, {num('payment_variance')} AS payment_variance, odd_hour_payments FROM t_spread",
    "peer_anomalies": f"SELECT taxpayer_id, business_sector, business_size_category, {num('total_tax_paid')} AS total_tax_paid, {num('peer_avg_tax')} AS peer_avg_tax, {num('variance_from_peers')} AS variance_from_peers FROM t_peers",
    "alerts_vat_drop": _alerts("t_a_vat"),
    "alerts_paye_mismatch": _alerts("t_a_paye"),
    "alerts_payment": _alerts("t_a_payment"),
    "alerts_peer": _alerts("t_a_peer"),
    "alerts_noncompliance": _alerts("t_a_filing"),
    "fraud_detection_alerts": _alerts("t_alerts").replace("SELECT ", "SELECT alert_id, alert_priority, created_date, status, ", 1),
    "fraud_alerts_enriched": f"SELECT {ALERT}, name AS taxpayer_name, business_sector, region, {PRIORITY.format(s='risk_score')} AS alert_priority FROM fraud_alerts JOIN taxpayers USING (taxpayer_id) WHERE status = 'Open'",
    "pattern_revenue_drop": f"""WITH q AS (SELECT taxpayer_id, cast(date_trunc('quarter', payment_date) AS date) AS quarter_day, sum(amount)::double AS amount FROM payments GROUP BY 1, 2),
  placed AS (SELECT *, row_number() OVER (PARTITION BY taxpayer_id ORDER BY quarter_day) AS i FROM q),
  rolled AS (SELECT a.taxpayer_id, a.quarter_day, a.amount, a.i, avg(b.amount) AS mean FROM placed a JOIN placed b
    ON a.taxpayer_id = b.taxpayer_id AND b.i BETWEEN a.i - 3 AND a.i GROUP BY ALL)
SELECT taxpayer_id, cast(quarter_day + INTERVAL 3 MONTH AS date) + 29 AS alert_date, '{C.REVENUE_DROP_TYPE}' AS alert_type,
  {num('least(0.95::double, abs(amount - mean) / mean)')} AS risk_score,
  'Revenue dropped by ' || {text1('abs(amount - mean) / mean * 100')} || '% compared to 4-quarter average' AS description, 'Open' AS status
FROM rolled WHERE i >= 4 AND (amount - mean) / mean < -0.3 AND taxpayer_id IN (SELECT taxpayer_id FROM q GROUP BY 1 HAVING count(*) > 4)""",
    "pattern_channel_anomaly": f"""SELECT taxpayer_id, {DAY} AS alert_date, '{C.CHANNEL_ANOMALY_TYPE}' AS alert_type,
  {num('least(0.8, count(DISTINCT payment_channel) * 0.2)')} AS risk_score,
  concat('Using ', count(DISTINCT payment_channel), ' different payment channels - possible structuring') AS description, 'Open' AS status
FROM payments GROUP BY taxpayer_id HAVING count(DISTINCT payment_channel) > 3""",
    "pattern_below_industry": f"""WITH industry AS (SELECT business_sector, tax_type, (sum(amount)::double / count(amount)) AS mean FROM payments JOIN taxpayers USING (taxpayer_id) GROUP BY 1, 2),
  own AS (SELECT taxpayer_id, business_sector, tax_type, (sum(amount)::double / count(amount)) AS mean FROM payments JOIN taxpayers USING (taxpayer_id) GROUP BY 1, 2, 3)
SELECT taxpayer_id, {DAY} AS alert_date, '{C.BELOW_INDUSTRY_TYPE}' AS alert_type, {num('least(0.85::double, 1 - own.mean / industry.mean)')} AS risk_score,
  tax_type || ' payments ' || {text1('abs((own.mean - industry.mean) / industry.mean) * 100')} || '% below industry average' AS description, 'Open' AS status
FROM own JOIN industry USING (business_sector, tax_type) WHERE (own.mean - industry.mean) / industry.mean < -0.5""",
    "bi_latest_month_by_type": f"""SELECT tax_type, {num('sum(revenue_amount)')} AS total_revenue, count(DISTINCT unique_taxpayers) AS distinct_payer_counts,
  {num('avg(revenue_amount / transaction_count)')} AS avg_transaction FROM t_metrics
WHERE metric_type = 'monthly_revenue' AND metric_date = (SELECT max(metric_date) FROM t_months) GROUP BY tax_type""",
    "bi_revenue_trend_12m": f"SELECT metric_date, tax_type, {num('revenue_amount')} AS revenue_amount FROM t_metrics WHERE metric_type = 'monthly_revenue' AND metric_date >= {YEAR_BACK}",
    "bi_regional_heatmap": f"SELECT region, {num('sum(revenue_amount)')} AS total_revenue, count(DISTINCT unique_taxpayers) AS distinct_payer_counts FROM t_metrics WHERE metric_type = 'regional_revenue' AND metric_date = {MONTH} GROUP BY region",
    "bi_target_vs_actual": f"SELECT tax_type, {num('revenue_amount')} AS performance_percentage FROM t_metrics WHERE metric_type = 'target_vs_actual' AND metric_date = {MONTH}",
    "bi_yoy": f"SELECT tax_type, metric_date, {num('revenue_amount')} AS yoy_growth_percentage FROM t_metrics WHERE metric_type = 'yoy_growth' AND metric_date >= {YEAR_BACK}",
    "bi_channel_distribution": f"""SELECT payment_channel, {num('sum(revenue_amount)')} AS total_revenue, count(DISTINCT unique_taxpayers) AS distinct_payer_counts,
  {num(f"sum(revenue_amount) / (SELECT sum(revenue_amount) FROM t_metrics WHERE metric_type = 'channel_revenue' AND metric_date = {MONTH}) * 100")} AS percentage
FROM t_metrics WHERE metric_type = 'channel_revenue' AND metric_date = {MONTH} GROUP BY payment_channel""",
    "bi_alerts_by_priority": f"SELECT alert_priority, count(*) AS alert_count, {num('avg(fraud_score)')} AS avg_risk_score, {num('sum(potential_revenue_impact::decimal(28,6))')} AS total_impact FROM t_alerts GROUP BY 1",
    "bi_top20_risk": f"SELECT taxpayer_name, alert_type, {num('fraud_score')} AS fraud_score, {num('potential_revenue_impact')} AS potential_revenue_impact, recommended_action FROM t_alerts ORDER BY alert_id LIMIT 20",
    "bi_alerts_by_type": f"SELECT alert_type, count(*) AS count, {num('avg(fraud_score)')} AS avg_score, {num('sum(potential_revenue_impact::decimal(28,6))')} AS total_impact FROM t_alerts GROUP BY 1",
    "bi_risk_by_sector": f"""SELECT t.business_sector, count(DISTINCT t.taxpayer_id) AS total_taxpayers, count(DISTINCT a.taxpayer_id) AS flagged_taxpayers,
  {num('count(DISTINCT a.taxpayer_id)::double / count(DISTINCT t.taxpayer_id) * 100')} AS risk_percentage
FROM taxpayers t LEFT JOIN t_alerts a ON a.taxpayer_id = t.taxpayer_id WHERE t.business_sector IS NOT NULL GROUP BY 1""",
    "bi_taxpayer_profile": f"""SELECT name, tin, taxpayer_type, region || ', ' || district AS location, business_sector, business_subsector, years_registered,
  employee_count, {num('annual_turnover')} AS annual_turnover, {num('filing_compliance_rate * 100')} AS compliance_percentage,
  {num('total_tax_paid')} AS total_tax_paid, risk_category_calculated, {num('engagement_score * 100')} AS engagement_percentage
FROM t_profile WHERE taxpayer_id = '{TAXPAYER}'""",
    "bi_payment_history": f"SELECT payment_date, tax_type, {num('amount')} AS amount, payment_channel, payment_provider FROM t_completed WHERE taxpayer_id = '{TAXPAYER}' ORDER BY payment_date DESC, payment_id LIMIT 50",
    "bi_compliance_timeline": f"""SELECT coalesce(w.period_year, s.period_year) AS year, coalesce(w.period_month, s.period_quarter * 3) AS period,
  if(w.return_id IS NULL, 'VAT', 'PAYE') AS tax_type, coalesce(w.status, s.status) AS status,
  coalesce(w.filing_date, s.filing_date) AS filing_date, coalesce(w.due_date, s.due_date) AS due_date,
  if(coalesce(w.filing_date, s.filing_date) > coalesce(w.due_date, s.due_date), 'Late', 'On Time') AS filing_status
FROM paye_returns w FULL JOIN vat_returns s ON w.taxpayer_id = s.taxpayer_id AND w.period_year = s.period_year
WHERE coalesce(w.taxpayer_id, s.taxpayer_id) = '{TAXPAYER}'""",
    "bi_peer_comparison": f"""SELECT o.name, {num('o.total_tax_paid')} AS total_tax_paid, {num('o.filing_compliance_rate * 100')} AS compliance_rate,
  o.employee_count, {num('o.annual_turnover')} AS annual_turnover
FROM t_profile m JOIN t_profile o ON o.business_sector = m.business_sector AND o.business_size_category = m.business_size_category AND o.taxpayer_id <> m.taxpayer_id
WHERE m.taxpayer_id = '{TAXPAYER}' ORDER BY abs(o.total_tax_paid - m.total_tax_paid), o.taxpayer_id LIMIT 10""",
    "bi_revenue_by_sector": f"""SELECT business_sector, tax_type, {num('sum(amount)')} AS total_revenue, count(DISTINCT taxpayer_id) AS taxpayers, {num('(sum(amount)::double / count(amount))')} AS avg_payment
FROM t_completed JOIN taxpayers USING (taxpayer_id) WHERE payment_date {BETWEEN} AND business_sector IS NOT NULL GROUP BY 1, 2""",
    "bi_compliance_by_region": f"""SELECT region, {num('avg(filing_compliance_rate) * 100')} AS avg_compliance_rate, count(*) AS taxpayer_count,
  count(*) FILTER (chronic_late_filer) AS chronic_late_filers FROM t_filing JOIN taxpayers USING (taxpayer_id) GROUP BY region""",
    "bi_payment_delays": f"""SELECT {month('c.payment_date')} AS month, c.tax_type, {num("avg(date_diff('day', coalesce(w.due_date, s.due_date), c.payment_date))")} AS avg_delay_days, count(*) AS payment_count
FROM t_completed c LEFT JOIN paye_returns w ON w.return_id = c.reference_number LEFT JOIN vat_returns s ON s.return_id = c.reference_number
WHERE coalesce(w.due_date, s.due_date) IS NOT NULL AND c.payment_date >= {YEAR_BACK} GROUP BY 1, 2""",
    "bi_forecast_30d": f"SELECT forecast_date, tax_type, {num('predicted_revenue')} AS predicted_revenue, {num('lower_bound')} AS lower_bound, {num('upper_bound')} AS upper_bound FROM t_forecast30 WHERE forecast_date - {DAY} BETWEEN 0 AND 30",
    "bi_forecast_vs_actual": f"""SELECT f.forecast_date, f.tax_type, {num('any_value(f.predicted_revenue)')} AS predicted_revenue, {num('coalesce(sum(c.amount), 0)')} AS actual_revenue,
  {num('coalesce(sum(c.amount), 0) - any_value(f.predicted_revenue)')} AS variance,
  {num('coalesce((coalesce(sum(c.amount), 0)::double - any_value(f.predicted_revenue)::double) / nullif(greatest(any_value(f.predicted_revenue), 0), 0)::double * 100, 0)')} AS variance_percentage
FROM t_forecast30 f LEFT JOIN t_completed c ON c.payment_date = f.forecast_date AND c.tax_type = f.tax_type
WHERE {DAY} - f.forecast_date BETWEEN 1 AND 30 GROUP BY 1, 2""",
    "live_today_collections": f"SELECT {num('coalesce(sum(amount), 0)')} AS total FROM payments WHERE payment_date = {DAY}",
    "live_active_alerts": "SELECT count(*) AS count FROM fraud_alerts WHERE status = 'Open'",
    "live_month_revenue_growth": f"""SELECT {num('a')} AS monthly_revenue, {num('b')} AS last_year_revenue, {num('coalesce((a - b) / nullif(b, 0) * 100, 0)')} AS growth
FROM (SELECT coalesce(sum(amount) FILTER (date_trunc('month', payment_date) = {MONTH}), 0)::double AS a,
  coalesce(sum(amount) FILTER (date_trunc('month', payment_date) = {MONTH} - INTERVAL 1 YEAR), 0)::double AS b FROM payments)""",
    "live_compliance_rate": f"SELECT {num('avg(compliance_score::double) * 100')} AS rate FROM taxpayers",
    "live_active_taxpayers_30d": f"SELECT count(DISTINCT taxpayer_id) AS count FROM payments WHERE payment_date >= {DAY} - 30",
    "live_revenue_trend_30d": f"SELECT payment_date AS date, {num('sum(amount)')} AS revenue FROM payments WHERE payment_date >= {DAY} - 30 GROUP BY 1",
    "live_revenue_by_region_30d": f"SELECT region, {num('sum(amount)')} AS revenue FROM payments JOIN taxpayers USING (taxpayer_id) WHERE payment_date >= {DAY} - 30 GROUP BY 1",
    "live_top5_alerts": f"SELECT alert_date, alert_type, description, name AS taxpayer_name, {num('risk_score')} AS risk_score FROM fraud_alerts JOIN taxpayers USING (taxpayer_id) WHERE status = 'Open' ORDER BY fraud_alerts.risk_score DESC, alert_id LIMIT 5",
    "live_revenue_by_type": f"SELECT tax_type, {num('sum(amount)')} AS revenue, count(*) AS transactions, count(DISTINCT taxpayer_id) AS taxpayers FROM payments WHERE payment_date {BETWEEN} GROUP BY 1",
    "live_channel_analysis": f"SELECT payment_channel, count(*) AS transactions, {num('sum(amount)')} AS total_amount, {num('(sum(amount)::double / count(amount))')} AS avg_amount FROM payments WHERE payment_date {BETWEEN} GROUP BY 1",
    "live_high_risk_count": "SELECT count(*) AS count FROM taxpayers WHERE risk_category = 'High'",
    "live_revenue_at_risk": f"SELECT {num('coalesce(sum(amount), 0)')} AS total FROM payments JOIN taxpayers USING (taxpayer_id) WHERE risk_category = 'High' AND payment_date >= {DAY} - 30",
    "live_alert_table": f"SELECT alert_date, name AS taxpayer_name, tin, alert_type, {num('risk_score')} AS risk_score, description, region, business_sector FROM fraud_alerts JOIN taxpayers USING (taxpayer_id) WHERE status = 'Open'",
    "live_risk_bands": """SELECT CASE WHEN compliance_score < 0.3 THEN '0-30%' WHEN compliance_score < 0.5 THEN '30-50%' WHEN compliance_score < 0.7 THEN '50-70%'
  WHEN compliance_score < 0.9 THEN '70-90%' ELSE '90-100%' END AS risk_band, count(*) AS count FROM taxpayers GROUP BY 1""",
    "live_taxpayer_search": f"SELECT taxpayer_id, name, tin, region, business_sector FROM taxpayers WHERE name ILIKE '%{SEARCH}%' OR tin LIKE '%{SEARCH}%' ORDER BY taxpayer_id LIMIT 10",
    "live_taxpayer_lookup": f"{PROFILE_SELECT} WHERE taxpayer_id = '{TAXPAYER}'",
    "live_recent_payments": f"SELECT payment_date, tax_type, {num('amount')} AS amount, payment_channel FROM payments WHERE taxpayer_id = '{TAXPAYER}' ORDER BY payment_date DESC, payment_id LIMIT 20",
    "validate_transactions": TX_CHECKED,
    "stream_validate_transactions": TX_CHECKED,
    "transaction_features": f"""SELECT transaction_id, taxpayer_id, ts, payment_channel, {num('amount')} AS amount, tax_type, status, risk_flag,
  cast(tx_hour AS int) AS hour, off_day AS is_weekend, {num('amount')} AS amount_value, cast(risk_flag AS int) AS risk_flag_value,
  cast(off_day AS int) AS weekend_value, {_one_hot()} FROM t_tx""",
    "anomaly_reasons": f"""SELECT transaction_id, cast(tx_hour AS int) AS hour, off_day AS is_weekend,
  coalesce(nullif(concat_ws('; ', if(amount > 1000000, '{C.REASON_HIGH_AMOUNT}', NULL), if(tx_hour NOT BETWEEN 6 AND 22, '{C.REASON_HOURS}', NULL),
    if(off_day, '{C.REASON_WEEKEND}', NULL), if(risk_flag, '{C.REASON_FLAGGED}', NULL)), ''), '{C.REASON_FALLBACK}') AS alert_reason FROM t_tx""",
    "revenue_insights": f"""SELECT {num('coalesce(a, 0)')} AS current_month_revenue, {num('coalesce((a - b) / nullif(b, 0) * 100, 0)')} AS growth_rate, payers AS active_taxpayers,
  if(a > b, 'on_track', 'below_target') AS status
FROM (SELECT sum(amount)::double AS a, count(DISTINCT taxpayer_id) AS payers FROM payments WHERE {month('payment_date')} = {MONTH})
  CROSS JOIN (SELECT sum(amount)::double AS b FROM payments WHERE {month('payment_date')} = {MONTH} - INTERVAL 1 MONTH)""",
    "compliance_insights": f"SELECT count(*) FILTER (compliance_score < 0.5) AS low_compliance_count, count(*) FILTER (compliance_score >= 0.8) AS high_compliance_count, {num('avg(compliance_score::double)')} AS average_score FROM taxpayers",
    "collection_projection_7d": f"""SELECT cast({DAY} + i AS date) AS date, {num('mean')} AS predicted_amount, {num('mean * 0.85::double')} AS lower_bound, {num('mean * 1.15::double')} AS upper_bound, {num('mean * 7')} AS total_expected
FROM (SELECT avg(total) AS mean FROM (SELECT sum(amount)::double AS total FROM payments WHERE payment_date >= {DAY} - 30 GROUP BY payment_date)), (SELECT unnest(range(1, 8))::int AS i)""",
    "fraud_features_weekly": f"SELECT * REPLACE ({_rounded(WEEKLY_NUMBERS)}) FROM t_weekly",
    "derived_features": f"""SELECT * REPLACE ({_rounded(WEEKLY_NUMBERS, fill=True)}, coalesce(employee_count, 0) AS employee_count),
  {num('coalesce(avg_payment_amount / (payment_amount_stddev + 1), 0)')} AS payment_consistency, {num('vat_sales_stddev / (avg_vat_sales + 1)')} AS vat_sales_volatility,
  {num('1 - (paye_late_rate + vat_late_rate) / 2')} AS filing_reliability, {num('(paye_returns_count + vat_returns_count) / (years_active + 1)::double')} AS returns_per_year FROM t_weekly""",
    "fraud_features_extended": f"SELECT * REPLACE ({_rounded(EXTENDED_NUMBERS)}) FROM t_extended",
    "derived_features_extended": f"""SELECT * REPLACE ({_rounded(EXTENDED_NUMBERS, fill=True)}), {num('coalesce(avg_payment / (payment_stddev + 1), 0)')} AS payment_consistency,
  {num('total_payments / (years_active + 1)::double')} AS payment_velocity, {num('payment_channels / greatest(total_payments, 1)::double')} AS channel_diversity FROM t_extended""",
    "ml_alerts": "SELECT * FROM t_ml_alerts",
    "revenue_history": f"""SELECT payment_date AS ds, tax_type, {num('sum(amount)')} AS y FROM t_completed WHERE payment_date >= {DAY} - INTERVAL 2 YEAR GROUP BY 1, 2
UNION ALL SELECT payment_date, 'Total', {num('sum(amount)')} FROM t_completed WHERE payment_date >= {DAY} - INTERVAL 2 YEAR GROUP BY 1""",
    "forecast_deviation_alerts": f"""SELECT tax_type, forecast_date, {num('predicted_revenue')} AS current_forecast, {num('mean')} AS historical_avg,
  {num('(predicted_revenue::double - mean) / mean * 100')} AS variance_pct
FROM t_forecast30 JOIN (SELECT tax_type, (sum(amount)::double / count(amount)) AS mean FROM payments WHERE {DAY} - payment_date BETWEEN 1 AND 30 GROUP BY 1) USING (tax_type)
WHERE forecast_date - {DAY} BETWEEN 0 AND 7 AND abs((predicted_revenue::double - mean) / mean) > 0.2""",
    "dq_null_ids": "SELECT count(*) AS null_count FROM taxpayers WHERE coalesce(taxpayer_id, '') = '' OR coalesce(tin, '') = ''",
    "dq_duplicate_tin": "SELECT tin, count(*) AS count FROM taxpayers GROUP BY tin HAVING count(*) > 1",
    "dq_unique": "SELECT reference_number, count(*) AS n_records FROM payments WHERE reference_number IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "dq_not_null": f"SELECT {columns('payments', skip=('created_at',))} FROM payments WHERE reference_number IS NULL",
    "dq_relationships": f"SELECT {columns('payments', skip=('created_at',))} FROM payments WHERE reference_number NOT IN (SELECT return_id FROM vat_returns)",
    "dq_accepted_values": "SELECT tax_type AS value, count(*) AS n_records FROM realtime_transactions WHERE NOT list_contains(" + str(C.TAX_TYPES) + ", tax_type) GROUP BY 1",
    "dq_report": _checks(),
    "stream_daily_revenue": f"""SELECT ts::date AS date, {num('sum(amount)')} AS revenue, count(*) AS transactions FROM realtime_transactions GROUP BY 1""",
}
_PLAIN["write_json_report"] = _PLAIN["compliance_insights"]


def _complete(sql: str) -> str:
    """Put the parts in front of a query that may bring its own parts."""
    full = oracle(sql)
    own = re.match(r"(?s)(WITH .*?)\nWITH (.*)", full)
    return full.replace("\nWITH ", ",\n", 1) if own else full


ORACLES: dict[str, str] = {name: _complete(sql) for name, sql in _PLAIN.items()}

# The same results from tables stored by key or refreshed.
ORACLES |= {
    stored: ORACLES[plain]
    for stored, plain in {
        "refresh_summary": "materialize_summary",
        "lookup_payment_history": "bi_payment_history",
        "lookup_recent_payments": "live_recent_payments",
        "search_by_postings": "live_taxpayer_search",
        "lookup_taxpayer": "live_taxpayer_lookup",
        "lookup_taxpayer_profile": "bi_taxpayer_profile",
    }.items()
}

# The dashboard pack sent as SQL text gives the same rows.
ORACLES |= {f"sql_{name}": ORACLES[name] for name in BI_SQL_INPUTS}

# Facts about trained results that hold whatever the fit.
ORACLES |= {
    "split_class_counts": f"""WITH sizes AS (SELECT cast(is_fraud AS int) AS label, count(*) AS n FROM ({ORACLES['fraud_features_weekly']}) GROUP BY 1),
  cut AS (SELECT label, n, cast(floor(n * 0.8 + 0.5) AS bigint) AS train FROM sizes)
SELECT label, cast(NULL AS int) AS fold, n - train AS n_rows FROM cut WHERE n > train
UNION ALL SELECT label, cast(f AS int) AS fold, (train + 4 - f) // 5 AS n_rows FROM cut, range(5) folds(f) WHERE train > f""",
    "oversample_class_counts": f"""WITH sizes AS (SELECT cast(is_fraud AS int) AS label, count(*) AS n FROM ({ORACLES['fraud_features_weekly']}) GROUP BY 1),
  normal AS (SELECT coalesce(sum(n) FILTER (WHERE label = 0), 0) AS n FROM sizes)
SELECT label, cast(if(label = 1, normal.n // 2, sizes.n) AS bigint) AS n_rows, cast(if(label = 1, least(normal.n // 2, sizes.n), sizes.n) AS bigint) AS n_taxpayers
FROM sizes, normal""",
    "stored_model_scores": f"SELECT taxpayer_id, 1 AS model_version, true AS same_score FROM ({ORACLES['fraud_features_weekly']})",
    "forecast_ranges": f"""SELECT tax_type, count(*) + 90 AS n_rows, min(ds) AS first_day, cast(max(ds) + 90 AS date) AS last_day, true AS ordered, true AS widening
FROM ({ORACLES['revenue_history']}) GROUP BY tax_type""",
}

# The payment rule over its own six months.
ORACLES["payment_anomalies_6m"] = ORACLES["payment_anomalies"].replace(f"INTERVAL {ANOMALY_MONTHS} MONTH", "INTERVAL 6 MONTH")
