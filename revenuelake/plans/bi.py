"""The dashboard query pack. ``metrics``, ``alerts`` and ``profile`` are the written mart tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revenuelake.functions.dates import days_after, in_period, month_start, months_before
from revenuelake.functions.ratios import ratio
from revenuelake.functions.scores import priority_rank
from revenuelake.operators.compliance import return_due_dates
from revenuelake.operators.revenue import taxpayer_totals
from revenuelake.operators.staging import stg_payments


def _metric(metrics: DataFrame, metric_type: str) -> DataFrame:
    return metrics.filter(F.col("metric_type") == metric_type)


def _first_of_month(as_of: dt.date) -> Column:
    return F.lit(as_of.replace(day=1))


def _year_back(as_of: dt.date) -> dt.date:
    return months_before(as_of, 12).replace(day=1)


# --- executive revenue ---------------------------------------------------------------


def bi_latest_month_by_type(metrics: DataFrame) -> DataFrame:
    """``distinct_payer_counts`` counts distinct numbers of payers, as the source query does."""
    monthly = _metric(metrics, "monthly_revenue")
    latest = monthly.agg(F.max("metric_date").alias("metric_date"))  # one row
    return (
        monthly.join(F.broadcast(latest), "metric_date")
        .groupBy("tax_type")
        .agg(
            F.sum("revenue_amount").alias("total_revenue"),
            F.countDistinct("unique_taxpayers").alias("distinct_payer_counts"),
            F.avg(ratio(F.col("revenue_amount"), F.col("transaction_count"))).alias("avg_transaction"),
        )
        .orderBy(F.desc_nulls_first("total_revenue"), "tax_type")
    )


def bi_revenue_trend_12m(metrics: DataFrame, as_of: dt.date) -> DataFrame:
    recent = _metric(metrics, "monthly_revenue").filter(F.col("metric_date") >= F.lit(_year_back(as_of)))
    return recent.select("metric_date", "tax_type", "revenue_amount").orderBy("metric_date", "tax_type")


def bi_regional_heatmap(metrics: DataFrame, as_of: dt.date) -> DataFrame:
    return (
        _metric(metrics, "regional_revenue")
        .filter(F.col("metric_date") == _first_of_month(as_of))
        .groupBy("region")
        .agg(
            F.sum("revenue_amount").alias("total_revenue"),
            F.countDistinct("unique_taxpayers").alias("distinct_payer_counts"),
        )
        .orderBy(F.desc_nulls_first("total_revenue"), "region")
    )


def bi_target_vs_actual(metrics: DataFrame, as_of: dt.date) -> DataFrame:
    return (
        _metric(metrics, "target_vs_actual")
        .filter(F.col("metric_date") == _first_of_month(as_of))
        .select("tax_type", F.col("revenue_amount").alias("performance_percentage"))
    )


def bi_yoy(metrics: DataFrame, as_of: dt.date) -> DataFrame:
    return (
        _metric(metrics, "yoy_growth")
        .filter(F.col("metric_date") >= F.lit(_year_back(as_of)))
        .select("tax_type", "metric_date", F.col("revenue_amount").alias("yoy_growth_percentage"))
        .orderBy(F.desc("metric_date"), "tax_type")
    )


def bi_channel_distribution(metrics: DataFrame, as_of: dt.date) -> DataFrame:
    """Share of each channel; the window runs over one row per channel."""
    totals = (
        _metric(metrics, "channel_revenue")
        .filter(F.col("metric_date") == _first_of_month(as_of))
        .groupBy("payment_channel")
        .agg(
            F.sum("revenue_amount").alias("total_revenue"),
            F.countDistinct("unique_taxpayers").alias("distinct_payer_counts"),
        )
    )
    share = ratio(F.col("total_revenue"), F.sum("total_revenue").over(Window.partitionBy())) * 100
    return totals.withColumn("percentage", share).orderBy(F.desc_nulls_first("total_revenue"), "payment_channel")


# --- fraud ------------------------------------------------------------------------------


def _exact_sum(name: str) -> Column:
    """Sum in decimals, so that it does not depend on the order in which rows arrive."""
    return F.sum(F.col(name).cast("decimal(28,6)"))


def _open(alerts: DataFrame) -> DataFrame:
    return alerts.filter(F.col("status") == "Open")


def bi_alerts_by_priority(alerts: DataFrame) -> DataFrame:
    return (
        _open(alerts)
        .groupBy("alert_priority")
        .agg(
            F.count(F.lit(1)).alias("alert_count"),
            F.avg("fraud_score").alias("avg_risk_score"),
            _exact_sum("potential_revenue_impact").alias("total_impact"),
        )
        .orderBy(priority_rank(F.col("alert_priority")))
    )


def bi_top20_risk(alerts: DataFrame) -> DataFrame:
    """Ordered by the alert number, which already ranks by score with ties resolved."""
    return (
        _open(alerts)
        .orderBy("alert_id")
        .limit(20)
        .select("taxpayer_name", "alert_type", "fraud_score", "potential_revenue_impact", "recommended_action")
    )


def bi_alerts_by_type(alerts: DataFrame) -> DataFrame:
    return (
        _open(alerts)
        .groupBy("alert_type")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.avg("fraud_score").alias("avg_score"),
            _exact_sum("potential_revenue_impact").alias("total_impact"),
        )
        .orderBy(F.desc("count"), "alert_type")
    )


def bi_risk_by_sector(profile: DataFrame, alerts: DataFrame) -> DataFrame:
    """Flagged share per sector. The alerts are reduced to one row per taxpayer, so nothing fans out."""
    flagged = _open(alerts).select("taxpayer_id").distinct().withColumn("flagged", F.lit(1))
    return (
        profile.filter(F.col("business_sector").isNotNull())
        .select("taxpayer_id", "business_sector")
        .join(flagged, "taxpayer_id", "left")
        .groupBy("business_sector")
        .agg(F.count("taxpayer_id").alias("total_taxpayers"), F.count("flagged").alias("flagged_taxpayers"))
        .withColumn("risk_percentage", ratio(F.col("flagged_taxpayers"), F.col("total_taxpayers")) * 100)
        .orderBy(F.desc("risk_percentage"), "business_sector")
    )


# --- taxpayer ------------------------------------------------------------------------------


def bi_taxpayer_profile(profile: DataFrame, taxpayer_id: str) -> DataFrame:
    """``location`` is NULL when region or district is missing."""
    return profile.filter(F.col("taxpayer_id") == taxpayer_id).select(
        "name", "tin", "taxpayer_type",
        F.concat("region", F.lit(", "), "district").alias("location"),
        "business_sector", "business_subsector", "years_registered", "employee_count", "annual_turnover",
        (F.col("filing_compliance_rate") * 100).alias("compliance_percentage"),
        "total_tax_paid", "risk_category_calculated",
        (F.col("engagement_score") * 100).alias("engagement_percentage"),
    )


def bi_payment_history(payments: DataFrame, taxpayer_id: str, rows: int = 50) -> DataFrame:
    """Latest payments; the payment id settles ties of the date."""
    return (
        payments.filter((F.col("taxpayer_id") == taxpayer_id) & (F.col("status") == "Completed"))
        .orderBy(F.desc_nulls_first("payment_date"), "payment_id")
        .limit(rows)
        .select("payment_date", "tax_type", "amount", "payment_channel", "payment_provider")
    )


def bi_compliance_timeline(paye_returns: DataFrame, vat_returns: DataFrame, taxpayer_id: str) -> DataFrame:
    """Payroll and VAT returns of one taxpayer, matched on the year.

    A full outer join: within a year every payroll return meets every VAT return, and the payroll values
    win where both are known. Both sides are cut to the one taxpayer before they are joined.
    """
    fields = ["return_id", "period", "status", "filing_date", "due_date"]

    def side(returns: DataFrame, period: Column, prefix: str) -> DataFrame:
        mine = returns.filter(F.col("taxpayer_id") == taxpayer_id).withColumn("period", period)
        return mine.select(F.col("period_year").alias("year"), *[F.col(f).alias(prefix + f) for f in fields])

    both = side(paye_returns, F.col("period_month"), "p_").join(
        side(vat_returns, F.col("period_quarter") * 3, "v_"), "year", "full_outer"
    )
    first = {f: F.coalesce(F.col(f"p_{f}"), F.col(f"v_{f}")) for f in fields}
    late = first["filing_date"] > first["due_date"]
    return both.select(
        "year",
        first["period"].alias("period"),
        F.when(F.col("p_return_id").isNotNull(), "PAYE").when(F.col("v_return_id").isNotNull(), "VAT").alias("tax_type"),
        *[first[f].alias(f) for f in ("status", "filing_date", "due_date")],
        F.when(late, "Late").otherwise("On Time").alias("filing_status"),
    ).orderBy(F.desc("year"), F.desc("period"))


def bi_peer_comparison(profile: DataFrame, taxpayer_id: str, rows: int = 10) -> DataFrame:
    """The taxpayers of the same sector and size whose tax paid is nearest."""
    own = profile.filter(F.col("taxpayer_id") == taxpayer_id).select(
        "business_sector", "business_size_category", F.col("total_tax_paid").alias("own_tax_paid")
    )
    return (
        profile.filter(F.col("taxpayer_id") != taxpayer_id)
        .join(F.broadcast(own), ["business_sector", "business_size_category"])  # one row: taxpayer_id is the key
        .orderBy(F.abs(F.col("total_tax_paid") - F.col("own_tax_paid")), "taxpayer_id")
        .limit(rows)
        .select(
            "name", "total_tax_paid", (F.col("filing_compliance_rate") * 100).alias("compliance_rate"),
            "employee_count", "annual_turnover",
        )
    )


# --- self service ----------------------------------------------------------------------------


def bi_revenue_by_sector(payments: DataFrame, taxpayers: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    in_range = stg_payments(in_period(payments, start=start, until=end))
    sectors = taxpayers.filter(F.col("business_sector").isNotNull()).select("taxpayer_id", "business_sector")
    return (
        taxpayer_totals(in_range, "tax_type")
        .join(sectors, "taxpayer_id")
        .groupBy("business_sector", "tax_type")
        .agg(
            F.sum("amount").alias("total_revenue"),
            F.count("taxpayer_id").alias("taxpayers"),  # one row per taxpayer and tax type
            ratio(F.sum("amount"), F.sum("amounts")).alias("avg_payment"),
        )
        .orderBy(F.desc_nulls_first("total_revenue"), "business_sector", "tax_type")
    )


def bi_compliance_by_region(profile: DataFrame) -> DataFrame:
    return (
        profile.groupBy("region")
        .agg(
            (F.avg("filing_compliance_rate") * 100).alias("avg_compliance_rate"),
            F.count(F.lit(1)).alias("taxpayer_count"),
            F.count_if("chronic_late_filer").alias("chronic_late_filers"),
        )
        .orderBy(F.desc_nulls_first("avg_compliance_rate"), "region")
    )


def bi_payment_delays(
    payments: DataFrame, paye_returns: DataFrame, vat_returns: DataFrame, as_of: dt.date
) -> DataFrame:
    """Payments are counted per day, tax type and reference before they are joined to the due dates."""
    recent = stg_payments(in_period(payments, start=_year_back(as_of)))
    counted = (
        recent.filter(F.col("reference_number").isNotNull())
        .groupBy("reference_number", "payment_date", "tax_type")
        .agg(F.count(F.lit(1)).alias("payments"))
    )
    due = return_due_dates(paye_returns, vat_returns).filter(F.col("due_date").isNotNull())
    linked = counted.join(due, F.col("reference_number") == F.col("return_id"))
    days = F.sum(F.datediff("payment_date", "due_date") * F.col("payments"))
    return (
        linked.groupBy(month_start(F.col("payment_date")).alias("month"), "tax_type")
        .agg(ratio(days, F.sum("payments")).alias("avg_delay_days"), F.sum("payments").alias("payment_count"))
        .orderBy(F.desc("month"), "tax_type")
    )


# --- forecasts ----------------------------------------------------------------------------------


def bi_forecast_30d(forecasts: DataFrame, as_of: dt.date) -> DataFrame:
    return (
        forecasts.filter(F.col("forecast_date").between(F.lit(as_of), F.lit(days_after(as_of, 30))))
        .select("forecast_date", "tax_type", "predicted_revenue", "lower_bound", "upper_bound")
        .orderBy("forecast_date", "tax_type")
    )


def bi_forecast_vs_actual(forecasts: DataFrame, payments: DataFrame, as_of: dt.date) -> DataFrame:
    """Past 30 days. Payments are summed per day and tax type before they meet the forecasts."""
    start = days_after(as_of, -30)
    past = forecasts.filter((F.col("forecast_date") >= F.lit(start)) & (F.col("forecast_date") < F.lit(as_of)))
    actual = (
        stg_payments(in_period(payments, start=start, before=as_of))
        .groupBy(F.col("payment_date").alias("forecast_date"), "tax_type")
        .agg(F.sum("amount").alias("actual"))
    )
    predicted = F.col("predicted_revenue").cast("double")
    real = F.coalesce(F.col("actual").cast("double"), F.lit(0.0))
    return (
        past.join(actual, ["forecast_date", "tax_type"], "left")
        .select(
            "forecast_date",
            "tax_type",
            "predicted_revenue",
            real.alias("actual_revenue"),
            (real - predicted).alias("variance"),
            F.when(predicted > 0, (real - predicted) / F.nullif(predicted, F.lit(0.0)) * 100)
            .otherwise(0.0)
            .alias("variance_percentage"),
        )
        .orderBy(F.desc("forecast_date"), "tax_type")
    )
