"""Live dashboard queries over the raw tables; payments of every status count."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revenuelake.functions.dates import days_after, in_months, in_period
from revenuelake.functions.ratios import ratio
from revenuelake.functions.scores import compliance_band
from revenuelake.operators.revenue import taxpayer_totals
from revenuelake.operators.rules import join_owner


def _total() -> Column:
    return F.coalesce(F.sum("amount").cast("double"), F.lit(0.0)).alias("total")


def _last_30_days(payments: DataFrame, as_of: dt.date) -> DataFrame:
    return in_period(payments, start=days_after(as_of, -30))


def _within(payments: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    return in_period(payments, start=start, until=end)


def live_today_collections(payments: DataFrame, as_of: dt.date) -> DataFrame:
    return in_period(payments, start=as_of, until=as_of).agg(_total())


def live_active_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.filter(F.col("status") == "Open").agg(F.count(F.lit(1)).alias("count"))


def live_month_revenue_growth(payments: DataFrame, as_of: dt.date) -> DataFrame:
    """This month, the same month a year ago and the growth (0 without a base), from one read of the two months."""
    this_year = F.year("payment_date") == as_of.year

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("amount"))).cast("double"), F.lit(0.0))

    sums = in_months(payments, [(as_of.year, as_of.month), (as_of.year - 1, as_of.month)]).agg(
        total(this_year).alias("monthly_revenue"), total(~this_year).alias("last_year_revenue")
    )
    base = F.col("last_year_revenue")
    growth = (F.col("monthly_revenue") - base) / F.nullif(base, F.lit(0.0)) * 100
    return sums.withColumn("growth", F.when(base > 0, growth).otherwise(0.0))


def live_compliance_rate(taxpayers: DataFrame) -> DataFrame:
    return taxpayers.agg((F.avg(F.col("compliance_score").cast("double")) * 100).alias("rate"))


def live_active_taxpayers_30d(payments: DataFrame, as_of: dt.date) -> DataFrame:
    return _last_30_days(payments, as_of).agg(F.countDistinct("taxpayer_id").alias("count"))


def live_revenue_trend_30d(payments: DataFrame, as_of: dt.date) -> DataFrame:
    daily = _last_30_days(payments, as_of).groupBy(F.col("payment_date").alias("date"))
    return daily.agg(F.sum("amount").alias("revenue")).orderBy("date")


def live_revenue_by_region_30d(payments: DataFrame, taxpayers: DataFrame, as_of: dt.date) -> DataFrame:
    return (
        taxpayer_totals(_last_30_days(payments, as_of))
        .join(taxpayers.select("taxpayer_id", "region"), "taxpayer_id")
        .groupBy("region")
        .agg(F.sum("amount").alias("revenue"))
        .orderBy(F.desc_nulls_first("revenue"), "region")
    )


def _open_with_owner(alerts: DataFrame, taxpayers: DataFrame, *columns: str) -> DataFrame:
    owner = taxpayers.select("taxpayer_id", F.col("name").alias("taxpayer_name"), *columns)
    return join_owner(alerts.filter(F.col("status") == "Open"), owner)


def live_top5_alerts(alerts: DataFrame, taxpayers: DataFrame, rows: int = 5) -> DataFrame:
    """The alert id settles ties of the score."""
    return (
        _open_with_owner(alerts, taxpayers)
        .orderBy(F.desc_nulls_first("risk_score"), "alert_id")
        .limit(rows)
        .select("alert_date", "alert_type", "description", "taxpayer_name", "risk_score")
    )


def live_revenue_by_type(payments: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    return (
        _within(payments, start, end)
        .groupBy("tax_type")
        .agg(
            F.sum("amount").alias("revenue"),
            F.count(F.lit(1)).alias("transactions"),
            F.countDistinct("taxpayer_id").alias("taxpayers"),
        )
        .orderBy(F.desc_nulls_first("revenue"), "tax_type")
    )


def live_channel_analysis(payments: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    return (
        _within(payments, start, end)
        .groupBy("payment_channel")
        .agg(
            F.count(F.lit(1)).alias("transactions"),
            F.sum("amount").alias("total_amount"),
            ratio(F.sum("amount"), F.count("amount")).alias("avg_amount"),
        )
    )


def live_high_risk_count(taxpayers: DataFrame) -> DataFrame:
    return taxpayers.filter(F.col("risk_category") == "High").agg(F.count(F.lit(1)).alias("count"))


def live_revenue_at_risk(payments: DataFrame, taxpayers: DataFrame, as_of: dt.date) -> DataFrame:
    risky = taxpayers.filter(F.col("risk_category") == "High").select("taxpayer_id")
    return taxpayer_totals(_last_30_days(payments, as_of)).join(risky, "taxpayer_id", "left_semi").agg(_total())


def live_alert_table(alerts: DataFrame, taxpayers: DataFrame) -> DataFrame:
    return (
        _open_with_owner(alerts, taxpayers, "tin", "region", "business_sector")
        .orderBy(F.desc_nulls_first("risk_score"), "alert_id")
        .select(
            "alert_date", "taxpayer_name", "tin", "alert_type", "risk_score", "description", "region",
            "business_sector",
        )
    )


def live_risk_bands(taxpayers: DataFrame) -> DataFrame:
    banded = taxpayers.groupBy(compliance_band(F.col("compliance_score")).alias("risk_band"))
    return banded.agg(F.count(F.lit(1)).alias("count")).orderBy("risk_band")


def live_taxpayer_search(taxpayers: DataFrame, text: str, rows: int = 10) -> DataFrame:
    """Name contains the text in any case, or the TIN contains it; sorted so the first rows are stable."""
    found = F.lower("name").contains(text.lower()) | F.col("tin").contains(text)
    return (
        taxpayers.filter(found)
        .orderBy("taxpayer_id")
        .limit(rows)
        .select("taxpayer_id", "name", "tin", "region", "business_sector")
    )


def live_taxpayer_lookup(profile: DataFrame, taxpayer_id: str) -> DataFrame:
    return profile.filter(F.col("taxpayer_id") == taxpayer_id)


def live_recent_payments(payments: DataFrame, taxpayer_id: str, rows: int = 20) -> DataFrame:
    return (
        payments.filter(F.col("taxpayer_id") == taxpayer_id)
        .orderBy(F.desc_nulls_first("payment_date"), "payment_id")
        .limit(rows)
        .select("payment_date", "tax_type", "amount", "payment_channel")
    )
