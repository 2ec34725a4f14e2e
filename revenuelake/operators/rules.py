"""Rule-based fraud detection and the combined alert table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revenuelake import constants as C
from revenuelake.functions.dates import in_period, months_before, quarter_slot, quarter_start
from revenuelake.functions.ratios import join_text, one_decimal, pct_change, ratio
from revenuelake.functions.scores import alert_priority
from revenuelake.operators.skew import global_row_number, heavy_keys_in_sample, salted_join, split_join
from revenuelake.operators.staging import stg_payments


def vat_drop(vat_returns: DataFrame) -> DataFrame:
    """Filed quarters against the mean sales of the four quarter slots before them.

    Returns are summed per quarter first, so the window of one taxpayer holds one row per quarter even if
    a quarter was declared many times. At least two earlier returns are needed; a return declared several
    times with the same sales is reported once and counts its earlier returns once per copy.
    """
    quarter = ["taxpayer_id", "period_year", "period_quarter"]
    slot = quarter_slot(F.col("period_year"), F.col("period_quarter"))
    earlier = Window.partitionBy("taxpayer_id").orderBy(slot).rangeBetween(-4, -1)
    history = (
        vat_returns.groupBy(*quarter)
        .agg(
            F.sum("total_sales").alias("sales"),
            F.count("total_sales").alias("known"),
            F.count("return_id").alias("returns"),
        )
        .select(
            *quarter,
            ratio(F.sum("sales").over(earlier), F.sum("known").over(earlier)).alias("avg_previous_sales"),
            F.sum("returns").over(earlier).alias("previous_returns"),
        )
        .filter(F.col("previous_returns") > 0)
    )
    filed = (
        vat_returns.filter(F.col("status") == "Filed")
        .groupBy(*quarter, F.col("total_sales").alias("current_sales"))
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    return (
        filed.join(history, quarter)
        .filter(F.col("copies") * F.col("previous_returns") >= 2)
        .select(
            *quarter,
            "current_sales",
            "avg_previous_sales",
            pct_change(F.col("current_sales"), F.col("avg_previous_sales")).alias("sales_change_pct"),
        )
    )


def paye_revenue_mismatch(paye_returns: DataFrame, taxpayers: DataFrame) -> DataFrame:
    corporates = taxpayers.filter((F.col("taxpayer_type") == "Corporate") & (F.col("annual_turnover") > 0)).select(
        "taxpayer_id", "annual_turnover"
    )
    yearly = (
        paye_returns.filter(F.col("status") == "Filed")
        .groupBy("taxpayer_id", "period_year")
        .agg(F.sum("gross_salaries").alias("annual_salaries"))
    )
    return yearly.join(corporates, "taxpayer_id").select(
        "taxpayer_id",
        "period_year",
        "annual_salaries",
        "annual_turnover",
        (ratio(F.col("annual_salaries"), F.col("annual_turnover")) * 100).alias("salary_to_revenue_ratio"),
    )


def payment_anomalies(payments: DataFrame, as_of: dt.date, months: int = 6) -> DataFrame:
    amount = F.col("amount").cast("double")
    return (
        stg_payments(in_period(payments, start=months_before(as_of, months)))
        .groupBy("taxpayer_id")
        .agg(
            F.countDistinct("payment_channel").alias("channel_switches"),
            ratio(F.stddev_samp(amount), ratio(F.sum("amount"), F.count("amount"))).alias("payment_variance"),
            F.count_if(~F.hour("created_at").between(8, 18)).alias("odd_hour_payments"),
        )
    )


def peer_anomalies(profile: DataFrame) -> DataFrame:
    """Tax paid against the mean of the other taxpayers of the same sector and size.

    The mean of the others follows from the group's sum and count, so no pairs are formed; the group
    figures are joined with salts because a sector can hold most taxpayers.
    """
    peer_group = ["business_sector", "business_size_category"]
    members = profile.filter(F.col("business_sector").isNotNull()).select(
        "taxpayer_id", *peer_group, "total_tax_paid"
    )
    totals = members.groupBy(*peer_group).agg(
        F.sum("total_tax_paid").alias("group_tax"), F.count(F.lit(1)).alias("group_size")
    )
    compared = salted_join(members.filter(F.col("total_tax_paid") > 0), totals, peer_group, ["taxpayer_id"])
    others = F.col("group_size") - 1
    return (
        compared.filter(others >= 5)
        .withColumn("peer_avg_tax", ratio(F.col("group_tax") - F.col("total_tax_paid"), others))
        .select(
            "taxpayer_id", *peer_group, "total_tax_paid", "peer_avg_tax",
            pct_change(F.col("total_tax_paid"), F.col("peer_avg_tax")).alias("variance_from_peers"),
        )
    )


# --- alert branches -----------------------------------------------------------------


def _alert(
    source: DataFrame, alert_type: str, description: Column, score: Column, impact: Column, action: str
) -> DataFrame:
    return source.select(
        "taxpayer_id",
        F.col("name").alias("taxpayer_name"),
        F.lit(alert_type).alias("alert_type"),
        description.alias("alert_description"),
        score.cast("double").alias("fraud_score"),
        impact.cast("double").alias("potential_revenue_impact"),
        F.lit(action).alias("recommended_action"),
    )


def _capped(score: Column) -> Column:
    return F.least(score, F.lit(1.0))


def _names(profile: DataFrame) -> DataFrame:
    return profile.select("taxpayer_id", "name")


def alerts_vat_drop(profile: DataFrame, vat_returns: DataFrame) -> DataFrame:
    change = F.col("sales_change_pct")
    return _alert(
        vat_drop(vat_returns).filter(change < -30).join(_names(profile), "taxpayer_id"),
        C.VAT_DROP_TYPE,
        join_text(
            "VAT sales dropped by ", one_decimal(F.abs(change)), "% in Q", F.col("period_quarter"), " ",
            F.col("period_year"),
        ),
        _capped(F.abs(change) / 100),
        (F.col("avg_previous_sales") - F.col("current_sales").cast("double")) * 0.15,
        C.VAT_DROP_ACTION,
    )


def alerts_paye_mismatch(profile: DataFrame, paye_returns: DataFrame) -> DataFrame:
    share = F.col("salary_to_revenue_ratio")
    found = paye_revenue_mismatch(paye_returns, profile).filter((share < 20) | (share > 80))
    return _alert(
        found.join(_names(profile), "taxpayer_id"),
        C.PAYE_MISMATCH_TYPE,
        join_text("Salary to revenue ratio is ", one_decimal(share), "% - industry average is 25-40%"),
        F.when(share < 10, 0.8).when(share < 15, 0.6).otherwise(0.4),
        F.col("annual_salaries").cast("double") * 0.1,
        C.PAYE_MISMATCH_ACTION,
    )


def alerts_payment(profile: DataFrame, payments: DataFrame, as_of: dt.date, months: int = 6) -> DataFrame:
    variance, channels = F.col("payment_variance"), F.col("channel_switches")
    found = payment_anomalies(payments, as_of, months).filter((variance > 2) | (channels > 3))
    return _alert(
        found.join(profile.select("taxpayer_id", "name", "total_tax_paid"), "taxpayer_id"),
        C.PAYMENT_TYPE,
        join_text(
            "High payment variance (", one_decimal(variance * 100), "%) with ", channels, " channel switches"
        ),
        _capped(variance + channels * 0.1),
        F.col("total_tax_paid").cast("double") * 0.05,
        C.PAYMENT_ACTION,
    )


def alerts_peer(profile: DataFrame) -> DataFrame:
    variance = F.col("variance_from_peers")
    return _alert(
        peer_anomalies(profile).filter(variance < -50).join(_names(profile), "taxpayer_id"),
        C.PEER_TYPE,
        join_text(
            "Paying ", one_decimal(F.abs(variance)), "% less than similar businesses in ", F.col("business_sector")
        ),
        _capped(F.abs(variance) / 100),
        F.col("peer_avg_tax") - F.col("total_tax_paid").cast("double"),
        C.PEER_ACTION,
    )


def alerts_noncompliance(profile: DataFrame) -> DataFrame:
    rate, previous = F.col("filing_compliance_rate"), F.col("fraud_alert_count")
    return _alert(
        profile.filter((rate < 0.5) | (previous > 2)),
        C.NONCOMPLIANCE_TYPE,
        join_text(
            "Filing compliance rate only ", one_decimal(rate * 100), "% with ", previous, " previous alerts"
        ),
        F.greatest(1 - rate, F.col("fraud_risk_score").cast("double")),
        F.col("total_tax_paid").cast("double") * 0.2,
        C.NONCOMPLIANCE_ACTION,
    )


def fraud_detection_alerts(
    profile: DataFrame,
    vat_returns: DataFrame,
    paye_returns: DataFrame,
    payments: DataFrame,
    as_of: dt.date,
    months: int = 6,
) -> DataFrame:
    """All branches with a score of at least 0.4, ranked. ``profile`` is the written 360 table.

    Ties are ordered by taxpayer, type, text and impact, and the rank is computed without a global window.
    """
    branches = [
        alerts_vat_drop(profile, vat_returns),
        alerts_paye_mismatch(profile, paye_returns),
        alerts_payment(profile, payments, as_of, months),
        alerts_peer(profile),
        alerts_noncompliance(profile),
    ]
    combined = branches[0]
    for branch in branches[1:]:
        combined = combined.unionByName(branch)
    kept = combined.filter(F.col("fraud_score") >= C.MIN_ALERT_SCORE).withColumn(
        "ranking_score", F.round("fraud_score", 6)
    )
    order = [
        F.desc("ranking_score"), F.asc("taxpayer_id"), F.asc("alert_type"), F.asc("alert_description"),
        F.asc("potential_revenue_impact"),
    ]
    return global_row_number(kept, order, "alert_id").select(
        "alert_id", "taxpayer_id", "taxpayer_name", "alert_type", "alert_description", "fraud_score",
        alert_priority(F.col("fraud_score")).alias("alert_priority"),
        "potential_revenue_impact", "recommended_action",
        F.lit(as_of).alias("created_date"),
        F.lit("Open").alias("status"),
    )


def join_owner(alerts: DataFrame, owner: DataFrame) -> DataFrame:
    """Alerts with the columns of their taxpayer; one with very many alerts is kept out of the shuffle."""
    heavy = heavy_keys_in_sample(alerts, ["taxpayer_id"], "alert_id")
    return split_join(alerts.filter(F.col("taxpayer_id").isNotNull()), owner, ["taxpayer_id"], heavy)


def fraud_alerts_enriched(alerts: DataFrame, taxpayers: DataFrame) -> DataFrame:
    """Open stored alerts with their taxpayer and a priority."""
    owner = taxpayers.select("taxpayer_id", F.col("name").alias("taxpayer_name"), "business_sector", "region")
    return join_owner(alerts.filter(F.col("status") == "Open"), owner).withColumn(
        "alert_priority", alert_priority(F.col("risk_score"))
    )


# --- patterns over raw payments --------------------------------------------------------


def pattern_revenue_drop(payments: DataFrame) -> DataFrame:
    """Quarters below 70 % of the rolling mean of four paid quarters, for payers with more than four."""
    quarterly = payments.groupBy("taxpayer_id", quarter_start(F.col("payment_date")).alias("quarter")).agg(
        F.sum("amount").alias("amount")
    )
    of_taxpayer = Window.partitionBy("taxpayer_id")
    rolling = of_taxpayer.orderBy("quarter").rowsBetween(-3, 0)
    change = pct_change(F.col("amount"), F.col("rolling_avg")) / 100
    return (
        quarterly.withColumns(
            {
                "rolling_avg": ratio(F.sum("amount").over(rolling), F.count("amount").over(rolling)),
                "rolling_quarters": F.count("amount").over(rolling),
                "quarters": F.count(F.lit(1)).over(of_taxpayer),
            }
        )
        .filter((F.col("quarters") > 4) & (F.col("rolling_quarters") == 4))
        .withColumn("change", change)
        .filter(F.col("change") < -0.3)
        .select(
            "taxpayer_id",
            F.date_add(F.date_sub(F.add_months("quarter", 3), 1), 30).alias("alert_date"),
            F.lit(C.REVENUE_DROP_TYPE).alias("alert_type"),
            F.least(F.lit(0.95), F.abs("change")).alias("risk_score"),
            join_text(
                "Revenue dropped by ", one_decimal(F.abs("change") * 100), "% compared to 4-quarter average"
            ).alias("description"),
            F.lit("Open").alias("status"),
        )
    )


def pattern_channel_anomaly(payments: DataFrame, as_of: dt.date) -> DataFrame:
    used = payments.groupBy("taxpayer_id").agg(F.countDistinct("payment_channel").alias("channels"))
    return used.filter(F.col("channels") > 3).select(
        "taxpayer_id",
        F.lit(as_of).alias("alert_date"),
        F.lit(C.CHANNEL_ANOMALY_TYPE).alias("alert_type"),
        F.least(F.lit(0.8), F.col("channels") * 0.2).cast("double").alias("risk_score"),
        join_text("Using ", F.col("channels"), " different payment channels - possible structuring").alias(
            "description"
        ),
        F.lit("Open").alias("status"),
    )


def pattern_below_industry(payments: DataFrame, taxpayers: DataFrame, as_of: dt.date) -> DataFrame:
    """Taxpayers whose mean payment of a tax type is less than half of their sector's mean."""
    per_taxpayer = (
        payments.groupBy("taxpayer_id", "tax_type")
        .agg(F.sum("amount").alias("amount"), F.count("amount").alias("amounts"))
        .join(
            taxpayers.filter(F.col("business_sector").isNotNull()).select("taxpayer_id", "business_sector"),
            "taxpayer_id",
        )
    )
    group = ["business_sector", "tax_type"]
    industry = per_taxpayer.groupBy(*group).agg(
        ratio(F.sum("amount"), F.sum("amounts")).alias("industry_mean")
    )
    compared = salted_join(per_taxpayer, industry, group, ["taxpayer_id"]).withColumn(
        "variance", pct_change(ratio(F.col("amount"), F.col("amounts")), F.col("industry_mean")) / 100
    )
    return compared.filter(F.col("variance") < -0.5).select(
        "taxpayer_id",
        F.lit(as_of).alias("alert_date"),
        F.lit(C.BELOW_INDUSTRY_TYPE).alias("alert_type"),
        F.least(F.lit(0.85), F.abs("variance")).alias("risk_score"),
        join_text(
            F.col("tax_type"), " payments ", one_decimal(F.abs("variance") * 100), "% below industry average"
        ).alias("description"),
        F.lit("Open").alias("status"),
    )
