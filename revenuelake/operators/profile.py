"""One row per taxpayer: profile, compliance, revenue, assets and fraud indicators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revenuelake.functions.dates import full_years, month_start
from revenuelake.functions.ratios import zero_if_null
from revenuelake.functions.scores import engagement_score, risk_category, size_category
from revenuelake.operators.compliance import filing_rate, filing_summary_simple, with_filing_measures
from revenuelake.operators.staging import stg_payments


def _paid(tax_type: str) -> Column:
    return F.sum(F.when(F.col("tax_type") == tax_type, F.col("amount")).otherwise(0))


def revenue_contribution(payments: DataFrame) -> DataFrame:
    return stg_payments(payments).groupBy("taxpayer_id").agg(
        _paid("PAYE").alias("total_paye_paid"),
        _paid("VAT").alias("total_vat_paid"),
        _paid("Corporate Tax").alias("total_corporate_tax_paid"),
        F.sum("amount").alias("total_tax_paid"),
        F.min("payment_date").alias("first_payment_date"),
        F.max("payment_date").alias("last_payment_date"),
        F.countDistinct(month_start(F.col("payment_date"))).alias("active_payment_months"),
    )


def attach_assets(frame: DataFrame, companies: DataFrame, vehicles: DataFrame, land: DataFrame) -> DataFrame:
    """Add asset counts and values. Each registry is summed first, so one cannot multiply another."""
    owned = companies.groupBy("taxpayer_id").agg(F.count("company_reg_no").alias("companies_owned"))
    driven = vehicles.groupBy("taxpayer_id").agg(
        F.count("vehicle_reg_no").alias("vehicles_owned"), F.sum("purchase_value").alias("total_vehicle_value")
    )
    held = land.groupBy("taxpayer_id").agg(
        F.count("property_id").alias("properties_owned"), F.sum("valuation").alias("total_property_value")
    )
    joined = frame
    for assets in (owned, driven, held):
        joined = joined.join(assets, "taxpayer_id", "left")
    return joined


_ASSET_COUNTS = ["companies_owned", "vehicles_owned", "properties_owned"]
_ASSET_VALUES = ["total_vehicle_value", "total_property_value"]


def external_assets(taxpayers: DataFrame, companies: DataFrame, vehicles: DataFrame, land: DataFrame) -> DataFrame:
    """Counts are 0 and values NULL for a taxpayer without such assets."""
    joined = attach_assets(taxpayers.select("taxpayer_id"), companies, vehicles, land)
    return joined.withColumns({name: zero_if_null(F.col(name)) for name in _ASSET_COUNTS})


def alert_rollup(alerts: DataFrame, statuses: list[str], score_name: str) -> DataFrame:
    """Alert count, highest score and the joined alert types of each taxpayer.

    Alerts are first counted per type: the task that builds a text collects one entry per type, however
    many alerts the taxpayer has.
    """
    per_type = (
        alerts.filter(F.col("status").isin(statuses))
        .groupBy("taxpayer_id", "alert_type")
        .agg(F.count(F.lit(1)).alias("n"), F.max("risk_score").alias("score"))
    )
    types = F.array_sort(F.collect_list(F.struct("alert_type", "n")))
    repeated = F.flatten(F.transform(types, lambda t: F.array_repeat(t["alert_type"], t["n"].cast("int"))))
    return per_type.groupBy("taxpayer_id").agg(
        F.sum("n").alias("fraud_alert_count"),
        F.max("score").alias(score_name),
        F.nullif(F.array_join(repeated, "; "), F.lit("")).alias("fraud_alert_types"),
    )


def fraud_indicators(alerts: DataFrame) -> DataFrame:
    return alert_rollup(alerts, ["Open", "Under Investigation"], "max_fraud_risk_score")


_PROFILE = [
    "taxpayer_id", "tin", "name", "taxpayer_type", "registration_date", "email", "phone", "district", "region",
    "business_sector", "business_subsector", "employee_count", "annual_turnover",
]
_FILING = [
    "filing_compliance_rate", "total_paye_returns_expected", "paye_returns_filed", "paye_on_time",
    "avg_paye_days_late", "total_vat_returns_expected", "vat_returns_filed", "vat_on_time", "avg_vat_days_late",
    "chronic_late_filer", "low_filing_rate",
]
_REVENUE = ["total_paye_paid", "total_vat_paid", "total_corporate_tax_paid", "total_tax_paid"]


def taxpayer_360(
    taxpayers: DataFrame,
    paye_returns: DataFrame,
    vat_returns: DataFrame,
    payments: DataFrame,
    companies: DataFrame,
    vehicles: DataFrame,
    land: DataFrame,
    alerts: DataFrame,
    as_of: dt.date,
) -> DataFrame:
    """Every joined side is reduced to one row per taxpayer first, and all joins share that key.

    The taxpayers are shuffled once; each aggregate already lies in the partitioning the joins need.
    """
    joined = attach_assets(
        with_filing_measures(taxpayers.select(*_PROFILE), paye_returns, vat_returns).join(
            revenue_contribution(payments), "taxpayer_id", "left"
        ),
        companies, vehicles, land,
    ).join(fraud_indicators(alerts), "taxpayer_id", "left")

    rate, score = F.col("filing_compliance_rate"), F.col("max_fraud_risk_score")
    return joined.select(
        *_PROFILE,
        full_years(F.col("registration_date"), as_of).alias("years_registered"),
        *_FILING,
        *[zero_if_null(F.col(name)).alias(name) for name in _REVENUE],
        "first_payment_date",
        "last_payment_date",
        zero_if_null(F.col("active_payment_months")).alias("active_payment_months"),
        *[zero_if_null(F.col(name)).alias(name) for name in _ASSET_COUNTS + _ASSET_VALUES],
        zero_if_null(F.col("fraud_alert_count")).alias("fraud_alert_count"),
        zero_if_null(score).alias("fraud_risk_score"),
        "fraud_alert_types",
        risk_category(score, F.col("chronic_late_filer"), F.col("low_filing_rate"), rate).alias(
            "risk_category_calculated"
        ),
        size_category(F.col("annual_turnover")).alias("business_size_category"),
        engagement_score(F.col("email"), F.col("active_payment_months"), rate).alias("engagement_score"),
        F.lit(as_of).cast("timestamp").alias("last_updated"),
    )


def taxpayer_360_simple(
    taxpayers: DataFrame,
    paye_returns: DataFrame,
    vat_returns: DataFrame,
    payments: DataFrame,
    alerts: DataFrame,
    as_of: dt.date,
) -> DataFrame:
    """The reduced variant: open alerts only, no assets and no calculated scores."""
    paid = (
        stg_payments(payments)
        .groupBy("taxpayer_id")
        .agg(
            _paid("PAYE").alias("total_paye_paid"),
            _paid("VAT").alias("total_vat_paid"),
            F.sum("amount").alias("total_tax_paid"),
            F.countDistinct("payment_channel").alias("payment_channels_used"),
            F.min("payment_date").alias("first_payment_date"),
            F.max("payment_date").alias("last_payment_date"),
        )
    )
    counted = ["total_paye_paid", "total_vat_paid", "total_tax_paid", "payment_channels_used"]
    filings = [
        "total_paye_returns", "paye_returns_filed", "paye_on_time", "total_vat_returns", "vat_returns_filed",
        "vat_on_time",
    ]
    joined = taxpayers
    for side in (
        paid,
        filing_summary_simple(paye_returns, "paye"),
        filing_summary_simple(vat_returns, "vat"),
        alert_rollup(alerts, ["Open"], "fraud_risk_score"),
    ):
        joined = joined.join(side, "taxpayer_id", "left")
    filled = joined.withColumns(
        {name: zero_if_null(F.col(name)) for name in [*counted, *filings, "fraud_alert_count", "fraud_risk_score"]}
    )
    return filled.select(
        *taxpayers.columns,
        *counted,
        "first_payment_date",
        "last_payment_date",
        *filings,
        filing_rate(
            F.col("paye_returns_filed") + F.col("vat_returns_filed"),
            F.col("total_paye_returns") + F.col("total_vat_returns"),
        ).alias("filing_compliance_rate"),
        "fraud_alert_count",
        "fraud_risk_score",
        "fraud_alert_types",
        full_years(F.col("registration_date"), as_of).alias("years_registered"),
    )
