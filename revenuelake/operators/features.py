"""Feature tables for the fraud models: one row per corporate or partnership taxpayer.

Payments and returns are aggregated per taxpayer before they are joined. Joining the three tables first
would multiply their rows with each other.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revenuelake.functions.dates import full_years
from revenuelake.functions.ratios import ratio, zero_if_null


def _mean_amount() -> Column:
    return ratio(F.sum("amount"), F.count("amount"))


def _modelled(taxpayers: DataFrame) -> DataFrame:
    return taxpayers.filter(F.col("taxpayer_type").isin("Corporate", "Partnership"))


def _is_late() -> Column:
    return F.col("filing_date") > F.col("due_date")


def _zero(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({name: zero_if_null(F.col(name)) for name in names})


def _label_by_score() -> Column:
    return (F.col("risk_category") == "High") & (F.col("compliance_score") < 0.5)


def fraud_features_weekly(
    taxpayers: DataFrame, paye_returns: DataFrame, vat_returns: DataFrame, payments: DataFrame, as_of: dt.date
) -> DataFrame:
    """Filing, payment and sales statistics with the label, for taxpayers with at least one return."""
    late = F.avg(F.when(_is_late(), 1.0).otherwise(0.0))
    sales, amount = F.col("total_sales").cast("double"), F.col("amount").cast("double")
    mean_sales = ratio(F.sum("total_sales"), F.count("total_sales"))
    paye = paye_returns.groupBy("taxpayer_id").agg(
        F.count("return_id").alias("paye_returns_count"), late.alias("paye_late_rate")
    )
    vat = vat_returns.groupBy("taxpayer_id").agg(
        F.count("return_id").alias("vat_returns_count"),
        late.alias("vat_late_rate"),
        mean_sales.alias("avg_vat_sales"),
        F.stddev_samp(sales).alias("vat_sales_stddev"),
        F.min("total_sales").alias("min_vat_sales"),
        F.max("total_sales").alias("max_vat_sales"),
    )
    paid = payments.groupBy("taxpayer_id").agg(
        F.count("payment_id").alias("payment_count"),
        _mean_amount().alias("avg_payment_amount"),
        F.stddev_samp(amount).alias("payment_amount_stddev"),
        F.countDistinct("payment_channel").alias("payment_channels_used"),
    )
    joined = _modelled(taxpayers).select(
        "taxpayer_id", "taxpayer_type", "business_sector", "annual_turnover", "employee_count", "compliance_score",
        "risk_category",
        full_years(F.col("registration_date"), as_of).alias("years_active"),
        F.when(_label_by_score(), 1).otherwise(0).alias("is_fraud"),
    )
    for side in (paye, vat, paid):
        joined = joined.join(side, "taxpayer_id", "left")
    filled = _zero(
        joined,
        [
            "paye_returns_count", "vat_returns_count", "paye_late_rate", "vat_late_rate", "payment_count",
            "payment_channels_used", "avg_vat_sales", "vat_sales_stddev", "min_vat_sales", "max_vat_sales",
        ],
    )
    return filled.filter((F.col("paye_returns_count") > 0) | (F.col("vat_returns_count") > 0))


def fraud_features_extended(
    taxpayers: DataFrame,
    paye_returns: DataFrame,
    vat_returns: DataFrame,
    payments: DataFrame,
    alerts: DataFrame,
    as_of: dt.date,
) -> DataFrame:
    """Variant with the mean filing delay and a label that also counts a stored alert above 0.7."""
    amount = F.col("amount").cast("double")
    delay = F.when(_is_late(), F.datediff("filing_date", "due_date")).otherwise(0)
    paid = payments.groupBy("taxpayer_id").agg(
        F.count("payment_id").alias("total_payments"),
        F.countDistinct("payment_channel").alias("payment_channels"),
        _mean_amount().alias("avg_payment"),
        F.stddev_samp(amount).alias("payment_stddev"),
        F.max("amount").alias("max_payment"),
    )
    paye = paye_returns.groupBy("taxpayer_id").agg(
        F.count("return_id").alias("paye_returns"), F.avg(delay).alias("avg_paye_delay")
    )
    vat = vat_returns.groupBy("taxpayer_id").agg(F.count("return_id").alias("vat_returns"))
    flagged = (
        alerts.filter(F.col("risk_score") > 0.7).select("taxpayer_id").distinct().withColumn("alerted", F.lit(True))
    )
    joined = _modelled(taxpayers).select(
        "taxpayer_id", "annual_turnover", zero_if_null(F.col("employee_count")).alias("employee_count"),
        "compliance_score", "risk_category",
        full_years(F.col("registration_date"), as_of).alias("years_active"),
    )
    for side in (paid, paye, vat, flagged):
        joined = joined.join(side, "taxpayer_id", "left")
    label = F.when(_label_by_score() | F.coalesce("alerted", F.lit(False)), 1).otherwise(0)
    return (
        _zero(joined, ["total_payments", "payment_channels", "paye_returns", "vat_returns", "avg_paye_delay"])
        .withColumn("is_fraud", label)
        .drop("alerted", "risk_category")
    )


def _filled(df: DataFrame) -> DataFrame:
    """NULL numbers become 0."""
    numeric = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("string", "date", "timestamp", "boolean")]
    return df.withColumns({name: zero_if_null(F.col(name)) for name in numeric})


def derived_features(features: DataFrame) -> DataFrame:
    """Consistency, volatility, reliability and returns per year on top of the weekly features."""
    ratios = features.withColumns(
        {
            "payment_consistency": F.col("avg_payment_amount") / (F.col("payment_amount_stddev") + 1),
            "vat_sales_volatility": F.col("vat_sales_stddev") / (F.col("avg_vat_sales") + 1),
            "filing_reliability": 1 - (F.col("paye_late_rate") + F.col("vat_late_rate")) / 2,
            "returns_per_year": (F.col("paye_returns_count") + F.col("vat_returns_count")) / (F.col("years_active") + 1),
        }
    )
    return _filled(ratios)


def derived_features_extended(features: DataFrame) -> DataFrame:
    """Consistency, payments per year and channel diversity on top of the extended features."""
    ratios = features.withColumns(
        {
            "payment_consistency": F.col("avg_payment") / (F.col("payment_stddev") + 1),
            "payment_velocity": F.col("total_payments") / (F.col("years_active") + 1),
            "channel_diversity": F.col("payment_channels") / F.greatest("total_payments", F.lit(1)),
        }
    )
    return _filled(ratios)


# The label is computed from risk_category and compliance_score, so neither is a feature by default.
WEEKLY_FEATURES = [
    "annual_turnover", "employee_count", "years_active", "paye_returns_count", "vat_returns_count",
    "paye_late_rate", "vat_late_rate", "payment_count", "avg_payment_amount", "payment_amount_stddev",
    "payment_channels_used", "avg_vat_sales", "vat_sales_stddev", "min_vat_sales", "max_vat_sales",
    "payment_consistency", "vat_sales_volatility", "filing_reliability", "returns_per_year",
]
EXTENDED_FEATURES = [
    "annual_turnover", "employee_count", "years_active", "total_payments", "payment_channels", "avg_payment",
    "payment_stddev", "max_payment", "paye_returns", "vat_returns", "avg_paye_delay", "payment_consistency",
    "payment_velocity", "channel_diversity",
]
