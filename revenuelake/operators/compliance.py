"""Filing and payment compliance per taxpayer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revenuelake import constants as C
from revenuelake.functions.ratios import ratio, zero_if_null
from revenuelake.operators.skew import heavy_keys_in_sample, split_join
from revenuelake.operators.staging import stg_paye_returns, stg_payments, stg_vat_returns


def _filing_measures(staged: DataFrame, tax: str) -> DataFrame:
    late = F.when(F.col("days_late") > 0, F.col("days_late"))
    return staged.groupBy("taxpayer_id").agg(
        F.count(F.lit(1)).alias(f"total_{tax}_returns_expected"),
        F.count_if(F.col("status") == "Filed").alias(f"{tax}_returns_filed"),
        F.count_if(F.col("filing_status") == C.ON_TIME).alias(f"{tax}_on_time"),
        F.avg(late).alias(f"avg_{tax}_days_late"),
    )


def paye_compliance(paye_returns: DataFrame) -> DataFrame:
    return _filing_measures(stg_paye_returns(paye_returns), "paye")


def vat_compliance(vat_returns: DataFrame) -> DataFrame:
    return _filing_measures(stg_vat_returns(vat_returns), "vat")


def return_due_dates(paye_returns: DataFrame, vat_returns: DataFrame) -> DataFrame:
    """One row per return id with its due date; a payroll return wins over a VAT return of the same id.

    The grouping leaves the rows partitioned by return id, so a join on that id shuffles them only once.
    """
    none = F.lit(None).cast("date")
    both = paye_returns.select("return_id", F.col("due_date").alias("paye_due"), none.alias("vat_due")).unionByName(
        vat_returns.select("return_id", none.alias("paye_due"), F.col("due_date").alias("vat_due"))
    )
    return both.groupBy("return_id").agg(F.coalesce(F.max("paye_due"), F.max("vat_due")).alias("due_date"))


def join_due_dates(payments: DataFrame, paye_returns: DataFrame, vat_returns: DataFrame) -> DataFrame:
    """Payments that refer to a return, with its due date; expects ``payment_id``.

    Payments without a reference are dropped before the shuffle, where they would all meet in one task. A
    reference shared by very many payments, such as a placeholder, is kept out of the shuffle.
    """
    due = return_due_dates(paye_returns, vat_returns).withColumnRenamed("return_id", "reference_number")
    referring = payments.filter(F.col("reference_number").isNotNull())
    heavy = heavy_keys_in_sample(referring, ["reference_number"], "payment_id")
    return split_join(referring, due, ["reference_number"], heavy)


def payment_behavior(payments: DataFrame, paye_returns: DataFrame, vat_returns: DataFrame) -> DataFrame:
    """Completed payments per taxpayer. Counts rely on ``payment_id`` being the key of the table."""
    completed = stg_payments(payments)
    totals = (
        completed.groupBy("taxpayer_id", "payment_channel")
        .agg(F.count("payment_id").alias("n"), F.sum("amount").alias("amount"))
        .groupBy("taxpayer_id")
        .agg(
            F.sum("n").alias("total_payments"),
            F.sum("amount").alias("total_amount_paid"),
            F.count("payment_channel").alias("payment_channels_used"),
        )
    )
    on_time = (
        join_due_dates(
            completed.select("payment_id", "taxpayer_id", "payment_date", "reference_number"), paye_returns, vat_returns
        )
        .filter(F.col("payment_date") <= F.col("due_date"))
        .groupBy("taxpayer_id")
        .agg(F.count(F.lit(1)).alias("on_time_payments"))
    )
    return totals.join(on_time, "taxpayer_id", "left").withColumn(
        "on_time_payments", zero_if_null(F.col("on_time_payments"))
    )


_FILING_COUNTS = [
    "total_paye_returns_expected", "paye_returns_filed", "paye_on_time", "avg_paye_days_late",
    "total_vat_returns_expected", "vat_returns_filed", "vat_on_time", "avg_vat_days_late",
]


def filing_rate(filed: Column, expected: Column) -> Column:
    """Filed returns over expected returns; 0 when none are expected."""
    return F.when(expected > 0, ratio(filed, expected)).otherwise(0.0)


def with_filing_measures(taxpayers: DataFrame, paye_returns: DataFrame, vat_returns: DataFrame) -> DataFrame:
    """Taxpayers with their filing counts, rate and flags; every side has one row per taxpayer."""
    joined = taxpayers.join(paye_compliance(paye_returns), "taxpayer_id", "left").join(
        vat_compliance(vat_returns), "taxpayer_id", "left"
    )
    counts = joined.withColumns({name: zero_if_null(F.col(name)) for name in _FILING_COUNTS})
    filed = F.col("paye_returns_filed") + F.col("vat_returns_filed")
    expected = F.col("total_paye_returns_expected") + F.col("total_vat_returns_expected")
    chronic = F.greatest("avg_paye_days_late", "avg_vat_days_late") > C.CHRONIC_LATE_DAYS
    return counts.withColumns(
        {
            "filing_compliance_rate": filing_rate(filed, expected),
            "chronic_late_filer": chronic,
            "low_filing_rate": filed < expected * C.LOW_FILING_SHARE,
        }
    )


def taxpayer_compliance(
    taxpayers: DataFrame, paye_returns: DataFrame, vat_returns: DataFrame, payments: DataFrame
) -> DataFrame:
    base = taxpayers.select(
        "taxpayer_id", "name", "taxpayer_type", "risk_category",
        F.col("compliance_score").alias("original_compliance_score"),
    )
    payment_columns = ["total_payments", "total_amount_paid", "payment_channels_used", "on_time_payments"]
    return (
        with_filing_measures(base, paye_returns, vat_returns)
        .join(payment_behavior(payments, paye_returns, vat_returns), "taxpayer_id", "left")
        .withColumns({name: zero_if_null(F.col(name)) for name in payment_columns})
    )


def filing_summary_simple(returns: DataFrame, tax: str) -> DataFrame:
    """Counts on the raw returns; on time means filed on or before the due date."""
    return returns.groupBy("taxpayer_id").agg(
        F.count(F.lit(1)).alias(f"total_{tax}_returns"),
        F.count_if(F.col("status") == "Filed").alias(f"{tax}_returns_filed"),
        F.count_if(F.col("filing_date") <= F.col("due_date")).alias(f"{tax}_on_time"),
    )
