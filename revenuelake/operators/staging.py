"""Staged tables: the raw columns plus the fields every later step derives from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revenuelake import constants as C
from revenuelake.functions.ratios import ratio
from revenuelake.schemas import SCHEMAS


def stg_taxpayers(taxpayers: DataFrame) -> DataFrame:
    return taxpayers.select(*SCHEMAS["taxpayers"].names)


def _filing_status() -> Column:
    return (
        F.when(F.col("filing_date").isNull(), C.NOT_FILED)
        .when(F.col("filing_date") > F.col("due_date"), C.LATE)
        .otherwise(C.ON_TIME)
    )


def _with_filing(returns: DataFrame, table: str) -> DataFrame:
    """``days_late`` is negative for an early filing and NULL when nothing was filed."""
    return returns.select(
        *SCHEMAS[table].names,
        _filing_status().alias("filing_status"),
        F.datediff("filing_date", "due_date").alias("days_late"),
    )


def stg_paye_returns(paye_returns: DataFrame) -> DataFrame:
    return _with_filing(paye_returns, "paye_returns")


def stg_vat_returns(vat_returns: DataFrame) -> DataFrame:
    effective = F.when(F.col("total_sales") > 0, ratio(F.col("output_vat"), F.col("total_sales"))).otherwise(0.0)
    return _with_filing(vat_returns, "vat_returns").withColumn("vat_rate_effective", effective)


def stg_payments(payments: DataFrame) -> DataFrame:
    return payments.filter(F.col("status") == "Completed").select(
        *SCHEMAS["payments"].names,
        F.year("payment_date").alias("payment_year"),
        F.month("payment_date").alias("payment_month"),
        F.quarter("payment_date").alias("payment_quarter"),
    )
