"""The daily load: files to stored tables, checks, staged views, marts and refreshed scores."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from revenuelake.operators import compliance, mutation, profile, quality, revenue, rules, staging
from revenuelake.sources.readers import read_csv_table, read_table
from revenuelake.sources.writers import CSV_TABLES, overwrite_table, publish_marts, publish_views, write_payments


@dataclass(frozen=True)
class Marts:
    """Stored results of a load, as lazy reads."""

    taxpayer_360: DataFrame
    revenue_dashboard_metrics: DataFrame
    fraud_detection_alerts: DataFrame
    taxpayers: DataFrame


def load_csv_tables(spark: SparkSession, source: str, target: str) -> dict[str, DataFrame]:
    """Replace each stored table by its CSV file and return lazy reads of the stored tables."""
    tables = {}
    for table in [*CSV_TABLES, "fraud_alerts"]:
        path = f"{target.rstrip('/')}/{table}"
        frame = read_csv_table(spark, table, f"{source.rstrip('/')}/{table}.csv")
        write_payments(frame, path) if table == "payments" else overwrite_table(frame, path)
        tables[table] = read_table(spark, target, table)
    return tables


def run_daily_load(spark: SparkSession, source: str, target: str, as_of: dt.date) -> Marts:
    """Load, check, refresh the scores, then build the marts, so that they see the new scores."""
    raw, marts = f"{target.rstrip('/')}/raw", f"{target.rstrip('/')}/marts"
    tables = load_csv_tables(spark, source, raw)
    quality.require_quality(quality.dq_report(tables))

    scored = mutation.update_compliance_scores(
        tables["taxpayers"], tables["paye_returns"], tables["vat_returns"], as_of
    )
    overwrite_table(scored, f"{raw}/taxpayers_scored")
    taxpayers = spark.read.parquet(f"{raw}/taxpayers_scored")
    paye, vat, payments = tables["paye_returns"], tables["vat_returns"], tables["payments"]
    publish_views(
        {
            "stg_taxpayers": staging.stg_taxpayers(taxpayers),
            "stg_paye_returns": staging.stg_paye_returns(paye),
            "stg_vat_returns": staging.stg_vat_returns(vat),
            "stg_payments": staging.stg_payments(payments),
            "int_revenue_aggregations": revenue.revenue_aggregations(payments, taxpayers),
            "int_taxpayer_compliance": compliance.taxpayer_compliance(taxpayers, paye, vat, payments),
        }
    )
    publish_marts(
        {
            "taxpayer_360": profile.taxpayer_360(
                taxpayers, paye, vat, payments, tables["companies_registry"], tables["vehicle_registry"],
                tables["land_registry"], tables["fraud_alerts"], as_of,
            ),
            "revenue_dashboard_metrics": revenue.revenue_dashboard_metrics(payments, taxpayers, as_of),
        },
        marts,
    )
    stored_360 = spark.read.parquet(f"{marts}/taxpayer_360")
    publish_marts(
        {"fraud_detection_alerts": rules.fraud_detection_alerts(stored_360, vat, paye, payments, as_of)}, marts
    )
    return Marts(
        stored_360,
        spark.read.parquet(f"{marts}/revenue_dashboard_metrics"),
        spark.read.parquet(f"{marts}/fraud_detection_alerts"),
        taxpayers,
    )
