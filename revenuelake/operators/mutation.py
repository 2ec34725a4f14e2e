"""Table changes as whole-table expressions: each returns the new content of the table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revenuelake import constants as C
from revenuelake.functions.ratios import clamp, ratio, zero_if_null
from revenuelake.operators.skew import global_row_number


def _stamp(as_of: dt.date) -> Column:
    return F.lit(as_of).cast("timestamp")


def touch_updated_at(table: DataFrame, changed: Column, as_of: dt.date) -> DataFrame:
    """Set ``updated_at`` on the changed rows, as the update trigger does."""
    return table.withColumn("updated_at", F.when(changed, _stamp(as_of)).otherwise(F.col("updated_at").cast("timestamp")))


def upsert_forecasts(target: DataFrame, source: DataFrame, as_of: dt.date) -> DataFrame:
    """Rows of ``source`` replace or extend ``target`` on (forecast_date, tax_type)."""
    keys = ["forecast_date", "tax_type"]
    incoming = source.select(
        *keys,
        *[F.round(name, 2).cast("decimal(15,2)").alias(name) for name in ("predicted_revenue", "lower_bound", "upper_bound")],
        _stamp(as_of).alias("created_at"),
    )
    return target.join(incoming.select(*keys), keys, "left_anti").select(*incoming.columns).unionByName(incoming)


def _return_counts(returns: DataFrame, tax: str) -> DataFrame:
    return returns.groupBy("taxpayer_id").agg(
        F.count(F.lit(1)).alias(f"{tax}_expected"), F.count_if(F.col("status") == "Filed").alias(f"{tax}_filed")
    )


def update_compliance_scores(
    taxpayers: DataFrame, paye_returns: DataFrame, vat_returns: DataFrame, as_of: dt.date
) -> DataFrame:
    """Score = filed share of expected returns, kept between 0.1 and 0.95.

    Without any expected return the share is NULL, which LEAST skips: such taxpayers get 0.95.
    """
    joined = taxpayers.join(_return_counts(paye_returns, "paye"), "taxpayer_id", "left").join(
        _return_counts(vat_returns, "vat"), "taxpayer_id", "left"
    )
    filed = zero_if_null(F.col("paye_filed")) + zero_if_null(F.col("vat_filed"))
    expected = zero_if_null(F.col("paye_expected")) + zero_if_null(F.col("vat_expected"))
    score = clamp(ratio(filed, expected), C.SCORE_FLOOR, C.SCORE_CEILING).cast("decimal(3,2)")
    scored = joined.withColumn("compliance_score", score).select(*taxpayers.columns)
    return touch_updated_at(scored, F.lit(True), as_of)


def apply_fraud_scores(taxpayers: DataFrame, scores: DataFrame, as_of: dt.date) -> DataFrame:
    """Take over the scored taxpayers' risk band and set their score to 1 - p, kept between 0.1 and 0.95."""
    probability = F.col("fraud_probability")
    found = probability.isNotNull()
    new_score = clamp(1 - probability, C.SCORE_FLOOR, C.SCORE_CEILING).cast("decimal(3,2)")
    joined = taxpayers.join(
        scores.select("taxpayer_id", "fraud_probability", "fraud_risk_category"), "taxpayer_id", "left"
    ).withColumns(
        {
            "risk_category": F.when(found, F.col("fraud_risk_category")).otherwise(F.col("risk_category")),
            "compliance_score": F.when(found, new_score).otherwise(F.col("compliance_score")),
        }
    )
    return touch_updated_at(joined, found, as_of).select(*taxpayers.columns)


def close_open_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.withColumn("status", F.when(F.col("status") == "Open", "Closed").otherwise(F.col("status")))


def redate_old_alerts(alerts: DataFrame, before: dt.date, new_date: dt.date) -> DataFrame:
    redated = F.when(F.col("alert_date") < F.lit(before), F.lit(new_date)).otherwise(F.col("alert_date"))
    return alerts.withColumn("alert_date", redated)


def append_alerts(alerts: DataFrame, new_alerts: DataFrame, as_of: dt.date) -> DataFrame:
    """Stored alerts followed by new ones; columns a side lacks are NULL.

    New alerts are numbered on from the highest stored id, in the order of taxpayer, type and text, and get
    ``as_of`` as their creation time.
    """
    order = [F.col("taxpayer_id"), F.col("alert_type"), F.col("description")]
    numbered = global_row_number(new_alerts.drop("alert_id", "created_at"), order, "_place")
    highest = alerts.agg(F.coalesce(F.max("alert_id"), F.lit(0)).alias("_highest"))  # one row
    keyed = numbered.crossJoin(F.broadcast(highest)).select(
        (F.col("_highest") + F.col("_place")).alias("alert_id"), *numbered.drop("_place").columns, _stamp(as_of).alias("created_at")
    )
    return alerts.unionByName(keyed, allowMissingColumns=True)
