"""Daily transaction checks and the figures of the insight report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revenuelake import constants as C
from revenuelake.functions.dates import days_after, in_period
from revenuelake.functions.ratios import pct_change
from revenuelake.operators.skew import exact_quantile, heavy_keys, salted_join, split_join
from revenuelake.session import materialize

MAX_CATEGORIES = 200

_COPY = ["tx_date", "taxpayer_id", "amount", "tax_type"]


def validate_transactions(transactions: DataFrame, processed_at: dt.datetime | None = None) -> DataFrame:
    """Mark duplicates and unusually high amounts per day; ``processed_at`` is stored as ``processing_time``.

    Every copy of a (taxpayer, amount, tax type) is a duplicate; an amount above the 95th percentile of
    its tax type overrides that. Both facts depend only on day, tax type, taxpayer and amount, so the
    copies are counted once, and limits and flags are found from the stored counts.
    """
    dated = transactions.withColumn("tx_date", F.to_date("ts"))
    if processed_at is not None:
        dated = dated.withColumn("processing_time", F.lit(processed_at))
    combos = materialize(dated.groupBy(*_COPY).agg(F.count(F.lit(1)).alias("copies")), "transaction-combinations")
    limits = exact_quantile(combos, ["tx_date", "tax_type"], "amount", C.HIGH_AMOUNT_QUANTILE, weight="copies")
    status = (
        F.when(F.col("amount").cast("double") > F.col("threshold"), C.HIGH_AMOUNT_WARNING)
        .when(F.col("copies") > 1, C.DUPLICATE_WARNING)
        .otherwise(C.VALID)
    )
    checked = (
        salted_join(combos, limits, ["tx_date", "tax_type"], ["taxpayer_id", "amount"], how="left")
        .select(*_COPY, status.alias("validation_status"), (F.col("copies") > 1).alias("is_duplicate"))
        .filter(F.col("validation_status") != C.VALID)
    )
    # Only flagged combinations take part. Those with very many copies are joined without a shuffle.
    marked = split_join(
        dated, checked, _COPY, heavy_keys(combos, _COPY, "copies"), "left", null_safe=True
    ).select(
        *dated.columns,
        F.coalesce("validation_status", F.lit(C.VALID)).alias("validation_status"),
        F.coalesce("is_duplicate", F.lit(False)).alias("is_duplicate"),
    )
    return marked.withColumn(
        "status", F.when(F.col("validation_status") == C.VALID, "Completed").otherwise("Under Review")
    )


def _flag_name(prefix: str, value: str) -> str:
    return f"{prefix}_{value}".lower().replace(" ", "_")


def feature_columns(channels: Sequence[str] = C.PAYMENT_CHANNELS, tax_types: Sequence[str] = C.TAX_TYPES) -> list[str]:
    flags = [*[_flag_name("channel", c) for c in channels], *[_flag_name("type", t) for t in tax_types]]
    return ["amount_value", "risk_flag_value", "hour", "weekend_value", *dict.fromkeys(flags)]


def categories(transactions: DataFrame, column: str, accepted: Sequence[str] = (), limit: int = MAX_CATEGORIES) -> list[str]:
    """The accepted values, then all others of a column, in order; more than ``limit`` found are an error."""
    found = transactions.where(F.col(column).isNotNull()).select(column).distinct().limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"{column} has more than {limit} values, too many for a flag each")
    return [*accepted, *sorted({r[0] for r in found} - set(accepted))]


def _flags(prefix: str, column: str, values: Sequence[str]) -> dict[str, Column]:
    """One 0/1 column for each name; values that share a name share a flag. A value without a flag is an error."""
    named: dict[str, list[str]] = {}
    for value in values:
        named.setdefault(_flag_name(prefix, value), []).append(value)
    given = F.col(column)
    unknown = given.isNotNull() & ~given.isin(list(values))
    failed = F.raise_error(F.concat(F.lit(f"no flag for {column} "), given)).cast("int")
    return {name: F.when(unknown, failed).otherwise(F.coalesce(given.isin(same).cast("int"), F.lit(0))) for name, same in named.items()}


def transaction_features(
    transactions: DataFrame,
    channels: Sequence[str] | None = None,
    tax_types: Sequence[str] | None = None,
) -> DataFrame:
    """Hour, weekend and one 0/1 column per channel and tax type.

    The channels are the accepted ones and those of the data, the tax types those of the data. Where a list is given, a value outside it is an error.
    """
    channels = categories(transactions, "payment_channel", C.PAYMENT_CHANNELS) if channels is None else channels
    tax_types = categories(transactions, "tax_type") if tax_types is None else tax_types
    one_hot = _flags("channel", "payment_channel", channels) | _flags("type", "tax_type", tax_types)
    weekend = F.weekday("ts") >= 5
    return transactions.withColumns(
        {
            "hour": F.hour("ts"),
            "is_weekend": weekend,
            "amount_value": F.coalesce(F.col("amount").cast("double"), F.lit(0.0)),
            "risk_flag_value": F.coalesce(F.col("risk_flag").cast("int"), F.lit(0)),
            "weekend_value": weekend.cast("int"),
            **one_hot,
        }
    )


def anomaly_reasons() -> Column:
    """Reasons joined with "; ", or a fallback; expects amount, hour, is_weekend and risk_flag."""
    reasons = F.concat_ws(
        "; ",
        F.when(F.col("amount") > C.REASON_AMOUNT_LIMIT, C.REASON_HIGH_AMOUNT),
        F.when((F.col("hour") < 6) | (F.col("hour") > 22), C.REASON_HOURS),
        F.when(F.col("is_weekend"), C.REASON_WEEKEND),
        F.when(F.col("risk_flag"), C.REASON_FLAGGED),
    )
    return F.coalesce(F.nullif(reasons, F.lit("")), F.lit(C.REASON_FALLBACK))


def with_anomaly_reasons(featured: DataFrame) -> DataFrame:
    return featured.withColumn("alert_reason", anomaly_reasons())


def anomaly_summary(anomalies: DataFrame, top: int = 5) -> DataFrame:
    """One row: number of anomalies, amount at risk and the taxpayers of the most anomalous rows.

    A low score is anomalous. The list is a top-k report: its order step keeps ``top`` rows per task.
    """
    figures = anomalies.agg(
        F.count(F.lit(1)).alias("anomalies_detected"),
        F.coalesce(F.sum("amount").cast("double"), F.lit(0.0)).alias("total_at_risk"),
    )
    lowest = anomalies.orderBy("anomaly_score", "transaction_id").limit(top)
    taxpayers = lowest.agg(
        F.array_sort(F.collect_list(F.struct("anomaly_score", "transaction_id", "taxpayer_id"))).alias("rows")
    ).select(F.transform("rows", lambda r: r["taxpayer_id"]).alias("top_risk_taxpayers"))
    return figures.crossJoin(taxpayers)  # two one-row aggregates


def _month_of(day: dt.date) -> tuple[dt.date, dt.date]:
    start = day.replace(day=1)
    return start, (start + dt.timedelta(days=32)).replace(day=1)


def revenue_insights(payments: DataFrame, as_of: dt.date) -> DataFrame:
    """Month of ``as_of`` against the month before, over payments of every status, in one pass."""
    start, end = _month_of(as_of)
    before, _ = _month_of(start - dt.timedelta(days=1))
    current = F.col("payment_date") >= F.lit(start)
    months = in_period(payments, start=before, before=end).agg(
        F.sum(F.when(current, F.col("amount"))).cast("double").alias("current_total"),
        F.sum(F.when(~current, F.col("amount"))).cast("double").alias("previous_total"),
        F.countDistinct(F.when(current, F.col("taxpayer_id"))).alias("active_taxpayers"),
    )
    growth = F.coalesce(pct_change(F.col("current_total"), F.col("previous_total")), F.lit(0.0))
    return months.select(
        F.coalesce("current_total", F.lit(0.0)).alias("current_month_revenue"),
        growth.alias("growth_rate"),
        "active_taxpayers",
        F.when(growth > 0, "on_track").otherwise("below_target").alias("status"),
    )


def compliance_insights(taxpayers: DataFrame) -> DataFrame:
    score = F.col("compliance_score")
    return taxpayers.agg(
        F.count_if(score < 0.5).alias("low_compliance_count"),
        F.count_if(score >= 0.8).alias("high_compliance_count"),
        F.avg(score.cast("double")).alias("average_score"),
    )


def collection_projection_7d(payments: DataFrame, as_of: dt.date) -> DataFrame:
    """The mean daily total of the last 30 days, projected over the next seven with a 15 % band."""
    recent = in_period(payments, start=days_after(as_of, -30))
    daily = recent.groupBy("payment_date").agg(F.sum("amount").cast("double").alias("total"))
    mean = daily.agg(F.avg("total").alias("predicted_amount")).filter(F.col("predicted_amount").isNotNull())
    days = F.sequence(F.lit(days_after(as_of, 1)), F.lit(days_after(as_of, 7)))
    amount = F.col("predicted_amount")
    return mean.select(
        F.explode(days).alias("date"),
        "predicted_amount",
        (amount * 0.85).alias("lower_bound"),
        (amount * 1.15).alias("upper_bound"),
        (amount * 7).alias("total_expected"),
    )
