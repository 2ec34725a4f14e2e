"""The revenue summary kept up to date from late payments alone.

Sums and counts of payments merge by addition, distinct payers by the union of bitmaps: each taxpayer has a number, and a
state row holds, for one day, tax type, channel, region and block of 64 numbers, a bitmap of those who paid in one ``bigint``. So a
row is small however thinly the payers are spread, there are never more rows than payments, and all aggregates work on fixed
widths. A refresh aggregates only the late payments, reads the state of only the months they touch, and rewrites these months' folders. Every figure is
exact, so it equals a rebuild from all payments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revenuelake.operators.skew import global_row_number, heavy_keys_in_sample, split_join
from revenuelake.session import materialize

GROUP = ["date", "tax_type", "payment_channel", "region"]
STATE = "month string, date date, tax_type string, payment_channel string, region string, payers_block bigint, total_amount decimal(25,2), transaction_count bigint, payers bigint"
BLOCK_BITS = 6  # 64 payers for each bitmap


def number_taxpayers(taxpayers: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """taxpayer_id, payer_number (from 1) and region; taxpayers that are ``known`` keep their numbers, others follow."""
    ids = taxpayers.select("taxpayer_id", "region")
    if known is None:
        return global_row_number(ids, [F.col("taxpayer_id")], "payer_number").select("taxpayer_id", "payer_number", "region")
    kept = ids.join(known.select("taxpayer_id", "payer_number"), "taxpayer_id")
    added = number_taxpayers(ids.join(known, "taxpayer_id", "left_anti"))
    last = known.agg(F.coalesce(F.max("payer_number"), F.lit(0)).alias("_last"))  # one row
    moved = added.crossJoin(F.broadcast(last)).withColumn("payer_number", F.col("payer_number") + F.col("_last")).drop("_last")
    return kept.select("taxpayer_id", "payer_number", "region").unionByName(moved)


def summary_state(payments: DataFrame, numbers: DataFrame) -> DataFrame:
    """State rows of the payments; payments of unknown taxpayers belong to no region and are left out, as in the summary."""
    paid = payments.select("payment_id", "taxpayer_id", F.col("payment_date").cast("date").alias("date"), "tax_type", "payment_channel", "amount")
    owned = split_join(paid, numbers, ["taxpayer_id"], heavy_keys_in_sample(paid, ["taxpayer_id"], "payment_id"))
    block = F.shiftright("payer_number", BLOCK_BITS).alias("payers_block")
    bit = F.expr(f"shiftleft(1L, cast(payer_number & {(1 << BLOCK_BITS) - 1} as int))")
    return owned.groupBy(F.date_format("date", "yyyy-MM").alias("month"), *GROUP, block).agg(
        F.sum("amount").cast("decimal(25,2)").alias("total_amount"),
        F.count(F.lit(1)).alias("transaction_count"),
        F.bit_or(bit).alias("payers"),
    )


def merged_states(*states: DataFrame) -> DataFrame:
    """The state of all payments together."""
    first, *rest = states
    for state in rest:
        first = first.unionByName(state)
    return first.groupBy("month", *GROUP, "payers_block").agg(
        F.sum("total_amount").cast("decimal(25,2)").alias("total_amount"),
        F.sum("transaction_count").alias("transaction_count"),
        F.bit_or("payers").alias("payers"),
    )


def summary_of(state: DataFrame) -> DataFrame:
    """The revenue summary, with its month: a payer's number lies in one block, so the blocks' counts add up."""
    return state.groupBy("month", *GROUP).agg(
        F.sum("total_amount").alias("total_amount"),
        F.sum("transaction_count").alias("transaction_count"),
        F.sum(F.bit_count("payers")).alias("unique_taxpayers"),
    )


def read_state(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(STATE).parquet(f"{folder.rstrip('/')}/state")


def _write_months(df: DataFrame, path: str) -> None:
    """Replace the folders of the months in ``df`` and no others."""
    writer = df.hint("rebalance", "month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("month").parquet(path)


def _store(state: DataFrame, folder: str) -> None:
    folder = folder.rstrip("/")
    _write_months(state, f"{folder}/state")
    _write_months(summary_of(state), f"{folder}/summary")


def build_summary(payments: DataFrame, numbers: DataFrame, folder: str) -> None:
    """State and summary of all payments, one folder for each month."""
    _store(materialize(summary_state(payments, numbers), "summary-state"), folder)


def touched_state(spark: SparkSession, folder: str, late: DataFrame) -> tuple[DataFrame, list[str]]:
    """The stored state of the months in ``late`` (one name for each touched month reaches the driver)."""
    months = sorted(r["month"] for r in late.select("month").distinct().collect())
    return read_state(spark, folder).filter(F.col("month").isin(months)), months


def refresh_summary(late_payments: DataFrame, numbers: DataFrame, folder: str) -> list[str]:
    """Add payments that no build or refresh has seen; returns the months whose folders were rewritten.

    The merged months are written apart first, because the folders they come from are replaced.
    """
    late = materialize(summary_state(late_payments, numbers), "late-state")
    old, months = touched_state(late_payments.sparkSession, folder, late)
    if months:
        _store(materialize(merged_states(old, late), "merged-state"), folder)
    return months
