"""Sinks: stored tables, CSV and JSON files, views and the materialised summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revenuelake.operators.revenue import revenue_summary

from revenuelake.sources.readers import line_ends_escaped, read_csv_table
from revenuelake.sources.rejects import read_csv_with_rejects

# Tables loaded from CSV files, in load order.
CSV_TABLES = [
    "taxpayers", "paye_returns", "vat_returns", "payments", "companies_registry", "vehicle_registry",
    "land_registry",
]


def overwrite_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the table. NaN becomes NULL.

    Partitioned output is rebalanced on its partition columns: files get an even size and adaptive
    execution splits an overfull partition value over several tasks.
    """
    floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    cleaned = df.withColumns({n: F.when(~F.isnan(n), F.col(n)) for n in floats}) if floats else df
    if partition_by:
        cleaned = cleaned.hint("rebalance", *partition_by)
    writer = cleaned.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_payments(payments: DataFrame, path: str) -> None:
    """The fact table, one folder per payment month; ``in_period`` skips the folders it does not need."""
    by_month = payments.withColumn("payment_month", F.date_format("payment_date", "yyyy-MM"))
    overwrite_table(by_month, path, ["payment_month"])


def copy_csv_load(
    spark: SparkSession, source: str, target: str, tables: Sequence[str] = CSV_TABLES, rejects: str | None = None
) -> list[str]:
    """Append the CSV file of each table to its stored table and return the tables loaded.

    With a path for ``rejects``, records that cannot be taken are appended there with their file and reasons; without, malformed
    dates become NULL and other malformed values are an error.
    """
    for table in tables:
        path = f"{source.rstrip('/')}/{table}.csv"
        if rejects is None:
            frame = read_csv_table(spark, table, path)
        else:
            frame, rejected = read_csv_with_rejects(spark, table, path)
            rejected.write.mode("append").parquet(rejects)
        frame.write.mode("append").parquet(f"{target.rstrip('/')}/{table}")
    return list(tables)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV files with a header; every task writes its own part. Line ends in texts are escaped, blanks are kept."""
    texts = {f.name: line_ends_escaped(F.col(f.name)) for f in df.schema.fields if f.dataType.typeName() == "string"}
    plain = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.withColumns(texts).write.mode("overwrite").options(**plain).csv(path)


def write_json_report(report: DataFrame, path: str) -> None:
    """A small report as JSON lines. Reports have one row per figure group, so one file is enough."""
    report.coalesce(1).write.mode("overwrite").json(path)


def materialize_summary(payments: DataFrame, taxpayers: DataFrame, path: str) -> None:
    """Create or refresh the revenue summary, one folder per month.

    With dynamic overwrite only the months present in ``payments`` are replaced, so a refresh may pass
    just the recent months.
    """
    summary = revenue_summary(payments, taxpayers).withColumn("month", F.date_format("date", "yyyy-MM"))
    (
        summary.hint("rebalance", "month")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("month")
        .parquet(path)
    )


def publish_views(views: dict[str, DataFrame]) -> None:
    """Staged and intermediate results as session views; nothing is computed until they are queried."""
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)


def publish_marts(marts: dict[str, DataFrame], folder: str) -> None:
    """Marts as stored tables."""
    for name, frame in marts.items():
        overwrite_table(frame, f"{folder.rstrip('/')}/{name}")


