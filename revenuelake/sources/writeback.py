"""Write-back of changed partitions: a stored table takes over new content, and folders whose rows stay the same are not touched."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from revenuelake.operators.mutation import upsert_forecasts
from revenuelake.session import materialize

FORECAST_MONTH = "forecast_month"


def _digests(table: DataFrame, partition: str) -> DataFrame:
    """Rows and two sums of hashes of each partition: equal for equal rows in any order, repeats counted."""

    def total(seed: int) -> Column:
        # A null and a value never hash alike: the pattern of nulls is part of what is hashed.
        nulls = F.array(*[F.col(name).isNull() for name in columns])
        return F.sum(F.xxhash64(F.lit(seed), nulls, *columns).cast("decimal(38,0)"))

    columns = [name for name in table.columns if name != partition]
    return table.groupBy(partition).agg(F.count(F.lit(1)).alias("rows"), total(1).alias("first"), total(2).alias("second"))


def write_changed(new: DataFrame, stored: DataFrame, path: str, partition: str) -> list[str]:
    """Replace the folders of ``path`` whose rows in ``new`` differ from those in ``stored``, and return their values, sorted.

    ``new`` holds whole partitions; partitions that it lacks stay. It may read from ``path``: its rows are written to the
    shared folder first. A repeated run finds equal digests and writes nothing; one that was lost halfway starts anew from
    whole partitions. Partition values are not null.
    """
    kept = materialize(new.select(*stored.columns), "write-back")
    before, after = _digests(stored, partition), _digests(kept, partition)
    same = (before["rows"] == after["rows"]) & (before["first"] == after["first"]) & (before["second"] == after["second"])
    differing = after.join(before, after[partition].eqNullSafe(before[partition]) & same, "left_anti").select(partition)
    values = sorted(r[0] for r in differing.collect())  # partition values only, one for each folder
    if values:
        changed = kept.where(F.col(partition).isin(values)).hint("rebalance", partition)
        changed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    return values


def store_forecasts(forecasts: DataFrame, path: str) -> None:
    """A new table of forecasts, one folder for each month."""
    month = F.date_format("forecast_date", "yyyy-MM").alias(FORECAST_MONTH)
    forecasts.select("*", month).hint("rebalance", FORECAST_MONTH).write.partitionBy(FORECAST_MONTH).parquet(path)


def read_forecasts(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The stored forecasts with their month; a filter on the month skips folders."""
    return spark.read.schema(StructType(schema.fields).add(FORECAST_MONTH, "string")).parquet(path)


def upsert_stored_forecasts(spark: SparkSession, path: str, schema: StructType, source: DataFrame, as_of: dt.date) -> list[str]:
    """``upsert_forecasts`` on the stored table: only months of ``source`` are read, only changed ones written.

    A forecast that comes again with the same figures keeps its row, so a rerun on a later day changes nothing either.
    """
    month = F.date_format("forecast_date", "yyyy-MM")
    fresh = materialize(source, "forecast-source")
    months = sorted(r[0] for r in fresh.select(month).distinct().collect())  # months only
    stored = read_forecasts(spark, path, schema).where(F.col(FORECAST_MONTH).isin(months))
    figures = ["forecast_date", "tax_type", "predicted_revenue", "lower_bound", "upper_bound"]
    rounded = fresh.select("forecast_date", "tax_type", *[F.round(c, 2).cast("decimal(15,2)").alias(c) for c in figures[2:]])
    alike = [rounded[c].eqNullSafe(stored[c]) for c in figures]
    differing = rounded.join(stored, alike, "left_anti")
    updated = upsert_forecasts(stored.drop(FORECAST_MONTH), differing, as_of).withColumn(FORECAST_MONTH, month)
    return write_changed(updated, stored, path, FORECAST_MONTH)
