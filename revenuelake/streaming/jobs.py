"""Structured Streaming jobs over the realtime transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from revenuelake.operators.insights import validate_transactions
from revenuelake.schemas import SCHEMAS


def read_transaction_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Daily CSV files of a folder as a stream; new files are picked up as they arrive."""
    return (
        spark.readStream.schema(SCHEMAS["realtime_transactions"])
        .option("header", True)
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
        .csv(folder)
    )


def stream_validate_transactions(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Validate each day as a whole: duplicates and the percentile are taken over all its rows so far.

    The rows of each micro-batch are kept by day and batch beside ``target``; the days that a batch touches are
    validated anew and replace their folders. A batch repeated after a failure replaces its own rows first.
    """
    kept = f"{target.rstrip('/')}-rows"

    def check(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        day = F.coalesce(F.date_format("ts", "yyyy-MM-dd"), F.lit("none"))
        dated = batch.withColumn("day", day).withColumn("batch", F.lit(batch_id).cast("long"))
        dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(kept)
        stored = spark.read.schema(dated.schema).parquet(kept)
        days = [r["day"] for r in stored.where(F.col("batch") == batch_id).select("day").distinct().collect()]  # days only
        touched = validate_transactions(stored.where(F.col("day").isin(days)).drop("day", "batch"))
        touched.withColumn("day", day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(target)

    return (
        stream.writeStream.foreachBatch(check)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def daily_revenue(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """Amount and number of transactions per day; rows later than the watermark are dropped."""
    return (
        stream.withWatermark("ts", delay)
        .groupBy(F.window("ts", "1 day").alias("day"))
        .agg(F.sum("amount").alias("revenue"), F.count(F.lit(1)).alias("transactions"))
        .select(F.to_date("day.start").alias("date"), "revenue", "transactions")
    )


def stream_daily_revenue(stream: DataFrame, target: str, checkpoint: str, delay: str = "1 day") -> StreamingQuery:
    """Keep one folder for each day with its figures so far; a day that grows replaces its folder."""

    def upsert(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(target)

    return (
        daily_revenue(stream, delay)
        .writeStream.foreachBatch(upsert)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
