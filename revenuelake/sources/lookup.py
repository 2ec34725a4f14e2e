"""Stored tables for point look-ups: buckets by key, sorted files, small row groups.

A filter on the key reads the files of one bucket, and in them the few row groups whose bounds hold the key. Buckets are
written by a rebalance on the key with as many partitions as buckets, so each bucket is one file, and a bucket that one key
makes large is split over several tasks and files instead of going through one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

BUCKETS = 256
ROW_GROUP_BYTES = 4 << 20


def store_by_key(
    df: DataFrame, name: str, path: str, key: str, order: Sequence[str] = (), buckets: int = BUCKETS,
    row_group_bytes: int = ROW_GROUP_BYTES,
) -> DataFrame:
    """Replace the table at ``path``, known to the session as ``name``, and return a lazy read of it."""
    spark = df.sparkSession
    (
        df.hint("rebalance", buckets, key)
        .write.format("parquet")
        .mode("overwrite")
        .option("path", path)
        .option("parquet.block.size", row_group_bytes)
        .bucketBy(buckets, key)
        .sortBy(key, *order)
        .saveAsTable(name)
    )
    return spark.table(name)


def open_by_key(
    spark: SparkSession, name: str, path: str, schema: StructType, key: str, order: Sequence[str] = (), buckets: int = BUCKETS
) -> DataFrame:
    """A table that another session has stored; key, order and buckets are those it was stored with."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    sorting = ", ".join(f"`{c}`" for c in (key, *order))
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY ({sorting}) "
        f"INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    return spark.table(name)
