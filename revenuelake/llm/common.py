"""What several operators of this folder share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def whole_text(column: str = "text") -> Column:
    """The text, or an empty one where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def sample_by_hash(df: DataFrame, key: str, rows: int, seed: int = 42) -> DataFrame:
    """About ``rows`` rows (all, if there are fewer), chosen by the hash of ``key`` over the whole table."""
    total = df.count()
    if total <= rows:
        return df
    buckets = 1 << 30
    return df.where(F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(buckets)) < int(buckets * rows / total))


def hand_back() -> None:
    """Give the memory that a Python worker has freed back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def hand_back_driver(spark: SparkSession) -> None:
    """The same for the driver, in Python and in its JVM, whose heap shrinks when it is collected as a whole."""
    gc.collect()
    hand_back()
    spark.sparkContext._jvm.java.lang.System.gc()


def tidy(over_batches: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same function over batches, handing memory back when its task ends.

    Workers outlive their tasks and share the executor's memory with stages that need no Python.
    """

    def run(batches: Iterator) -> Iterator:
        try:
            yield from over_batches(batches)
        finally:
            hand_back()

    return run


def unit_hash(*columns: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the values alone."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("~")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
