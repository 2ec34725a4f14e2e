"""Trained models kept with a version, their feature columns and their figures.

A store is a folder: ``version=N/model`` holds the MLlib pipeline, ``version=N/columns`` the names of its features in order and
``version=N/figures`` the figures of its evaluation. A version exists once its ``columns``, written last, are complete, so a
writer that is lost half-way leaves no version behind, and versions are never rewritten.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from revenuelake.operators.models import score_taxpayers

_COLUMNS = "place int, column string"


@dataclass(frozen=True)
class StoredModel:
    version: int
    model: PipelineModel
    columns: list[str]
    figures: DataFrame


def stored_versions(spark: SparkSession, folder: str) -> list[int]:
    """The complete versions, ascending; names of folders only, no data is read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder.rstrip("/"))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, "version=*/columns/_SUCCESS")) or []
    return sorted(int(status.getPath().getParent().getParent().getName().split("=")[1]) for status in found)


def save_model(model: PipelineModel, columns: Sequence[str], figures: DataFrame, folder: str) -> int:
    """Store the model as the next version and return its number; fails if another writer takes the same one."""
    spark = figures.sparkSession
    version = max(stored_versions(spark, folder), default=0) + 1
    path = f"{folder.rstrip('/')}/version={version}"
    model.write().overwrite().save(f"{path}/model")  # left by a writer that was lost
    figures.write.mode("overwrite").parquet(f"{path}/figures")
    names = spark.createDataFrame(list(enumerate(columns)), _COLUMNS)
    names.coalesce(1).write.mode("error").parquet(f"{path}/columns")
    return version


def load_model(spark: SparkSession, folder: str, version: int | None = None) -> StoredModel:
    """The given version, or the latest one."""
    known = stored_versions(spark, folder)
    if not known or version is not None and version not in known:
        raise ValueError(f"{folder} holds the versions {known}")
    chosen = known[-1] if version is None else version
    path = f"{folder.rstrip('/')}/version={chosen}"
    rows = spark.read.schema(StructType.fromDDL(_COLUMNS)).parquet(f"{path}/columns").orderBy("place").collect()  # one row a feature
    return StoredModel(chosen, PipelineModel.load(f"{path}/model"), [r["column"] for r in rows], spark.read.parquet(f"{path}/figures"))


def score_with_stored(stored: StoredModel, features: DataFrame) -> DataFrame:
    """Scores of the stored model; a feature that the table lacks is an error. ``model_version`` tells whose they are."""
    missing = sorted(set(stored.columns) - set(features.columns))
    if missing:
        raise ValueError(f"model version {stored.version} needs the columns {missing}")
    return score_taxpayers(stored.model, features).withColumn("model_version", F.lit(stored.version))
