"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import pathlib
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
ARROW_BATCH_BYTES = "8m"


def build_session(app_name: str = "revenuelake", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the operators rely on; ``settings`` override them."""
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    conf.update({key.replace("__", "."): value for key, value in settings.items()})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; only a local session may fall back to its own.

    Every executor must reach the folder, so on a cluster an unset value is an error.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if current is None:
        if configured is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="revenuelake-"))
        current = context.getCheckpointDir()
    return configured or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where several branches read one expensive result: each branch then scans only its own
    columns, and the planner knows the true size when it considers a broadcast.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, whose Python workers import it for Arrow functions.

    Arrow batches are also bounded by bytes, unless the session says otherwise: ten thousand long texts would
    fill a worker.
    """
    context = spark.sparkContext
    if ARROW_BYTES not in spark.conf.getAll:
        spark.conf.set(ARROW_BYTES, ARROW_BATCH_BYTES)
    if getattr(context, "_revenuelake_shipped", False):
        return
    root = pathlib.Path(__file__).resolve().parent
    archive = pathlib.Path(tempfile.mkdtemp(prefix="revenuelake-")) / "revenuelake.zip"
    with zipfile.ZipFile(archive, "w") as bundle:
        for source in sorted(root.rglob("*.py")):
            bundle.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._revenuelake_shipped = True
