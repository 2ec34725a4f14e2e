"""Sources: CSV files, stored tables and databases, always with an explicit schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DateType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

from revenuelake import constants as C
from revenuelake.schemas import SCHEMAS

# Values a missing column takes, as declared by the tables.
COLUMN_DEFAULTS = {
    "taxpayers": {"risk_category": "Low", "compliance_score": 0.75},
    "fraud_alerts": {"status": "Open"},
}


def _typed(name: str, kind: DataType) -> Column:
    """Text to the column's type. Malformed dates become NULL; other malformed text is an error."""
    if isinstance(kind, StringType):
        return F.nullif(F.col(name), F.lit("")).cast(kind)
    text = F.nullif(F.trim(F.col(name)), F.lit(""))
    if name in C.DATE_COLUMNS:
        return F.try_to_timestamp(text).cast(kind)
    if isinstance(kind, (DateType, TimestampType)):
        return text.cast(kind)
    if isinstance(kind, (IntegerType, LongType)):
        return text.cast("decimal(20,4)").cast(kind)  # files written by pandas may hold 25.0
    if isinstance(kind, ArrayType):
        return F.split(text, r"\|")
    return text.cast(kind)


def read_csv_table(
    spark: SparkSession, table: str, path: str, escaped: bool = False, multi_line: bool = False
) -> DataFrame:
    """Header CSV files as the typed table. Columns are matched by name; unknown ones are an error.

    All files of a folder need the same columns in the same order; another header is an error. Texts keep their
    blanks. ``escaped`` restores the line ends that ``write_csv`` escapes, so that such files can be split;
    ``multi_line`` reads other files whose quoted texts hold line ends, one task for each file.
    """
    schema = SCHEMAS[table]
    options = {"header": True, "escape": '"', "multiLine": multi_line}
    names = spark.read.options(**options).csv(path).columns
    texts = StructType([StructField(n, StringType()) for n in names])
    raw = spark.read.schema(texts).options(**options, enforceSchema=False).csv(path)
    if escaped:
        raw = raw.select(*[line_ends_restored(F.col(n)).alias(n) for n in names])
    unknown = sorted(set(raw.columns) - set(schema.names))
    if unknown:
        raise ValueError(f"{table}: unknown columns {unknown}")
    defaults = COLUMN_DEFAULTS.get(table, {})
    return raw.select(
        *[
            (_typed(f.name, f.dataType) if f.name in raw.columns else F.lit(defaults.get(f.name)).cast(f.dataType)).alias(
                f.name
            )
            for f in schema.fields
        ]
    )


def line_ends_escaped(text: Column) -> Column:
    """Escape signs and line ends as two visible characters each."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def line_ends_restored(text: Column) -> Column:
    """The inverse of ``line_ends_escaped``."""
    mark = "\u0000"  # stands for a doubled escape sign meanwhile
    kept = F.replace(text, F.lit("\\\\"), F.lit(mark))
    lines = F.replace(F.replace(kept, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))
    return F.replace(lines, F.lit(mark), F.lit("\\"))


def read_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A stored Parquet table; only the columns and rows a query needs are read.

    Payments keep their folder column ``payment_month``, which date filters use to skip folders.
    """
    return spark.read.schema(SCHEMAS[table]).parquet(f"{folder.rstrip('/')}/{table}")


def read_jdbc_table(
    spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None,
    partition_column: str | None = None, lower: str | None = None, upper: str | None = None, partitions: int = 32,
) -> DataFrame:
    """A database table; with a partition column the executors read disjoint ranges in parallel."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if partition_column:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", partitions)
        )
    return reader.load()


def region_districts(regions: DataFrame) -> DataFrame:
    """One row per region and district."""
    return regions.select("region_id", "region_name", F.explode("districts").alias("district"))
