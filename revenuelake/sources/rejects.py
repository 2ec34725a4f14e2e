"""CSV loads that keep what they cannot take: each record is either a typed row or a reject with its file and reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, IntegerType, LongType, StringType, StructField, StructType

from revenuelake import constants as C
from revenuelake.schemas import PRIMARY_KEYS, REQUIRED, SCHEMAS
from revenuelake.sources.readers import COLUMN_DEFAULTS, line_ends_restored

CORRUPT = "_corrupt_record"
WRONG_FIELDS = "wrong number of fields"


def _given(name: str) -> Column:
    return F.nullif(F.trim(F.col(name)), F.lit(""))


def _tried(name: str, kind: DataType) -> Column:
    """Text to the column's type, NULL where it is malformed."""
    if isinstance(kind, StringType):
        return F.nullif(F.col(name), F.lit(""))
    text = _given(name)
    if name in C.DATE_COLUMNS:
        return F.try_to_timestamp(text).cast(kind)
    if isinstance(kind, (IntegerType, LongType)):
        return text.try_cast("decimal(20,4)").try_cast(kind)
    if isinstance(kind, ArrayType):
        return F.split(text, r"\|")
    return text.try_cast(kind)


def check_csv_table(spark: SparkSession, table: str, path: str, escaped: bool = False) -> DataFrame:
    """One row for each record of the files: ``row`` (typed), ``file``, ``record`` (its text) and ``reasons``.

    A record has a reason if it has more or fewer fields than the header, for each malformed value, and for each key or
    declared NOT NULL column without one. Unknown columns are an error, as in ``read_csv_table``.
    """
    schema = SCHEMAS[table]
    options = {"header": True, "escape": '"'}
    names = spark.read.options(**options).csv(path).columns
    unknown = sorted(set(names) - set(schema.names))
    if unknown:
        raise ValueError(f"{table}: unknown columns {unknown}")
    texts = StructType([StructField(n, StringType()) for n in [*names, CORRUPT]])
    # Without column pruning a record is judged by all its fields whatever a query reads.
    reader = spark.read.schema(texts).options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, columnPruning=False, enforceSchema=False)
    raw = reader.csv(path).select("*", F.col("_metadata.file_path").alias("_file"))
    written = F.coalesce(CORRUPT, F.to_csv(F.struct(*names), {"escape": '"'}))
    raw = raw.withColumn("_record", written)
    if escaped:
        raw = raw.withColumns({n: line_ends_restored(F.col(n)) for n in names})
    defaults = COLUMN_DEFAULTS.get(table, {})
    typed = [
        (_tried(f.name, f.dataType) if f.name in names else F.lit(defaults.get(f.name)).cast(f.dataType)).alias(f.name) for f in schema.fields
    ]
    required = [*PRIMARY_KEYS[table], *[n for n in REQUIRED.get(table, []) if n not in PRIMARY_KEYS[table]]]
    malformed = [
        F.when(_given(n).isNotNull() & F.col(f"row.{n}").isNull(), F.lit(f"malformed {n}")) for n in names if schema[n].dataType != StringType()
    ]
    missing = [F.when(_given(n).isNull(), F.lit(f"missing {n}")) if n in names else F.lit(f"missing {n}") for n in required]
    found = F.when(F.col(CORRUPT).isNotNull(), F.array(F.lit(WRONG_FIELDS))).otherwise(F.array_compact(F.array(*malformed, *missing)))
    judged = raw.withColumn("row", F.struct(*typed)).withColumn("reasons", found)
    return judged.select("row", F.col("_file").alias("file"), F.col("_record").alias("record"), "reasons")


def read_csv_with_rejects(spark: SparkSession, table: str, path: str, escaped: bool = False) -> tuple[DataFrame, DataFrame]:
    """The typed rows, and the rejects: table_name, file, record and reason. Together they are all records."""
    checked = check_csv_table(spark, table, path, escaped)
    taken = F.size("reasons") == 0
    rejects = checked.where(~taken).select(F.lit(table).alias("table_name"), "file", "record", F.array_join("reasons", "; ").alias("reason"))
    return checked.where(taken).select("row.*"), rejects
