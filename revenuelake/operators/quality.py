"""Data-quality checks. Each returns the offending rows or keys; an empty result means the check passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revenuelake import constants as C
from revenuelake.schemas import PRIMARY_KEYS, REQUIRED


def dq_null_ids(taxpayers: DataFrame) -> DataFrame:
    """Number of taxpayers without an id or a TIN."""
    missing = F.col("taxpayer_id").isNull() | F.col("tin").isNull()
    return taxpayers.filter(missing).agg(F.count(F.lit(1)).alias("null_count"))


def dq_duplicate_tin(taxpayers: DataFrame) -> DataFrame:
    counted = taxpayers.groupBy("tin").agg(F.count(F.lit(1)).alias("count"))
    return counted.filter(F.col("count") > 1)


def dq_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values that occur more than once; NULL keys are the business of ``dq_not_null``."""
    known = df
    for name in columns:
        known = known.filter(F.col(name).isNotNull())
    return known.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1)


def dq_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def dq_relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-NULL key is missing in the parent table."""
    known = parent.select(F.col(parent_column).alias(column)).filter(F.col(column).isNotNull())
    return child.filter(F.col(column).isNotNull()).join(known, column, "left_anti")


def dq_orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Keys missing in the parent table with their row counts; a busy key is one row before the join."""
    counted = child.groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    return dq_relationships(counted, column, parent, parent_column)


def dq_accepted_values(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Values outside the accepted list with their row counts; NULL is accepted, as in a CHECK."""
    return (
        df.filter(~F.col(column).isin(list(accepted)))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


# (table, column, accepted values) of every declared value list.
ACCEPTED_VALUES = [
    ("taxpayers", "taxpayer_type", C.TAXPAYER_TYPES),
    ("paye_returns", "status", C.RETURN_STATUSES),
    ("vat_returns", "status", C.RETURN_STATUSES),
    ("corporate_tax", "status", C.ASSESSMENT_STATUSES),
    ("payments", "payment_channel", C.PAYMENT_CHANNELS),
    ("payments", "tax_type", C.TAX_TYPES),
    ("payments", "status", C.PAYMENT_STATUSES),
]
UNIQUE = [("taxpayers", "tin"), *[(t, PRIMARY_KEYS[t][0]) for t in ("taxpayers", "paye_returns", "vat_returns", "payments")]]
REFERRING = ["paye_returns", "vat_returns", "corporate_tax", "payments", "fraud_alerts"]  # tables whose taxpayer_id refers to a taxpayer
NOT_NULL = [
    *UNIQUE,
    ("paye_returns", "taxpayer_id"), ("vat_returns", "taxpayer_id"), ("payments", "taxpayer_id"),
    ("taxpayers", "compliance_score"),
    # Asset registries come from other offices and are not gated.
    *[(t, c) for t, columns in REQUIRED.items() if not t.endswith("_registry") for c in columns if (t, c) not in UNIQUE],
]
RELATIONSHIPS = [(table, "taxpayer_id") for table in REFERRING]


def _row_checks(table: str, df: DataFrame) -> DataFrame | None:
    """The checks that look at single rows, counted in one pass over the table."""
    nulls = [("not_null", column, F.col(column).isNull()) for name, column in NOT_NULL if name == table]
    lists = [
        ("accepted_values", column, ~F.col(column).isin(accepted))
        for name, column, accepted in ACCEPTED_VALUES
        if name == table
    ]
    checks = nulls + lists
    if not checks:
        return None
    counts = df.agg(*[F.count_if(condition).alias(f"c{i}") for i, (_, _, condition) in enumerate(checks)])
    entries = [
        F.struct(F.lit(check).alias("check"), F.lit(column).alias("column"), F.col(f"c{i}").alias("failures"))
        for i, (check, column, _) in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*entries)))


def dq_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Failures per declared check over the given tables: check, table, column, failures.

    Row checks count rows, key checks count repeated keys, relationship checks count orphans.
    """
    results: list[DataFrame] = []

    def add(table: str, found: DataFrame | None) -> None:
        if found is not None:
            results.append(found.select("check", F.lit(table).alias("table"), "column", "failures"))

    def counted(check: str, column: str, offending: DataFrame) -> DataFrame:
        return offending.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(check).alias("check"), F.lit(column).alias("column"), "failures"
        )

    for table, df in tables.items():
        add(table, _row_checks(table, df))
    for table, column in UNIQUE:
        if table in tables:
            add(table, counted("unique", column, dq_unique(tables[table], [column])))
    for table, column in RELATIONSHIPS:
        if table in tables and "taxpayers" in tables:
            orphans = dq_orphan_keys(tables[table], column, tables["taxpayers"], "taxpayer_id")
            failures = F.coalesce(F.sum("n_records"), F.lit(0)).alias("failures")
            add(table, orphans.agg(failures).select(F.lit("relationships").alias("check"), F.lit(column).alias("column"), "failures"))
    report = results[0]
    for result in results[1:]:
        report = report.unionByName(result)
    return report


def require_quality(report: DataFrame) -> None:
    """Raise if any check failed. The report has one row per check, so collecting it is safe."""
    failed = report.filter(F.col("failures") > 0).collect()
    if failed:
        raise ValueError("; ".join(f"{r['check']} {r['table']}.{r['column']}: {r['failures']}" for r in failed))
