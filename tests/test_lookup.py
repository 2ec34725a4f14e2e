"""Point look-ups read one bucket and few row groups, also beside a taxpayer with a third of all payments."""

import datetime as dt
import glob
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from revenuelake.functions.dates import in_months, in_period
from revenuelake.operators.staging import stg_payments
from revenuelake.plans import bi, live
from revenuelake.schemas import SCHEMAS
from revenuelake.sources import lookup, readers, writers


@pytest.fixture
def buckets_shown(spark):
    """Buckets are skipped by any scan; the plan only tells so where it keeps the buckets apart."""
    auto = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    spark.conf.set(auto, "false")
    yield
    spark.conf.unset(auto)


@pytest.fixture(scope="module")
def payments(spark):
    i = F.col("id")
    rows = spark.range(60_000).select(
        F.concat(F.lit("P"), i.cast("string")).alias("payment_id"),
        F.when(i % 3 == 0, "HOT").otherwise(F.concat(F.lit("T"), (i % 2000).cast("string"))).alias("taxpayer_id"),
        F.date_add(F.lit(dt.date(2023, 1, 1)), (i % 500).cast("int")).alias("payment_date"),
        (i % 97).cast("decimal(15,2)").alias("amount"),
        F.lit("VAT").alias("tax_type"), F.lit("Cash").alias("payment_channel"), F.lit("Completed").alias("status"),
    )
    known = rows.columns
    schema = SCHEMAS["payments"]
    return rows.select(*[(F.col(f.name) if f.name in known else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


@pytest.fixture(scope="module")
def stored(spark, payments, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lookup") / "payments")
    lookup.store_by_key(payments, "payments_by_taxpayer", path, "taxpayer_id", ["payment_date"], 16, 64 << 10)
    yield path
    spark.sql("DROP TABLE payments_by_taxpayer")


def formatted(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_one_taxpayer_reads_one_bucket(spark, payments, stored, buckets_shown):
    table = spark.table("payments_by_taxpayer")
    for taxpayer in ("T7", "HOT", "nobody"):
        plan = formatted(live.live_recent_payments(table, taxpayer))
        assert "SelectedBucketsCount: 1 out of 16" in plan and f"EqualTo(taxpayer_id,{taxpayer})" in plan
        for question in (live.live_recent_payments, bi.bi_payment_history):
            assert question(table, taxpayer).collect() == question(payments, taxpayer).collect()


def test_one_taxpayer_lies_in_few_row_groups(stored):
    files = glob.glob(f"{stored}/*.parquet")
    buckets = {}
    for file in files:
        buckets.setdefault(re.search(r"_(\d{5})\.", file).group(1), []).append(file)
    groups = holding = 0
    for file in files:
        meta = pq.ParquetFile(file).metadata
        column = meta.schema.names.index("taxpayer_id")
        for g in range(meta.num_row_groups):
            bounds = meta.row_group(g).column(column).statistics
            groups += 1
            holding += bounds.min <= "T7" <= bounds.max
    assert len(buckets) == 16
    assert groups >= 16 and holding <= len(files)  # at most one row group of a file


def test_another_session_opens_the_table(spark, payments, stored):
    other = spark.newSession()
    other.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    table = lookup.open_by_key(other, "payments_again", stored, payments.schema, "taxpayer_id", ["payment_date"], 16)
    found = live.live_recent_payments(table, "T8")
    assert "SelectedBucketsCount: 1 out of 16" in formatted(found)
    assert found.collect() == live.live_recent_payments(payments, "T8").collect()
    other.sql("DROP TABLE payments_again")


def test_two_months_read_two_folders(spark, payments, tmp_path):
    writers.write_payments(payments, str(tmp_path / "payments"))
    table = readers.read_table(spark, str(tmp_path), "payments")
    as_of = dt.date(2024, 2, 10)
    grown = live.live_month_revenue_growth(table, as_of)
    assert grown.collect() == live.live_month_revenue_growth(payments, as_of).collect()
    assert re.search(r"PartitionFilters: \[.*payment_month#\d+ IN \(2024-02,2023-02\)", formatted(grown))
    assert in_months(payments, [(2023, 12)]).count() == payments.filter("payment_date BETWEEN '2023-12-01' AND '2023-12-31'").count()


def test_staged_payments_have_a_period(payments):
    start = dt.date(2024, 1, 1)
    assert in_period(stg_payments(payments), start=start).count() == in_period(payments, start=start).count()
