"""A refreshed summary equals a rebuilt one and touches only the months of the late payments."""

import datetime as dt
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from revenuelake.operators import summary_state as ss
from revenuelake.operators.revenue import revenue_summary

REGIONS = ["North", "South", None]


@pytest.fixture(scope="module")
def taxpayers(table):
    return table("taxpayers", [dict(taxpayer_id=f"T{i}", region=REGIONS[i % 3]) for i in range(40)])


@pytest.fixture(scope="module")
def payments(table):
    rng = random.Random(4)
    return table(
        "payments",
        [
            dict(
                payment_id=f"P{i}", taxpayer_id="T7" if i % 3 == 0 else f"T{rng.randrange(45)}", payment_date=str(dt.date(2024, 1, 1) + dt.timedelta(rng.randrange(120))),
                amount=rng.randrange(1, 500), tax_type=rng.choice(["VAT", "PAYE"]), payment_channel=rng.choice(["Cash", None]), status="Completed",
            )
            for i in range(900)
        ],
    )


def rows(df):
    names = [*ss.GROUP, "total_amount", "transaction_count", "unique_taxpayers"]
    return sorted(str(tuple(r[c] for c in names)) for r in df.collect())


def files(folder):
    return {str(p): p.stat().st_mtime_ns for p in pathlib.Path(folder).rglob("*.parquet")}


def test_late_payments_give_what_a_rebuild_gives(spark, payments, taxpayers, tmp_path):
    folder, numbers = str(tmp_path / "kept"), ss.number_taxpayers(taxpayers)
    late = F.col("payment_id").isin("P10", "P11", "P12", "P13") | F.col("payment_date").between("2024-02-10", "2024-02-12")
    late &= F.col("payment_date") < "2024-04-01"
    ss.build_summary(payments.filter(~late), numbers, folder)
    before = files(folder)
    months = ss.refresh_summary(payments.filter(late), numbers, folder)
    after = files(folder)
    assert rows(spark.read.parquet(f"{folder}/summary")) == rows(revenue_summary(payments, taxpayers))
    assert "2024-02" in months and "2024-04" not in months
    untouched = {p: t for p, t in before.items() if not any(f"month={m}" in p for m in months)}
    assert untouched and untouched.items() <= after.items()
    assert ss.refresh_summary(payments.limit(0), numbers, folder) == [] and files(folder) == after


def test_refresh_reads_the_touched_month_only(spark, payments, taxpayers, tmp_path):
    folder, numbers = str(tmp_path / "kept"), ss.number_taxpayers(taxpayers)
    ss.build_summary(payments, numbers, folder)
    late = ss.summary_state(payments.filter("payment_date = '2024-03-05'"), numbers)
    old, months = ss.touched_state(spark, folder, late)
    assert months == ["2024-03"]
    plan = old._sc._jvm.PythonSQLUtils.explainString(old._jdf.queryExecution(), "formatted")
    assert "PartitionFilters" in plan and "(month#" in plan and "2024-03" in plan
    assert {r["month"] for r in old.collect()} == {"2024-03"}


def test_new_taxpayers_keep_old_numbers(taxpayers, table, spark):
    old = ss.number_taxpayers(taxpayers).cache()
    more = taxpayers.unionByName(table("taxpayers", [dict(taxpayer_id="A1", region="North"), dict(taxpayer_id="Z1", region="South")]))
    new = {r["taxpayer_id"]: r["payer_number"] for r in ss.number_taxpayers(more, old).collect()}
    assert {r["taxpayer_id"]: r["payer_number"] for r in old.collect()}.items() <= new.items()
    assert sorted(new.values()) == list(range(1, 43))


def test_state_rows_are_narrow_and_blocks_are_whole(payments, table):
    many = table("taxpayers", [dict(taxpayer_id=f"N{i:04d}", region="North") for i in range(300)])
    rows = [dict(payment_id=f"Q{i}", taxpayer_id=f"N{i % 300:04d}", payment_date="2024-05-01", amount=1, tax_type="VAT") for i in range(900)]
    numbers = ss.number_taxpayers(many)
    made = table("payments", rows)
    state = ss.merged_states(ss.summary_state(made.filter("payment_id < 'Q5'"), numbers), ss.summary_state(made.filter("payment_id >= 'Q5'"), numbers))
    assert [(r["transaction_count"], r["unique_taxpayers"]) for r in ss.summary_of(state).collect()] == [(900, 300)]
    plan = state._jdf.queryExecution().toString()  # a wide state cannot be aggregated by hash
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert state.schema["payers"].dataType.typeName() == "long" and state.count() == 5  # numbers 1 to 300
