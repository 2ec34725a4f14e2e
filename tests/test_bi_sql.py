"""The dashboard pack as SQL: parameters are values, whatever they hold."""

import datetime as dt

import pytest

from revenuelake.plans import bi, bi_sql

HARD = ["TP'1", "x' OR '1'='1", ":taxpayer_id", "a;b--", "back\\slash", '"quoted"']


@pytest.fixture(scope="module")
def payments(table):
    rows = [
        dict(payment_id=f"P{i}", taxpayer_id=HARD[i % len(HARD)], payment_date=f"2001-0{1 + i % 9}-10", tax_type="VAT", amount=i, status="Completed")
        for i in range(60)
    ]
    return table("payments", rows)


def test_parameters_are_values(spark, payments):
    bi_sql.publish_dashboard(payments=payments)
    for taxpayer in [*HARD, "nobody' OR true OR 'x", ""]:
        got = bi_sql.run_sql(spark, "bi_payment_history", taxpayer_id=taxpayer).collect()
        assert got == bi.bi_payment_history(payments, taxpayer).collect() and len(got) == (10 if taxpayer in HARD else 0)


def test_dates_bind_and_reach_the_scan(spark, payments, tmp_path, capsys):
    payments.write.parquet(str(tmp_path / "payments"))
    stored = spark.read.parquet(str(tmp_path / "payments"))
    bi_sql.publish_dashboard(payments=stored, taxpayers=spark.createDataFrame([(h, "Trade") for h in HARD], "taxpayer_id string, business_sector string"))
    found = bi_sql.run_sql(spark, "bi_revenue_by_sector", start=dt.date(2001, 3, 1), end=dt.date(2001, 4, 30))
    assert float(found.collect()[0]["total_revenue"]) == sum(i for i in range(60) if i % 9 in (2, 3))
    found.explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(payment_date,2001-03-01)" in plan and "payment_provider" not in plan


def test_strange_names_are_errors(spark, payments):
    with pytest.raises(ValueError):
        bi_sql.publish_dashboard(other=payments)
    with pytest.raises(ValueError):
        bi_sql.run_sql(spark, "bi_alerts_by_type", taxpayer_id="x")
    with pytest.raises(KeyError):
        bi_sql.run_sql(spark, "DROP TABLE payments")


def test_every_dashboard_query_has_a_text():
    assert set(bi_sql.BI_SQL) == {n for n in vars(bi) if n.startswith("bi_")}
