"""What the physical plans must look like, with broadcasts and adaptive execution switched off."""

import re

import pytest

from conftest import DATA
from revenuelake.checks.queries import AS_OF, DerivedTables
from revenuelake.operators import compliance, profile, revenue, rules
from revenuelake.session import materialize


@pytest.fixture(scope="module")
def stored(spark):
    t = DerivedTables(spark, DATA)
    names = [
        "taxpayers", "vat_returns", "paye_returns", "payments", "fraud_alerts", "companies_registry",
        "vehicle_registry", "land_registry",
    ]
    tables = {n: materialize(getattr(t, n), n) for n in names}
    settings = {
        "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.maxMetadataStringLength": "2000",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield type("Stored", (), tables)
    for k, v in before.items():
        spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return re.findall(r"Exchange (hashpartitioning\([^\n]*?, \d+\)|SinglePartition|rangepartitioning)", text)


def test_profile_shuffles_each_source_once_on_the_taxpayer(stored):
    text = plan(
        profile.taxpayer_360(
            stored.taxpayers, stored.paye_returns, stored.vat_returns, stored.payments, stored.companies_registry,
            stored.vehicle_registry, stored.land_registry, stored.fraud_alerts, AS_OF,
        )
    )
    found = exchanges(text)
    # eight sources, and one more step for the distinct months and for the alert types
    assert len(found) == 10 and all("taxpayer_id" in e for e in found)
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_scans_read_needed_columns_and_push_filters(stored):
    text = plan(revenue.revenue_daily(stored.payments))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",") if ":" in c} == {
        "taxpayer_id", "payment_date", "payment_channel", "amount", "tax_type", "status",
    }
    assert "EqualTo(status,Completed)" in text
    recent = plan(revenue.metric_daily(stored.payments, AS_OF))
    assert "GreaterThanOrEqual(payment_date,1999-08-01)" in recent


def test_metric_table_reads_payments_twice(stored):
    text = plan(revenue.revenue_dashboard_metrics(stored.payments, stored.taxpayers, AS_OF))
    scans = [line for line in text.splitlines() if "FileScan" in line and "payment_date" in line]
    assert len(scans) == 2
    assert "SinglePartition" not in text


def test_rules_form_no_pairs(stored):
    for df in (
        rules.vat_drop(stored.vat_returns),
        rules.pattern_revenue_drop(stored.payments),
        rules.pattern_below_industry(stored.payments, stored.taxpayers, AS_OF),
        compliance.paye_compliance(stored.paye_returns),
    ):
        text = plan(df)
        assert "NestedLoop" not in text and "Cartesian" not in text and "SinglePartition" not in text
        assert "python" not in text.lower()
