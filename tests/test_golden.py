import datetime as dt

import pytest
from pyspark.sql import functions as F

import golden
from conftest import rows_by
from revenuelake.functions.dates import full_years, in_period, months_before
from revenuelake.operators import compliance, mutation, profile, quality, revenue, rules, staging

AS_OF = dt.date(2023, 6, 1)


@pytest.fixture(scope="module")
def t(table):
    class Tables:
        taxpayers = table("taxpayers", golden.TAXPAYERS)
        paye = table("paye_returns", golden.PAYE)
        vat = table("vat_returns", golden.VAT)
        payments = table("payments", golden.PAYMENTS)
        alerts = table("fraud_alerts", golden.ALERTS)
        companies = table("companies_registry", [])
        vehicles = table("vehicle_registry", [])
        land = table("land_registry", [])

    return Tables


@pytest.fixture(scope="module")
def profile_rows(t):
    return rows_by(
        profile.taxpayer_360(
            t.taxpayers, t.paye, t.vat, t.payments, t.companies, t.vehicles, t.land, t.alerts, AS_OF
        ),
        "taxpayer_id",
    )


def test_staged_returns(t):
    paye = rows_by(staging.stg_paye_returns(t.paye), "return_id")
    assert {k: (r["days_late"], r["filing_status"]) for k, r in paye.items()} == {
        "P1A": (-5, "On Time"), "P1B": (-3, "On Time"), "P2A": (5, "Late"), "P2B": (None, "Not Filed"),
    }
    vat = rows_by(staging.stg_vat_returns(t.vat), "return_id")
    assert {k: (r["days_late"], r["filing_status"]) for k, r in vat.items()} == {
        "V1": (-5, "On Time"), "V2": (5, "Late"), "V3": (-10, "On Time"),
    }
    assert [vat[k]["vat_rate_effective"] for k in ("V1", "V2", "V3")] == pytest.approx([0.105, 0.105, 0.03])


def test_compliance(t):
    rows = rows_by(compliance.taxpayer_compliance(t.taxpayers, t.paye, t.vat, t.payments), "taxpayer_id")
    rates = {k: r["filing_compliance_rate"] for k, r in rows.items()}
    assert rates == {"TP000001": 1.0, "TP000002": 0.0, "TP000003": 1.0, "TP000004": 0.0, "TP000005": 0.0}
    assert {k for k, r in rows.items() if r["low_filing_rate"]} == {"TP000002"}
    assert not any(r["chronic_late_filer"] for r in rows.values())


def test_payment_behavior(t):
    rows = rows_by(compliance.payment_behavior(t.payments, t.paye, t.vat), "taxpayer_id")
    one, two = rows["TP000001"], rows["TP000002"]
    assert (one["total_payments"], float(one["total_amount_paid"]), one["payment_channels_used"], one["on_time_payments"]) == (3, 190500.0, 2, 3)
    assert (two["total_payments"], float(two["total_amount_paid"]), two["payment_channels_used"], two["on_time_payments"]) == (1, 135000.0, 1, 0)


def test_fraud_indicators(t):
    (row,) = profile.fraud_indicators(t.alerts).collect()
    assert (row["fraud_alert_count"], float(row["max_fraud_risk_score"])) == (2, 0.87)
    assert row["fraud_alert_types"] == "Multiple Late Payments; Sudden VAT Declaration Drop"


def test_profile(profile_rows):
    assert {k: r["risk_category_calculated"] for k, r in profile_rows.items()} == {
        "TP000001": "Very Low", "TP000002": "Critical", "TP000003": "Very Low", "TP000004": "Medium", "TP000005": "Medium",
    }
    assert {k: r["business_size_category"] for k, r in profile_rows.items()} == {
        "TP000001": "Medium", "TP000002": "Large", "TP000003": "Large", "TP000004": "Large", "TP000005": "Medium",
    }
    engagement = {k: r["engagement_score"] for k, r in profile_rows.items()}
    assert engagement["TP000001"] == pytest.approx(0.775)
    assert engagement["TP000002"] == pytest.approx(0.225)
    assert [engagement[f"TP00000{i}"] for i in (3, 4, 5)] == [None, None, None]


def test_salary_share(t):
    rows = rules.paye_revenue_mismatch(t.paye, t.taxpayers).collect()
    assert [(r["taxpayer_id"], r["period_year"]) for r in rows] == [("TP000001", 2023)]
    assert rows[0]["salary_to_revenue_ratio"] == pytest.approx(20.4)


def test_monthly_metric(t):
    rows = {(str(r["metric_date"]), r["tax_type"]): r for r in revenue.metric_monthly(t.payments).collect()}
    assert {k: (float(r["revenue_amount"]), r["unique_taxpayers"]) for k, r in rows.items()} == {
        ("2023-02-01", "PAYE"): (210000.0, 2), ("2023-03-01", "PAYE"): (78000.0, 1), ("2023-04-01", "VAT"): (37500.0, 1),
    }


def test_quality_passes(t):
    report = quality.dq_report({"taxpayers": t.taxpayers, "paye_returns": t.paye, "vat_returns": t.vat, "payments": t.payments})
    assert {r["failures"] for r in report.collect()} == {0}
    quality.require_quality(report)


def test_quality_failures(t, table):
    orphan = t.paye.unionByName(table("paye_returns", [dict(return_id="P1A", taxpayer_id="NOBODY", status="Odd")]))
    report = quality.dq_report({"taxpayers": t.taxpayers, "paye_returns": orphan})
    failed = {(r["check"], r["column"]) for r in report.collect() if r["failures"]}
    assert failed == {("unique", "return_id"), ("relationships", "taxpayer_id"), ("accepted_values", "status")}
    with pytest.raises(ValueError):
        quality.require_quality(report)


def test_edge_rows(table):
    taxpayers = table("taxpayers", [dict(taxpayer_id="A", name="a"), dict(taxpayer_id="B", name="b", annual_turnover=999999)])
    vat = table("vat_returns", [dict(return_id="V", taxpayer_id="A", total_sales=0, output_vat=5, filing_date="2023-03-20", due_date="2023-01-15", status="Filed")])
    assert staging.stg_vat_returns(vat).first()["vat_rate_effective"] == 0
    companies = table("companies_registry", [dict(company_reg_no=f"C{i}", taxpayer_id="A") for i in range(2)])
    vehicles = table("vehicle_registry", [dict(vehicle_reg_no=f"V{i}", taxpayer_id="A", purchase_value=10) for i in range(3)])
    land = table("land_registry", [dict(property_id=f"L{i}", taxpayer_id="A", valuation=100) for i in range(4)])
    none = [table(n, []) for n in ("paye_returns", "payments", "fraud_alerts")]
    rows = rows_by(profile.taxpayer_360(taxpayers, none[0], vat, none[1], companies, vehicles, land, none[2], AS_OF), "taxpayer_id")
    a = rows["A"]
    assert (a["companies_owned"], a["vehicles_owned"], a["properties_owned"]) == (2, 3, 4)
    assert (float(a["total_vehicle_value"]), float(a["total_property_value"])) == (30.0, 400.0)
    assert a["chronic_late_filer"] and a["risk_category_calculated"] == "High"
    assert (a["business_size_category"], rows["B"]["business_size_category"]) == ("Very Large", "Small")


def test_full_years(spark):
    days = ["2020-02-29", "2020-02-28", "2020-03-01"]
    df = spark.createDataFrame([(dt.date.fromisoformat(d),) for d in days], "d date")
    assert [r[0] for r in df.select(full_years(F.col("d"), dt.date(2021, 2, 28))).collect()] == [0, 1, 0]


def test_months_before_clips():
    assert months_before(dt.date(2024, 3, 31), 1) == dt.date(2024, 2, 29)
    assert months_before(dt.date(2024, 1, 15), 24) == dt.date(2022, 1, 15)


def test_period_filter_prunes_folders(t, spark, tmp_path):
    from revenuelake.sources.readers import read_table
    from revenuelake.sources.writers import write_payments

    write_payments(t.payments, str(tmp_path / "payments"))
    stored = read_table(spark, str(tmp_path), "payments")
    recent = in_period(stored, start=dt.date(2023, 3, 1), until=dt.date(2023, 3, 31))
    assert [r["payment_id"] for r in recent.collect()] == ["Y2"]
    assert len(recent.inputFiles()) <= len(stored.inputFiles())
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(payment_month" in plan


def test_mutations(t, table):
    scored = rows_by(mutation.update_compliance_scores(t.taxpayers, t.paye, t.vat, AS_OF), "taxpayer_id")
    assert {k: float(r["compliance_score"]) for k, r in scored.items()} == {
        "TP000001": 0.95, "TP000002": 0.1, "TP000003": 0.95, "TP000004": 0.95, "TP000005": 0.95,
    }
    assert scored["TP000001"]["updated_at"] == dt.datetime(2023, 6, 1)
    assert {r["status"] for r in mutation.close_open_alerts(t.alerts).collect()} == {"Closed"}
    moved = mutation.redate_old_alerts(t.alerts, dt.date(2025, 1, 1), dt.date(2025, 7, 1))
    assert {r["alert_date"] for r in moved.collect()} == {dt.date(2025, 7, 1)}
    added = mutation.append_alerts(t.alerts, t.alerts.drop("alert_id"), dt.date(2024, 1, 1))
    ids = sorted(r["alert_id"] for r in added.collect())
    highest = max(r["alert_id"] for r in t.alerts.collect())
    assert len(ids) == 4 and ids[2:] == [highest + 1, highest + 2] and added.filter("created_at = '2024-01-01'").count() == 2
    old = table("revenue_forecasts", [dict(forecast_date="2023-06-01", tax_type="VAT", predicted_revenue=1), dict(forecast_date="2023-06-02", tax_type="VAT", predicted_revenue=2)])
    new = table("revenue_forecasts", [dict(forecast_date="2023-06-02", tax_type="VAT", predicted_revenue=9), dict(forecast_date="2023-06-03", tax_type="VAT", predicted_revenue=3)])
    once = mutation.upsert_forecasts(old, new, AS_OF)
    twice = mutation.upsert_forecasts(once, new, AS_OF)
    values = lambda df: sorted((str(r["forecast_date"]), float(r["predicted_revenue"])) for r in df.collect())
    assert values(once) == values(twice) == [("2023-06-01", 1.0), ("2023-06-02", 9.0), ("2023-06-03", 3.0)]
