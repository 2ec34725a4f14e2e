"""Results under heavy keys, against brute force on small data where one key owns most rows."""

import datetime as dt
import random
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows_by
from revenuelake.operators import compliance, insights, profile, revenue, rules
from revenuelake.operators.skew import (
    exact_quantile, global_row_number, heavy_keys, heavy_keys_in_sample, salted_join, split_join,
)

relaxed = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@relaxed
@given(
    values=st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "cold"]), st.integers(-50, 50)), min_size=1, max_size=60),
    q=st.sampled_from([0.0, 0.05, 0.5, 0.95, 1.0]),
    margins=st.sampled_from([(0.3,), (0.05, 0.01, 0.002), (0.0,)]),
)
def test_exact_quantile(spark, values, q, margins):
    df = spark.createDataFrame(values, "k string, v int")
    got = {r["k"]: r["threshold"] for r in exact_quantile(df, ["k"], "v", q, margins=margins).collect()}
    expected = pd.DataFrame(values, columns=["k", "v"]).groupby("k")["v"].quantile(q).to_dict()
    assert got == pytest.approx(expected)
    (whole,) = exact_quantile(df, [], "v", q, margins=margins).collect()
    assert whole["threshold"] == pytest.approx(np.quantile([v for _, v in values], q))


def test_exact_quantile_ignores_nulls(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), (None, 5.0)], "k string, v double")
    got = {r["k"]: r["threshold"] for r in exact_quantile(df, ["k"], "v", 0.5).collect()}
    assert got["a"] == 2.0


def test_global_row_number(spark):
    random.seed(1)
    rows = [(i, 1.0 if random.random() < 0.6 else random.random()) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, score double")
    numbered = global_row_number(df, [F.desc("score"), F.asc("id")], "place", partitions=7).collect()
    expected = [i for i, _ in sorted(rows, key=lambda r: (-r[1], r[0]))]
    assert [r["id"] for r in sorted(numbered, key=lambda r: r["place"])] == expected
    assert sorted(r["place"] for r in numbered) == list(range(1, 501))


def test_salted_join(spark):
    big = spark.createDataFrame([("hot" if i % 3 else f"k{i % 7}", i) for i in range(300)], "k string, i int")
    small = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    plain = big.join(small, "k")
    salted = salted_join(big, small, ["k"], ["i"], salts=5)
    assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, plain.collect()))


def test_validate_transactions(table, spark):
    random.seed(2)
    rows = []
    for i in range(400):
        hot = i % 3 == 0
        rows.append(
            dict(
                transaction_id=f"X{i}",
                taxpayer_id="HOT" if hot else f"T{random.randrange(20)}",
                ts=f"2024-01-0{1 + i % 2} {i % 24:02d}:00:00",
                payment_channel="Cash",
                amount=500 if hot else random.randrange(1, 60),
                tax_type="VAT" if random.random() < 0.8 else "PAYE",
                status="Pending",
                risk_flag=False,
            )
        )
    rows.append(dict(transaction_id="N1", taxpayer_id=None, ts="2024-01-01 00:00:00", amount=None, tax_type="VAT"))
    rows.append(dict(transaction_id="N2", taxpayer_id=None, ts="2024-01-01 00:00:00", amount=None, tax_type="VAT"))
    got = rows_by(insights.validate_transactions(table("realtime_transactions", rows)), "transaction_id")
    assert len(got) == len(rows)
    for day, part in pd.DataFrame(rows).assign(day=lambda d: d["ts"].str[:10]).groupby("day"):
        duplicate = part.duplicated(subset=["taxpayer_id", "amount", "tax_type"], keep=False)
        limit = part.groupby("tax_type")["amount"].quantile(0.95)
        for (_, row), dup in zip(part.iterrows(), duplicate):
            high = row["amount"] > limit[row["tax_type"]]
            expected = "High Amount Warning" if high else "Duplicate Warning" if dup else "Valid"
            found = got[row["transaction_id"]]
            assert (found["validation_status"], found["is_duplicate"]) == (expected, dup)
            assert found["status"] == ("Completed" if expected == "Valid" else "Under Review")


def test_vat_drop_with_repeated_returns(table):
    """A taxpayer with many returns per quarter, against the pairwise definition."""
    random.seed(3)
    rows = []
    for i in range(160):
        taxpayer = "HOT" if i % 2 else f"T{i % 5}"
        rows.append(
            dict(
                return_id=f"R{i}", taxpayer_id=taxpayer, period_year=2020 + random.randrange(3),
                period_quarter=1 + random.randrange(4), total_sales=random.choice([100, 200, 900]),
                status=random.choice(["Filed", "Filed", "Overdue"]),
            )
        )
    pairs = defaultdict(list)
    for new in rows:
        if new["status"] == "Filed":
            slot = new["period_year"] * 4 + new["period_quarter"]
            for old in rows:
                if old["taxpayer_id"] == new["taxpayer_id"] and slot - 4 <= old["period_year"] * 4 + old["period_quarter"] < slot:
                    key = (new["taxpayer_id"], new["period_year"], new["period_quarter"], new["total_sales"])
                    pairs[key].append(old["total_sales"])
    expected = {k: sum(v) / len(v) for k, v in pairs.items() if len(v) >= 2}
    got = {
        (r["taxpayer_id"], r["period_year"], r["period_quarter"], int(r["current_sales"])): r["avg_previous_sales"]
        for r in rules.vat_drop(table("vat_returns", rows)).collect()
    }
    assert got == pytest.approx(expected)


def test_peer_gap_against_pairs(spark):
    random.seed(4)
    people = [(f"T{i}", "Retail" if i % 3 else "Farm", "Small", float(random.randrange(0, 500))) for i in range(60)]
    people += [("N", None, "Small", 5.0)]
    schema = "taxpayer_id string, business_sector string, business_size_category string, total_tax_paid double"
    got = {r["taxpayer_id"]: r["peer_avg_tax"] for r in rules.peer_anomalies(spark.createDataFrame(people, schema)).collect()}
    expected = {}
    for t, sector, size, tax in people:
        others = [x for o, s, z, x in people if o != t and sector and s == sector and z == size]
        if tax > 0 and len(others) >= 5:
            expected[t] = sum(others) / len(others)
    assert got == pytest.approx(expected)


def test_alert_texts_of_a_busy_taxpayer(table):
    rows = [dict(alert_id=i, taxpayer_id="HOT", alert_type=f"Type-{i % 3}", risk_score=0.5, status="Open") for i in range(90)]
    rows.append(dict(alert_id=99, taxpayer_id="B", alert_type=None, risk_score=0.1, status="Open"))
    got = rows_by(profile.fraud_indicators(table("fraud_alerts", rows)), "taxpayer_id")
    assert Counter(got["HOT"]["fraud_alert_types"].split("; ")) == {f"Type-{k}": 30 for k in range(3)}
    assert got["HOT"]["fraud_alert_count"] == 90
    assert (got["B"]["fraud_alert_types"], got["B"]["fraud_alert_count"]) == (None, 1)


def test_metric_table_is_the_union_of_its_branches(spark):
    from conftest import DATA
    from revenuelake.checks.queries import AS_OF, DerivedTables

    t = DerivedTables(spark, DATA)
    branches = [
        revenue.metric_daily(t.payments, AS_OF), revenue.metric_monthly(t.payments),
        revenue.metric_regional(t.payments, t.taxpayers), revenue.metric_channel(t.payments),
        revenue.metric_ytd(t.payments), revenue.metric_yoy(t.payments), revenue.metric_target_vs_actual(t.payments, AS_OF),
    ]
    combined = revenue.revenue_dashboard_metrics(t.payments, t.taxpayers, AS_OF)
    totals = {r[0]: (r[1], r[2]) for r in combined.groupBy("metric_type").agg(F.count("*"), F.sum("revenue_amount")).collect()}
    for branch in branches:
        row = branch.groupBy("metric_type").agg(F.count("*"), F.sum(F.col("revenue_amount").cast("double"))).first()
        assert totals[row[0]][0] == row[1]
        assert totals[row[0]][1] == pytest.approx(row[2])
    assert len(totals) == 7


def test_growth_over_a_gap(table):
    months = ["2022-01-10", "2022-03-10", "2023-01-10", "2023-02-10", "2023-03-10"]
    rows = [dict(payment_id=str(i), taxpayer_id="T", payment_date=d, tax_type="VAT", amount=100 * (i + 1), status="Completed") for i, d in enumerate(months)]
    got = {str(r["metric_date"]): r["revenue_amount"] for r in revenue.metric_yoy(table("payments", rows)).collect()}
    assert got == {"2022-01-01": None, "2022-03-01": None, "2023-01-01": 200.0, "2023-02-01": None, "2023-03-01": 150.0}


def test_orphan_payments_stay_out_of_regional_levels(table):
    taxpayers = table("taxpayers", [dict(taxpayer_id="A", region=None, district=None, business_sector="S")])
    rows = [dict(payment_id=str(i), taxpayer_id=k, payment_date="2023-01-05", tax_type="VAT", payment_channel="POS", amount=10, status="Completed") for i, k in enumerate("AB")]
    payments = table("payments", rows)
    levels = Counter(r["aggregation_level"] for r in revenue.revenue_aggregations(payments, taxpayers).collect())
    assert levels == {"daily": 1, "monthly": 1, "regional": 1, "sector": 1}
    full = revenue.revenue_dashboard_metrics(payments, taxpayers, dt.date(2023, 1, 31))
    regional = full.filter("metric_type = 'regional_revenue'").collect()
    assert [(r["region"], r["revenue_amount"]) for r in regional] == [(None, 10.0)]


def test_fan_out_identity(spark):
    """Sums inflated by joining three registries equal the true sums times the other registries' counts."""
    from conftest import DATA
    from revenuelake.checks.queries import DerivedTables

    t = DerivedTables(spark, DATA)
    true = profile.external_assets(t.taxpayers, t.companies_registry, t.vehicle_registry, t.land_registry)
    closed = true.agg(
        F.sum(F.col("total_vehicle_value") * F.greatest("companies_owned", F.lit(1)) * F.greatest("properties_owned", F.lit(1)))
    ).first()[0]
    fanned = t.taxpayers.select("taxpayer_id")
    for side in (t.companies_registry, t.vehicle_registry, t.land_registry):
        fanned = fanned.join(side, "taxpayer_id", "left")
    assert closed == fanned.agg(F.sum("purchase_value")).first()[0]


def test_split_join_keeps_every_row_once(spark):
    rows = [("hot", i) if i % 3 else (None if i % 5 == 0 else f"k{i % 50}", i) for i in range(900)]
    left = spark.createDataFrame(rows, "k string, i int")
    right = spark.createDataFrame([("hot", 1), (None, 2), *[(f"k{j}", 3) for j in range(40)]], "k string, v int")
    counts = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    values = {r["k"]: r["v"] for r in right.collect()}
    for heavy in (heavy_keys(counts, ["k"], "n"), heavy_keys_in_sample(left, ["k"], "i"), counts.filter("k = 'hot'").select("k"), counts.limit(0).select("k")):
        outer = split_join(left, right, ["k"], heavy, "left", null_safe=True).collect()
        assert sorted((r["i"], r["v"]) for r in outer if r["v"]) == sorted((i, values[k]) for k, i in rows if k in values)
        assert len(outer) == 900
        assert split_join(left, right, ["k"], heavy, null_safe=True).count() == sum(k in values for k, _ in rows)
        plain = split_join(left, right, ["k"], heavy, "left").collect()
        assert len(plain) == 900 and all(r["v"] is None for r in plain if r["k"] is None)
        assert split_join(left, right, ["k"], heavy).count() == sum(k is not None and k in values for k, _ in rows)


def test_heavy_keys_are_bounded(spark):
    df = spark.range(5000).selectExpr("id % 4000 AS k", "id")
    counts = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert heavy_keys(counts, ["k"], "n").count() < 1000
    assert heavy_keys_in_sample(df, ["k"], "id").count() < 1000


def test_placeholder_references(table):
    """A reference shared by most payments that belongs to no return, and payments without one."""
    due = "2023-02-15"
    paye = table("paye_returns", [dict(return_id=f"P{i}", taxpayer_id=f"T{i}", due_date=due) for i in range(5)])
    rows = [
        dict(payment_id=f"Y{i}", taxpayer_id=f"T{i % 5}", payment_date="2023-02-10" if i % 2 else "2023-02-20", payment_channel="POS", amount=1, tax_type="PAYE",
             reference_number="N/A" if i % 3 == 0 else None if i % 3 == 1 else f"P{i % 5}", status="Completed")
        for i in range(300)
    ]
    got = rows_by(compliance.payment_behavior(table("payments", rows), paye, table("vat_returns", [])), "taxpayer_id")
    for k in range(5):
        mine = [r for r in rows if r["taxpayer_id"] == f"T{k}"]
        on_time = sum((r["reference_number"] or "N")[0] == "P" and r["payment_date"] <= due for r in mine)
        assert (got[f"T{k}"]["total_payments"], got[f"T{k}"]["on_time_payments"]) == (len(mine), on_time)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    values=st.lists(st.tuples(st.sampled_from(["hot", "hot", "cold"]), st.floats(-1e6, 1e6), st.integers(1, 5)), min_size=1, max_size=80),
    q=st.sampled_from([0.0, 0.05, 0.5, 0.95, 1.0]),
    last=st.sampled_from([2, 3, 20]),
)
def test_exact_quantile_narrows_counted_values(spark, values, q, last):
    df = spark.createDataFrame(values, "k string, v double, n int")
    told = [(k, v) for k, v, n in values for _ in range(n)]
    expected = pd.DataFrame(told, columns=["k", "v"]).groupby("k")["v"].quantile(q).to_dict()
    got = {r["k"]: r["threshold"] for r in exact_quantile(df, ["k"], "v", q, margins=(0.3,), weight="n", last_values=last).collect()}
    assert got == pytest.approx(expected)
    (whole,) = exact_quantile(df, [], "v", q, margins=(0.3,), weight="n", last_values=last).collect()
    assert whole["threshold"] == pytest.approx(np.quantile([v for _, v in told], q))


@pytest.fixture
def sorted_rows(monkeypatch):
    """Rows of the last stored values, which are all that a quantile sorts."""
    from revenuelake.operators import skew

    stored = []

    def noted(df, name, write=skew.materialize):
        out = write(df, name)
        if name == "quantile-values":
            stored.append(out.count())
        return out

    monkeypatch.setattr(skew, "materialize", noted)
    return stored


@pytest.mark.parametrize("q", [0.05, 0.5, 0.95])
def test_quantile_of_a_continuous_column_sorts_a_fixed_number_of_values(spark, sorted_rows, q):
    scores = spark.range(200_000).select(F.rand(7).alias("score"))
    scores = spark.createDataFrame(scores.toPandas())
    (got,) = exact_quantile(scores, [], "score", q, margins=(0.2,), last_values=256).collect()
    assert got["threshold"] == pytest.approx(np.quantile(scores.toPandas()["score"], q), abs=1e-15)
    assert len(sorted_rows) > 1 and sorted_rows[-1] <= 256
    assert all(b < a / 8 for a, b in zip(sorted_rows, sorted_rows[1:]))


def test_quantile_sorts_nothing_but_the_last_values(spark):
    """The only windows are over counts of ranges and over the stored last values."""
    scores = spark.range(50_000).select((F.rand(3) * F.rand(4)).alias("score"))
    plan = exact_quantile(scores, [], "score", 0.05, last_values=4096)._jdf.queryExecution().executedPlan().toString()
    assert "quantile-values" in plan and "quantile-groups" in plan
    assert "rand" not in plan and "Range" not in plan  # the scores themselves are not read again


def test_hot_value_among_continuous_ones(spark):
    values = [0.5] * 3000 + np.random.default_rng(1).random(4000).tolist()
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for q in (0.1, 0.5, 0.9):
        (got,) = exact_quantile(df, [], "v", q, last_values=16).collect()
        assert got["threshold"] == pytest.approx(np.quantile(values, q), abs=1e-15)


def test_processing_time_is_stored(table):
    at = dt.datetime(2024, 5, 6, 7, 8)
    rows = [dict(transaction_id="A", taxpayer_id="T", ts="2024-01-01 00:00:00", amount=1, tax_type="VAT")]
    got = insights.validate_transactions(table("realtime_transactions", rows), at).collect()
    assert [r["processing_time"] for r in got] == [at]
