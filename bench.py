"""Wall time of the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (folder of driver tables), BENCH_CPUS (local cores), BENCH_RUNS (repetitions).
The tax tables are derived from the driver's tables and stored first, then the marts are built and stored, as a
deployment would; that is ``load_to_marts``. The registered queries then run on the stored tables and the
dashboard pack on the stored tables and marts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from revenuelake.checks.queries import (  # noqa: E402
    AS_OF, QUERIES, RANGE, SEARCH, TAXPAYER, DerivedTables, profile_360, rule_alerts, shifted_forecasts,
)
from revenuelake.operators import features, revenue, rules  # noqa: E402
from revenuelake.plans import bi, live  # noqa: E402
from revenuelake.session import build_session, scratch_path, ship_package  # noqa: E402
from revenuelake.sources.writers import overwrite_table, write_payments  # noqa: E402

HEADLINE = [
    "stg_payments", "stg_vat_returns", "taxpayer_compliance", "payment_behavior", "revenue_aggregations",
    "revenue_dashboard_metrics", "revenue_summary", "taxpayer_360", "vat_drop", "peer_anomalies",
    "fraud_detection_alerts", "pattern_revenue_drop", "pattern_below_industry", "validate_transactions",
    "isolation_forest_anomalies", "derived_features", "train_random_forest", "train_forecast",
    "update_compliance_scores", "dq_report",
]


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action, runs: int) -> float:
    """Median of ``runs`` after one warm-up."""
    action()
    samples = []
    for _ in range(runs):
        start = time.perf_counter()
        action()
        samples.append(time.perf_counter() - start)
    return round(statistics.median(samples), 3)


TABLES = [
    "taxpayers", "vat_returns", "paye_returns", "fraud_alerts", "companies_registry", "vehicle_registry",
    "land_registry", "realtime_transactions",
]


class Store:
    """The tax tables and marts as stored tables; its attributes are what a query expects."""

    def __init__(self, t: DerivedTables):
        self.spark, self.root = t.spark, scratch_path(t.spark, "bench")
        for name in TABLES:
            overwrite_table(getattr(t, name).repartition(8), f"{self.root}/{name}")
        write_payments(t.payments, f"{self.root}/payments")
        overwrite_table(shifted_forecasts(t, 30), f"{self.root}/forecasts")
        overwrite_table(profile_360(self), f"{self.root}/profile")
        overwrite_table(
            revenue.revenue_dashboard_metrics(self.payments, self.taxpayers, AS_OF), f"{self.root}/metrics"
        )
        overwrite_table(rule_alerts(self, self.profile), f"{self.root}/alerts")

    def __getattr__(self, name: str):
        frame = self.spark.read.parquet(f"{self.root}/{name}")
        self.__dict__[name] = frame  # later uses skip the look at the file footers
        return frame

    def get(self, name: str):
        return getattr(self, name)

    def rows(self) -> int:
        return sum(self.get(n).count() for n in ("taxpayers", "vat_returns", "paye_returns", "payments", "realtime_transactions"))


def dashboard(s: Store) -> dict:
    g = s.get
    return {
        "bi_latest_month_by_type": lambda: bi.bi_latest_month_by_type(g("metrics")),
        "bi_revenue_trend_12m": lambda: bi.bi_revenue_trend_12m(g("metrics"), AS_OF),
        "bi_regional_heatmap": lambda: bi.bi_regional_heatmap(g("metrics"), AS_OF),
        "bi_channel_distribution": lambda: bi.bi_channel_distribution(g("metrics"), AS_OF),
        "bi_alerts_by_priority": lambda: bi.bi_alerts_by_priority(g("alerts")),
        "bi_top20_risk": lambda: bi.bi_top20_risk(g("alerts")),
        "bi_risk_by_sector": lambda: bi.bi_risk_by_sector(g("profile"), g("alerts")),
        "bi_taxpayer_profile": lambda: bi.bi_taxpayer_profile(g("profile"), TAXPAYER),
        "bi_payment_history": lambda: bi.bi_payment_history(g("payments"), TAXPAYER),
        "bi_compliance_timeline": lambda: bi.bi_compliance_timeline(g("paye_returns"), g("vat_returns"), TAXPAYER),
        "bi_peer_comparison": lambda: bi.bi_peer_comparison(g("profile"), TAXPAYER),
        "bi_revenue_by_sector": lambda: bi.bi_revenue_by_sector(g("payments"), g("taxpayers"), *RANGE),
        "bi_compliance_by_region": lambda: bi.bi_compliance_by_region(g("profile")),
        "bi_payment_delays": lambda: bi.bi_payment_delays(g("payments"), g("paye_returns"), g("vat_returns"), AS_OF),
        "bi_forecast_vs_actual": lambda: bi.bi_forecast_vs_actual(g("forecasts"), g("payments"), AS_OF),
        "live_month_revenue_growth": lambda: live.live_month_revenue_growth(g("payments"), AS_OF),
        "live_revenue_by_region_30d": lambda: live.live_revenue_by_region_30d(g("payments"), g("taxpayers"), AS_OF),
        "live_alert_table": lambda: live.live_alert_table(g("fraud_alerts"), g("taxpayers")),
        "live_taxpayer_search": lambda: live.live_taxpayer_search(g("taxpayers"), SEARCH),
    }


# The plain forms of three rewrites, timed for comparison only (BENCH_COMPARE=1).
PLAIN = {
    "vat_drop_self_join": """
        SELECT a.taxpayer_id, a.period_year, a.period_quarter, a.total_sales, avg(b.total_sales) AS mean
        FROM {vat} a JOIN {vat} b ON a.taxpayer_id = b.taxpayer_id
          AND (a.period_year - b.period_year) * 4 + a.period_quarter - b.period_quarter BETWEEN 1 AND 4
        WHERE a.status = 'Filed' GROUP BY 1, 2, 3, 4 HAVING count(b.return_id) > 1""",
    "peer_anomalies_self_join": """
        SELECT a.taxpayer_id, a.total_tax_paid, avg(b.total_tax_paid) AS mean
        FROM {profile} a JOIN {profile} b ON a.business_sector = b.business_sector
          AND a.business_size_category = b.business_size_category AND a.taxpayer_id <> b.taxpayer_id
        WHERE a.total_tax_paid > 0 GROUP BY 1, 2 HAVING count(*) >= 5""",
    "fraud_features_fan_out": """
        SELECT t.taxpayer_id, count(DISTINCT w.return_id) AS paye, count(DISTINCT v.return_id) AS vat,
          count(DISTINCT p.payment_id) AS payments, avg(p.amount) AS mean, stddev(p.amount) AS spread,
          avg(v.total_sales) AS sales, max(v.total_sales) AS highest
        FROM {taxpayers} t LEFT JOIN {paye} w ON w.taxpayer_id = t.taxpayer_id
          LEFT JOIN {vat} v ON v.taxpayer_id = t.taxpayer_id LEFT JOIN {payments} p ON p.taxpayer_id = t.taxpayer_id
        WHERE t.taxpayer_type IN ('Corporate', 'Partnership') GROUP BY t.taxpayer_id""",
}


def comparisons(s: Store, runs: int) -> dict[str, float]:
    frames = {
        "vat": s.vat_returns, "paye": s.paye_returns, "payments": s.payments, "taxpayers": s.taxpayers,
        "profile": s.profile,
    }
    used = {name: {k: v for k, v in frames.items() if "{" + k + "}" in text} for name, text in PLAIN.items()}
    actions = {name: (lambda name=name: s.spark.sql(PLAIN[name], **used[name])) for name in PLAIN}
    actions["vat_drop_window"] = lambda: rules.vat_drop(s.vat_returns)
    actions["peer_anomalies_leave_one_out"] = lambda: rules.peer_anomalies(s.profile)
    actions["fraud_features_pre_aggregated"] = lambda: features.fraud_features_weekly(
        s.taxpayers, s.paye_returns, s.vat_returns, s.payments, AS_OF
    )
    return {name: timed(lambda: consume(action()), runs) for name, action in actions.items()}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus, runs = os.environ.get("BENCH_CPUS", "8"), int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.driver.host": "127.0.0.1",
            "spark.driver.bindAddress": "127.0.0.1", "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    only = sys.argv[1:]
    times: dict[str, float] = {}
    start = time.perf_counter()
    Store(DerivedTables(spark, folder))
    cold = round(time.perf_counter() - start, 3)
    start = time.perf_counter()
    store = Store(DerivedTables(spark, folder))
    times["load_to_marts"] = round(time.perf_counter() - start, 3)
    actions = {name: (lambda name=name: QUERIES[name](store)) for name in HEADLINE} | dashboard(store)
    for name, query in actions.items():
        if not only or name in only:
            times[name] = timed(lambda: consume(query()), runs)
            print(name, times[name], file=sys.stderr, flush=True)
    compared = comparisons(store, runs) if os.environ.get("BENCH_COMPARE") else {}
    records_per_sec = round(store.rows() / times["load_to_marts"])
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total warm wall time of headline queries", "value": round(sum(times.values()), 3),
                "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus), "load_to_marts_cold": cold, "load_to_marts_records_per_sec": records_per_sec,
                **({"comparisons": compared} if compared else {}),
            }
        )
    )


if __name__ == "__main__":
    main()
