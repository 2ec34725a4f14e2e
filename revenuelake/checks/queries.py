"""Every operator as a query over one folder of driver tables.

Results are made comparable across engines: decimals become doubles and doubles keep four places.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revenuelake.functions.scores import engagement_score, fraud_band, risk_category, size_category
from revenuelake.operators import (
    compliance, features, forecast, insights, isoforest, model_store, models, mutation, profile, quality, revenue, rules, staging,
    summary_state,
)
from revenuelake.plans import bi, bi_sql, live
from revenuelake.session import materialize, scratch_path, ship_package
from revenuelake.sources import lookup, postings, readers, writeback, writers
from revenuelake.sources.adapter import VIEWS, DerivedTables
from revenuelake.streaming import jobs

AS_OF = dt.date(2001, 8, 1)
ANOMALY_MONTHS = 60
RANGE = (dt.date(2000, 1, 1), dt.date(2000, 12, 31))
TAXPAYER = "TP000007"
SEARCH = "CUSTOMER#00000001"

Query = Callable[[DerivedTables], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, doubles to four places, timestamps without zone as plain timestamps.

    The two engines' ``round`` differ on values a hair below a tie, so the places are cut with arithmetic
    that both do alike.
    """

    def places(value: Column) -> Column:
        return F.floor(value * 1e4 + 0.5) / 1e4

    columns = []
    for field in df.schema.fields:
        column, kind = F.col(f"`{field.name}`"), field.dataType.typeName()
        if kind == "decimal":
            column = places(column.cast("double"))
        elif kind == "double":
            column = places(column)
        elif kind == "timestamp_ntz":
            column = column.cast("timestamp")
        columns.append(column.alias(field.name))
    return df.select(*columns)


# --- inputs derived from the tables ------------------------------------------------------


def profile_360(t: DerivedTables) -> DataFrame:
    return profile.taxpayer_360(
        t.taxpayers, t.paye_returns, t.vat_returns, t.payments, t.companies_registry, t.vehicle_registry,
        t.land_registry, t.fraud_alerts, AS_OF,
    )


def stored_profile(t: DerivedTables) -> DataFrame:
    return materialize(profile_360(t), "taxpayer-360")


def rule_alerts(t: DerivedTables, stored: DataFrame | None = None) -> DataFrame:
    stored = stored if stored is not None else stored_profile(t)
    return rules.fraud_detection_alerts(stored, t.vat_returns, t.paye_returns, t.payments, AS_OF, ANOMALY_MONTHS)


def metrics(t: DerivedTables) -> DataFrame:
    return revenue.revenue_dashboard_metrics(t.payments, t.taxpayers, AS_OF)


def shifted_forecasts(t: DerivedTables, days: int) -> DataFrame:
    """Stand-in forecasts: nine tenths of the revenue ``days`` before, with a band."""
    total = F.sum("amount")
    return (
        staging.stg_payments(t.payments)
        .groupBy(F.date_add("payment_date", days).alias("forecast_date"), "tax_type")
        .agg(
            (total * F.lit(0.9).cast("decimal(2,1)")).cast("decimal(15,2)").alias("predicted_revenue"),
            (total * F.lit(0.8).cast("decimal(2,1)")).cast("decimal(15,2)").alias("lower_bound"),
            (total * F.lit(1.1).cast("decimal(2,1)")).cast("decimal(15,2)").alias("upper_bound"),
        )
    )


def stored_scores(t: DerivedTables) -> DataFrame:
    """Stand-in model scores: one minus the compliance score of corporates and partnerships."""
    p = F.lit(1.0) - F.col("compliance_score").cast("double")
    return t.taxpayers.filter(F.col("taxpayer_type").isin("Corporate", "Partnership")).select(
        "taxpayer_id", F.round(p, 2).alias("fraud_probability"), fraud_band(F.round(p, 2)).alias("fraud_risk_category")
    )


def weekly_features(t: DerivedTables) -> DataFrame:
    return features.derived_features(
        features.fraud_features_weekly(t.taxpayers, t.paye_returns, t.vat_returns, t.payments, AS_OF)
    )


def extended_features(t: DerivedTables) -> DataFrame:
    return features.fraud_features_extended(
        t.taxpayers, t.paye_returns, t.vat_returns, t.payments, t.fraud_alerts, AS_OF
    )


def training_table(t: DerivedTables) -> DataFrame:
    """The weekly features, written once: training reads them many times."""
    return materialize(weekly_features(t), "fraud-features")


def transaction_table(t: DerivedTables) -> DataFrame:
    return insights.transaction_features(t.realtime_transactions)


def marked_transactions(t: DerivedTables) -> DataFrame:
    channels = insights.categories(t.realtime_transactions, "payment_channel", insights.C.PAYMENT_CHANNELS)
    found = channels, insights.categories(t.realtime_transactions, "tax_type")
    featured = insights.transaction_features(t.realtime_transactions, *found)
    return isoforest.isolation_forest_anomalies(featured, insights.feature_columns(*found))


def history(t: DerivedTables) -> DataFrame:
    return forecast.revenue_history(t.payments, AS_OF)


def _joined(*sides: DataFrame) -> DataFrame:
    first, *rest = sides
    for side in rest:
        first = first.join(side, "taxpayer_id", "left")
    return first


# --- sources and sinks: written to the shared folder and read back ----------------------------


def q_read_csv_table(t: DerivedTables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    writers.write_csv(t.taxpayers, path)
    return readers.read_csv_table(t.spark, "taxpayers", path, escaped=True)


def q_copy_csv_load(t: DerivedTables) -> DataFrame:
    source, target = scratch_path(t.spark, "csv"), scratch_path(t.spark, "tables")
    for table in writers.CSV_TABLES:
        writers.write_csv(getattr(t, table), f"{source}/{table}.csv")
    loaded = writers.copy_csv_load(t.spark, source, target)
    counts = None
    for table in loaded:
        stored = readers.read_table(t.spark, target, table)
        one = stored.agg(F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        counts = one if counts is None else counts.unionByName(one)
    return counts


def q_copy_csv_rejects(t: DerivedTables) -> DataFrame:
    """All payments, some made faulty by their number, loaded and rejected."""
    source, target = scratch_path(t.spark, "csv"), scratch_path(t.spark, "tables")
    texts, ends = t.payments.select(*[F.col(c).cast("string").alias(c) for c in t.payments.columns]), F.right(F.col("payment_id"), F.lit(2))
    faulty = texts.withColumns(
        {
            "payment_date": F.when(ends == "07", F.lit("2001-02-30")).otherwise(F.col("payment_date")),
            "amount": F.when(ends == "13", F.lit("n/a")).when(ends == "29", F.lit(None)).otherwise(F.col("amount")),
            "period_year": F.when(ends == "29", F.lit("last year")).otherwise(F.col("period_year")),
        }
    )
    writers.write_csv(faulty, f"{source}/payments.csv")
    writers.copy_csv_load(t.spark, source, target, ["payments"], f"{target}/rejects")
    loaded = readers.read_table(t.spark, target, "payments").select("payment_id", F.lit(None).cast("string").alias("reason"), "amount", "payment_date")
    rejects = t.spark.read.parquet(f"{target}/rejects")
    return loaded.unionByName(rejects.select(F.split("record", ",")[0].alias("payment_id"), "reason"), allowMissingColumns=True)


def q_overwrite_table(t: DerivedTables) -> DataFrame:
    path = f"{scratch_path(t.spark, 'tables')}/vat_returns"
    writers.overwrite_table(t.vat_returns, path)
    writers.overwrite_table(t.vat_returns, path)
    return readers.read_table(t.spark, path.rsplit("/", 1)[0], "vat_returns")


def q_read_table(t: DerivedTables) -> DataFrame:
    folder = scratch_path(t.spark, "tables")
    writers.write_payments(t.payments, f"{folder}/payments")
    return readers.read_table(t.spark, folder, "payments").drop("created_at", "payment_month")


def q_write_csv(t: DerivedTables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    writers.write_csv(t.fraud_alerts, path)
    stored = readers.read_csv_table(t.spark, "fraud_alerts", path, escaped=True)
    return stored.select(*t.fraud_alerts.columns)


def q_write_json_report(t: DerivedTables) -> DataFrame:
    path = scratch_path(t.spark, "report")
    report = insights.compliance_insights(t.taxpayers)
    writers.write_json_report(report, path)
    return t.spark.read.schema(report.schema).json(path)


def q_materialize_summary(t: DerivedTables) -> DataFrame:
    path = scratch_path(t.spark, "summary")
    writers.materialize_summary(t.payments, t.taxpayers, path)
    return t.spark.read.parquet(path).drop("month")


def q_refresh_summary(t: DerivedTables) -> DataFrame:
    """The summary built without the payments of one month's last days, which then come late."""
    folder, late = scratch_path(t.spark, "summary"), F.col("payment_date").between("2000-03-20", "2000-04-05")
    numbers = materialize(summary_state.number_taxpayers(t.taxpayers), "payer-numbers")
    summary_state.build_summary(t.payments.filter(~late), numbers, folder)
    summary_state.refresh_summary(t.payments.filter(late), numbers, folder)
    return t.spark.read.parquet(f"{folder}/summary").drop("month")


def q_publish_views(t: DerivedTables) -> DataFrame:
    writers.publish_views({"stg_paye_returns": staging.stg_paye_returns(t.paye_returns)})
    return t.spark.sql(
        "SELECT filing_status, count(*) AS n_returns, sum(gross_salaries) AS gross_salaries "
        "FROM stg_paye_returns GROUP BY filing_status"
    )


def _stored_by_taxpayer(t: DerivedTables, df: DataFrame, *order: str) -> DataFrame:
    path = scratch_path(t.spark, "lookup")
    return lookup.store_by_key(df, path.rsplit("/", 1)[1].replace("-", "_"), path, "taxpayer_id", order)


def q_search_by_postings(t: DerivedTables) -> DataFrame:
    path = scratch_path(t.spark, "postings")
    lists, lengths = postings.store_postings(t.taxpayers, path.rsplit("/", 1)[1].replace("-", "_"), path)
    return postings.search_postings(t.taxpayers, lists, lengths, SEARCH)


def q_upsert_stored_forecasts(t: DerivedTables) -> DataFrame:
    path = scratch_path(t.spark, "forecasts")
    stamp = F.lit(dt.date(2001, 7, 1)).cast("timestamp").alias("created_at")
    first = shifted_forecasts(t, 30).select("*", stamp)
    writeback.store_forecasts(first, path)
    for _ in range(2):  # the second run finds nothing to change
        writeback.upsert_stored_forecasts(t.spark, path, first.schema, shifted_forecasts(t, 20), AS_OF)
    return writeback.read_forecasts(t.spark, path, first.schema).drop(writeback.FORECAST_MONTH)


def q_lookup_payment_history(t: DerivedTables) -> DataFrame:
    return bi.bi_payment_history(_stored_by_taxpayer(t, t.payments, "payment_date"), TAXPAYER)


def q_lookup_recent_payments(t: DerivedTables) -> DataFrame:
    return live.live_recent_payments(_stored_by_taxpayer(t, t.payments, "payment_date"), TAXPAYER)


def q_lookup_taxpayer(t: DerivedTables) -> DataFrame:
    return live.live_taxpayer_lookup(_stored_by_taxpayer(t, profile_360(t)), TAXPAYER)


def q_lookup_taxpayer_profile(t: DerivedTables) -> DataFrame:
    return bi.bi_taxpayer_profile(_stored_by_taxpayer(t, profile_360(t)), TAXPAYER)


# --- streams ------------------------------------------------------------------------------------


def _event_stream(t: DerivedTables) -> DataFrame:
    schema = t.source("events").schema
    events = t.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(t.folder)
    return t.spark.sql(VIEWS["realtime_transactions"][1], events=events).withColumn("ts", F.col("ts").cast("timestamp"))


def q_stream_validate_transactions(t: DerivedTables) -> DataFrame:
    target = scratch_path(t.spark, "validated")
    jobs.stream_validate_transactions(_event_stream(t), target, scratch_path(t.spark, "offsets")).awaitTermination()
    return t.spark.read.parquet(target).drop("day")


def q_stream_daily_revenue(t: DerivedTables) -> DataFrame:
    target = scratch_path(t.spark, "daily")
    jobs.stream_daily_revenue(_event_stream(t), target, scratch_path(t.spark, "offsets")).awaitTermination()
    return t.spark.read.parquet(target)


# --- models ---------------------------------------------------------------------------------------


def q_train_random_forest(t: DerivedTables) -> DataFrame:
    data = training_table(t)
    model = models.train_random_forest(data, features.WEEKLY_FEATURES)
    return models.score_taxpayers(model, data)


def q_train_gradient_boosting(t: DerivedTables) -> DataFrame:
    data = training_table(t)
    plain = models.train_gradient_boosting(data, features.WEEKLY_FEATURES)
    weighted = models.train_gradient_boosting(data, features.WEEKLY_FEATURES, weighted=True)
    sides = [
        models.with_probability(m, data).select("taxpayer_id", F.col("fraud_probability").alias(name))
        for m, name in ((plain, "plain_probability"), (weighted, "weighted_probability"))
    ]
    return _joined(*sides)


def q_split_evaluate_select(t: DerivedTables) -> DataFrame:
    return models.split_evaluate_select(training_table(t), features.WEEKLY_FEATURES)[1]


def q_feature_importance(t: DerivedTables) -> DataFrame:
    data = training_table(t)
    model = models.train_random_forest(data, features.WEEKLY_FEATURES)
    return models.feature_importance(model, features.WEEKLY_FEATURES, t.spark)


def q_score_taxpayers(t: DerivedTables) -> DataFrame:
    """Forest on the balanced extended features, as the daily chain trains it; the second model variant."""
    data = materialize(features.derived_features_extended(extended_features(t)), "extended-features")
    balanced = materialize(models.balance_oversample(data), "balanced-features")
    model = models.train_random_forest(balanced, features.EXTENDED_FEATURES)
    return models.score_taxpayers(model, data)


def q_stored_model_scores(t: DerivedTables) -> DataFrame:
    """A forest is trained, stored with its figures, loaded and applied: scores of the stored model beside the trained one's."""
    data, folder = training_table(t), scratch_path(t.spark, "models")
    model = models.train_random_forest(data, features.WEEKLY_FEATURES)
    model_store.save_model(model, features.WEEKLY_FEATURES, models.feature_importance(model, features.WEEKLY_FEATURES, t.spark), folder)
    stored = model_store.score_with_stored(model_store.load_model(t.spark, folder), data)
    same = F.abs(F.col("fraud_probability") - F.col("trained_probability")) < 1e-12
    trained = models.score_taxpayers(model, data).select("taxpayer_id", F.col("fraud_probability").alias("trained_probability"))
    return stored.join(trained, "taxpayer_id", "full").select("taxpayer_id", "model_version", same.alias("same_score"))


def q_forecast_ranges(t: DerivedTables) -> DataFrame:
    """What a forecast must hold whatever the fit: its days, and intervals around positive values that widen after the history."""
    told = materialize(history(t), "history")
    ends = told.groupBy("tax_type").agg(F.max("ds").alias("_end"))
    out = forecast.train_forecast(told).join(ends, "tax_type")
    wide = F.log("yhat_upper") - F.log("yhat_lower")
    future = F.col("ds") > F.col("_end")
    ordered = (F.col("yhat_lower") > 0) & (F.col("yhat_lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("yhat_upper"))
    return out.groupBy("tax_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("ds").alias("first_day"), F.max("ds").alias("last_day"),
        F.bool_and(ordered).alias("ordered"),
        (F.max_by(wide, F.when(future, F.col("ds"))) >= F.min_by(wide, F.when(future, F.col("ds"))) * 0.99).alias("widening"),
    )


def q_risk_category(t: DerivedTables) -> DataFrame:
    measured = _joined(
        compliance.with_filing_measures(t.taxpayers.select("taxpayer_id"), t.paye_returns, t.vat_returns),
        profile.fraud_indicators(t.fraud_alerts),
    )
    return measured.select(
        "taxpayer_id",
        risk_category(
            F.col("max_fraud_risk_score"), F.col("chronic_late_filer"), F.col("low_filing_rate"),
            F.col("filing_compliance_rate"),
        ).alias("risk_category_calculated"),
    )


def q_engagement_score(t: DerivedTables) -> DataFrame:
    measured = _joined(
        compliance.with_filing_measures(t.taxpayers.select("taxpayer_id", "email"), t.paye_returns, t.vat_returns),
        profile.revenue_contribution(t.payments),
    )
    score = engagement_score(F.col("email"), F.col("active_payment_months"), F.col("filing_compliance_rate"))
    return measured.select("taxpayer_id", score.alias("engagement_score"))


def _from_profile(rule: Callable[..., DataFrame], *tables: str) -> Query:
    return lambda t: rule(stored_profile(t), *[getattr(t, name) for name in tables])


QUERIES: dict[str, Query] = {
    # sources, sinks
    "read_csv_table": q_read_csv_table,
    "copy_csv_load": q_copy_csv_load,
    "copy_csv_rejects": q_copy_csv_rejects,
    "overwrite_table": q_overwrite_table,
    "read_table": q_read_table,
    "write_csv": q_write_csv,
    "write_json_report": q_write_json_report,
    "materialize_summary": q_materialize_summary,
    "refresh_summary": q_refresh_summary,
    "publish_views": q_publish_views,
    "region_districts": lambda t: readers.region_districts(t.regions),
    # table changes
    "upsert_forecasts": lambda t: mutation.upsert_forecasts(
        mutation.upsert_forecasts(
            t.spark.createDataFrame([], "forecast_date date, tax_type string, predicted_revenue decimal(15,2), lower_bound decimal(15,2), upper_bound decimal(15,2), created_at timestamp"),
            shifted_forecasts(t, 30), dt.date(2001, 7, 1),
        ),
        shifted_forecasts(t, 20), AS_OF,
    ),
    "upsert_stored_forecasts": q_upsert_stored_forecasts,
    "update_compliance_scores": lambda t: mutation.update_compliance_scores(
        t.taxpayers, t.paye_returns, t.vat_returns, AS_OF
    ),
    "apply_fraud_scores": lambda t: mutation.apply_fraud_scores(t.taxpayers, stored_scores(t), AS_OF),
    "close_open_alerts": lambda t: mutation.close_open_alerts(t.fraud_alerts),
    "redate_old_alerts": lambda t: mutation.redate_old_alerts(t.fraud_alerts, dt.date(2001, 1, 1), dt.date(2001, 7, 1)),
    "append_alerts": lambda t: mutation.append_alerts(
        t.fraud_alerts, models.ml_alerts(stored_scores(t), t.taxpayers, t.paye_returns, t.vat_returns, AS_OF), AS_OF
    ).drop("created_at"),
    "touch_updated_at": lambda t: mutation.touch_updated_at(t.taxpayers, F.col("risk_category") == "High", AS_OF),
    # staging
    "stg_taxpayers": lambda t: staging.stg_taxpayers(t.taxpayers),
    "stg_paye_returns": lambda t: staging.stg_paye_returns(t.paye_returns),
    "stg_vat_returns": lambda t: staging.stg_vat_returns(t.vat_returns),
    "stg_payments": lambda t: staging.stg_payments(t.payments),
    # compliance
    "paye_compliance": lambda t: compliance.paye_compliance(t.paye_returns),
    "vat_compliance": lambda t: compliance.vat_compliance(t.vat_returns),
    "payment_behavior": lambda t: compliance.payment_behavior(t.payments, t.paye_returns, t.vat_returns),
    "taxpayer_compliance": lambda t: compliance.taxpayer_compliance(
        t.taxpayers, t.paye_returns, t.vat_returns, t.payments
    ),
    "filing_summary_simple": lambda t: compliance.filing_summary_simple(t.paye_returns, "paye"),
    "filing_summary_simple_vat": lambda t: compliance.filing_summary_simple(t.vat_returns, "vat"),
    # revenue
    "revenue_daily": lambda t: revenue.revenue_daily(t.payments),
    "revenue_monthly": lambda t: revenue.revenue_monthly(t.payments),
    "revenue_regional": lambda t: revenue.revenue_regional(t.payments, t.taxpayers),
    "revenue_sector": lambda t: revenue.revenue_sector(t.payments, t.taxpayers),
    "revenue_aggregations": lambda t: revenue.revenue_aggregations(t.payments, t.taxpayers),
    "metric_daily": lambda t: revenue.metric_daily(t.payments, AS_OF),
    "metric_monthly": lambda t: revenue.metric_monthly(t.payments),
    "metric_regional": lambda t: revenue.metric_regional(t.payments, t.taxpayers),
    "metric_channel": lambda t: revenue.metric_channel(t.payments),
    "metric_ytd": lambda t: revenue.metric_ytd(t.payments),
    "metric_yoy": lambda t: revenue.metric_yoy(t.payments),
    "yearly_targets": lambda t: revenue.yearly_targets(t.payments, AS_OF),
    "metric_target_vs_actual": lambda t: revenue.metric_target_vs_actual(t.payments, AS_OF),
    "revenue_dashboard_metrics": metrics,
    "revenue_dashboard_simple": lambda t: revenue.revenue_dashboard_simple(t.payments, t.taxpayers),
    "revenue_summary": lambda t: revenue.revenue_summary(t.payments, t.taxpayers),
    # profile
    "revenue_contribution": lambda t: profile.revenue_contribution(t.payments),
    "external_assets": lambda t: profile.external_assets(
        t.taxpayers, t.companies_registry, t.vehicle_registry, t.land_registry
    ),
    "fraud_indicators": lambda t: profile.fraud_indicators(t.fraud_alerts),
    "taxpayer_360": profile_360,
    "taxpayer_360_simple": lambda t: profile.taxpayer_360_simple(
        t.taxpayers, t.paye_returns, t.vat_returns, t.payments, t.fraud_alerts, AS_OF
    ),
    "risk_category": q_risk_category,
    "size_category": lambda t: t.taxpayers.groupBy(
        size_category(F.col("annual_turnover")).alias("business_size_category")
    ).agg(F.count(F.lit(1)).alias("n_taxpayers")),
    "engagement_score": q_engagement_score,
    # fraud rules
    "vat_drop": lambda t: rules.vat_drop(t.vat_returns),
    "paye_revenue_mismatch": lambda t: rules.paye_revenue_mismatch(t.paye_returns, t.taxpayers),
    "payment_anomalies": lambda t: rules.payment_anomalies(t.payments, AS_OF, ANOMALY_MONTHS),
    "payment_anomalies_6m": lambda t: rules.payment_anomalies(t.payments, AS_OF),
    "peer_anomalies": _from_profile(rules.peer_anomalies),
    "alerts_vat_drop": _from_profile(rules.alerts_vat_drop, "vat_returns"),
    "alerts_paye_mismatch": _from_profile(rules.alerts_paye_mismatch, "paye_returns"),
    "alerts_payment": lambda t: rules.alerts_payment(stored_profile(t), t.payments, AS_OF, ANOMALY_MONTHS),
    "alerts_peer": _from_profile(rules.alerts_peer),
    "alerts_noncompliance": _from_profile(rules.alerts_noncompliance),
    "fraud_detection_alerts": rule_alerts,
    "fraud_alerts_enriched": lambda t: rules.fraud_alerts_enriched(t.fraud_alerts, t.taxpayers),
    "pattern_revenue_drop": lambda t: rules.pattern_revenue_drop(t.payments),
    "pattern_channel_anomaly": lambda t: rules.pattern_channel_anomaly(t.payments, AS_OF),
    "pattern_below_industry": lambda t: rules.pattern_below_industry(t.payments, t.taxpayers, AS_OF),
    # dashboard pack
    "bi_latest_month_by_type": lambda t: bi.bi_latest_month_by_type(metrics(t)),
    "bi_revenue_trend_12m": lambda t: bi.bi_revenue_trend_12m(metrics(t), AS_OF),
    "bi_regional_heatmap": lambda t: bi.bi_regional_heatmap(metrics(t), AS_OF),
    "bi_target_vs_actual": lambda t: bi.bi_target_vs_actual(metrics(t), AS_OF),
    "bi_yoy": lambda t: bi.bi_yoy(metrics(t), AS_OF),
    "bi_channel_distribution": lambda t: bi.bi_channel_distribution(metrics(t), AS_OF),
    "bi_alerts_by_priority": lambda t: bi.bi_alerts_by_priority(rule_alerts(t)),
    "bi_top20_risk": lambda t: bi.bi_top20_risk(rule_alerts(t)),
    "bi_alerts_by_type": lambda t: bi.bi_alerts_by_type(rule_alerts(t)),
    "bi_risk_by_sector": lambda t: (lambda stored: bi.bi_risk_by_sector(stored, rule_alerts(t, stored)))(
        stored_profile(t)
    ),
    "bi_taxpayer_profile": lambda t: bi.bi_taxpayer_profile(profile_360(t), TAXPAYER),
    "bi_payment_history": lambda t: bi.bi_payment_history(t.payments, TAXPAYER),
    "bi_compliance_timeline": lambda t: bi.bi_compliance_timeline(t.paye_returns, t.vat_returns, TAXPAYER),
    "bi_peer_comparison": lambda t: bi.bi_peer_comparison(stored_profile(t), TAXPAYER),
    "bi_revenue_by_sector": lambda t: bi.bi_revenue_by_sector(t.payments, t.taxpayers, *RANGE),
    "bi_compliance_by_region": lambda t: bi.bi_compliance_by_region(profile_360(t)),
    "bi_payment_delays": lambda t: bi.bi_payment_delays(t.payments, t.paye_returns, t.vat_returns, AS_OF),
    "bi_forecast_30d": lambda t: bi.bi_forecast_30d(shifted_forecasts(t, 30), AS_OF),
    "bi_forecast_vs_actual": lambda t: bi.bi_forecast_vs_actual(shifted_forecasts(t, 30), t.payments, AS_OF),
    # live queries
    "live_today_collections": lambda t: live.live_today_collections(t.payments, AS_OF),
    "live_active_alerts": lambda t: live.live_active_alerts(t.fraud_alerts),
    "live_month_revenue_growth": lambda t: live.live_month_revenue_growth(t.payments, AS_OF),
    "live_compliance_rate": lambda t: live.live_compliance_rate(t.taxpayers),
    "live_active_taxpayers_30d": lambda t: live.live_active_taxpayers_30d(t.payments, AS_OF),
    "live_revenue_trend_30d": lambda t: live.live_revenue_trend_30d(t.payments, AS_OF),
    "live_revenue_by_region_30d": lambda t: live.live_revenue_by_region_30d(t.payments, t.taxpayers, AS_OF),
    "live_top5_alerts": lambda t: live.live_top5_alerts(t.fraud_alerts, t.taxpayers),
    "live_revenue_by_type": lambda t: live.live_revenue_by_type(t.payments, *RANGE),
    "live_channel_analysis": lambda t: live.live_channel_analysis(t.payments, *RANGE),
    "live_high_risk_count": lambda t: live.live_high_risk_count(t.taxpayers),
    "live_revenue_at_risk": lambda t: live.live_revenue_at_risk(t.payments, t.taxpayers, AS_OF),
    "live_alert_table": lambda t: live.live_alert_table(t.fraud_alerts, t.taxpayers),
    "live_risk_bands": lambda t: live.live_risk_bands(t.taxpayers),
    "live_taxpayer_search": lambda t: live.live_taxpayer_search(t.taxpayers, SEARCH),
    "live_taxpayer_lookup": lambda t: live.live_taxpayer_lookup(profile_360(t), TAXPAYER),
    "live_recent_payments": lambda t: live.live_recent_payments(t.payments, TAXPAYER),
    # the look-ups of one taxpayer over tables stored by key
    "search_by_postings": q_search_by_postings,
    "lookup_payment_history": q_lookup_payment_history,
    "lookup_recent_payments": q_lookup_recent_payments,
    "lookup_taxpayer": q_lookup_taxpayer,
    "lookup_taxpayer_profile": q_lookup_taxpayer_profile,
    # transactions and insights
    "validate_transactions": lambda t: insights.validate_transactions(t.realtime_transactions),
    "transaction_features": transaction_table,
    "isolation_forest_anomalies": marked_transactions,
    "anomaly_reasons": lambda t: insights.with_anomaly_reasons(transaction_table(t)).select(
        "transaction_id", "hour", "is_weekend", "alert_reason"
    ),
    "anomaly_summary": lambda t: insights.anomaly_summary(isoforest.anomalies_with_reasons(marked_transactions(t))),
    "revenue_insights": lambda t: insights.revenue_insights(t.payments, AS_OF),
    "compliance_insights": lambda t: insights.compliance_insights(t.taxpayers),
    "collection_projection_7d": lambda t: insights.collection_projection_7d(t.payments, AS_OF),
    # fraud models
    "fraud_features_weekly": lambda t: features.fraud_features_weekly(
        t.taxpayers, t.paye_returns, t.vat_returns, t.payments, AS_OF
    ),
    "fraud_features_extended": extended_features,
    "derived_features": weekly_features,
    "derived_features_extended": lambda t: features.derived_features_extended(extended_features(t)),
    "balance_oversample": lambda t: models.balance_oversample(training_table(t)),
    "train_random_forest": q_train_random_forest,
    "train_gradient_boosting": q_train_gradient_boosting,
    "split_evaluate_select": q_split_evaluate_select,
    "split_class_counts": lambda t: models.split_class_counts(training_table(t)),
    "oversample_class_counts": lambda t: models.balance_oversample(training_table(t)).groupBy(F.col("is_fraud").cast("int").alias("label")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("taxpayer_id").alias("n_taxpayers")
    ),
    "stored_model_scores": q_stored_model_scores,
    "feature_importance": q_feature_importance,
    "score_taxpayers": q_score_taxpayers,
    "ml_alerts": lambda t: models.ml_alerts(stored_scores(t), t.taxpayers, t.paye_returns, t.vat_returns, AS_OF),
    # forecasts
    "revenue_history": history,
    "train_forecast": lambda t: forecast.train_forecast(history(t)),
    "forecast_ranges": q_forecast_ranges,
    "forecast_holdout_mape": lambda t: forecast.forecast_holdout_mape(history(t)),
    "forecast_summary": lambda t: forecast.forecast_summary(forecast.train_forecast(history(t)), AS_OF),
    "forecast_deviation_alerts": lambda t: forecast.forecast_deviation_alerts(
        shifted_forecasts(t, 30), t.payments, AS_OF
    ),
    # data quality
    "dq_null_ids": lambda t: quality.dq_null_ids(t.taxpayers),
    "dq_duplicate_tin": lambda t: quality.dq_duplicate_tin(t.taxpayers),
    "dq_unique": lambda t: quality.dq_unique(t.payments, ["reference_number"]),
    "dq_not_null": lambda t: quality.dq_not_null(t.payments, "reference_number").drop("created_at"),
    "dq_relationships": lambda t: quality.dq_relationships(
        t.payments, "reference_number", t.vat_returns, "return_id"
    ).drop("created_at"),
    "dq_accepted_values": lambda t: quality.dq_accepted_values(
        t.realtime_transactions, "tax_type", quality.C.TAX_TYPES
    ),
    "dq_report": lambda t: quality.dq_report(
        {name: getattr(t, name) for name in ("taxpayers", "paye_returns", "vat_returns", "payments")}
    ),
    # streams
    "stream_validate_transactions": q_stream_validate_transactions,
    "stream_daily_revenue": q_stream_daily_revenue,
}


# What each query of the SQL pack reads, and its parameters.
BI_SQL_INPUTS: dict[str, tuple[tuple[str, ...], dict[str, dt.date | str]]] = {
    "bi_latest_month_by_type": (("revenue_dashboard_metrics",), {}),
    "bi_revenue_trend_12m": (("revenue_dashboard_metrics",), {"as_of": AS_OF}),
    "bi_regional_heatmap": (("revenue_dashboard_metrics",), {"as_of": AS_OF}),
    "bi_target_vs_actual": (("revenue_dashboard_metrics",), {"as_of": AS_OF}),
    "bi_yoy": (("revenue_dashboard_metrics",), {"as_of": AS_OF}),
    "bi_channel_distribution": (("revenue_dashboard_metrics",), {"as_of": AS_OF}),
    "bi_alerts_by_priority": (("fraud_detection_alerts",), {}),
    "bi_top20_risk": (("fraud_detection_alerts",), {}),
    "bi_alerts_by_type": (("fraud_detection_alerts",), {}),
    "bi_risk_by_sector": (("taxpayer_360", "fraud_detection_alerts"), {}),
    "bi_taxpayer_profile": (("taxpayer_360",), {"taxpayer_id": TAXPAYER}),
    "bi_payment_history": (("payments",), {"taxpayer_id": TAXPAYER}),
    "bi_compliance_timeline": (("paye_returns", "vat_returns"), {"taxpayer_id": TAXPAYER}),
    "bi_peer_comparison": (("taxpayer_360",), {"taxpayer_id": TAXPAYER}),
    "bi_revenue_by_sector": (("payments", "taxpayers"), {"start": RANGE[0], "end": RANGE[1]}),
    "bi_compliance_by_region": (("taxpayer_360",), {}),
    "bi_payment_delays": (("payments", "paye_returns", "vat_returns"), {"as_of": AS_OF}),
    "bi_forecast_30d": (("revenue_forecasts",), {"as_of": AS_OF}),
    "bi_forecast_vs_actual": (("revenue_forecasts", "payments"), {"as_of": AS_OF}),
}


def run_bi_sql(t: DerivedTables, name: str) -> DataFrame:
    """A query of the SQL pack over views of the stored profile, the alerts and the other tables."""
    wanted, parameters = BI_SQL_INPUTS[name]
    made: dict[str, DataFrame] = {}
    for table in wanted:
        if table == "revenue_dashboard_metrics":
            made[table] = metrics(t)
        elif table == "taxpayer_360":
            made[table] = stored_profile(t)
        elif table == "fraud_detection_alerts":
            made[table] = rule_alerts(t, made.get("taxpayer_360"))
        elif table == "revenue_forecasts":
            made[table] = shifted_forecasts(t, 30)
        else:
            made[table] = getattr(t, table)
    bi_sql.publish_dashboard(**made)
    return bi_sql.run_sql(t.spark, name, **parameters)


QUERIES |= {f"sql_{name}": partial(run_bi_sql, name=name) for name in BI_SQL_INPUTS}


def run_query(name: str, spark: SparkSession, folder: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package(spark)
    return comparable(QUERIES[name](DerivedTables(spark, folder)))
