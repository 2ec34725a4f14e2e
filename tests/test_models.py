import datetime as dt
import threading

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from conftest import rows_by
from revenuelake.functions.scores import fraud_band
from revenuelake.operators import forecast, isoforest, model_store, models

COLUMNS = ["x", "y"]


@pytest.fixture(scope="module")
def planted(spark):
    """Labels that follow x with noise, one fraud row in five."""
    rng = np.random.default_rng(0)
    rows = []
    for i in range(400):
        fraud = int(i % 5 == 0)
        rows.append((f"T{i}", float(rng.normal(2.0 * fraud, 1.0)), float(rng.normal()), fraud))
    return spark.createDataFrame(rows, "taxpayer_id string, x double, y double, is_fraud int").cache()


def test_selection_finds_the_signal(planted):
    model, figures = models.split_evaluate_select(planted, COLUMNS, trees=5, folds=2)
    rows = figures.collect()
    assert {r["model"] for r in rows} == {"random_forest", "gradient_boosting", "weighted_boosting"}
    assert len(rows) == 6 and any(r["selected"] for r in rows)
    assert max(r["roc_auc"] for r in rows) > 0.75
    assert all(0 <= r["precision"] <= 1 and 0 <= r["recall"] <= 1 for r in rows)
    top = models.feature_importance(model, COLUMNS, planted.sparkSession).first()
    assert top["feature"] == "x"
    scores = models.score_taxpayers(model, planted)
    assert scores.filter("fraud_probability < 0 OR fraud_probability > 1").count() == 0


def test_fits_of_all_folds_run_side_by_side(planted, monkeypatch):
    gate = threading.Barrier(9)  # three models, each for two folds and for all rows

    class Waiting:
        def __init__(self, pipeline):
            self.pipeline = pipeline

        def fit(self, rows):
            gate.wait(60)
            return self.pipeline.fit(rows)

    for name in ("random_forest", "gradient_boosting"):
        made = getattr(models, name)
        monkeypatch.setattr(models, name, lambda *args, _made=made, **kwargs: Waiting(_made(*args, **kwargs)))
    rows = models.split_evaluate_select(planted, COLUMNS, trees=2, folds=2)[1].collect()
    assert len(rows) == 6 and not gate.broken


def test_folds_give_the_figures_of_the_cross_validator(planted):
    rows = models.split_evaluate_select(planted, COLUMNS, trees=3, folds=2)[1].collect()
    train = models.split_and_fold(planted, folds=2).filter("fold IS NOT NULL").withColumn("weight", F.lit(1.0))
    auc = BinaryClassificationEvaluator(labelCol=models.LABEL, metricName="areaUnderROC")
    pipeline = models.gradient_boosting(COLUMNS, 3)
    known = CrossValidator(estimator=pipeline, estimatorParamMaps=ParamGridBuilder().build(), evaluator=auc, numFolds=2, foldCol="fold").fit(train)
    found = next(r for r in rows if r["model"] == "gradient_boosting")
    assert (found["cv_mean"], found["cv_std"]) == pytest.approx((known.avgMetrics[0], known.stdMetrics[0]))


def test_a_fold_without_rows_is_an_error(planted):
    with pytest.raises(ValueError, match="fold 3 is empty"):
        models.split_evaluate_select(planted.filter("is_fraud = 0").limit(4), COLUMNS, trees=1, folds=5)


def test_split_is_disjoint_and_stratified(planted):
    train, test = models.stratified_split(planted)
    assert train.count() + test.count() == 400
    assert train.join(test, "taxpayer_id", "left_semi").count() == 0
    share = {r["is_fraud"]: r["n"] for r in train.groupBy("is_fraud").agg(F.count("*").alias("n")).collect()}
    assert share == {1: 64, 0: 256}


def test_classes_are_cut_exactly_and_folds_are_even(planted):
    some = planted.filter("taxpayer_id != 'T0' AND taxpayer_id != 'T1'")  # 79 and 319 rows
    cut = models.split_and_fold(some)
    counts = {(r["is_fraud"], r["fold"]): r["count"] for r in cut.groupBy("is_fraud", "fold").count().collect()}
    assert sum(n for (label, fold), n in counts.items() if label == 1 and fold is not None) == 63
    assert sum(n for (label, fold), n in counts.items() if label == 0 and fold is not None) == 255
    for label in (0, 1):
        sizes = [counts[label, fold] for fold in range(5)]
        assert max(sizes) - min(sizes) <= 1
    where = {r["taxpayer_id"]: r["fold"] for r in cut.collect()}
    assert where == {r["taxpayer_id"]: r["fold"] for r in models.split_and_fold(some.repartition(7)).collect()}


def test_stored_models_score_like_trained_ones(planted, spark, tmp_path):
    folder = str(tmp_path / "models")
    assert model_store.stored_versions(spark, folder) == []
    with pytest.raises(ValueError):
        model_store.load_model(spark, folder)
    forest = models.train_random_forest(planted, COLUMNS, trees=5)
    boosted = models.train_gradient_boosting(planted, COLUMNS, trees=3)
    figures = spark.createDataFrame([("random_forest", 0.9)], "model string, roc_auc double")
    assert model_store.save_model(forest, COLUMNS, figures, folder) == 1
    (tmp_path / "models" / "version=2" / "model").mkdir(parents=True)  # a writer that was lost
    assert model_store.save_model(boosted, COLUMNS, figures, folder) == 2
    for version, model in ((1, forest), (2, boosted), (None, boosted)):
        stored = model_store.load_model(spark, folder, version)
        got = rows_by(model_store.score_with_stored(stored, planted), "taxpayer_id")
        want = rows_by(models.score_taxpayers(model, planted), "taxpayer_id")
        assert {k: v["fraud_probability"] for k, v in got.items()} == {k: v["fraud_probability"] for k, v in want.items()}
        assert {v["model_version"] for v in got.values()} == {version or 2}
        assert stored.columns == COLUMNS and stored.figures.collect() == figures.collect()
    with pytest.raises(ValueError):
        model_store.score_with_stored(stored, planted.drop("y"))
    with pytest.raises(ValueError):
        model_store.load_model(spark, folder, 7)


def test_forest_splits_no_small_node(planted):
    forest = models.train_random_forest(planted.limit(19), COLUMNS, trees=3).stages[-1]
    assert all(tree.numNodes == 1 for tree in forest.trees)


def series_with_a_break(spark, slope_after, seed=3):
    start, rng = dt.date(2022, 1, 1), np.random.default_rng(seed)
    days = np.arange(730)
    trend = 0.0005 * days + np.maximum(days - 400, 0) * slope_after
    level = 1000 * np.exp(trend + rng.normal(0, 0.04, 730)) * (1 + 0.2 * np.sin(2 * np.pi * days / 7))
    return days, np.log(level), spark.createDataFrame(
        [(start + dt.timedelta(days=int(i)), "VAT", float(v)) for i, v in zip(days, level)], "ds date, tax_type string, y double"
    )


def test_planted_break_is_found(spark):
    days, target, history = series_with_a_break(spark, -0.004)
    found = forecast.change_points(days.astype(float), target, 729.0)
    assert 1 <= len(found) <= 3 and np.abs(found - 400).min() < 30
    bent, straight = (forecast.forecast_holdout_mape(history, bending=b).first()["mape"] for b in (True, False))
    assert bent < straight / 2
    _, target, _ = series_with_a_break(spark, 0.0)
    assert len(forecast.change_points(days.astype(float), target, 729.0)) == 0


def test_intervals_widen_with_the_horizon(spark):
    _, _, history = series_with_a_break(spark, -0.004)
    rows = sorted(forecast.train_forecast(history).collect(), key=lambda r: r["ds"])[730:]
    width = [np.log(r["yhat_upper"] / r["yhat_lower"]) for r in rows]
    assert width[89] > 1.1 * width[0] and width[60] > width[5]


def test_coordinate_descent_solves_the_penalised_problem():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(100, 6))
    y = x @ np.array([2.0, 0, 0, -1.5, 0, 0]) + rng.normal(0, 0.1, 100)
    quadratic, linear, strength = x.T @ x, x.T @ y, 30.0
    change = forecast.sparse_bends(quadratic, linear, strength, np.zeros(6))
    slope = linear - quadratic @ change
    assert np.allclose(slope[change != 0], strength * np.sign(change[change != 0]), atol=1e-4)
    assert (np.abs(slope[change == 0]) <= strength + 1e-6).all() and set(np.flatnonzero(change)) == {0, 3}


def test_oversample_reaches_half_the_normal_rows(planted):
    counts = {r["is_fraud"]: r["count"] for r in models.balance_oversample(planted).groupBy("is_fraud").count().collect()}
    assert counts == {0: 320, 1: 160}
    draws = [sorted(r["taxpayer_id"] for r in models.balance_oversample(planted.repartition(n)).collect()) for n in (1, 5)]
    assert draws[0] == draws[1]


def test_fraud_bands(spark):
    df = spark.createDataFrame([(p,) for p in (0.0, 0.3, 0.31, 0.6, 0.8, 0.81, 1.0)], "p double")
    got = [r[0] for r in df.select(fraud_band(F.col("p"))).collect()]
    assert got == [None, "Low", "Medium", "Medium", "High", "Critical", "Critical"]


def test_ml_alert_text(table, spark):
    scores = spark.createDataFrame([("A", 0.9123), ("B", 0.7), ("C", 0.95)], "taxpayer_id string, fraud_probability double")
    taxpayers = table("taxpayers", [dict(taxpayer_id="A"), dict(taxpayer_id="B"), dict(taxpayer_id="C")])
    paye = table("paye_returns", [dict(return_id="1", taxpayer_id="A", status="Overdue", due_date="2023-05-01"), dict(return_id="2", taxpayer_id="A", status="Overdue", due_date="2022-01-01")])
    vat = table("vat_returns", [dict(return_id=str(i), taxpayer_id="A", status="Overdue", due_date="2023-04-01") for i in range(2)])
    rows = rows_by(models.ml_alerts(scores, taxpayers, paye, vat, dt.date(2023, 6, 1)), "taxpayer_id")
    assert set(rows) == {"A", "C"}
    assert rows["A"]["description"] == "Fraud probability: 91.23%. 1 missing PAYE returns. 2 missing VAT returns. "
    assert rows["C"]["description"] == "Fraud probability: 95.00%. "


def test_isolation_forest_ranks_planted_outliers_first(spark):
    rng = np.random.default_rng(5)
    rows = [(f"n{i}", float(rng.normal()), float(rng.normal())) for i in range(400)]
    rows += [(f"o{i}", 9.0 + i, -9.0 - i) for i in range(8)]
    df = spark.createDataFrame(rows, "transaction_id string, x double, y double")
    marked = isoforest.isolation_forest_anomalies(df, COLUMNS, contamination=0.05, trees=50)
    lowest = [r["transaction_id"] for r in marked.orderBy("anomaly_score").limit(8).collect()]
    assert set(lowest) == {f"o{i}" for i in range(8)}
    share = marked.filter("is_anomaly").count() / len(rows)
    assert 0.03 < share <= 0.06
    again = isoforest.isolation_forest_anomalies(df.repartition(3), COLUMNS, contamination=0.05, trees=50)
    scores = lambda frame: {r["transaction_id"]: r["anomaly_score"] for r in frame.collect()}
    assert scores(again) == pytest.approx(scores(marked))


@pytest.fixture(scope="module")
def seasonal(spark):
    start = dt.date(2022, 1, 1)
    rng = np.random.default_rng(7)
    rows = []
    for i in range(730):
        level = 1000 * (1 + 0.3 * np.sin(2 * np.pi * i / 7)) * (1 + 0.2 * np.sin(2 * np.pi * i / 365.25)) * np.exp(rng.normal(0, 0.03))
        rows.append((start + dt.timedelta(days=i), "VAT", float(level)))
    return spark.createDataFrame(rows, "ds date, tax_type string, y double")


def test_forecast_beats_the_last_value(seasonal):
    mape = forecast.forecast_holdout_mape(seasonal).first()
    values = [r["y"] for r in seasonal.orderBy("ds").collect()]
    naive = np.mean([abs(v - values[-31]) / v for v in values[-30:]]) * 100
    assert mape["test_rows"] == 30 and mape["mape"] < naive / 2


def test_forecast_shape_and_summary(seasonal):
    out = forecast.train_forecast(seasonal)
    assert out.count() == 730 + 90
    assert out.filter("yhat_lower > yhat OR yhat > yhat_upper OR yhat <= 0").count() == 0
    last = dt.date(2022, 1, 1) + dt.timedelta(days=729)
    row = forecast.forecast_summary(out, last).first()
    future = sorted((r for r in out.collect() if r["ds"] > last), key=lambda r: r["ds"])[:30]
    assert row["next_30_days_total"] == pytest.approx(sum(r["yhat"] for r in future))
    expected = "increasing" if future[-1]["yhat"] > future[0]["yhat"] else "decreasing"
    assert row["trend_direction"] == expected


def test_anomaly_summary(spark):
    from revenuelake.operators.insights import anomaly_summary

    rows = [(f"X{i}", f"T{i}", 10.0 * i, -0.5 - i / 100) for i in range(8)]
    df = spark.createDataFrame(rows, "transaction_id string, taxpayer_id string, amount double, anomaly_score double")
    row = anomaly_summary(df).first()
    assert (row["anomalies_detected"], row["total_at_risk"]) == (8, 280.0)
    assert row["top_risk_taxpayers"] == ["T7", "T6", "T5", "T4", "T3"]
    empty = anomaly_summary(df.limit(0)).first()
    assert (empty["anomalies_detected"], empty["total_at_risk"], empty["top_risk_taxpayers"]) == (0, 0.0, [])
