"""Fraud models with MLlib: balancing, training, evaluation, scoring and alerts."""

from __future__ import annotations

import datetime as dt
import statistics
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revenuelake import constants as C
from revenuelake.functions.dates import months_before
from revenuelake.functions.ratios import join_text, ratio, two_decimals, zero_if_null
from revenuelake.functions.scores import fraud_band
from revenuelake.operators.skew import global_row_number
from revenuelake.session import materialize

LABEL = "is_fraud"
FITS_AT_ONCE = 9  # models in training: each keeps its own binned rows in the executors
MIN_SPLIT_ROWS = 20  # a node with fewer rows is not split: each side of a split holds at least half of that


def _class_counts(df: DataFrame) -> tuple[int, int]:
    """Rows with label 0 and 1, from one aggregated row."""
    row = df.agg(F.count_if(F.col(LABEL) == 0).alias("normal"), F.count_if(F.col(LABEL) == 1).alias("fraud")).first()
    return row["normal"], row["fraud"]


def balance_oversample(features: DataFrame, key: str = "taxpayer_id", seed: int = 42) -> DataFrame:
    """Normal rows and the fraud rows repeated to exactly half their number.

    Each fraud row is taken a whole number of times; the hash of its key decides who is taken once more. So the draw
    does not depend on how the table is stored.
    """
    normal, fraud = _class_counts(features)
    if not fraud:
        return features
    times, more = divmod(normal // 2, fraud)
    numbered = global_row_number(features.filter(F.col(LABEL) == 1), [F.xxhash64(F.lit(seed), key), F.col(key)], "_place")
    copies = F.lit(times) + (F.col("_place") <= more).cast("int")
    taken = numbered.withColumn("_copies", copies).filter("_copies > 0")
    repeated = taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return features.filter(F.col(LABEL) == 0).unionByName(repeated.select(*features.columns))


def class_ranks(features: DataFrame, key: str = "taxpayer_id", seed: int = 42) -> DataFrame:
    """``class_rank`` (from 1), a row's place within its class by the hash of its key, and ``class_rows``.

    All rows are numbered in one total order of class, hash and key, and each class starts at its own offset, so no
    task holds a class. The order depends on the keys alone.
    """
    ordered = global_row_number(features, [F.col(LABEL), F.xxhash64(F.lit(seed), key), F.col(key)], "_place")
    classes = ordered.groupBy(F.col(LABEL).alias("_class")).agg((F.min("_place") - 1).alias("_before"), F.count(F.lit(1)).alias("class_rows"))
    placed = ordered.join(F.broadcast(classes), F.col(LABEL).eqNullSafe(F.col("_class")))  # one row for each label
    return placed.withColumn("class_rank", F.col("_place") - F.col("_before")).drop("_place", "_class", "_before")


def split_and_fold(
    features: DataFrame, train_share: float = 0.8, folds: int = 5, key: str = "taxpayer_id", seed: int = 42
) -> DataFrame:
    """The rows with ``fold``: null for the test rows, else the number of the validation fold.

    Of each class exactly the rounded share is for training, and the class's rows of any two folds differ by at most one.
    """
    ranked = class_ranks(features, key, seed)
    trains = F.col("class_rank") <= F.floor(F.col("class_rows") * train_share + 0.5)
    return ranked.withColumn("fold", F.when(trains, F.pmod(F.col("class_rank") - 1, F.lit(folds)).cast("int"))).drop("class_rank", "class_rows")


def stratified_split(
    features: DataFrame, train_share: float = 0.8, key: str = "taxpayer_id", seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; each class is cut at exactly the rounded share."""
    cut = split_and_fold(features, train_share, 1, key, seed)
    return cut.filter(F.col("fold").isNotNull()).drop("fold"), cut.filter(F.col("fold").isNull()).drop("fold")


def split_class_counts(features: DataFrame) -> DataFrame:
    """Rows of each class in the test part (fold null) and in each fold of the training part."""
    return split_and_fold(features).groupBy(F.col(LABEL).cast("int").alias("label"), "fold").agg(F.count(F.lit(1)).alias("n_rows"))


def with_balanced_weights(features: DataFrame) -> DataFrame:
    """``weight`` = rows / (2 x rows of the class)."""
    normal, fraud = _class_counts(features)
    total = normal + fraud
    weight = F.when(F.col(LABEL) == 1, total / (2 * max(fraud, 1))).otherwise(total / (2 * max(normal, 1)))
    return features.withColumn("weight", weight)


def with_positive_weights(features: DataFrame) -> DataFrame:
    """``weight`` = normal rows per fraud row for fraud, 1 otherwise."""
    normal, fraud = _class_counts(features)
    return features.withColumn("weight", F.when(F.col(LABEL) == 1, normal / max(fraud, 1)).otherwise(1.0))


def _pipeline(columns: Sequence[str], classifier) -> Pipeline:
    assembler = VectorAssembler(inputCols=list(columns), outputCol="raw_features", handleInvalid="error")
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
    return Pipeline(stages=[assembler, scaler, classifier])


def random_forest(columns: Sequence[str], trees: int = 100, depth: int = 10, seed: int = 42) -> Pipeline:
    return _pipeline(
        columns,
        RandomForestClassifier(
            labelCol=LABEL, weightCol="weight", numTrees=trees, maxDepth=depth, minInstancesPerNode=MIN_SPLIT_ROWS // 2, seed=seed
        ),
    )


def gradient_boosting(columns: Sequence[str], trees: int = 100, depth: int = 3, seed: int = 42) -> Pipeline:
    return _pipeline(
        columns,
        GBTClassifier(labelCol=LABEL, weightCol="weight", maxIter=trees, maxDepth=depth, stepSize=0.1, seed=seed),
    )


def train_random_forest(features: DataFrame, columns: Sequence[str], trees: int = 100, depth: int = 10) -> PipelineModel:
    """Forest with balanced class weights."""
    return random_forest(columns, trees, depth).fit(with_balanced_weights(features))


def train_gradient_boosting(
    features: DataFrame, columns: Sequence[str], trees: int = 100, weighted: bool = False
) -> PipelineModel:
    """Boosted trees; ``weighted`` gives the fraud rows the weight of the imbalance."""
    data = with_positive_weights(features) if weighted else features.withColumn("weight", F.lit(1.0))
    return gradient_boosting(columns, trees).fit(data)


def with_probability(model: PipelineModel, features: DataFrame) -> DataFrame:
    scored = model.transform(features)
    return scored.withColumn("fraud_probability", vector_to_array("probability")[1])


def _report(predictions: DataFrame, name: str) -> DataFrame:
    """Precision, recall, F1 and support of both classes, from the counts of label x prediction."""
    counts = predictions.groupBy(F.col(LABEL).cast("int").alias("label"), F.col("prediction").cast("int").alias("predicted"))
    cells = counts.agg(F.count(F.lit(1)).alias("n"))

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    rows = []
    for label in (0, 1):
        truth, said = F.col("label") == label, F.col("predicted") == label
        precision = F.coalesce(ratio(total(truth & said), total(said)), F.lit(0.0))
        recall = F.coalesce(ratio(total(truth & said), total(truth)), F.lit(0.0))
        f1 = F.coalesce(ratio(2 * precision * recall, precision + recall), F.lit(0.0))
        rows.append(
            F.struct(
                F.lit(name).alias("model"), F.lit(label).alias("label"), precision.alias("precision"),
                recall.alias("recall"), f1.alias("f1"), total(truth).alias("support"),
            )
        )
    return cells.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def _check_folds(train: DataFrame, folds: int) -> None:
    """Every fold must have rows, and rows outside it."""
    sizes = {r["fold"]: r["count"] for r in train.groupBy("fold").count().collect()}  # one row for each fold
    for fold in range(folds):
        if not sum(sizes.values()) - sizes.get(fold, 0):
            raise ValueError(f"The training data at fold {fold} is empty.")
        if not sizes.get(fold):
            raise ValueError(f"The validation data at fold {fold} is empty.")


def split_evaluate_select(
    features: DataFrame, columns: Sequence[str], trees: int = 100, folds: int = 5, seed: int = 42
) -> tuple[PipelineModel, DataFrame]:
    """Train the candidates on 80 %, compare them on 20 % and return the best with the figures of all.

    The figures hold, per model and class, the hold-out AUC, the cross-validated AUC (mean, deviation) and
    precision, recall, F1 and support.
    """
    spark = features.sparkSession
    cut = materialize(split_and_fold(features, folds=folds, seed=seed), "split-features")
    train, test = cut.filter(F.col("fold").isNotNull()), cut.filter(F.col("fold").isNull()).drop("fold")
    auc = BinaryClassificationEvaluator(labelCol=LABEL, metricName="areaUnderROC")
    candidates = {
        "random_forest": (random_forest(columns, trees, seed=seed), with_balanced_weights),
        "gradient_boosting": (gradient_boosting(columns, trees, seed=seed), lambda df: df.withColumn("weight", F.lit(1.0))),
        "weighted_boosting": (gradient_boosting(columns, trees, seed=seed), with_positive_weights),
    }

    _check_folds(train, folds)
    weighted = {name: weigh(train) for name, (_, weigh) in candidates.items()}

    def fitted(task: tuple[str, int | None]) -> tuple[PipelineModel, float]:
        """The model of all training rows, or of all folds but one, and its AUC on the rows left out."""
        name, left_out = task
        rows, others = weighted[name], test
        if left_out is not None:
            rows, others = rows.filter(F.col("fold") != left_out), rows.filter(F.col("fold") == left_out)
        model = candidates[name][0].fit(rows)
        return model, float(auc.evaluate(model.transform(others)))

    # One fit is many short jobs in a row. All fits, of the folds as well, are independent, and share the cluster.
    tasks = [(name, left_out) for left_out in (None, *range(folds)) for name in candidates]
    with ThreadPool(min(FITS_AT_ONCE, len(tasks))) as pool:
        fits = dict(zip(tasks, pool.map(fitted, tasks, chunksize=1)))
    validated = []
    for name in candidates:
        areas = [fits[name, left_out][1] for left_out in range(folds)]
        validated.append((name, *fits[name, None], statistics.fmean(areas), statistics.pstdev(areas)))
    best = max(validated, key=lambda entry: entry[2])
    figures = [(name, score, mean, spread, name == best[0]) for name, _, score, mean, spread in validated]
    summary = spark.createDataFrame(
        figures, "model string, roc_auc double, cv_mean double, cv_std double, selected boolean"
    )
    report = None
    for name, model, *_ in validated:
        rows = _report(model.transform(test), name)
        report = rows if report is None else report.unionByName(rows)
    return best[1], summary.join(report, "model")


def feature_importance(model: PipelineModel, columns: Sequence[str], spark, top: int = 15) -> DataFrame:
    """The model's most important features; one row per feature column at most."""
    importances = model.stages[-1].featureImportances.toArray()
    ranked = sorted(zip(columns, importances.tolist()), key=lambda pair: (-pair[1], pair[0]))[:top]
    return spark.createDataFrame(ranked, "feature string, importance double")


def score_taxpayers(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Fraud probability and band; a probability of zero has no band."""
    return with_probability(model, features).select(
        "taxpayer_id", "fraud_probability", fraud_band(F.col("fraud_probability")).alias("fraud_risk_category")
    )


def ml_alerts(
    scores: DataFrame, taxpayers: DataFrame, paye_returns: DataFrame, vat_returns: DataFrame, as_of: dt.date,
    threshold: float = 0.7,
) -> DataFrame:
    """Alerts for probabilities above the threshold, naming the overdue returns of the last six months."""

    def overdue(returns: DataFrame, name: str) -> DataFrame:
        recent = (F.col("status") == "Overdue") & (F.col("due_date") >= F.lit(months_before(as_of, 6)))
        return returns.filter(recent).groupBy("taxpayer_id").agg(F.count("return_id").alias(name))

    probability = F.col("fraud_probability")
    risky = (
        scores.filter(probability > threshold)
        .join(taxpayers.select("taxpayer_id"), "taxpayer_id", "left_semi")
        .join(overdue(paye_returns, "missing_paye"), "taxpayer_id", "left")
        .join(overdue(vat_returns, "missing_vat"), "taxpayer_id", "left")
    )
    paye, vat = zero_if_null(F.col("missing_paye")), zero_if_null(F.col("missing_vat"))
    return risky.select(
        "taxpayer_id",
        F.lit(as_of).alias("alert_date"),
        F.lit(C.ML_ALERT_TYPE).alias("alert_type"),
        F.round(probability, 2).cast("decimal(3,2)").alias("risk_score"),
        join_text(
            "Fraud probability: ", two_decimals(probability * 100), "%. ",
            F.when(paye > 0, F.concat(paye.cast("string"), F.lit(" missing PAYE returns. "))),
            F.when(vat > 0, F.concat(vat.cast("string"), F.lit(" missing VAT returns. "))),
        ).alias("description"),
        F.lit("Open").alias("status"),
    )
