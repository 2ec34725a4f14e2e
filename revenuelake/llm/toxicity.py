"""Toxicity by ordinal regression with cumulative links.

Grades are ordered: 0 clean, 1 mild, 2 marked, 3 severe. P(grade >= k | x) = sigmoid(w.x - theta_k): all grades
share the weights ``w`` and differ in the ordered thresholds ``theta``. The score is the expected grade, the sum
of these probabilities.

The labels say toxic or not. The grade of a toxic text follows from how many places hold a *marker*, a word
that labelled texts use nearly only when toxic; a toxic text with few or none of them has grade 1.

The model is fitted on a bounded sample of labelled rows (``sample_rows``) and then applied to every text.

Defined results: a null or empty text has no features and gets the base rate; rows of ``labels`` with a null id
or label are left out; of several labels of one document the largest counts; equal texts count once in the
fit; without labelled rows of both kinds the severity is 0 everywhere. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revenuelake.llm.common import hand_back, sample_by_hash, tidy, whole_text
from revenuelake.session import materialize, ship_package

SAMPLE_ROWS = 20_000  # bound of the labelled rows that the fit sees
FEATURES = 256  # bound of the words that carry a weight
MIN_GAIN = 30.0  # least likelihood-ratio statistic of a word and the label
MARKER_SHARE = 0.5  # a marker's share of toxic texts
GRADE_STEPS = (2, 5)  # more marker places than these: grade 2, grade 3
REJECT_AT = 0.5  # expected grade from which a document is rejected
WORD = r"[^\W\d_]+"


@dataclass(frozen=True)
class OrdinalModel:
    vocabulary: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray  # ascending; one fewer than there are grades

    def at_least(self, counts: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ... of rows of word counts."""
        margin = np.log1p(counts) @ self.weights
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds[None, :] - margin[:, None], -60, 60)))


def count_words(text: str, vocabulary: dict[str, int]) -> np.ndarray:
    counts = np.zeros(len(vocabulary))
    for word, n in Counter(re.findall(WORD, text.lower())).items():
        at = vocabulary.get(word)
        if at is not None:
            counts[at] = n
    return counts


def fit_ordinal(x: np.ndarray, grade: np.ndarray, grades: int, l2: float = 1e-3, steps: int = 600) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds by gradient steps (Adam) on the penalised likelihood.

    P(grade = k) is a difference of neighbouring cumulative probabilities; the thresholds are a first value
    and exponentials of free gaps, so they stay ordered.
    """
    rows, width = x.shape
    shares = np.array([(grade >= k).mean() for k in range(1, grades)]).clip(1e-4, 1 - 1e-4)
    start = np.maximum.accumulate(np.log(1 / shares - 1) + 1e-3 * np.arange(grades - 1))
    free = np.concatenate([np.zeros(width), start[:1], np.log(np.diff(start) + 1e-3)])
    first, second = np.zeros_like(free), np.zeros_like(free)
    for step in range(1, steps + 1):
        w, gaps = free[:width], np.exp(free[width + 1 :])
        theta = free[width] + np.concatenate([[0.0], np.cumsum(gaps)])
        upper = 1.0 / (1.0 + np.exp(np.clip(theta[None, :] - (x @ w)[:, None], -60, 60)))  # P(grade >= k)
        edges = np.concatenate([np.ones((rows, 1)), upper, np.zeros((rows, 1))], axis=1)
        at = np.arange(rows)
        low, high = edges[at, grade], edges[at, grade + 1]
        mass = np.maximum(low - high, 1e-12)
        d_low, d_high = low * (1 - low) / mass, high * (1 - high) / mass
        d_margin = d_low - d_high  # of the log likelihood
        d_theta = np.zeros((rows, grades + 1))
        d_theta[at, grade] -= d_low
        d_theta[at, grade + 1] += d_high
        d_theta = d_theta[:, 1:grades].sum(axis=0)
        tail = np.cumsum(d_theta[::-1])[::-1]
        slope = np.concatenate([x.T @ d_margin / rows - l2 * w, tail[:1] / rows, tail[1:] * gaps / rows])
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        free = free + 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return free[:width], free[width] + np.concatenate([[0.0], np.cumsum(np.exp(free[width + 1 :]))])


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Distinct texts with their label (0 or 1) for about ``rows`` labelled documents."""
    one_each = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    )
    drawn = F.broadcast(sample_by_hash(one_each, "doc_id", rows))  # bounded by ``rows``
    texts = docs.select("doc_id", whole_text().alias("text")).join(drawn, "doc_id")
    return texts.groupBy("text").agg(F.max("toxic").alias("toxic"))


def informative_words(sample: DataFrame, features: int = FEATURES, min_gain: float = MIN_GAIN) -> DataFrame:
    """Words whose presence depends on the label: word, toxic and clean texts with it, likelihood ratio."""
    totals = sample.agg(F.count(F.lit(1)).alias("_n"), F.sum("toxic").alias("_t"))  # one row
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))
    counted = (
        sample.select("toxic", F.explode(words).alias("word"))
        .groupBy("word")
        .agg(F.sum("toxic").alias("with_toxic"), F.sum(1 - F.col("toxic")).alias("with_clean"))
        .crossJoin(F.broadcast(totals))
    )

    def part(seen: Column, row: Column, column: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen * F.col("_n") / (row * column))).otherwise(0.0)

    a, b = F.col("with_toxic").cast("double"), F.col("with_clean").cast("double")
    t, c = F.col("_t").cast("double"), (F.col("_n") - F.col("_t")).cast("double")
    without = F.col("_n") - a - b
    gain = 2 * (part(a, a + b, t) + part(b, a + b, c) + part(t - a, without, t) + part(c - b, without, c))
    return (
        counted.withColumn("gain", gain)
        .where(F.col("gain") >= min_gain)
        .orderBy(F.desc("gain"), "word")
        .limit(features)
        .select("word", "with_toxic", "with_clean", "gain")
    )


def train(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, features: int = FEATURES,
    steps: Sequence[int] = GRADE_STEPS,
) -> OrdinalModel:
    """Fit on the bounded sample; at most ``sample_rows`` short count vectors and ``features`` words reach the driver."""
    ship_package(docs.sparkSession)
    sample = materialize(labelled_sample(docs, labels, sample_rows), "toxicity-sample")
    chosen = informative_words(sample, features).collect()
    vocabulary = {row["word"]: at for at, row in enumerate(chosen)}
    none = OrdinalModel({}, np.zeros(0), np.full(len(steps) + 1, 60.0))
    if not vocabulary:
        return none

    def counted(batches):
        for batch in batches:
            counts = [count_words(t, vocabulary) for t in batch["text"]]
            places = [np.flatnonzero(c) for c in counts]
            yield pd.DataFrame({"toxic": batch["toxic"], "places": places, "n": [c[p] for c, p in zip(counts, places)]})

    # Only the words that occur travel; one dense array of the sample's bounded size is filled from them.
    rows = sample.mapInPandas(tidy(counted), "toxic int, places array<int>, n array<double>").toArrow().combine_chunks()
    if not rows.num_rows:
        return none
    toxic, places = rows.column("toxic").to_numpy(), rows.column("places").chunk(0)
    counts = np.zeros((rows.num_rows, len(vocabulary)))
    row = np.repeat(np.arange(rows.num_rows), np.diff(places.offsets.to_numpy()))
    counts[row, places.values.to_numpy()] = rows.column("n").chunk(0).values.to_numpy()
    order = np.lexsort((*counts.T[:8], toxic))  # the fit does not depend on the order of arrival
    counts, toxic = counts[order], toxic[order]
    if toxic.min() == toxic.max():
        return none
    marker = [at for at, r in enumerate(chosen) if r["with_toxic"] >= MARKER_SHARE * (r["with_toxic"] + r["with_clean"])]
    places = counts[:, marker].sum(axis=1)
    grade = np.where(toxic > 0, 1 + sum((places > s).astype(int) for s in steps), 0)
    weights, thresholds = fit_ordinal(np.log1p(counts, out=counts), grade, len(steps) + 2)
    return OrdinalModel(vocabulary, weights, thresholds)


def severity(model: OrdinalModel, text: Column) -> Column:
    """Struct of the expected grade, the most likely grade and P(grade >= 1) of a text column."""

    @F.pandas_udf("severity double, grade int, p_toxic double")
    def graded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            counts = [count_words(t or "", model.vocabulary) for t in texts]
            upper = model.at_least(np.array(counts).reshape(len(counts), len(model.vocabulary)))
            edges = np.concatenate([np.ones((len(upper), 1)), upper, np.zeros((len(upper), 1))], axis=1)
            likely = (edges[:, :-1] - edges[:, 1:]).argmax(axis=1)
            yield pd.DataFrame({"severity": upper.sum(axis=1), "grade": likely.astype("int32"), "p_toxic": upper[:, 0]})
        hand_back()

    return graded(text)


def grade_documents(docs: DataFrame, model: OrdinalModel, reject_at: float = REJECT_AT) -> DataFrame:
    """doc_id, severity, grade, p_toxic and whether the document is rejected; one row for each document."""
    ship_package(docs.sparkSession)
    scored = docs.select("doc_id", severity(model, whole_text()).alias("_s"))
    return scored.select("doc_id", "_s.severity", "_s.grade", "_s.p_toxic", (F.col("_s.severity") >= reject_at).alias("rejected"))


def keep_clean(docs: DataFrame, model: OrdinalModel, reject_at: float = REJECT_AT) -> DataFrame:
    """The documents whose expected grade stays below ``reject_at``, with their own columns."""
    ship_package(docs.sparkSession)
    return docs.where(severity(model, whole_text())["severity"] < reject_at)
