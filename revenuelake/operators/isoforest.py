"""Isolation forest (Liu, Ting and Zhou, 2008) as Spark jobs.

Each tree is grown by one task from a sample of at most 256 rows, drawn from all rows by hash. The trees form a small fixed-size model,
which scores all rows in Arrow batches where they lie.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from revenuelake.operators.insights import anomaly_reasons
from revenuelake.operators.skew import exact_quantile
from revenuelake.session import materialize

TREES = 100
SAMPLE_ROWS = 256
SAMPLE_ROWS_HELD = 2  # times its sample that a tree is offered, so that it is hardly ever short

_NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, path double"


def average_path(n: int) -> float:
    """Mean path length of an unsuccessful search among ``n`` points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (np.log(n - 1) + np.euler_gamma) - 2.0 * (n - 1) / n


def _grow(sample: np.ndarray, rng: np.random.Generator) -> list[tuple]:
    """Nodes (feature, threshold, left, right, path); a leaf points to itself."""
    limit = int(np.ceil(np.log2(max(len(sample), 2))))
    nodes: list[tuple] = []

    def split(rows: np.ndarray, depth: int) -> int:
        index = len(nodes)
        nodes.append(())
        spread = np.flatnonzero(rows.min(axis=0) < rows.max(axis=0)) if len(rows) > 1 else np.array([])
        if depth >= limit or len(spread) == 0:
            nodes[index] = (0, 0.0, index, index, depth + average_path(len(rows)))
            return index
        feature = int(rng.choice(spread))
        values = rows[:, feature]
        threshold = float(rng.uniform(values.min(), values.max()))
        below = values <= threshold
        left, right = split(rows[below], depth + 1), split(rows[~below], depth + 1)
        nodes[index] = (feature, threshold, left, right, 0.0)
        return index

    split(sample, 0)
    return nodes


def grow_trees(
    featured: DataFrame, columns: Sequence[str], key: str, rows: int, trees: int = TREES, seed: int = 42,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """One row per tree node. ``rows`` is the number of rows of ``featured``, all of which may be drawn.

    The hash of its key decides how many trees a row is offered to (none, for most rows of a large table) and which;
    a tree takes the ``sample_rows`` of its offers that another hash puts first. The draws depend on the key only,
    so a repeated task draws the same.
    """
    columns = list(columns)
    share = min(float(trees), trees * SAMPLE_ROWS_HELD * sample_rows / max(rows, 1))  # mean offers of one row
    uniform = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 40)) / F.lit(float(1 << 40))
    offers = (F.floor(F.lit(share)) + (uniform < share % 1.0).cast("int")).cast("int")
    first = F.pmod(F.xxhash64(F.lit(seed + 1), key), F.lit(trees)).cast("int")
    lot = F.xxhash64(F.lit(seed), "tree", key)
    draw = Window.partitionBy("tree").orderBy("lot", key)
    samples = (
        featured.select(key, *columns)
        .withColumn("offers", offers)
        .filter("offers > 0")
        .withColumn("place", F.explode(F.sequence(F.lit(0), F.col("offers") - 1)))
        .withColumn("tree", F.pmod(first + F.col("place"), F.lit(trees)))
        .withColumn("lot", lot)
        .withColumn("place", F.row_number().over(draw))
        .filter(F.col("place") <= sample_rows)
    )

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        ordered = pdf.sort_values("place")[columns].to_numpy(dtype=float)
        nodes = _grow(ordered, np.random.default_rng([seed, tree]))
        frame = pd.DataFrame(nodes, columns=["feature", "threshold", "left", "right", "path"])
        frame.insert(0, "node", range(len(frame)))
        frame.insert(0, "tree", tree)
        return frame

    return samples.groupBy("tree").applyInPandas(grow, _NODE_SCHEMA)


def isolation_scores(
    featured: DataFrame, columns: Sequence[str], key: str, trees: int = TREES, seed: int = 42,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Add ``anomaly_score`` in [-1, 0); the lower, the more anomalous."""
    columns = list(columns)
    rows = featured.count()
    # At most trees x (2 x sample_rows - 1) nodes whatever the size of the data, so the model may pass through the driver.
    nodes = grow_trees(featured, columns, key, rows, trees, seed, sample_rows).toPandas().sort_values(["tree", "node"])
    forest = [
        tuple(group[name].to_numpy() for name in ("feature", "threshold", "left", "right", "path"))
        for _, group in nodes.groupby("tree")
    ]
    norm = max(average_path(min(rows, sample_rows)), 1.0)
    shared = featured.sparkSession.sparkContext.broadcast((forest, norm))

    @F.pandas_udf(DoubleType())
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        model, mean_path = shared.value
        for batch in batches:
            given = batch if isinstance(batch, tuple) else (batch,)  # one column comes without a tuple
            rows = np.column_stack([series.to_numpy(dtype=float) for series in given])
            index = np.arange(len(rows))
            total = np.zeros(len(rows))
            for feature, threshold, left, right, path in model:
                at = np.zeros(len(rows), dtype=np.int64)
                while True:
                    below = rows[index, feature[at]] <= threshold[at]
                    step = np.where(below, left[at], right[at])
                    if np.array_equal(step, at):
                        break
                    at = step
                total += path[at]
            yield pd.Series(-np.power(2.0, -total / (max(len(model), 1) * mean_path)))

    return featured.withColumn("anomaly_score", score(*columns))


def isolation_forest_anomalies(
    featured: DataFrame,
    columns: Sequence[str],
    key: str = "transaction_id",
    contamination: float = 0.05,
    trees: int = TREES,
    seed: int = 42,
) -> DataFrame:
    """Score all rows and mark those below the exact contamination quantile of the scores.

    The scored rows are written once: the quantile and the comparison both read them.
    """
    scored = materialize(isolation_scores(featured, columns, key, trees, seed), "scored-transactions")
    limit = exact_quantile(scored, [], "anomaly_score", contamination, out="score_limit")
    marked = scored.crossJoin(F.broadcast(limit))  # one row
    return marked.withColumn("is_anomaly", F.col("anomaly_score") < F.col("score_limit")).drop("score_limit")


def anomalies_with_reasons(marked: DataFrame) -> DataFrame:
    return marked.filter("is_anomaly").withColumn("alert_reason", anomaly_reasons())
