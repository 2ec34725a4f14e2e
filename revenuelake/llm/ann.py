"""Approximate nearest neighbours by an adaptive dimension scan.

Nearness is the largest inner product. Vectors get one more component, sqrt(M^2 - |x|^2) with M the largest norm,
and queries a 0: the order by distance is then the order by inner product. All are rotated at random, so that any
leading columns tell about the whole distance, and belong to the list of their nearest centre. A query probes
the lists of its nearest centres: as many as hold ``RECALL`` of the true neighbours of a bounded sample of the
queries (``MEASURED``), found by brute force over all rows, with two standard errors to spare. On vectors without
clusters that is most of the lists, and the savings are left to the dimension scan. Within a list the columns are scanned in blocks: after each, a candidate whose
partial distance, scaled up by the share of columns seen, is larger than the distance to beat by more than chance
allows (``EPSILON``) is abandoned. Queries of a task are scanned together. What is left is scored exactly on the original vectors.

The centres are fitted on a bounded sample (``FIT_ROWS``); every row is in the index. Lists are cut into pieces of
``PIECE_ROWS`` rows and their queries into ``PIECE_QUERIES``, so a list with a third of all rows is many tasks,
and each task returns at most k rows for each of its queries.

Defined results: vectors that are null, of another length than most, zero or with null or non-finite components
take no part, neither do rows with a null id; equal scores are ordered by id; rows that repeat an id are
candidates of their own, but a query never finds its own id, and asks once; with fewer than k candidates all are
found. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from revenuelake.llm.common import sample_by_hash
from revenuelake.session import materialize, ship_package

K = 20
FIT_ROWS = 20_000
ROWS_PER_LIST = 256  # lists grow with the sample, up to FIT_ROWS / 16
RECALL = 0.95  # of the true neighbours, in the probed lists
MEASURED = 256  # queries whose true neighbours are found by brute force
COLUMNS = 16  # scanned at once
EPSILON = 2.1
PIECE_ROWS = 4096
PIECE_QUERIES = 4096
PAIRS = 1 << 20  # of a query and a candidate, compared at once
FEW = 1 / 16  # of them left: cheaper to follow one by one
SEED = 5


@dataclass(frozen=True)
class Index:
    rotation: np.ndarray  # (d + 1) x (d + 1), orthogonal
    centres: np.ndarray  # rotated
    norm: float  # the largest norm M

    def lift(self, vectors: np.ndarray) -> np.ndarray:
        """Rotated candidates with the component that makes all norms equal."""
        rest = np.sqrt(np.maximum(self.norm**2 - (vectors**2).sum(axis=1), 0.0))
        return np.hstack([vectors, rest[:, None]]) @ self.rotation

    def lift_queries(self, queries: np.ndarray) -> np.ndarray:
        """Queries are scaled to norm M, which keeps their order of candidates, and rotated alike."""
        unit = queries * (self.norm / np.linalg.norm(queries, axis=1))[:, None]
        return np.hstack([unit, np.zeros((len(queries), 1))]) @ self.rotation


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2 * a @ b.T, 0.0)


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id and vec (array of doubles) of the rows that take part."""
    typed = embeddings.where(F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec")
    )
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    sound = typed.where(F.coalesce(finite, F.lit(False)) & F.exists("vec", lambda x: x != 0))
    lengths = sound.groupBy(F.size("vec").alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    common = lengths.orderBy(F.desc("_n"), "_d").limit(1).select("_d").first()
    return sound.where(F.size("vec") == (common["_d"] if common else 0))


def fit(vectors: DataFrame, rows: int = FIT_ROWS, rows_per_list: int = ROWS_PER_LIST, rounds: int = 8) -> Index | None:
    """Rotation, largest norm (over all rows) and centres (k-means on about ``rows`` rows)."""
    norm = vectors.agg(F.max(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)))).first()[0]
    if norm is None:
        return None
    drawn = sample_by_hash(vectors, "vec_id", rows).toPandas().sort_values("vec_id")
    if drawn.empty:  # a small share of very few ids
        drawn = vectors.limit(1).toPandas()
    points = np.unique(np.stack(drawn["vec"].to_numpy()), axis=0)  # copies of one vector would draw centres together
    rng = np.random.Generator(np.random.PCG64(SEED))
    width = points.shape[1] + 1
    rotation = np.linalg.qr(rng.standard_normal((width, width)))[0]
    index = Index(rotation, np.zeros((0, width)), float(norm) * (1 + 1e-12))
    lifted = index.lift(points)
    lists = max(1, int(round(len(points) / rows_per_list)))
    centres = lifted[rng.choice(len(lifted), lists, replace=False)]
    for _ in range(rounds):
        nearest = distances(lifted, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, lifted)
        counts = np.bincount(nearest, minlength=lists)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return Index(rotation, centres, index.norm)


def assign(vectors: DataFrame, index: Index) -> DataFrame:
    """vec_id, vec and the list of every candidate."""
    def near(batches):
        for batch in batches:
            if len(batch):
                lifted = index.lift(np.stack(batch["vec"].to_numpy()))
                batch["list"] = distances(lifted, index.centres).argmin(axis=1).astype("int32")
                yield batch[["vec_id", "vec", "list"]]

    return vectors.mapInPandas(near, "vec_id long, vec array<double>, list int")


def nearest_lists(listed: DataFrame, ids: np.ndarray, queries: np.ndarray, k: int) -> pd.DataFrame:
    """query_id and list of the true ``k`` nearest rows of a few queries, by brute force over all rows.

    Order among equal scores is left open: copies of a vector are in one list.
    """

    def kept(best: pd.DataFrame) -> pd.DataFrame:
        return best.sort_values("score", ascending=False).groupby("query_id").head(k)

    def best(batches):
        held = None  # k rows for each query and task
        for batch in batches:
            if not len(batch):
                continue
            score = queries @ np.stack(batch["vec"].to_numpy()).T
            score[ids[:, None] == batch["vec_id"].to_numpy()[None, :]] = -np.inf
            n = min(k, len(batch))
            top = np.argpartition(-score, n - 1, axis=1)[:, :n]
            found = pd.DataFrame(
                {
                    "query_id": np.repeat(ids, n), "score": np.take_along_axis(score, top, axis=1).ravel(),
                    "list": batch["list"].to_numpy()[top].ravel(),
                }
            )
            found = found[np.isfinite(found["score"])]
            held = kept(found if held is None else pd.concat([held, found]))
        if held is not None:
            yield held

    per_task = listed.select("vec_id", "vec", "list").mapInPandas(best, "query_id long, score double, list int")
    first = Window.partitionBy("query_id").orderBy(F.desc("score"), "list")
    return per_task.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= k).select("query_id", "list").toPandas()


def measured_probes(listed: DataFrame, asked: DataFrame, index: Index, k: int, recall: float = RECALL) -> int:
    """How many lists to probe, so that those hold ``recall`` of the true neighbours: measured on a sample of queries."""
    lists = len(index.centres)
    drawn = sample_by_hash(asked, "query_id", MEASURED).toPandas().sort_values("query_id") if lists > 1 else None
    if drawn is None or drawn.empty:
        return lists
    ids, queries = drawn["query_id"].to_numpy(), np.stack(drawn["vec"].to_numpy())
    true = nearest_lists(listed, ids, queries, k)
    place = distances(index.lift_queries(queries), index.centres).argsort(axis=1, kind="stable").argsort(axis=1)
    row = np.searchsorted(ids, true["query_id"].to_numpy())
    hits = np.zeros((len(ids), lists))
    np.add.at(hits, (row, place[row, true["list"].to_numpy()]), 1)
    hits = hits[hits.sum(axis=1) > 0]
    if not len(hits):
        return lists
    share = hits.cumsum(axis=1) / hits.sum(axis=1)[:, None]
    sure = share.mean(axis=0) - 2 * share.std(axis=0) / np.sqrt(len(share))
    return int(np.argmax(sure >= recall - 1e-12)) + 1  # all lists hold every neighbour


def probe(queries: DataFrame, index: Index, sizes: np.ndarray, probes: int, k: int) -> DataFrame:
    """query_id, vec and the lists to scan: the nearest ``probes``, and more until they hold 4 k rows."""

    def nearest(batches):
        for batch in batches:
            if not len(batch):
                continue
            order = distances(index.lift_queries(np.stack(batch["vec"].to_numpy())), index.centres).argsort(axis=1, kind="stable")
            enough = np.cumsum(sizes[order], axis=1)
            take = np.maximum(probes, (enough < 4 * k + 1).sum(axis=1) + 1)
            batch["lists"] = [row[:n].astype("int32").tolist() for row, n in zip(order, take)]
            yield batch

    return queries.mapInPandas(nearest, "query_id long, vec array<double>, lists array<int>").select(
        "query_id", "vec", F.explode("lists").alias("list")
    )


def best_of(rows: np.ndarray, columns: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores of each row, ties to the smaller id, row by row."""
    order = np.lexsort((ids[columns], -scores, rows))
    sorted_rows = rows[order]
    return order[np.arange(len(order)) - np.searchsorted(sorted_rows, sorted_rows) < k]


def inner_products(a: np.ndarray, b: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Of row ``rows[i]`` of ``a`` and row ``columns[i]`` of ``b``; equal vectors give equal products."""
    parts = (slice(at, at + PAIRS // 16) for at in range(0, len(rows), PAIRS // 16))
    return np.concatenate([np.zeros(0), *[np.einsum("ij,ij->i", a[rows[part]], b[columns[part]]) for part in parts]])


def scan(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, index: Index, k: int) -> pd.DataFrame:
    """The k nearest candidates of each query within one piece of a list, by partial distances.

    Queries are scanned together, as many as make ``PAIRS`` pairs. While many pairs are left, a block of columns is one
    product of matrices; once fewer than ``FEW`` of them are, the pairs are followed one by one.
    """
    lifted, asked = index.lift(vectors), index.lift_queries(queries)
    width = lifted.shape[1]
    ends = list(range(COLUMNS, width, COLUMNS)) + [width]
    blocks = [(b, np.ascontiguousarray(lifted[:, a:b]), np.ascontiguousarray(asked[:, a:b])) for a, b in zip([0, *ends[:-1]], ends)]
    first = min(len(ids), 4 * k)
    best = distances(asked, lifted[:first])
    best[query_ids[:, None] == ids[None, :first]] = np.inf
    # The distance to beat: the k-th of the first candidates, infinite if there are fewer.
    beat = np.partition(best, k - 1, axis=1)[:, k - 1] if first >= k else np.full(len(asked), np.inf)
    # Hypothesis: the candidate is nearer than the bound. Rejected if its scaled partial distance is too large. What rounding
    # can add to a distance is allowed on top.
    limits = {b: beat * ((1 + EPSILON / np.sqrt(b)) ** 2 if b < width else 1 + 1e-9) * (b / width) + 1e-12 * index.norm**2 for b in ends}
    out = []
    step = max(1, PAIRS // max(1, len(ids)))
    for at in range(0, len(asked), step):
        some = slice(at, at + step)
        alive = query_ids[some, None] != ids[None, :]
        partial = np.zeros(alive.shape)
        pairs = None
        for b, block, wanted in blocks:
            if pairs is None:
                partial += distances(wanted[some], block)
                alive &= partial <= limits[b][some, None]
                if b == width or np.count_nonzero(alive) < FEW * alive.size:
                    rows, columns = pairs = np.nonzero(alive)
                    followed = partial[pairs]
            else:
                followed = followed + ((block[columns] - wanted[at + rows]) ** 2).sum(axis=1)
                stays = followed <= limits[b][at + rows]
                rows, columns, followed = rows[stays], columns[stays], followed[stays]
        if len(rows) > 2 * k * len(alive):  # products of matrices leave out what is far from the k best
            score = np.full(alive.shape, -np.inf)
            score[rows, columns] = (queries[some] @ vectors.T)[rows, columns]
            least = -np.partition(-score, k - 1, axis=1)[:, k - 1] if len(ids) >= k else np.full(len(score), -np.inf)
            least -= 1e-12 * index.norm * np.linalg.norm(queries[some], axis=1)
            stays = score[rows, columns] >= least[rows]
            rows, columns = rows[stays], columns[stays]
        score = inner_products(queries[some], vectors, rows, columns)
        top = best_of(rows, columns, score, ids, k)
        out.append((query_ids[at + rows[top]], ids[columns[top]], score[top]))
    found = [np.concatenate(parts) for parts in zip(*out)] or [[], [], []]
    return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), found)))


def search(embeddings: DataFrame, every: int = 20, k: int = K, probes: int | None = None) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest rows found for each row whose id ``every`` divides.

    Without ``probes``, their number is measured.
    """
    spark = embeddings.sparkSession
    ship_package(spark)
    result = "query_id long, rank int, vec_id long, score double"
    vectors = usable(embeddings)
    index = fit(vectors)
    if index is None:
        return spark.createDataFrame([], result)
    listed = materialize(assign(vectors, index), "ann-lists")
    counts = {r["list"]: r["count"] for r in listed.groupBy("list").count().collect()}  # one row for each list
    sizes = np.array([counts.get(i, 0) for i in range(len(index.centres))])
    asked = vectors.where(F.col("vec_id") % every == 0).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vec").alias("vec"))
    if probes is None:
        probes = measured_probes(listed, asked, index, k)
    probed = probe(asked, index, sizes, min(probes, len(sizes)), k)
    pieces = F.lit([max(1, -(-int(n) // PIECE_ROWS)) for n in sizes])
    at = F.get(pieces, F.col("list"))
    rows = listed.withColumn("piece", F.pmod(F.xxhash64("vec_id"), at).cast("int"))
    n_queries = asked.count()
    shares = max(1, -(-n_queries // PIECE_QUERIES))
    share = F.pmod(F.xxhash64("query_id"), F.lit(shares)).cast("int")
    wanted = probed.withColumn("share", share).withColumn("piece", F.explode(F.sequence(F.lit(0), at - 1)))
    held = rows.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))

    def scanned(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return scan(
            np.stack(left["vec"].to_numpy()), left["query_id"].to_numpy(), np.stack(right["vec"].to_numpy()),
            right["vec_id"].to_numpy(), index, k,
        )

    keys = ["list", "piece", "share"]
    found = wanted.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(scanned, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")  # at most k rows from each piece
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
