"""N-gram Jaccard join by MinHash banding.

Texts are sets of word five-grams. Texts with the same set are one class and go on as one representative. Band and
row counts follow from the recall wanted at the threshold. Representatives meet in the buckets of their band hashes,
and each meeting is verified on the full sets, recomputed from the texts.

Buckets with the same members are one bucket, the one of the lowest band. A pair is counted in the bucket of the
first band on which it agrees, so once. Buckets are cut into blocks of ``BLOCK`` members and each pair of blocks is
a task of its own, in which sparse products give all intersections. A task returns one row for each member: its
number of links and one neighbour of its own component within the task. So rows grow with members, never with
pairs, and no link is lost. Components join through alternating rounds of ``connected`` in Spark.

Defined results: a text of fewer than five words is one n-gram, all of them; texts without words are alike only
if they are equal; null is an empty text. Rows with a null id take part, and a class whose members all have null
ids has a null id. Repeated rows are members of the same class. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revenuelake.llm.common import hand_back, tidy, whole_text
from revenuelake.session import materialize, ship_package

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.999
ROWS = 6
BLOCK = 512
SIEVE_CELLS = 1 << 20
SEED = 11
_WORD = re.compile(r"\w+")


def bands_for(threshold: float = THRESHOLD, recall: float = RECALL, rows: int = ROWS) -> int:
    """The least number of bands of ``rows`` rows that finds a pair at the threshold with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


def shingles(text: str, n: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams of a text."""
    words = _WORD.findall(text.lower())
    if not words:
        return np.zeros(0, np.uint64)
    codes: dict[str, int] = {}
    for w in words:
        if w not in codes:
            codes[w] = int.from_bytes(blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
    at = np.array([codes[w] for w in words], dtype=np.uint64)
    n = min(n, len(at))
    mixed = np.full(len(at) - n + 1, n, dtype=np.uint64)
    for i in range(n):  # order matters: each step mixes before the next word comes in
        mixed = (mixed ^ at[i : len(at) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def signature(grams: np.ndarray, bands: int, rows: int, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each band of minima."""
    least = np.full(bands * rows, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(grams), 4096):
        part = grams[at : at + 4096]
        mixed = factors[:, None] * part[None, :] + offsets[:, None]
        least = np.minimum(least, (mixed ^ (mixed >> np.uint64(32))).min(axis=1))
    out = np.arange(1, bands + 1, dtype=np.uint64)
    for row in least.reshape(bands, rows).T:
        out = (out ^ row) * np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return out


def _row_id() -> Column:
    """Tells rows apart by id and text; repeated rows share it."""
    return F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.hex(F.xxhash64(whole_text())))


def sketches(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """rid, doc_id, the digest of the n-gram set and the band hashes of every document."""
    rng = np.random.Generator(np.random.PCG64(SEED))
    factors = rng.integers(0, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    offsets = rng.integers(0, 2**63, bands * rows, dtype=np.uint64)

    def sketched(batches):
        for batch in batches:
            sets, marks = [], []
            for text in batch["text"]:
                grams = shingles(text)
                content = grams.tobytes() if len(grams) else b"text:" + text.encode("utf-8", "surrogatepass")
                sets.append(blake2b(content, digest_size=16).hexdigest())
                marks.append(signature(grams, bands, rows, factors, offsets).view(np.int64) if len(grams) else np.zeros(0, np.int64))
            yield pd.DataFrame({"rid": batch["rid"], "doc_id": batch["doc_id"].astype("Int64"), "set_id": sets, "bands": marks})

    return docs.select(_row_id().alias("rid"), F.col("doc_id"), whole_text().alias("text")).mapInPandas(
        tidy(sketched), "rid string, doc_id long, set_id string, bands array<long>"
    )


def verify(grams: list[np.ndarray], marks: np.ndarray, band: int, split: np.ndarray | None, threshold: float) -> list[tuple[int, int]]:
    """Pairs (i, j) of one task with Jaccard similarity of at least ``threshold`` that agree first on ``band``.

    With ``split``, only pairs between the two blocks it tells apart.
    """
    every, column = np.unique(np.concatenate(grams), return_inverse=True)
    lengths = np.array([len(g) for g in grams])
    row = np.repeat(np.arange(len(grams)), lengths)
    shared = np.bincount(column, minlength=len(every)) > 1
    row, column = row[shared[column]], (np.cumsum(shared) - 1)[column[shared[column]]]
    common = np.zeros((len(grams), len(grams)), dtype=np.float32)
    width = 4096
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for start in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [start, start + width])
        held = np.zeros((len(grams), width), dtype=np.float32)
        held[row[a:b], column[a:b] - start] = 1
        common += held @ held.T
    union = lengths[:, None] + lengths[None, :] - common
    near = np.triu(common >= threshold * union - 1e-6, 1)
    if split is not None:
        near &= split[:, None] != split[None, :]
    i, j = np.nonzero(near)
    first = (marks[i] == marks[j]).argmax(axis=1) if len(i) else np.zeros(0, int)
    agree = first == band
    return list(zip(i[agree].tolist(), j[agree].tolist()))


def roots(n: int, pairs: list[tuple[int, int]]) -> list[int]:
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def links(docs: DataFrame, classes: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """rid, links and root for each member of each task; ``classes`` has rid and bands, one row for each set."""
    spread = classes.select("rid", F.posexplode("bands").alias("band", "hash"))
    # Members are not gathered: their number and 128 bits of their hashes tell member lists apart.
    buckets = spread.groupBy("band", "hash").agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("rid")).alias("s1"),
        F.bit_xor(F.xxhash64(F.lit(1), "rid")).alias("s2"),
    )
    kept = buckets.where("n > 1").groupBy("n", "s1", "s2").agg(F.min(F.struct("band", "hash")).alias("b")).select("b.band", "b.hash", "n")
    blocks = F.ceil(F.col("n") / block).cast("int")
    mine = F.pmod(F.xxhash64("rid"), blocks).cast("int")
    members = spread.join(kept, ["band", "hash"]).withColumn("mine", mine)
    other = F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / block).cast("int") - 1))
    tasks = members.withColumn("other", other).select(
        "rid", "band", "hash", "mine", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high")
    )
    tasks = materialize(tasks, "jaccard-tasks")
    wanted = tasks.select("rid").distinct()
    # A sieve of a fixed number of cells keeps most texts that are not wanted out of the shuffle.
    cell = F.pmod(F.xxhash64("rid"), F.lit(SIEVE_CELLS)).cast("int").alias("cell")
    sieve = F.broadcast(wanted.select(cell).distinct())
    texts = docs.select(_row_id().alias("rid"), whole_text().alias("text")).select("*", cell)
    texts = texts.join(sieve, "cell", "left_semi").drop("cell").join(wanted, "rid", "left_semi")
    full = texts.groupBy("rid").agg(F.max("text").alias("text")).join(classes, "rid")
    ready = tasks.join(full, "rid")

    def judged(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("rid", ignore_index=True)
        low, high = int(group["low"][0]), int(group["high"][0])
        grams = [shingles(t) for t in group["text"]]
        marks = np.stack(group["bands"].to_numpy())
        split = group["mine"].to_numpy() if low != high else None
        pairs = verify(grams, marks, int(group["band"][0]), split, threshold)
        n = np.bincount(np.array(pairs, dtype=int).reshape(-1), minlength=len(group))
        root = roots(len(group), pairs)
        found = pd.DataFrame({"rid": group["rid"], "links": n, "root": group["rid"].to_numpy()[root]})[n > 0]
        if len(group) > BLOCK // 2:
            del group, grams, marks
            hand_back()
        return found

    return ready.groupBy("band", "hash", "low", "high").applyInPandas(judged, "rid string, links long, root string")


def connected(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """rid and component for every node of ``edges`` (a, b); the component is its least node.

    Alternates two steps until nothing changes: every node ties its larger neighbours to its least one, then its
    smaller neighbours. Edges are written after each round, which cuts the lineage.
    """
    current = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    for _ in range(rounds):
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        tied = large.join(small_least, "a")
        small = tied.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(tied.select("a", F.col("m").alias("b")))
        current = materialize(small.where("a <> b").distinct(), "links")
        digest = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if digest == state:
            return current.select(F.col("a").alias("rid"), F.col("b").alias("component")).unionByName(
                current.select(F.col("b").alias("rid"), F.col("b").alias("component")).distinct()
            )
        state = digest
    raise RuntimeError("components did not settle")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, rows: int = ROWS) -> DataFrame:
    """One row for each document: rid, doc_id, class_id, set_doc_id, n_links and rid_kept.

    class_id is the least doc_id of the documents tied by links or equal sets, set_doc_id that of equal sets,
    n_links the number of other sets with a similarity of at least ``threshold``, rid_kept the row that stands
    for its class.
    """
    ship_package(docs.sparkSession)
    marked = materialize(sketches(docs, bands_for(threshold, recall, rows), rows), "jaccard-sketches")
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "rid")
    sets = marked.groupBy("set_id").agg(F.min(order).alias("least"), F.max("bands").alias("bands"))
    sets = materialize(sets.select("set_id", "least.rid", "least.doc_id", "bands"), "jaccard-sets")
    found = materialize(links(docs, sets.where(F.size("bands") > 0).select("rid", "bands"), threshold), "jaccard-links")
    counts = found.groupBy("rid").agg(F.sum("links").alias("n_links"))
    parts = connected(found.select(F.col("rid").alias("a"), F.col("root").alias("b")))
    placed = (
        sets.join(counts, "rid", "left")
        .join(parts, "rid", "left")
        .select("set_id", "rid", "doc_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "rid").alias("component"))
    )
    stands = placed.groupBy("component").agg(F.min(order).alias("k"))
    classes = placed.join(stands, "component").select(
        "set_id", F.col("doc_id").alias("set_doc_id"), "n_links", F.col("k.doc_id").alias("class_id"), F.col("k.rid").alias("rid_kept")
    )
    return marked.select("rid", "doc_id", "set_id").join(classes, "set_id").select(
        "rid", "doc_id", "class_id", "set_doc_id", "n_links", "rid_kept"
    )


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class, that of the least id; columns as they come."""
    kept = near_duplicates(docs, threshold).where("rid = rid_kept").select(F.col("rid").alias("rid")).distinct()
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), _row_id().alias("rid"))
    one = packed.join(kept, "rid", "left_semi").groupBy("rid").agg(F.min("doc").alias("doc"))  # of rows with the same id and text the least
    return one.select("doc.*")
