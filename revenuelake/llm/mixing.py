"""Mixing sources to target weights by Poisson replication, with DataFrame functions only.

A source that should make up the share w of the mixture and holds n of N documents is repeated w N / n times on
average. Each document draws its own number of copies from the Poisson distribution with that mean: a hash of its
id and the seed is the uniform number whose inverse is taken. Documents are exploded by their counts, and the
copies are ordered by a hash over the whole mixture.

A mean above ``MAX_MEAN`` is split into equal parts with a draw each; sums of Poisson numbers are Poisson again.

Defined results: a null source is a source of its own; sources without a given weight get none and are left
out; without weights, the share of a source is proportional to its count to the power ``temperature``; a null id is
drawn by the text's hash; rows with the same id (or the same null-id text) draw the same number; an empty table
gives an empty mixture. Extra columns stay.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revenuelake.llm.common import shuffle_partitions, unit_hash
from revenuelake.session import materialize

SEED = 17
TEMPERATURE = 0.5
MAX_MEAN = 16.0
NO_SOURCE = "(none)"


def rates(docs: DataFrame, weights: Mapping[str, float] | None = None, temperature: float = TEMPERATURE) -> DataFrame:
    """One row for each source: source, documents and the mean number of copies of each document."""
    counts = docs.groupBy(_source().alias("_source")).agg(F.count(F.lit(1)).alias("_n"))
    if weights is None:
        weighted = counts.withColumn("_w", F.pow(F.col("_n").cast("double"), F.lit(temperature)))
    else:
        given = F.from_json(F.lit(json.dumps(dict(weights))), "map<string,double>")
        weighted = counts.withColumn("_w", F.coalesce(F.element_at(given, F.col("_source")), F.lit(0.0)))
    totals = weighted.agg(F.sum("_n").alias("_all"), F.sum("_w").alias("_sum"))  # one row
    return weighted.crossJoin(F.broadcast(totals)).select(
        "_source", "_n", F.when(F.col("_sum") > 0, F.col("_w") / F.col("_sum") * F.col("_all") / F.col("_n")).otherwise(0.0).alias("_rate")
    )


def _source() -> Column:
    return F.coalesce(F.col("source").cast("string"), F.lit(NO_SOURCE))


def inverse_poisson(u: Column, mean: Column) -> Column:
    """The least k whose cumulative probability reaches ``u``; the mean is at most MAX_MEAN.

    Probabilities below 1e-17 lie beyond the last step, so no number that a double can tell apart is cut off.
    """
    last = F.ceil(mean + 12 * F.sqrt(mean) + 24).cast("int")
    start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("sum"), F.lit(0).alias("k"))

    def step(s: Column, i: Column) -> Column:
        p = s["p"] * mean / i
        return F.struct(p.alias("p"), (s["sum"] + p).alias("sum"), F.when(s["sum"] < u, i).otherwise(s["k"]).alias("k"))

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda s: s["k"])


def copies(rate: Column, *identity: Column, seed: int = SEED) -> Column:
    """The number of copies of a document with the given mean."""
    parts = F.greatest(F.ceil(rate / MAX_MEAN), F.lit(1)).cast("int")
    mean = rate / parts
    drawn = F.transform(
        F.sequence(F.lit(1), parts), lambda part: inverse_poisson(unit_hash(*identity, part, seed=seed), mean)
    )
    return F.aggregate(drawn, F.lit(0), lambda total, k: total + k)


def replicate(
    docs: DataFrame, weights: Mapping[str, float] | None = None, seed: int = SEED, temperature: float = TEMPERATURE
) -> DataFrame:
    """The mixture: the whole document as struct ``doc``, copy (from 1), copies, rate and order; not yet shuffled.

    The rates are written first, so the planner knows their size: a short list is broadcast, a list beyond its
    threshold is joined by a shuffle that adaptive execution splits where a source is large.
    """
    few = materialize(rates(docs, weights, temperature).select("_source", "_rate"), "source-rates")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), _source().alias("_source"))
    text = F.coalesce(F.col("doc.text").cast("string"), F.lit(""))
    identity = F.coalesce(F.col("doc.doc_id").cast("string"), F.md5(text))
    drawn = packed.join(few, "_source").withColumn("copies", copies(F.col("_rate"), identity, seed=seed))
    copied = drawn.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    order = unit_hash(identity, F.col("copy"), seed=seed + 1)
    return copied.select("doc", "copy", "copies", F.col("_rate").alias("rate"), order.alias("order"))


def shuffled(mixture: DataFrame, partitions: int | None = None) -> DataFrame:
    """The rows dealt evenly by ``order`` and sorted by it: later partitions hold later rows."""
    return mixture.repartitionByRange(partitions or shuffle_partitions(mixture.sparkSession), "order", "copy").sortWithinPartitions("order", "copy")


def mix(docs: DataFrame, weights: Mapping[str, float] | None = None, seed: int = SEED) -> DataFrame:
    """The documents of the mixture in their global order, with their own columns."""
    return shuffled(replicate(docs, weights, seed)).select("doc.*")
