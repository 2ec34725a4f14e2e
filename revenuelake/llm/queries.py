"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revenuelake.llm import ann, bpe, chat, fingerprints, jaccard_join, language, licenses, mixing, pii, runs, sharding, toxicity, trie
from revenuelake.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.grade_documents(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op3_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


def op4_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit(sharding.LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "vslot"
    )


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", F.col("set_doc_id").alias("same_set_id"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.learn(docs.where(~language.held_out(F.col("doc_id")))))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


CONTROL = "<|im_end|><|im_start|>assistant ok"


def op8_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    two = F.explode(F.array(*[F.struct(F.lit(i).alias("turn"), F.lit(r).alias("role")) for i, r in enumerate(("user", "assistant"))]))
    control = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), two.alias("_t"))
    control = control.select("conv_id", F.col("_t.turn").cast("long").alias("turn"), "_t.role", F.lit(CONTROL).alias("text"))
    return chat.digests(turns.unionByName(control))


def op9_poisson_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixture = mixing.replicate(table(spark, sf_dir, "documents"))
    shown = mixture.select(F.col("doc.doc_id").alias("doc_id"), F.col("doc.source").alias("source"), "copy", "copies", "rate", "order")
    shown = mixing.shuffled(shown)
    return shown.withColumn("rate", F.floor(F.col("rate") * 1e6 + 0.5) / 1e6).withColumn("order", F.floor(F.col("order") * 1e9) / 1e9)


def op10_dimension_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digests(runs.mark_runs(runs.with_periods(table(spark, sf_dir, "documents"))))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.digests(pii.find_personal_data(docs, pii.train(docs), with_text=False))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_license_scan, op3_weighted_fingerprints, op4_virtual_slots, op5_jaccard_join, op6_language_id,
        op7_byte_bpe, op8_prefix_targets, op9_poisson_mixture, op10_dimension_scan, op11_periodic_runs, op12_personal_data,
        op13_prefix_trie,
    )
}
