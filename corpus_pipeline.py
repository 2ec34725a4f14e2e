"""The corpus pipeline: from raw documents to token ids, one stage for each operator.

Each stage works on all rows that its predecessor kept. Models are fitted inside their stage, on the stage's own
input, and every stage but the last returns the columns of documents.

Defined results: a null text is an empty one, which has no known language and goes; rows with a null id or a null source take part;
of equal and nearly equal texts the least id stays (a null id after all others), with its own columns; rows that were
repeated are one row before the mixing repeats them; extra columns travel along as far as the mixing; without labels nothing
is toxic; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revenuelake.llm import bpe, jaccard_join, language, mixing, toxicity
from revenuelake.llm.common import hand_back_driver, table
from revenuelake.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity is nearer to a toxic grade than to none go."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_unidentified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go."""
    return language.keep_identified(docs, language.learn(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the least id."""
    return jaccard_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated so that sources reach their shares."""
    return mixing.mix(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and token ids of every document of the mixture, with the digest of the bytes that the ids decode to."""
    # A smaller dictionary than the operator's: the stages before leave less of the driver's memory.
    return bpe.encode(docs, dictionary_words=1 << 18, with_bytes=True).select("doc_id", "ids", F.sha2("bytes", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language ID", drop_unidentified),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("mixing sources", mix_sources),
    ("byte-level BPE", encode_texts),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.split()[0].lower()}")
        hand_back_driver(spark)  # the plans, models and literals of a finished stage
    return docs
