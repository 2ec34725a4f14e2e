"""The corpus pipeline, stage by stage, against plain Python over the same rows."""

import hashlib
import math
import re

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from revenuelake.llm import bpe, language, mixing, toxicity

DATA = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("doc", "rid", "copy", "order", "_source", "ids", "severity", "score", "bytes", "toxic", "places")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows = duckdb.connect().execute(f"SELECT doc_id, text, lang, source, n_chars FROM '{DATA}/documents.parquet'").fetchall()
    some = next(r[1] for r in rows if r[2] == "en" and len(r[1]) > 400)
    rows += [
        (9001, None, "en", "src0", None), (9002, "", "en", None, 0), (9003, some, "en", None, 0), (9003, some, "en", None, 0),
        (None, some + " end", "en", "src0", 0), (None, "Ganz ohne Nummer, aber mit Text und Inhalt.", "de", None, 0), (9004, some * 40, "en", "src1", 0),
        (9005, "Жду утра " * 30, None, "src0", 0), (9006, "1234 5678", "en", "src0", 0),
    ]
    unkind = [(8000 + i, r[1] + " vrazkill grobhate" * (1 + i % 6), r[2], r[3], 0) for i, r in enumerate(rows[:90]) if r[1]]
    rows += unkind
    path = tmp_path_factory.mktemp("pipeline")
    docs = spark.createDataFrame(rows, DOCS).select("*", *[F.lit("x").alias(c) for c in CLASHING])
    docs.write.parquet(f"{path}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    more = spark.createDataFrame([(r[0], 1, 1) for r in unkind], "doc_id long, quality int, toxic int")
    labels.unionByName(more).write.parquet(f"{path}/labels.parquet")
    return str(path)


def key(row):
    return tuple((v is None, str(v)) for v in row)


def words(text):
    return re.findall(r"\w+", text.lower())


def grams(text):
    said = words(text)
    return {tuple(said[i : i + 5]) for i in range(max(len(said) - 4, 1))} if said else text


def alike(a, b):
    if isinstance(a, str) or isinstance(b, str):
        return a == b
    return len(a & b) >= 0.8 * len(a | b)


def one_of_each(rows):
    """The row of least id (null last) of every group that links of at least 0.8 tie together."""
    sets = [grams(r["text"] or "") for r in rows]
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if alike(sets[i], sets[j]):
                group[top(i)] = top(j)
    groups = {}
    for i, row in enumerate(rows):
        groups.setdefault(top(i), []).append(row)
    return [min(g, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0)) for g in groups.values()]


def unit(seed, *values):
    digest = hashlib.md5("|".join([str(seed), *map(str, values)]).encode()).hexdigest()
    return int(digest[:13], 16) / 2**52


def poisson_copies(identity, rate):
    parts = max(math.ceil(rate / mixing.MAX_MEAN), 1)
    total = 0
    for part in range(1, parts + 1):
        u, mean, k = unit(mixing.SEED, identity, part), rate / parts, 0
        p = reached = math.exp(-mean)
        while reached < u and k < 500:
            k += 1
            p *= mean / k
            reached += p
        total += k
    return total


def test_every_stage_equals_its_plain_version(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    given = [r.asDict() for r in docs.collect()]

    model = toxicity.train(docs, labels)

    def severity(text):
        counts = np.zeros(len(model.vocabulary))
        for word in re.findall(toxicity.WORD, (text or "").lower()):
            if word in model.vocabulary:
                counts[model.vocabulary[word]] += 1
        margin = float(np.log1p(counts) @ model.weights) if len(counts) else 0.0
        return sum(1 / (1 + math.exp(min(max(t - margin, -60), 60))) for t in model.thresholds)

    clean = [r for r in given if severity(r["text"]) < toxicity.REJECT_AT]
    assert 0 < len(clean) < len(given)
    kept = corpus_pipeline.drop_toxic(spark, docs, folder)
    assert sorted(map(key, kept.collect())) == sorted(key(r.values()) for r in clean)
    assert kept.columns == docs.columns

    prototypes = language.learn(kept)
    known = [r for r in clean if prototypes.predict([r["text"] or ""])[1][0] >= language.MIN_SCORE]
    stayed = corpus_pipeline.drop_unidentified(spark, kept, folder)
    assert sorted(map(key, stayed.collect())) == sorted(key(r.values()) for r in known)
    assert not {9001, 9002, 9006} & {r["doc_id"] for r in known}

    single = one_of_each(known)
    rest = corpus_pipeline.drop_near_duplicates(spark, stayed, folder)
    assert sorted(map(key, rest.collect())) == sorted(key(r.values()) for r in single)
    assert len(single) < len(known) and rest.columns == docs.columns

    counts = {}
    for r in single:
        counts[r["source"]] = counts.get(r["source"], 0) + 1
    share = {s: math.sqrt(n) for s, n in counts.items()}
    rate = {s: share[s] / sum(share.values()) * len(single) / n for s, n in counts.items()}
    mixture = []
    for r in single:
        identity = r["doc_id"] if r["doc_id"] is not None else hashlib.md5((r["text"] or "").encode()).hexdigest()
        mixture += [r] * poisson_copies(identity, rate[r["source"]])
    mixed = corpus_pipeline.mix_sources(spark, rest, folder)
    assert sorted(map(key, mixed.collect())) == sorted(key(r.values()) for r in mixture)

    ranks = bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY))
    encoding = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = [(r["doc_id"], encoding.encode_ordinary(r["text"]), hashlib.sha256(r["text"].encode()).hexdigest()) for r in mixture]
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == ["doc_id", "ids", "decoded_sha256"]
    assert sorted(map(key, got.collect())) == sorted(map(key, want))


def test_no_documents(spark, folder, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
