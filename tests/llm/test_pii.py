"""Personal data: base spans against the plain patterns, found spans on planted and on clean texts."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from revenuelake.llm import pii
from revenuelake.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes_luhn(digits):
    doubled = {0: 0, 1: 2, 2: 4, 3: 6, 4: 8, 5: 1, 6: 3, 7: 5, 8: 7, 9: 9}
    return sum(doubled[int(d)] if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def plain_spans(text):
    found = []
    for kind, pattern in enumerate(PATTERNS.values()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            valid = (
                True,
                kind == 1 and all(int(p) <= 255 for p in m.group().split(".")),
                12 <= len(digits) <= 19 and passes_luhn(digits),
                9 <= len(digits) <= 15,
            )
            if valid[kind]:
                found.append((kind, m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], s[0]))


def test_base_spans_equal_those_of_the_patterns():
    rng = random.Random(2)
    pieces = ["a", "Z", ".", "@", "-", "+", "1", "25", "007", "300", "4716", "+1", " ", "(", ")", "é", "\n", "%", "٣", "9", "12345678"]
    for _ in range(20_000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 30)))
        assert pii.base_spans(text) == plain_spans(text), text


@pytest.mark.parametrize("unit", ["x", "1", "1.", "+", "+1", "@", "a@", "1 ", "(", "0-", "a.", ":"])
def test_long_texts_take_linear_time(unit):
    text = unit * (200_000 // len(unit))
    pii.base_spans(text)
    pii.candidates(text)


def test_trees_learn_and_thresholds_are_calibrated():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 6))
    truth = ((x[:, 0] > 0) & (x[:, 1] < 0.5) | (x[:, 2] > 1.5)).astype(float)
    trees = pii.boost(x[:3000], truth[:3000])
    margin = trees.margin(x[3000:])
    assert ((margin > 0) == truth[3000:]).mean() > 0.97
    limit = pii.threshold(margin, truth[3000:].astype(int), 0.9)
    assert truth[3000:][margin >= limit].mean() >= 0.9
    assert pii.threshold(np.array([0.1, 0.2]), np.array([0, 0])) == float("inf")
    assert pii.threshold(np.array([0.1, 0.2, 0.3, 0.4]), np.array([0, 1, 1, 1])) == 0.2


def test_best_candidates_do_not_overlap():
    base = [(0, 10, 20)]
    chosen = pii.select(base, [(1.0, (3, 15, 30)), (2.0, (2, 20, 36)), (3.0, (3, 30, 40)), (3.0, (2, 28, 40))])
    assert chosen == [((2, 28, 40), 3.0)]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def model(documents):
    return pii.train(documents)


def test_fit_does_not_depend_on_order(documents, model):
    again = pii.train(documents.orderBy(F.desc("doc_id")).repartition(5))
    assert again.thresholds == model.thresholds
    assert all(np.array_equal(a, b) for a, b in ((again.trees.at, model.trees.at), (again.trees.bound, model.trees.bound), (again.trees.leaf, model.trees.leaf)))


def test_planted_data_is_found_and_lookalikes_are_left(spark, model):
    # Texts that the fit has not seen; each planted piece is a document of its own.
    rows = duckdb.connect().execute(f"SELECT doc_id, text FROM '{DATA}/documents.parquet' WHERE length(text) > 0").fetchall()
    pieces = {i: pii.planted_piece(text + " ") for i, text in rows}
    docs = spark.createDataFrame([(i, p[0], None, None, 0) for i, p in pieces.items()], DOCS)
    found = {r["doc_id"]: {(pii.KINDS.index(s["kind"]), s["start"], s["end"]) for s in r["spans"]} for r in pii.find_personal_data(docs, model).collect()}
    true = sum(len(p[1]) for p in pieces.values())
    hit = sum(len(found[i] & p[1]) for i, p in pieces.items())
    base = sum(len(set(plain_spans(p[0])) & p[1]) for p in pieces.values())
    print(f"planted {true}, found {hit}, base alone {base}")
    assert hit / true > 0.85 and hit > 1.3 * base
    wrong = [
        (i, s) for i, p in pieces.items() for s in found[i] - p[1] - set(plain_spans(p[0])) if any(a < s[2] and s[1] < b for a, b in p[2])
    ]
    assert len(wrong) < 0.02 * true


def test_clean_documents_are_left_alone(spark, model):
    clean = [
        "Version 2.0 of the Apache License, January 2004", "In 1998 2001 2004 2010 and 2012-2014 we met.", "The total was 1,299.00 of 12 345 678.",
        "ISBN 978-3-16-148410-0, page 112 of 340", "see section 1.2.3 and 4.5.6", "at 10:45:00 on 2021-03-04", 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"',
        "meet me at noon dot dot dot", "std::vector<int> a; x @ y", "no numbers here",
    ]
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in enumerate(clean)], DOCS)
    assert [(r["doc_id"], r["spans"]) for r in pii.find_personal_data(docs, model).collect() if r["spans"]] == []


def test_merged_numbers_are_taken_apart(spark, model):
    text = "pay 173 4716190207394368 or call +1 (171) 555-2028 4716190207394368 now"
    assert [k for k, *_ in plain_spans(text)] == []
    docs = spark.createDataFrame([(1, text, None, None, 0)], DOCS)
    row = pii.find_personal_data(docs, model).first()
    assert [(s["kind"], text[s["start"] : s["end"]], s["base"]) for s in row["spans"]] == [
        ("card", "4716190207394368", False), ("phone", "+1 (171) 555-2028", False), ("card", "4716190207394368", False),
    ]
    assert row["redacted"] == "pay 173 [CARD] or call [PHONE] [CARD] now"


def test_redaction_joins_overlapping_spans():
    assert pii.redacted("abcdefgh", [(1, 1, 4), (2, 2, 6)]) == "a[IP/CARD]gh"
    assert pii.redacted("abc", []) == "abc"


def test_digests_of_odd_documents(spark, model):
    texts = [
        (None, "mail a.b@c.de"), (1, None), (2, ""), (3, "é 10.0.0.1 \U0001f600 a@b.co"), (3, "é 10.0.0.1 \U0001f600 a@b.co"), (4, "x" * 300_000),
        (5, "4716 1902 0739 4368, 10.0.0.256, +12 3"), (6, "+1 (017) 555-7713"), (7, "a@b.c.@d.e"),
    ]
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in texts], DOCS)
    docs = docs.select("*", *[F.lit("x").alias(n) for n in ("spans", "kind", "start", "base", "redacted", "n_email")])
    got = sorted((tuple(r) for r in pii.digests(pii.find_personal_data(docs, model, with_text=False)).collect()), key=str)

    def expected(doc_id, text):
        spans = plain_spans(text or "")
        told = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in spans)
        return (doc_id, *[sum(k == kind for k, *_ in spans) for kind in range(4)], hashlib.sha256(told.encode()).hexdigest(), told)

    assert got == sorted((expected(i, t) for i, t in texts), key=str)


def test_query_keeps_every_base_span(spark):
    rows = dict(duckdb.connect().execute(f"SELECT doc_id, text FROM '{DATA}/documents.parquet'").fetchall())
    got = {r["doc_id"]: r for r in QUERIES["op12_personal_data"](spark, DATA).collect()}
    assert got.keys() == rows.keys()
    for i, text in rows.items():
        told = [f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in plain_spans(text or "")]
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(told).encode()).hexdigest()
        assert set(told) <= set(got[i]["spans"].split(","))


def test_no_documents(spark):
    empty = spark.createDataFrame([], DOCS)
    model = pii.train(empty)
    assert model.trees is None
    assert pii.digests(pii.find_personal_data(empty, model)).count() == 0
    docs = spark.createDataFrame([(1, "a@b.co 173 4716190207394368", None, None, 0)], DOCS)
    assert pii.digests(pii.find_personal_data(docs, model)).first()["spans"] == "email:0:6"
