"""Each operator against a brute-force version, and its defined results for nulls, ties, repeats and empty tables."""

import base64
import collections
import hashlib
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import functions as F

from revenuelake.llm import ann, bpe, chat, fingerprints, jaccard_join, language, licenses, mixing, sharding, toxicity
from revenuelake.llm.oracles import ORACLES
from revenuelake.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside.
CLASHING = (
    "k", "h", "rid", "term", "word", "band", "list", "vslot", "shard", "score", "doc", "copy", "order", "_source", "cell", "severity", "a", "b",
)
ODD = [
    (None, "a text without an id"), (1, None), (2, ""), (3, "same text here"), (4, "same text here"), (4, "same text here"),
    (5, "word " * 6000), (6, "!!! ... ---"), (7, "Été Übung ñandú \U0001f600 中文"), (8, "x" * 3000), (9, None), (None, None),
]


@pytest.fixture(scope="module")
def documents(spark):
    """Documents from texts: (doc_id, text) or (doc_id, text, lang, source) each."""

    def build(*rows):
        full = [(*r, *(None, None)[: 4 - len(r)], len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return build


@pytest.fixture(scope="module")
def clashing():
    """The same rows with extra columns."""
    return lambda df: df.select("*", *[F.lit("x").alias(n) for n in CLASHING])


@pytest.fixture(scope="module")
def texts():
    rows = duckdb.connect().execute(f"SELECT doc_id, text, lang, source FROM '{DATA}/documents.parquet' ORDER BY 1").fetchall()
    return rows


@pytest.fixture(scope="module")
def odd(documents, clashing):
    return clashing(documents(*ODD))


@pytest.fixture(scope="module")
def none(documents, clashing):
    return clashing(documents((1, "x"))).limit(0)


def by_id(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}


# --- toxicity -----------------------------------------------------------------------------------


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_ordinal_fit_orders_grades():
    rng = np.random.default_rng(0)
    x = rng.poisson(1.0, (3000, 2)).astype(float)
    margin = 2.0 * np.log1p(x[:, 0]) + rng.logistic(size=3000)
    grade = (margin > 1).astype(int) + (margin > 3)
    weights, thresholds = toxicity.fit_ordinal(np.log1p(x), grade, 3)
    assert abs(weights[0] - 2) < 0.3 and abs(weights[1]) < 0.2
    assert np.all(np.diff(thresholds) > 0) and np.allclose(thresholds, [1, 3], atol=0.3)


def test_toxicity_learns_and_rejects(spark, documents):
    rng = np.random.default_rng(1)
    plain = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(8) for j in range(8)]
    rows, marks = [], []
    for i in range(600):
        words = list(rng.choice(plain, 30))
        toxic = i % 5 == 0
        for _ in range(1 + i % 7 if toxic else 0):
            words.insert(int(rng.integers(0, 30)), "nasty" if rng.random() < 0.5 else "vile")
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(toxic)))
    docs = documents(*rows)
    model = toxicity.train(docs, labels_of(spark, marks))
    assert set(model.vocabulary) == {"nasty", "vile"} and np.all(np.diff(model.thresholds) > 0)
    got = by_id(toxicity.grade_documents(docs, model))
    assert all(got[i]["rejected"] == (i % 5 == 0) for i in range(600))
    severe, mild = got[20], got[35]  # seven places and one
    assert severe["severity"] > mild["severity"] and severe["grade"] >= mild["grade"]
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and kept.count() == 480


def test_toxicity_odd_rows(spark, odd, none):
    model = toxicity.train(odd, labels_of(spark, [(3, 1, 1), (3, 1, 0), (None, 0, 1), (1, 1, None)]))
    got = toxicity.grade_documents(odd, model)
    assert got.count() == len(ODD) and got.where("rejected").count() == 0
    assert toxicity.keep_clean(odd, model).columns == odd.columns
    assert toxicity.grade_documents(none, toxicity.train(none, labels_of(spark, []))).count() == 0


# --- licences -----------------------------------------------------------------------------------


def plain_scan(text):
    table = {i: i + 32 for i in range(65, 91)}
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(table))
    hits = []
    for phrase, label in licenses.BASE.items():
        part = phrase.split()
        hits += [(k, label) for k in range(len(words)) if words[k : k + len(part)] == part]
    at = [k for k, _ in hits]
    return len(words), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))


def test_license_scan(spark, documents, texts, odd, none):
    hard = [
        (1, "CC BY, cc-by; CC\nBY 4.0 and (all)rights reserved? All Rights  Reserved"),
        (2, "general public licensed / GENERAL PUBLIC LICENSE é cc by"),
        (3, "ccby cc byx xcc by cc by"),
    ]
    for docs, rows in ((documents(*hard), hard), (documents(*[t[:2] for t in texts]), texts)):
        got = by_id(licenses.scan_licenses(docs))
        for i, text, *_ in rows:
            r = got[i]
            assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == plain_scan(text)
            assert 0 <= r["score"] <= 1 and set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""}
    assert licenses.scan_licenses(odd).count() == len(ODD) and licenses.scan_licenses(none).count() == 0


@pytest.mark.parametrize(
    ("expression", "score", "names"),
    [
        ("MIT", 0.1, {"mit"}),
        ("MIT OR GPL-3.0-only", 0.1, {"mit", "gpl"}),
        ("MIT AND GPL-3.0-only", 0.7, {"mit", "gpl"}),
        ("MIT OR Apache-2.0 AND GPL-2.0+", 0.1, {"mit", "apache", "gpl"}),
        ("(MIT OR Apache-2.0) AND GPL-2.0+", 0.7, {"mit", "apache", "gpl"}),
        ("GPL-2.0 WITH Classpath-exception-2.0", 0.49, {"gpl"}),
        ("LGPL-2.1 AND (CC-BY-4.0 OR CC-BY-NC-4.0)", 0.5, {"lgpl", "cc-by", "cc-by-nc"}),
    ],
)
def test_license_expressions(expression, score, names):
    value, found = licenses.evaluate(expression)
    assert value == pytest.approx(score) and found == names


def test_malformed_expressions():
    for bad in ("MIT OR", "(MIT", "MIT)", "AND MIT", "MIT Apache", "()"):
        with pytest.raises(licenses.ExpressionError):
            licenses.evaluate(bad)
    row = dict(zip(licenses.COLUMNS, licenses.scan_text("// SPDX-License-Identifier: MIT OR\nx\n# SPDX-License-Identifier: Apache-2.0")))
    assert row["labels"] == "apache,expression-error,mit" and row["n_expressions"] == 2


@pytest.mark.parametrize(
    ("line", "labels"),
    [
        ("MIT and this file is part of the project", "mit"),
        ("MIT OR Apache-2.0 or whatever you like", "apache,mit"),
        ("(MIT OR GPL-2.0-only) AND the rest of the line", "gpl,mit"),
        ("(MIT OR GPL-2.0-only", "expression-error"),
        ("(MIT OR Apache-2.0) AND (GPL-3.0", "apache,expression-error,mit"),
        ("GPL-2.0-only WITH Classpath-exception-2.0 */", "gpl"),
        ("GPL-2.0-only WITH Linux-syscall-note", "gpl"),
        ("GPL-2.0-only with thanks to all", "gpl"),
        ("DocumentRef-x:LicenseRef-y", "licenseref"),
        ("LicenseRef-own AND MIT", "licenseref,mit"),
        ("MIT. See the file for more.", "mit"),
        ("GPL-3.0-or-later OR MPL-1.1+", "gpl,mpl"),
        ("CC-BY-NC-SA-4.0", "cc-by,cc-by-nc,cc-by-nc-sa"),
        ("mit-style terms", "expression-error"),
        ("a file of prose", "expression-error"),
        ("BSD-3-Clause MIT", "bsd"),
        ("MIT)", "mit"),
        ("", ""),
    ],
)
def test_labels_after_tags_are_identifiers(line, labels):
    row = dict(zip(licenses.COLUMNS, licenses.scan_text(f"x\n# SPDX-License-Identifier: {line}\nnext line of text")))
    assert row["labels"] == labels


def test_no_label_outside_known_names(texts):
    known = set(licenses.STRICTNESS) | {"expression-error", ""} | set(licenses.BASE.values())
    rng = np.random.default_rng(11)
    words = sorted({w for _, t, *_ in texts[:50] for w in t.split()}) + ["MIT", "OR", "AND", "WITH", "(", ")", "GPL-2.0", "Apache-2.0", "LicenseRef-a"]
    weights = np.ones(len(words))
    weights[-9:] = len(words) / 3
    for _ in range(2000):
        line = " ".join(rng.choice(words, int(rng.integers(0, 12)), p=weights / weights.sum()))
        row = dict(zip(licenses.COLUMNS, licenses.scan_text(f"SPDX-License-Identifier: {line}")))
        assert set(row["labels"].split(",")) <= known and 0 <= row["score"] <= 1


# --- fingerprints -------------------------------------------------------------------------------


def test_fingerprint_edits(documents, texts, odd, none):
    got = by_id(fingerprints.fingerprint_edits(documents(*[t[:2] for t in texts])))
    prints = collections.defaultdict(set)
    for at, (i, text, *_) in enumerate(texts):
        cut, after = len(text) // 4, texts[(at + 1) % len(texts)][1]
        edited = text[: len(text) - cut] + after[:cut]
        assert (got[i]["n_chars"], got[i]["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        prints[text].add(got[i]["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())
    rows = list(got.values())
    assert np.mean([r["near_edited"] for r in rows]) > 0.5 > 0.1 > np.mean([r["near_next"] for r in rows])
    odd_rows = fingerprints.fingerprint_edits(odd).collect()
    assert len(odd_rows) == len(ODD) and all(r["fingerprint"] and 0 <= r["near_next"] <= 1 for r in odd_rows)
    assert fingerprints.fingerprint_edits(none).count() == 0


def test_fingerprints_count_words(spark, documents):
    pairs = [("b a, b B c", "b b d a a"), ("...", "..."), ("", "x"), ("word " * 300, "word"), ("É1 é1", "é1 É1"), ("\x01", ""), ("ab a", "abc ab a")]
    made = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, text string, edited string")
    made = fingerprints.weighted_terms(made, ["i"]).collect()
    got = collections.defaultdict(dict)
    for r in made:
        for side in range(2):
            if r["sides"] >> side & 1:
                assert (r["word"], side) not in got[r["i"]]
                got[r["i"]][r["word"], side] = r["n"]
    for i, pair in enumerate(pairs):
        want = {}
        for side, text in enumerate(pair):
            counts = collections.Counter(re.findall(r"[^\W_]+", text.lower()) or [text])
            want |= {(w, side): n for w, n in counts.items()}
        assert got[i] == want
    assert sorted((r["word"], r["sides"]) for r in made if r["i"] == 0) == [("a", 1), ("a", 2), ("b", 1), ("b", 2), ("c", 1), ("d", 2)]
    assert sorted((r["word"], r["sides"]) for r in made if r["i"] == 6) == [("a", 3), ("ab", 3), ("abc", 2)]

    rows = [(1, "one two three four " + "five " * 400), (2, "one two three four five"), (3, "five four three two one")]
    prints = by_id(fingerprints.fingerprint_edits(documents(*rows)))
    assert prints[1]["near_next"] < 0.5 and prints[1]["fingerprint"] != prints[2]["fingerprint"]
    assert prints[2]["near_next"] == 1 and prints[2]["fingerprint"] == prints[3]["fingerprint"]


def test_collisions_follow_generalised_jaccard(spark):
    rng = np.random.default_rng(3)
    pairs = []
    for pair in range(60):
        for term in range(40):
            a, b = (float(x) for x in rng.integers(0, 5, 2))
            if a == b and a > 0:
                pairs.append((pair, term + 1000 * pair, a, 3))
            else:
                pairs += [(pair, term + 1000 * pair, w, s) for w, s in ((a, 1), (b, 2)) if w > 0]
    weights = collections.defaultdict(lambda: [0.0, 0.0])
    for pair, term, w, sides in pairs:
        for side in range(2):
            if sides >> side & 1:
                weights[pair, term][side] += w
    low, high = (sum(f(w) for w in weights.values()) for f in (min, max))
    made = fingerprints.signatures(spark.createDataFrame(pairs, "k long, term long, weight double, sides int"), ["k"])
    share = made.agg(F.avg(fingerprints.likeness(F.col("text"), F.col("edited")))).first()[0]
    assert share == pytest.approx(low / high, abs=0.04)


# --- sharding -----------------------------------------------------------------------------------


def test_sharding(spark, documents, texts, odd, none, tmp_path):
    path = str(tmp_path / "map")
    docs = documents(*[t[:2] for t in texts])
    got = sharding.shard_documents(docs, shards=5, map_path=path).toPandas()
    want = {i: (len(t.encode()) + 16, zlib.crc32(t.encode())) for i, t, *_ in texts}
    assert {i: (s, c) for i, s, c in zip(got["doc_id"], got["size"], got["text_crc32"])} == want
    loads = got.groupby("shard")["size"].sum()
    assert len(loads) == 5 and loads.max() - loads.min() <= max(s for s, _ in want.values())
    assert all(sorted(g) == list(range(len(g))) for _, g in got.groupby("shard")["slot"])

    rows, first = sharding.records(docs), sharding.load_map(spark, path)
    sizes = sharding.slot_bytes(rows)
    sharding.store_map(sharding.rebalance(first, sizes, 6), path)
    second = sharding.load_map(spark, path)
    old, new = by_id(first, "vslot"), by_id(second, "vslot")
    assert len(new) == sharding.SLOTS and {r["version"] for r in new.values()} == {2}
    moved = [s for s in new if new[s]["shard"] != old[s]["shard"]]
    assert {new[s]["shard"] for s in moved} >= {5} and len(moved) < 0.4 * len(new)
    bigger = sharding.place(rows, second).groupBy("shard").agg(F.sum("size").alias("n")).toPandas()["n"]
    assert len(bigger) == 6 and bigger.max() < 1.3 * bigger.mean()
    fewer = by_id(sharding.rebalance(second, sizes, 4), "vslot")
    assert {r["shard"] for r in fewer.values()} == set(range(4))

    assert sharding.shard_documents(odd).count() == len(ODD) and sharding.shard_documents(none).count() == 0


def test_a_map_path_is_used_again(spark, documents, tmp_path):
    path = str(tmp_path / "map")
    docs = documents(*[(i, f"text {i} " * (1 + i % 7)) for i in range(200)])
    first = by_id(sharding.shard_documents(docs, shards=4, map_path=path))
    more = docs.unionByName(documents(*[(i, "another text " * 9) for i in range(200, 260)]))
    again = sharding.shard_documents(more, shards=4, map_path=path)
    second = by_id(again)
    assert (len(first), again.count(), sharding.latest_version(spark, path)) == (200, 260, 2)
    assert {r["vslot"] for i, r in second.items() if i < 200} == {r["vslot"] for r in first.values()}
    stored = spark.read.parquet(path).groupBy("version").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("vslot").alias("d")).collect()
    assert {(r["version"], r["n"], r["d"]) for r in stored} == {(v, sharding.SLOTS, sharding.SLOTS) for v in (1, 2)}
    with pytest.raises(ValueError):
        sharding.store_map(sharding.load_map(spark, path, 1), path)
    assert sharding.latest_version(spark, str(tmp_path / "none")) == 0


# --- near copies --------------------------------------------------------------------------------


def brute_classes(rows):
    sets = {}
    for i, text in rows:
        words = re.findall(r"\w+", text.lower())
        sets[i] = frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset([text])
    first = {}
    for i in sorted(sets):
        first.setdefault(sets[i], i)
    parent, links, kinds = {i: i for i in first.values()}, collections.Counter(), list(first)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, one in enumerate(kinds):
        for two in kinds[:a]:
            if len(one & two) >= 0.8 * len(one | two):
                links.update((first[one], first[two]))
                x, y = find(first[one]), find(first[two])
                parent[max(x, y)] = min(x, y)
    return {i: (find(first[s]), first[s], links[first[s]]) for i, s in sets.items()}


def near_rows(seed=4, groups=6, size=25, words=80):
    """Groups of near copies: each a few edits away from a common text, besides exact copies and strangers."""
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        base = [f"w{g}x{k}" for k in range(words)]
        for m in range(size):
            text = list(base)
            for at in rng.choice(words, int(rng.integers(0, 3)), replace=False):
                text[at] = f"e{rng.integers(0, 3)}"
            rows.append((len(rows), " ".join(text)))
    return rows + [(len(rows) + k, f"alone {k} " * 5) for k in range(10)]


@pytest.mark.parametrize("block", [512, 8])
def test_near_duplicates(documents, monkeypatch, block):
    monkeypatch.setattr(jaccard_join.links, "__defaults__", (block,))
    rows = near_rows()
    got = by_id(jaccard_join.near_duplicates(documents(*rows)))
    assert {i: (r["class_id"], r["set_doc_id"], r["n_links"]) for i, r in got.items()} == brute_classes(rows)


def test_near_duplicates_keep_one(documents, odd, none):
    rows = near_rows(seed=5, groups=3)
    kept = jaccard_join.keep_one(documents(*rows))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for c, *_ in brute_classes(rows).values()})
    odd_classes = jaccard_join.near_duplicates(odd)
    assert odd_classes.count() == len(ODD)
    left = jaccard_join.keep_one(odd)
    assert left.columns == odd.columns
    # null and empty texts are one class, and so are the three rows of the same text
    assert left.count() == len({t or "" for _, t in ODD})
    assert jaccard_join.near_duplicates(none).count() == 0 and jaccard_join.keep_one(none).count() == 0


def test_band_count_reaches_recall():
    b = jaccard_join.bands_for(0.8, 0.999, 6)
    assert 1 - (1 - 0.8**6) ** b >= 0.999 > 1 - (1 - 0.8**6) ** (b - 1)


# --- language -----------------------------------------------------------------------------------


def test_language(documents, texts, odd, none):
    docs = documents(*texts)
    learned = language.learn(docs.where(~language.held_out(F.col("doc_id"))))
    got = by_id(language.identify(docs, learned))
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    unseen = [(i, lang) for i, _, lang, _ in texts if got[i]["held_out"]]
    assert np.mean([got[i]["lang_pred"] == lang for i, lang in unseen]) > 0.95
    found = language.identify(odd, learned).collect()
    assert len(found) == len(ODD) and all(0 <= r["score"] <= 1 for r in found)
    assert {r["lang_pred"] for r in found if r["doc_id"] in (1, 2, 6, 9)} == {language.UNDETERMINED}
    kept = language.keep_identified(odd, learned)
    assert kept.columns == odd.columns and not {1, 2, 6, 9} & {r["doc_id"] for r in kept.collect()}
    nothing = language.learn(none)
    assert {r["lang_pred"] for r in language.identify(odd, nothing).collect()} == {language.UNDETERMINED}


def test_unlearned_texts_go_and_short_clean_ones_stay(documents, texts):
    rng = np.random.default_rng(9)
    learned = language.learn(documents(*texts))
    letters = ("абвгдежзийклмнопрстуфхцчшщыэюя", "αβγδεζηθικλμνξοπρστυφχψω", "אבגדהוזחטיכלמנסעפצקרשת")
    strange = [" ".join("".join(rng.choice(list(a), 6)) for _ in range(n)) for a in letters for n in (1, 3, 30) for _ in range(40)]
    strange += [" ".join("".join(rng.choice(list("bcdfghjklmnpqrstvwxz"), 8)) for _ in range(40)) for _ in range(40)]
    short = [" ".join(text.split()[:12]) for _, text, lang, _ in texts if lang and len(text.split()) > 12]
    kept = language.keep_identified(documents(*enumerate(strange), *enumerate(short, 10_000)), learned)
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert not [i for i in ids if i < 10_000]
    assert len(ids) >= 0.98 * len(short)


def test_bundles_are_sums_of_bound_vectors():
    text = "abca abc"
    packed, counts = language.grams(text)
    want = np.zeros(language.DIMENSIONS)
    for a, b, c in zip(" abca abc ", "abca abc ", "bca abc "):
        la, lb, lc = (language._letter(ord(x)).astype(int) for x in (a, b, c))
        want += np.roll(la, 2) * np.roll(lb, 1) * lc
    assert counts.sum() == 8 and np.array_equal(language.bundles([text])[0], want)


def test_every_letter_counts():
    for code in (0x61, 0x4E2D, 0x20000, 0x32100, 0x323AF):
        assert chr(code).isalpha() == (len(language.grams(chr(code) * 3)[0]) > 0)


# --- byte-level BPE -----------------------------------------------------------------------------


@pytest.mark.parametrize("dictionary_words", [bpe.DICTIONARY_WORDS, 300, 0])
def test_byte_bpe(documents, texts, dictionary_words):
    ranks = bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY))
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    hard = [(10_000 + k, t) for k, (_, t) in enumerate(ODD) if t is not None]
    hard += [(20_000, "a b   c\n\n  d'll it's <|endoftext|> 12345678901234567890"), (20_001, "กำ näive ‍\U0001f468"), (20_002, "ab" * 500)]
    rows = [t[:2] for t in texts[:60]] + hard
    encoded = bpe.encode(documents(*rows), dictionary_words=dictionary_words)
    got = {r["doc_id"]: r for r in bpe.decode(encoded).collect()}
    for i, text in rows:
        assert got[i]["ids"] == known.encode_ordinary(text)
        assert bytes(got[i]["bytes"] or b"") == text.encode()


def test_digests_are_those_of_ids_and_text(documents, texts):
    ranks = bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY))
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = [t[:2] for t in texts[:200]]
    got = by_id(bpe.digests(documents(*rows)))
    for i, text in rows:
        ids = np.array(known.encode_ordinary(text), dtype="<u4")
        assert (got[i]["n_tokens"], got[i]["ids_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert got[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_merges_beside_neighbours_leave_the_result(texts):
    ranks = bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY))
    token, pairs = {rank: piece for piece, rank in ranks.items()}, bpe.pair_merges(ranks)
    table = bpe.rank_table(ranks)
    merge = bpe.beside_merger(bpe.neighbours(ranks, pairs, table))
    rng = np.random.default_rng(4)
    words = {w for _, text, *_ in texts[:200] for w in re.findall(r" ?\w+", text or "")} | {"яблоко", "見た目", "ß́", "aaaaaaa", "anananananas"}
    words = sorted(w.encode() for w in words) + [bytes(rng.choice(list(b"aenstr "), n).tolist()) for n in rng.integers(1, 20, 4000)]
    words += [bytes(rng.integers(0, 256, n).tolist()) for n in rng.integers(1, 12, 1000)]
    tokens = np.array([ranks[bytes([b])] for w in words for b in w], dtype=np.int32)
    got, lengths, still = merge(tokens, np.array([len(w) for w in words]))
    assert len(lengths) == len(words) and lengths.sum() == len(got) and 0 < still.sum() < 0.5 * len(words)
    for word, part, more in zip(words, np.split(got, np.cumsum(lengths)[:-1]), still):
        whole, parts = [[ranks[bytes([b])] for b in word], part.tolist()]
        for ids in (whole, parts):
            while True:
                best = min(((ranks.get(token[a] + token[b], 1 << 20), i) for i, (a, b) in enumerate(zip(ids, ids[1:]))), default=(1 << 20, 0))
                if best[0] == 1 << 20:
                    break
                ids[best[1] : best[1] + 2] = [best[0]]
        assert whole == parts and (more or parts == part.tolist()), word
    none = merge(tokens[:0], np.zeros(0, np.int64))
    assert [len(n) for n in none] == [0, 0, 0]


def test_words_are_the_matches_of_the_pattern(texts, monkeypatch):
    found = regex.compile(public_tokenizers.PATTERN)
    rng = np.random.default_rng(11)
    letters = list("\x27\x27\x27\x27    \n\tsstmdrevell1a.,!é見\U0001f468́\x1c\x85\u3000") + [chr(0x32100)]
    rows = ["", *("".join(rng.choice(letters, n)) for n in rng.integers(0, 14, 3000)), "", " '", "'s's 'll'", *(t or "" for _, t, *_ in texts[:50])]
    rows.append("".join(chr(c) for c in range(0x3200) if not 0xD800 <= c < 0xE000))
    for piece in (1, 40, bpe.PIECE_BYTES):
        monkeypatch.setattr(bpe, "PIECE_BYTES", piece)
        for given, part in ((rows, pa.array(rows, pa.string())), (rows[5:900], pa.array(rows, pa.string())[5:900]), ([], pa.array([], pa.string()))):
            words, ends = bpe.splitter(public_tokenizers.PATTERN)(part)
            got = words.to_pylist()
            assert [got[a:b] for a, b in zip(ends, ends[1:])] == [found.findall(text) for text in given]
            assert ends[0] == 0 and ends[-1] == len(got) and len(ends) == len(given) + 1
    words, ends = bpe.splitter(r"(b+)|[^b]")(pa.array(["abba", "", "bc"]))
    assert (words.to_pylist(), ends.tolist()) == (["a", "bb", "a", "b", "c"], [0, 3, 3, 5])


def test_counted_words_are_rare_and_short(documents):
    ranks = bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY))
    docs = documents((1, "the zqxj zqxj"), (2, "zqxj " + "q" * 65), (None, ""))
    counts = {r["word"]: r["n"] for r in bpe.word_counts(docs, public_tokenizers.PATTERN, ranks).collect()}
    assert set(counts) == {w for w in ("zqxj", " zqxj") if w.encode() not in ranks} and min(counts.values()) >= 1
    assert bpe.word_counts(docs.limit(0), public_tokenizers.PATTERN, ranks).count() == 0


def test_decode_odd_ids(spark):
    ranks = bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY))
    token = {rank: piece for piece, rank in ranks.items()}
    rows = [(1, [5, 600, 40_000]), (2, []), (3, None), (4, [5, -1, 10**9, None, 7]), (4, [5, -1, 10**9, None, 7]), (None, [300] * 5000)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, ids array<int>, bytes string, pieces string")
    got = bpe.decode(df)
    assert got.columns == ["doc_id", "ids", "pieces", "bytes"]
    want = {1: token[5] + token[600] + token[40_000], 2: b"", 3: None, 4: token[5] + token[7], None: token[300] * 5000}
    found = got.collect()
    assert len(found) == len(rows) and all((bytes(r["bytes"]) if r["bytes"] is not None else None) == want[r["doc_id"]] for r in found)
    assert bpe.decode(df.limit(0)).count() == 0


def test_byte_bpe_digests(odd, none):
    rows = bpe.digests(odd).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert len(rows) == len(ODD)
    assert {(r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows if r["doc_id"] in (1, 2, 9)} == {(0, empty, empty)}
    assert bpe.digests(none).count() == 0


def test_rank_table_holds_every_merge():
    ranks = bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY))
    table = bpe.rank_table(ranks)
    merges = bpe.pair_merges(ranks)
    slot = table.slots[table.base[merges[:, 0]] + merges[:, 1]]
    assert np.array_equal(slot >> bpe.RANK_BITS, merges[:, 0] + 1)
    assert np.array_equal(slot & ((1 << bpe.RANK_BITS) - 1), merges[:, 2])
    assert len(ranks) == len(base64.b64decode(base64.b64encode(bytes(len(ranks)))))


def test_plans_do_not_hold_the_rank_table(documents):
    plan = bpe.encode(documents((1, "lorem ipsum dolor"))).select("ids")._jdf.queryExecution().toString()
    assert len(plan) < 100_000  # millions, when the table was a literal


def test_certain_merges_leave_the_result(texts):
    ranks = bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY))
    token, size = {rank: piece for piece, rank in ranks.items()}, max(ranks.values()) + 1
    certain = bpe.table_of(bpe.certain_merges(bpe.pair_merges(ranks), size), size)
    rng = np.random.default_rng(3)
    words = {w for _, text, *_ in texts[:150] for w in re.findall(r" ?\w+", text or "")} | {"яблоко", "見た目", "ß́"}
    words = sorted(w.encode() for w in words) + [bytes(rng.integers(0, 256, n).tolist()) for n in rng.integers(1, 12, 2000)]
    tokens = np.array([ranks[bytes([b])] for w in words for b in w], dtype=np.int32)
    got, lengths = bpe.merge_certain(tokens, np.array([len(w) for w in words]), certain)
    assert len(lengths) == len(words) and lengths.sum() == len(got) < 0.95 * len(tokens)
    for word, part in zip(words, np.split(got, np.cumsum(lengths)[:-1])):
        whole, parts = [[ranks[bytes([b])] for b in word], part.tolist()]
        for ids in (whole, parts):
            while True:
                best = min(((ranks.get(token[a] + token[b], size), i) for i, (a, b) in enumerate(zip(ids, ids[1:]))), default=(size, 0))
                if best[0] == size:
                    break
                ids[best[1] : best[1] + 2] = [best[0]]
        assert whole == parts, word
    none = bpe.merge_certain(tokens[:0], np.zeros(0, np.int64), certain)
    assert len(none[0]) == len(none[1]) == 0


# --- chat ---------------------------------------------------------------------------------------

TURNS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "a\\<|im_end|>\n\\n\\\\"), (1, 2, "assistant", "<\\|im_end|> <|im_start|>user\nx\u0000\u00011"),
    (1, 3, "user", None), (1, 4, "assistant", ""), (2, 0, "user", "only"), (3, 1, "assistant", "b"), (3, 0, "assistant", "a"),
    (4, 0, "odd\nrole\\n<|", "t"), (5, 0, "user", "same"), (5, 0, "user", "same"), (None, 0, "assistant", "no id"), (6, 0, None, None),
]


def test_chat_round_trip(spark, clashing):
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    got = by_id(chat.digests(clashing(turns)), "conv_id")
    groups = collections.defaultdict(list)
    for conv, turn, role, text in TURNS:
        groups[conv].append((turn, role or "", text or ""))
    for conv, rows in groups.items():
        rows.sort()
        loss = "".join(t for _, r, t in rows if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for _, r, t in rows)
        assert got[conv]["n_turns"] == len(rows)
        assert got[conv]["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.digests(turns.limit(0)).count() == 0


def test_chat_examples(spark):
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    formatted = chat.format_turns(turns)
    written = by_id(chat.transcripts(formatted), "conv_id")
    examples = chat.render_examples(formatted).collect()
    assert len(examples) == 5 + 4  # assistant turns, and conversations that end otherwise
    for e in examples:
        whole = written[e["conv_id"]]["transcript"]
        assert whole.startswith(e["prompt"])
        if e["target"] is not None:
            assert whole[e["target_start"] : e["target_end"]] == e["target"] and len(e["prompt"]) == e["target_start"]
    chars = by_id(chat.digests(turns), "conv_id")
    spans = chat.example_spans(formatted).groupBy("conv_id").agg(F.sum("example_chars").alias("n")).collect()
    assert {r["conv_id"]: r["n"] for r in spans} == {c: r["formatted_chars"] for c, r in chars.items()}


@pytest.mark.parametrize("shift", [(1, 0), (0, 1), (-1, 0), (0, -1), (3, 3), (-30, 0)])
def test_wrong_spans_show_in_the_digest(spark, shift):
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    output = chat.formatted(chat.format_turns(turns))

    def moved(e):
        spans = e.withField("target_start", e["target_start"] + shift[0]).withField("target_end", e["target_end"] + shift[1])
        return F.when(e.isNotNull(), spans)

    def trained(rows):
        parts = [(r["conv_id"], r["at"], r["trained"]) for r in chat.read_back(rows).collect() if r["trained"] is not None]
        return {(c, at): text for c, at, text in parts}

    right, wrong = trained(output), trained(output.withColumn("examples", F.transform("examples", moved)))
    assert right[1, 2] == TURNS[2][3] and right[3, 0] == "a" and right[3, 1] == "b"
    assert all(wrong[k] != right[k] for k in right if right[k])


def test_examples_are_written_out(spark):
    rows = [(1, 0, "user", "q<|im_end|>"), (1, 1, "assistant", "a\\<|"), (1, 2, "user", "q"), (1, 3, "assistant", "b"), (1, 4, "user", "bye"), (2, 0, "assistant", "")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    output = chat.formatted(chat.format_turns(turns))
    got = {(r["conv_id"], r["at"]): r for r in chat.expanded(output).collect()}
    written = by_id(output, "conv_id")
    assert set(got) == {(1, 1), (1, 3), (1, 4), (2, 0)}
    for (conv, at), r in got.items():
        assert written[conv]["transcript"].startswith(r["prompt"] + (r["target"] or "") + r["end"])
        assert r["prompt"].count(chat.START) == at + 1 and r["end"] == ("" if r["target"] is None else chat.END + "\n")
    assert [got[k]["target"] for k in sorted(got)] == ["a\\\\<\\|", "b", None, ""]
    sizes = [sum(len(r["prompt"] + (r["target"] or "") + r["end"]) for (conv, _), r in got.items() if conv == c) for c in (1, 2)]
    assert [r["formatted_chars"] for r in chat.digests(turns).orderBy("conv_id").collect()] == sizes
    # A prompt that is cut short shows in what is read back.
    shorter = output.withColumn("examples", F.transform("examples", lambda e: e.withField("prompt_chars", e["prompt_chars"] - 1)))
    right, wrong = [[r["whole"] for r in chat.read_back(o).orderBy("conv_id", "at").collect()] for o in (output, shorter)]
    assert len(right) == 4 and all(a != b for a, b in zip(right, wrong))


# --- mixing -------------------------------------------------------------------------------------


def test_poisson_inverse(spark):
    u = spark.range(20000).select(((F.col("id") + 0.5) / 20000).alias("u"))
    for mean in (0.3, 1.0, 7.5, 16.0):
        k = u.select(mixing.inverse_poisson(F.col("u"), F.lit(mean)).alias("k")).toPandas()["k"]
        assert k.mean() == pytest.approx(mean, rel=0.01) and k.var() == pytest.approx(mean, rel=0.02)
        assert (k.diff().dropna() >= 0).all()


def test_mixture(documents, odd, none):
    rows = [(i, f"t{i}", "en", "big" if i % 10 else "small") for i in range(4000)]
    docs = documents(*rows)
    made = mixing.replicate(docs, {"big": 1.0, "small": 1.0}).selectExpr("doc.doc_id", "doc.source", "copy", "copies").toPandas()
    shares = made.groupby("source").size()
    assert abs(shares["small"] - 2000) < 200 and abs(shares["big"] - 2000) < 200
    assert (made.groupby("doc_id")["copy"].max() == made.groupby("doc_id")["copies"].first()).all()
    again = mixing.replicate(docs.repartition(7), {"big": 1.0, "small": 1.0}).selectExpr("doc.doc_id", "copy").toPandas()
    assert sorted(map(tuple, again.to_numpy())) == sorted(map(tuple, made[["doc_id", "copy"]].to_numpy()))
    assert mixing.mix(docs, {"small": 1.0}).select("source").distinct().collect()[0][0] == "small"
    heavy = mixing.replicate(docs.where("doc_id = 0").unionByName(docs.where("source = 'big'")), {"small": 1.0, "big": 1e-9})
    assert heavy.where("doc.source = 'small'").count() == pytest.approx(3601, rel=0.1)
    assert mixing.mix(odd).columns == odd.columns and mixing.mix(none).count() == 0


# --- nearest neighbours -------------------------------------------------------------------------


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(6)
    vectors = rng.standard_normal((1500, 24)) * rng.uniform(0.5, 2, (1500, 1))
    vectors[900:1300] = vectors[7]  # one vector many times
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    bad = [(-20, None, 0), (-40, [0.0] * 24, 0), (-60, [float("nan")] * 24, 0), (-80, [None] * 24, 0), (-100, [1.0], 0), (None, [1.0] * 24, 0)]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, label int")
    got = ann.search(table.withColumn("list", F.lit("x"))).toPandas().sort_values(["query_id", "rank"])
    assert set(got["query_id"]) == set(range(0, 1500, 20))
    recall = []
    for query, found in got.groupby("query_id"):
        score = vectors @ vectors[query]
        score[query] = -np.inf
        best = np.lexsort((np.arange(1500), -score))[:20]
        recall.append(len(set(best) & set(found["vec_id"])) / 20)
        assert list(found["rank"]) == list(range(1, 21)) and np.allclose(found["score"], score[found["vec_id"]], atol=1e-12)
        order = list(zip(-found["score"], found["vec_id"]))
        assert order == sorted(order)
    assert np.mean(recall) >= 0.9


def test_recall_where_lists_are_left_out(spark):
    rng = np.random.default_rng(8)
    vectors = rng.standard_normal((20_000, 64))  # no clusters, as in the given tables
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = ann.search(table, every=100).toPandas()
    score = vectors[::100] @ vectors.T
    score[np.arange(200), np.arange(0, 20_000, 100)] = -np.inf
    best = {100 * q: set(row) for q, row in enumerate(np.argsort(-score, axis=1)[:, :20])}
    found = got.groupby("query_id")["vec_id"].agg(set)
    recall = np.mean([len(found[q] & best[q]) / 20 for q in best])
    print(f"recall at 20 of 20,000 vectors: {recall:.4f}")
    assert recall >= 0.93  # 0.95 in the probed lists


@pytest.mark.parametrize("spread", [1.0, 0.05])  # without and with clusters
def test_a_scan_takes_its_queries_together(monkeypatch, spread):
    rng = np.random.default_rng(9)
    vectors = spread * rng.standard_normal((700, 32)) + rng.standard_normal((12, 32))[rng.integers(0, 12, 700)]
    vectors[300:400] = vectors[3]  # more equal scores than are wanted
    ids, asked = rng.permutation(7000)[:700], rng.choice(700, 150, replace=False)
    rotation = np.linalg.qr(rng.standard_normal((33, 33)))[0]
    index = ann.Index(rotation, np.zeros((1, 33)), float(np.linalg.norm(vectors, axis=1).max()) * (1 + 1e-12))
    made, frame = [], ann.pd.DataFrame
    monkeypatch.setattr(ann.pd, "DataFrame", lambda *a, **b: made.append(1) or frame(*a, **b))
    monkeypatch.setattr(ann, "PAIRS", 700 * 64)  # three steps
    got = ann.scan(vectors[asked], ids[asked], vectors, ids, index, 20)
    assert len(made) <= 2  # one for each query before: most of the scan's time
    hits = 0
    for query, found in got.groupby("query_id"):
        score = vectors @ vectors[ids == query][0]
        score[ids == query] = -np.inf
        best = np.lexsort((ids, -np.round(score, 9)))[:20]
        assert len(found) == 20 and np.allclose(found["score"], [score[ids == i][0] for i in found["vec_id"]], atol=1e-12)
        hits += len(set(found["vec_id"]) & set(ids[best]))
    assert got["query_id"].nunique() == 150 and hits >= 0.97 * 20 * 150


def test_few_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(20, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0])], schema)
    assert [(r["rank"], r["vec_id"]) for r in ann.search(few).orderBy("rank").collect()] == [(1, 1), (2, 2), (3, 3)]
    assert ann.search(few.limit(0)).count() == 0


# --- registered queries -------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracles(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "labels", "embeddings", "conversations", "benchmark", "pages"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    want = connection.execute(ORACLES[name])
    columns = sorted(d[0] for d in want.description)
    rows = [dict(zip([d[0] for d in want.description], r)) for r in want.fetchall()]
    got = [r.asDict() for r in QUERIES[name](spark, DATA).collect()]
    assert sorted(got[0]) == columns
    assert sorted(tuple(str(r[c]) for c in columns) for r in got) == sorted(tuple(str(r[c]) for c in columns) for r in rows)
