"""Periodic runs against a search over all lags."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from revenuelake.llm import runs

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def brute_runs(words):
    """Every lag of every place: stretches of matches, each with its least lag."""
    n, found = len(words), {}
    for lag in range(1, n // 4 + 1):
        i = lag
        while i < n:
            j = i
            while j < n and words[j] == words[j - lag]:
                j += 1
            if j > i and j - i + lag >= max(6, 4 * lag):
                found.setdefault((i - lag, j - i + lag), lag)
            i = max(j, i + 1)
    return sorted(((start, length, lag) for (start, length), lag in found.items()), key=lambda r: (r[0], r[2]))


def repeating_words(rng):
    alphabet, words = rng.choice([1, 2, 2, 3, 4]), []
    for _ in range(rng.randint(0, 8)):
        words += [str(rng.randrange(alphabet)) for _ in range(rng.randint(1, 7))] * rng.randint(1, 8)
        if rng.random() < 0.3:
            words += words[-rng.randint(1, 30) :] * rng.randint(1, 4)
    return words[:150]


def test_runs_equal_those_of_all_lags():
    rng = random.Random(1)
    for _ in range(5000):
        words = repeating_words(rng)
        found = brute_runs(words)
        assert runs.find_runs(words) == found, words
        dropped = {i for start, length, period in found for i in range(start + period, start + length)}
        assert runs.kept_words(words, found) == [w for i, w in enumerate(words) if i not in dropped]


@pytest.mark.parametrize(
    "words, want",
    [
        (["a"] * 5, []),
        (["a"] * 6, [(0, 6, 1)]),
        (["a", "b"] * 4, [(0, 8, 2)]),
        (["a", "b"] * 3, []),
        (["x", *["a", "b"] * 4, "a", "y"], [(1, 9, 2)]),
        (["a"] * 200_000, [(0, 200_000, 1)]),
        ((["a"] * 50 + ["b"]) * 200, [(0, 10_200, 51), *[(51 * k, 50, 1) for k in range(200)]]),
    ],
)
def test_known_runs(words, want):
    assert runs.find_runs(words) == sorted(want, key=lambda r: (r[0], r[2]))


def test_other_lengths():
    assert runs.find_runs(["a", "b"] * 3, min_words=6, min_powers=3) == [(0, 6, 2)]
    with pytest.raises(ValueError):
        runs.find_runs([], min_powers=2)


def test_digests_of_odd_documents(spark):
    texts = [
        (None, "w " * 9), (1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, "a b c d"), (4, "a b c d"), (5, "é x " * 30), (6, "x" * 5000),
        *[(i, " ".join(str(k % 97) for k in range(i))) for i in range(10, 90)],
    ]
    rows = [(i, t, None, None, 0) for i, t in texts]
    extra = [F.lit("x").alias(n) for n in ("h", "n", "a", "p", "g", "words", "runs", "start", "_l", "_line")]
    docs = spark.createDataFrame(rows, DOCS).select("*", *extra)
    got = sorted((tuple(r) for r in runs.digests(runs.mark_runs(runs.with_periods(docs))).collect()), key=str)

    def expected(doc_id, text):
        words = (text or "").encode().split()
        n = len(words)
        if doc_id is not None and n and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        found = brute_runs(words)
        dropped = {i for start, length, period in found for i in range(start + period, start + length)}
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
        kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
        s, m, q = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
        milli = 1000 * m // q if found else None
        return (doc_id, len(found), s, m, q, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())

    assert got == sorted((expected(i, t) for i, t in texts), key=str)
    assert any(r[1] for r in got if r[0] and r[0] >= 10)  # some documents were made periodic


def test_no_documents(spark):
    empty = spark.createDataFrame([], DOCS)
    assert runs.digests(runs.mark_runs(runs.with_periods(empty))).count() == 0
