"""Language identification with hyperdimensional profiles.

Every letter (and the gap between words) has a random vector of -1 and +1, drawn from its code point alone. An
n-gram is bound by multiplying its letters' vectors, each rotated by its place; a text is the bundle (sum) of its
n-grams, a language's prototype the bundle of its training texts. A text gets the language whose prototype has
the largest cosine with its own bundle.

``keep_identified`` keeps texts that score ``MIN_SCORE`` or more. The cosine of unrelated bundles has a standard deviation
of 1 / sqrt(DIMENSIONS), and the best of all languages is taken; five deviations are above the largest of 2,000 such cosines.

The prototypes are sums over all training rows, made in Spark; only ``languages x dimensions`` numbers reach the
driver, and more than ``MAX_LANGUAGES`` languages are an error.

Defined results: a null text, or one without a letter, is ``und`` with score 0, as is every text when nothing was
learned; equal cosines give the alphabetically first language; rows whose lang is null are not learned from; a
null doc_id hashes as the text "" does. Repeated rows count as often as they occur. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revenuelake.llm.common import hand_back, tidy, whole_text
from revenuelake.session import ship_package

DIMENSIONS = 2048
ORDER = 3
HELD_GRAMS = 1 << 18  # n-grams that a task counts before it bundles them
MAX_LANGUAGES = 2000
MIN_SCORE = 5 / DIMENSIONS**0.5  # 0.11
UNDETERMINED = "und"
CHUNK = 64  # texts bundled at once
GAP = 32


@cache
def _letter(code: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(code)).integers(0, 2, DIMENSIONS, dtype=np.int8) * 2 - 1


@cache
def _is_letter() -> np.ndarray:
    """For every code point, whether it is a letter."""
    return np.fromiter((chr(code).isalpha() for code in range(0x110000)), dtype=bool, count=0x110000)


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a text, as packed code points, and how often each occurs."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    letter = _is_letter()[codes]
    if not letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes = np.concatenate([[GAP], np.where(letter, codes, GAP), [GAP]])
    codes = codes[np.concatenate([[True], (codes[1:] != GAP) | (codes[:-1] != GAP)])]  # one gap in a row
    packed = codes[: 1 - ORDER] if ORDER > 1 else codes
    for place in range(1, ORDER):
        packed = (packed << 21) | codes[place : len(codes) - ORDER + 1 + place]
    return np.unique(packed, return_counts=True)


def gram_vectors(packed: np.ndarray) -> np.ndarray:
    """Bound vectors: the product of the letters' vectors, each rotated by its place."""
    bound = np.ones((len(packed), DIMENSIONS), dtype=np.int8)
    for place in range(ORDER):
        codes, at = np.unique((packed >> (21 * place)) & 0x1FFFFF, return_inverse=True)
        bound *= np.stack([np.roll(_letter(int(c)), place) for c in codes])[at]
    return bound


def bundles(texts: list[str]) -> np.ndarray:
    """One bundle for each of a few texts; a row of zeros where there is no letter."""
    found = [grams(t) for t in texts]
    vocabulary = np.unique(np.concatenate([g for g, _ in found])) if found else np.zeros(0, np.int64)
    counts = np.zeros((len(found), len(vocabulary)), dtype=np.float32)
    for row, (packed, n) in enumerate(found):
        counts[row, np.searchsorted(vocabulary, packed)] = n
    out = np.zeros((len(found), DIMENSIONS), dtype=np.float32)
    for at in range(0, len(vocabulary), 4096):
        out += counts[:, at : at + 4096] @ gram_vectors(vocabulary[at : at + 4096]).astype(np.float32)
    return out


@dataclass(frozen=True)
class Prototypes:
    languages: list[str]
    vectors: np.ndarray  # unit length, one row for each language

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        names, scores = [], []
        for at in range(0, len(texts), CHUNK):
            bundle = bundles(texts[at : at + CHUNK])
            norms = np.linalg.norm(bundle, axis=1)
            known = (norms > 0) & bool(self.languages)
            cosine = bundle @ self.vectors.T / np.where(norms > 0, norms, 1)[:, None] if self.languages else np.zeros((len(bundle), 1))
            best = cosine.argmax(axis=1)
            names += [self.languages[b] if k else UNDETERMINED for b, k in zip(best, known)]
            scores.append(np.where(known, cosine[np.arange(len(best)), best].clip(0, 1), 0.0))
        return names, np.concatenate(scores) if scores else np.zeros(0)


def learn(docs: DataFrame) -> Prototypes:
    """Prototypes of the languages in ``docs`` (text and lang); every row with a lang is used."""
    ship_package(docs.sparkSession)

    def bundle(sums: dict[int, int]) -> list[np.ndarray]:
        packed, n = np.array(list(sums), np.int64), np.array(list(sums.values()), float)
        total = np.zeros(DIMENSIONS)
        for at in range(0, len(packed), 4096):
            total += n[at : at + 4096] @ gram_vectors(packed[at : at + 4096])
        return [total]

    def bundled(batches):
        held: dict[str, dict[int, int]] = {}  # counts go on over batches, up to HELD_GRAMS n-grams in all
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                sums = held.setdefault(lang, {})
                for text in texts:
                    for packed, n in zip(*(x.tolist() for x in grams(text))):
                        sums[packed] = sums.get(packed, 0) + n
            if sum(map(len, held.values())) > HELD_GRAMS:
                for lang, sums in held.items():
                    yield pd.DataFrame({"lang": [lang], "bundle": bundle(sums)})
                held = {}
        for lang, sums in held.items():
            yield pd.DataFrame({"lang": [lang], "bundle": bundle(sums)})

    parts = (
        docs.where(F.col("lang").isNotNull())
        .select("lang", whole_text().alias("text"))
        .mapInPandas(tidy(bundled), "lang string, bundle array<double>")
    )
    sums = (
        parts.select("lang", F.posexplode("bundle").alias("at", "value"))
        .groupBy("lang", "at")
        .agg(F.sum("value").alias("value"))
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("bundle"))
        .select("lang", F.col("bundle.value").alias("bundle"))
    )
    rows = sorted(((r["lang"], np.array(r["bundle"])) for r in sums.limit(MAX_LANGUAGES + 1).collect()), key=lambda r: r[0])
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    rows = [(lang, v / np.linalg.norm(v)) for lang, v in rows if v.any()]
    vectors = np.stack([v for _, v in rows]) if rows else np.zeros((0, DIMENSIONS))
    return Prototypes([lang for lang, _ in rows], vectors.astype(np.float32))


def language(prototypes: Prototypes, text: Column) -> Column:
    """Struct of the predicted language and its cosine for a text column."""
    shared = prototypes  # at most MAX_LANGUAGES rows

    @F.pandas_udf("lang_pred string, score double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            names, scores = shared.predict([t or "" for t in texts])
            yield pd.DataFrame({"lang_pred": names, "score": scores.astype(float)})
        hand_back()

    return predicted(text)


def held_out(doc_id: Column, modulus: int = 4, remainder: int = 2) -> Column:
    """Whether a document is kept from learning: by the CRC of its id as text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def identify(docs: DataFrame, prototypes: Prototypes) -> DataFrame:
    """doc_id, held_out, lang_pred and score; one row for each document."""
    ship_package(docs.sparkSession)
    found = docs.select("doc_id", language(prototypes, whole_text()).alias("_l"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "_l.lang_pred", "_l.score")


def keep_identified(docs: DataFrame, prototypes: Prototypes, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents with a language whose cosine reaches ``min_score``; columns as they come."""
    ship_package(docs.sparkSession)
    # One call of the function decides: an undetermined text has score 0.
    return docs.where(language(prototypes, whole_text())["score"] >= min_score)
