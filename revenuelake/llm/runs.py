"""Runs: stretches of words that repeat with a period.

Words are what ASCII white space parts. A *run* is a stretch of consecutive words with smallest period ``q`` (words q
apart are identical) that spans at least ``max(MIN_WORDS, MIN_POWERS * q)`` words and that no neighbouring word extends
keeping the period.

Online sparse diagonal DP: words are read once, in order. A *diagonal* is a lag; it is active while each word equals the
word one lag before it, and its match length grows by one with each word that has an earlier occurrence there. When a
word breaks an active diagonal, the diagonal ends and gives out its run at once if its match is long enough. The state
is the places of each word and the active lags, nothing else.

Which earlier occurrences may open a diagonal follows from the lengths wanted, and no run is lost: a run of period q
holds more than 2q matches in a row, thus a place divisible by the least power of two above q. So a word at place i only
looks at occurrences nearer than the largest power of two that divides i. The words around such a pair are compared, as
far as a run needs, in steps that double; only if they suffice is the diagonal opened, from its first match on. A
multiple of an active period that already spans the lag is the same run again and is left out. So n words of which
a share f is alike cost about n f log n comparisons, also where all words are equal or repeats lie within repeats.

Each text is worked on where it lies; nothing is shuffled. A text is held whole by one task, as any row is.

Defined results: a null or empty text has no words, no runs and collapses to an empty text; ids may be null or
repeat, and every row keeps its own result; an empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revenuelake.llm.common import tidy, whole_text
from revenuelake.session import ship_package

MIN_WORDS = 6
MIN_POWERS = 4  # at least 3: see the openings above
SLICE_ROWS = 500  # texts whose results a Python worker holds at once
WORD = r"[^\x20\x09-\x0D]+"

_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _alike(packed: bytes, one: int, other: int, most: int) -> int:
    """How many words from ``one`` and from ``other`` on are equal, up to ``most``; found in steps that double, then halve."""
    n, step = 0, 4
    while n < most:
        step = min(step, most - n)
        if packed[4 * (one + n) : 4 * (one + n + step)] == packed[4 * (other + n) : 4 * (other + n + step)]:
            n, step = n + step, 2 * step
        elif step == 1:
            return n
        else:
            most, step = n + step - 1, max(step // 2, 1)
    return n


def _alike_before(packed: bytes, one: int, other: int, most: int) -> int:
    """The same for the words before ``one`` and before ``other``."""
    n, step = 0, 4
    while n < most:
        step = min(step, most - n)
        if packed[4 * (one - n - step) : 4 * (one - n)] == packed[4 * (other - n - step) : 4 * (other - n)]:
            n, step = n + step, 2 * step
        elif step == 1:
            return n
        else:
            most, step = n + step - 1, max(step // 2, 1)
    return n


def find_runs(words: Sequence, min_words: int = MIN_WORDS, min_powers: int = MIN_POWERS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    if min_powers < 3:
        raise ValueError("openings at powers of two find runs of at least three periods")
    number: dict = {}
    codes = [number.setdefault(word, len(number)) for word in words]
    packed = np.array(codes, dtype=np.int32).tobytes()
    n = len(codes)
    places: list[list[int]] = [[] for _ in number]
    active: dict[int, int] = {}  # lag: first word of the stretch; its match length is the place less this and the lag
    runs: list[tuple[int, int, int]] = []

    def end(lags: list[int], at: int) -> None:
        given = set()
        for lag in sorted(lags):
            start = active.pop(lag)
            if start not in given:  # the same stretch at a larger lag has a multiple of the smallest period
                given.add(start)
                runs.append((start, at - start, lag))

    for i, code in enumerate(codes):
        if active:
            broken = [lag for lag in active if codes[i - lag] != code]
            if broken:
                end(broken, i)
        earlier = places[code]
        reach = i & -i
        if earlier and reach > 1:
            for j in reversed(earlier):
                lag = i - j
                if lag >= reach:
                    break
                wanted = max(min_words, min_powers * lag) - lag  # matches
                if lag in active or any(lag % p == 0 and i - start >= lag for p, start in active.items()):
                    continue
                ahead = _alike(packed, i, j, min(wanted, n - i))
                before = _alike_before(packed, i, j, j)
                if ahead + before >= wanted:
                    active[lag] = j - before
        earlier.append(i)
    end(list(active), n)
    return sorted(runs, key=lambda run: (run[0], run[2]))


def kept_words(words: Sequence, runs: Sequence[tuple[int, int, int]]) -> list:
    """The words that no run holds after its first period."""
    if not runs:
        return list(words)
    kept, done = [], 0
    for start, length, period in sorted(runs, key=lambda run: run[0] + run[2]):
        kept += words[done : max(start + period, done)]
        done = max(done, start + length)
    return kept + list(words[done:])


def find_in_batches(min_words: int, min_powers: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                counts, runs, texts = [], [], []
                for text in part.column("text"):
                    words = text.as_py().encode().split()  # bytes are split at ASCII white space alone
                    found_here = find_runs(words, min_words, min_powers)
                    counts.append(len(words))
                    runs.append([{"start": s, "length": n, "period": p} for s, n, p in found_here])
                    texts.append(b" ".join(kept_words(words, found_here)).decode())
                yield pa.record_batch(
                    [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(runs, _RUNS), pa.array(texts, pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    return found


def mark_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_powers: int = MIN_POWERS) -> DataFrame:
    """doc_id, number of words, all runs, and the text with every run cut to its first period."""
    ship_package(docs.sparkSession)
    schema = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(tidy(find_in_batches(min_words, min_powers)), schema)


def longest_run(runs: Column) -> Column:
    """The run of greatest length (ties: least start, then period), null without runs."""
    keyed = F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    best = F.array_max(keyed)
    return F.struct((-best["s"]).alias("start"), best["length"].alias("length"), (-best["p"]).alias("period"))


def with_periods(docs: DataFrame) -> DataFrame:
    """The documents, with a tenth of them made periodic: the contract's input of ``op11``.

    h = crc32 of the decimal id. If h % 10 = 0, each word i >= a becomes word a + (i - a) % p. A null id has no h and its
    text stays.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    named = docs.select("doc_id", whole_text().alias("text"), h.alias("h")).select(
        "doc_id", "text", F.when(F.col("h") % 10 == 0, words).otherwise(F.array().cast("array<string>")).alias("words"), F.expr("h div 10").alias("g")
    )
    n = F.size("words")
    placed = named.withColumn("n", n).withColumn("a", F.expr("if(n > 0, g % n, 0)")).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    changed = F.expr("transform(words, (w, i) -> if(i < a, w, get(words, cast(a + (i - a) % p as int))))")
    return placed.select("doc_id", F.when(F.col("n") > 0, F.array_join(changed, " ")).otherwise(F.col("text")).alias("text"))


def digests(marked: DataFrame) -> DataFrame:
    """The contract's columns from the operator's result."""
    line = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
    return marked.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest_run(F.col("runs")).alias("_l"), line.alias("_line"), "collapsed").select(
        "doc_id",
        "n_runs",
        "_l.start",
        "_l.length",
        "_l.period",
        F.expr("1000 * _l.length div _l.period").alias("exponent_milli"),
        F.sha2("_line", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
