"""Substring search by posting lists of trigrams.

Every three letters of a lower-cased name, and of a TIN as it is, lead to the taxpayers that hold them. The lists are stored
by trigram (``lookup.store_by_key``: a trigram that a third of all names hold is split over several files), their lengths
beside them. A taxpayer makes some two dozen entries, so taxpayers are first dealt into pieces of about ``PIECE`` entries: what one task
makes does not grow with the table. A search reads the lengths of its own trigrams, then the lists of the few shortest; taxpayers in
all of those are compared with the whole text, so the rows are those of the full scan. A text of fewer than three letters has no
trigram and is searched by the scan.

Defined results: null names and TINs hold nothing; a trigram nobody holds means no row; repeated taxpayers are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revenuelake.plans.live import live_taxpayer_search
from revenuelake.sources.lookup import BUCKETS, store_by_key

GRAM = 3
SHORTEST = 3  # lists read for each of name and TIN
PIECE = 1 << 21  # entries that one task makes on average
NAME, TIN = "n", "t"  # first letter of a key: where its trigram stands


def _keys(text: Column, place: str) -> Column:
    grams = F.transform(F.sequence(F.lit(1), F.length(text) - (GRAM - 1)), lambda i: F.concat(F.lit(place), F.substring(text, i, F.lit(GRAM))))
    return F.when(F.length(text) >= GRAM, F.array_distinct(grams)).otherwise(F.array().cast("array<string>"))


def _keys_of(text: str, place: str) -> list[str]:
    return sorted({place + text[i : i + GRAM] for i in range(len(text) - GRAM + 1)})


def posting_entries(taxpayers: DataFrame, piece: int = PIECE) -> DataFrame:
    """gram and taxpayer_id: one row for each distinct trigram of a taxpayer's row."""
    grams = F.concat(_keys(F.lower("name"), NAME), _keys(F.col("tin"), TIN))
    total = taxpayers.agg(F.sum(F.size(grams))).first()[0] or 0
    pieces = taxpayers.select("taxpayer_id", "name", "tin").repartition(1 + total // piece)
    return pieces.select(F.explode(grams).alias("gram"), "taxpayer_id")


def store_postings(taxpayers: DataFrame, name: str, path: str, buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame]:
    """Write the posting lists (gram, taxpayer_id) and their lengths (gram, n); both are returned as lazy reads."""
    entries = posting_entries(taxpayers)
    lists = store_by_key(entries, name, path, "gram", ["taxpayer_id"], buckets)
    lengths = lists.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    return lists, store_by_key(lengths, f"{name}_lengths", f"{path.rstrip('/')}_lengths", "gram", buckets=buckets)


def candidates(lists: DataFrame, lengths: DataFrame, text: str) -> DataFrame:
    """taxpayer_id of everyone in the shortest lists of the text's trigrams, for the name or for the TIN."""
    wanted = {NAME: _keys_of(text.lower(), NAME), TIN: _keys_of(text, TIN)}
    asked = [gram for grams in wanted.values() for gram in grams]
    known = {r["gram"]: r["n"] for r in lengths.where(F.col("gram").isin(asked)).collect()}  # trigrams of the text only
    # Without a list for each of its trigrams the text stands nowhere in that place.
    read = {place: sorted(grams, key=lambda g: (known[g], g))[:SHORTEST] for place, grams in wanted.items() if all(g in known for g in grams)}
    chosen = lists.where(F.col("gram").isin([gram for grams in read.values() for gram in grams]))
    held = F.collect_set("gram")  # at most SHORTEST for each place
    complete = F.lit(False)
    for grams in read.values():
        complete = complete | (F.size(F.array_intersect("held", F.array(*map(F.lit, grams)))) == len(grams))
    return chosen.groupBy("taxpayer_id").agg(held.alias("held")).where(complete).select("taxpayer_id")


def search_postings(taxpayers: DataFrame, lists: DataFrame, lengths: DataFrame, text: str, rows: int = 10) -> DataFrame:
    """The rows of ``live_taxpayer_search``, found through the posting lists."""
    if min(len(text), len(text.lower())) < GRAM:
        return live_taxpayer_search(taxpayers, text, rows)
    return live_taxpayer_search(taxpayers.join(candidates(lists, lengths, text), "taxpayer_id", "left_semi"), text, rows)
