"""Search by trigrams gives the rows of the scan and reads only the lists of the text's trigrams."""

import random

import pytest
from pyspark.sql import functions as F

from revenuelake.plans.live import live_taxpayer_search
from revenuelake.schemas import SCHEMAS
from revenuelake.sources import postings

NAMES = ["ΟΔΟΣ Α.Ε.", "Straße Ltd", "aaaa", "aaaaaa", "ab", "", None, "İstanbul", "x😀y😀z", "Common Trading", "common goods"]


@pytest.fixture(scope="module")
def taxpayers(spark):
    schema = SCHEMAS["taxpayers"]
    some = random.Random(5)
    names = NAMES + ["Common " + "".join(some.choices("abcde ", k=some.randint(0, 12))) for _ in range(600)]
    rows = [(f"TP{i:05d}", name, None if i % 50 == 0 else f"T{some.randint(0, 99999):05d}X") for i, name in enumerate(names)]
    rows += rows[:12]  # repeated rows
    made = spark.createDataFrame(rows, "taxpayer_id string, name string, tin string")
    return made.select(*[(F.col(f.name) if f.name in made.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


@pytest.fixture(scope="module")
def stored(spark, taxpayers, tmp_path_factory):
    yield postings.store_postings(taxpayers, "name_grams", str(tmp_path_factory.mktemp("grams") / "lists"), 8)
    for name in ("name_grams", "name_grams_lengths"):
        spark.sql(f"DROP TABLE {name}")


def test_same_rows_as_the_scan(spark, taxpayers, stored):
    some = random.Random(6)
    held = [r for r in taxpayers.select("name", "tin").collect()]
    texts = ["common", "COMMON T", "aaa", "aaaaa", "ΟΔΟΣ", "οδος", "straße", "😀y😀", "İst", "T0", "", "x", "zzzzzz", "common qq", "09X", "9x"]
    for row in some.sample(held, 12):
        text = some.choice([t for t in row if t] or ["none"])
        start = some.randint(0, max(0, len(text) - 3))
        texts.append(text[start : start + some.randint(3, 9)])
    for text in texts:
        found = postings.search_postings(taxpayers, *stored, text, rows=10_000)
        assert found.collect() == live_taxpayer_search(taxpayers, text, 10_000).collect(), text
    assert len(postings.search_postings(taxpayers, *stored, "common").collect()) == 10


def test_reads_the_lists_of_few_trigrams(spark, stored):
    lists, lengths = stored
    plan = postings.candidates(lists, lengths, "common goods")._jdf.queryExecution().toString()
    shortest = lengths.where(F.col("gram").isin(["n" + "common goods"[i : i + 3] for i in range(10)])).orderBy("n", "gram").limit(3)
    for row in shortest.collect():
        assert row["gram"] in plan
    assert "nomm" not in plan and "PushedFilters: [In(gram" in plan


def test_empty_table(spark, taxpayers, tmp_path):
    empty = taxpayers.where("false")
    made = postings.store_postings(empty, "no_grams", str(tmp_path / "lists"), 4)
    assert postings.search_postings(empty, *made, "common").collect() == []
    for name in ("no_grams", "no_grams_lengths"):
        spark.sql(f"DROP TABLE {name}")


def test_no_task_makes_many_entries(taxpayers):
    one = taxpayers.coalesce(1)
    entries = postings.posting_entries(one, 1000)
    counts = [r["count"] for r in entries.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(counts) > 5000 and max(counts) < 1500
    whole = postings.posting_entries(one)
    assert entries.exceptAll(whole).count() == 0 and whole.exceptAll(entries).count() == 0
