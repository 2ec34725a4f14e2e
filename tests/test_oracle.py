"""Every query with an oracle, compared row by row with DuckDB on the same files."""

import duckdb
import pytest

from conftest import DATA
from revenuelake.checks.oracles import ORACLES
from revenuelake.checks.queries import QUERIES, run_query

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return f"{value + 0.0:.4f}"
    return None if value is None else str(value)


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        (tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is None, v or "") for v in r)
    )


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    df = run_query(name, spark, DATA)
    got = table(df.columns, df.collect())
    result = duck.execute(ORACLES[name])
    assert got == table([d[0] for d in result.description], result.fetchall())


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
