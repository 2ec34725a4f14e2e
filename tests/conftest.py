import datetime as dt
import pathlib
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from revenuelake.schemas import SCHEMAS  # noqa: E402
from revenuelake.session import build_session, ship_package  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.driver.host": "127.0.0.1",
            "spark.driver.bindAddress": "127.0.0.1",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    """Build a table from partial rows; text becomes the column's date, decimal or number."""

    def build(name, rows):
        schema = SCHEMAS[name]

        def value(field, given):
            kind = field.dataType.typeName()
            if given is None:
                return None
            if kind == "date":
                return dt.date.fromisoformat(given)
            if kind in ("timestamp", "timestamp_ntz"):
                return dt.datetime.fromisoformat(given)
            if kind == "decimal":
                return Decimal(str(given))
            return given

        data = [tuple(value(f, row.get(f.name)) for f in schema.fields) for row in rows]
        return spark.createDataFrame(data, schema)

    return build


def rows_by(df, key):
    return {row[key]: row.asDict() for row in df.collect()}
