"""Write-back rewrites the folders that changed and no others."""

import datetime as dt
import pathlib

from pyspark.sql import functions as F

from revenuelake.operators.mutation import upsert_forecasts
from revenuelake.sources import writeback

DAY = dt.date(2024, 1, 15)


def forecasts(spark, start, days, factor, kinds=("PAYE", "VAT")):
    i = F.col("id")
    rows = spark.range(days).select(F.date_add(F.lit(start), i.cast("int")).alias("forecast_date"), F.explode(F.array(*map(F.lit, kinds))).alias("tax_type"), (i * factor).alias("v"))
    amount = [(F.col("v") + more).cast("decimal(15,2)").alias(name) for more, name in ((0, "predicted_revenue"), (-1, "lower_bound"), (1, "upper_bound"))]
    return rows.select("forecast_date", "tax_type", *amount, F.lit(DAY).cast("timestamp").alias("created_at"))


def files(path):
    return {str(f.relative_to(path)) for f in pathlib.Path(path).rglob("*.parquet")}


def content(df):
    return sorted(map(tuple, df.select("forecast_date", "tax_type", "predicted_revenue", "lower_bound", "upper_bound").collect()))


def test_only_changed_months_are_written_and_a_rerun_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "forecasts")
    first = forecasts(spark, dt.date(2024, 1, 1), 91, 2)  # January to March
    schema = first.schema
    writeback.store_forecasts(first, path)
    before = files(path)
    # February comes with other figures, March with the same, April is new.
    same = first.where(F.month("forecast_date") == 3)
    source = forecasts(spark, dt.date(2024, 2, 10), 5, 7, ("VAT",)).unionByName(same).unionByName(forecasts(spark, dt.date(2024, 4, 1), 3, 1))
    later = dt.date(2024, 2, 20)
    wanted = content(upsert_forecasts(first, source, later))
    assert writeback.upsert_stored_forecasts(spark, path, schema, source, later) == ["2024-02", "2024-04"]
    after = files(path)
    assert {f for f in before if "2024-02" not in f} == {f for f in after if "2024-01" in f or "2024-03" in f}
    assert not {f for f in before if "2024-02" in f} & after
    assert content(writeback.read_forecasts(spark, path, schema)) == wanted
    for day in (later, dt.date(2024, 3, 1)):
        assert writeback.upsert_stored_forecasts(spark, path, schema, source, day) == []
    assert files(path) == after
    assert writeback.upsert_stored_forecasts(spark, path, schema, source.where("false"), later) == []


def test_nulls_repeats_and_order_count(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = [("a", None, 1), ("a", 1, None), ("b", 2, 2), ("b", 2, 2), ("c", 3, 3)]
    kind = "part string, x int, y int"
    spark.createDataFrame(rows, kind).write.partitionBy("part").parquet(path)

    def write(new):
        stored = spark.read.schema("x int, y int, part string").parquet(path)
        return writeback.write_changed(spark.createDataFrame(new, kind), stored, path, "part")

    assert write(rows[::-1]) == []
    assert write([("a", 1, None), ("a", 1, None), ("b", 2, 2)]) == ["a", "b"]
    assert write([("b", 2, 2)]) == []
    kept = sorted(map(str, spark.read.schema("x int, y int, part string").parquet(path).collect()))
    assert kept == ["Row(x=1, y=None, part='a')"] * 2 + ["Row(x=2, y=2, part='b')", "Row(x=3, y=3, part='c')"]
