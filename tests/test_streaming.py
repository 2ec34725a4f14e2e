import csv
import datetime as dt

from pyspark.sql import functions as F

from revenuelake.operators.insights import validate_transactions
from revenuelake.schemas import SCHEMAS
from revenuelake.streaming import jobs

NAMES = SCHEMAS["realtime_transactions"].names


def write_day(folder, name, rows):
    with open(folder / name, "w", newline="") as file:
        writer = csv.writer(file)
        writer.writerow(NAMES)
        writer.writerows(rows)


def row(i, day, hour=10, amount=None, taxpayer=None):
    return [f"X{day}-{i}", taxpayer or f"T{i}", f"{day} {hour:02d}:00:00", "POS", amount or 100 + i, "VAT", "Pending", "false"]


def test_validation_of_a_batch_equals_the_batch_operator(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    day = [row(i, "2024-01-01") for i in range(30)]
    write_day(source, "a.csv", [*day, row(3, "2024-01-01")])
    stream = jobs.read_transaction_stream(spark, str(source))
    jobs.stream_validate_transactions(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out")).drop("day")
    batch = validate_transactions(spark.read.schema(SCHEMAS["realtime_transactions"]).option("header", True).csv(str(source)))
    assert sorted(map(str, out.collect())) == sorted(map(str, batch.select(*out.columns).collect()))
    assert out.filter("validation_status = 'Duplicate Warning'").count() == 2

    write_day(source, "b.csv", [row(i, "2024-01-02") for i in range(5)])
    stream = jobs.read_transaction_stream(spark, str(source))
    jobs.stream_validate_transactions(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 36


def test_a_day_over_two_files_and_runs_is_judged_as_a_whole(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for name in ("a.csv", "b.csv"):
        write_day(source, name, [row(i, "2024-01-01") for i in range(30)])
        stream = jobs.read_transaction_stream(spark, str(source))
        jobs.stream_validate_transactions(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out")).drop("day")
    batch = validate_transactions(spark.read.schema(SCHEMAS["realtime_transactions"]).option("header", True).csv(str(source)))
    assert sorted(map(str, out.collect())) == sorted(map(str, batch.select(*out.columns).collect()))
    assert out.filter("is_duplicate").count() == 60


def test_daily_revenue_drops_late_rows_and_keeps_open_days(spark, tmp_path):
    source, out, check = tmp_path / "in", tmp_path / "out", tmp_path / "ck"
    source.mkdir()

    def run():
        jobs.stream_daily_revenue(jobs.read_transaction_stream(spark, str(source)), str(out), str(check)).awaitTermination()

    write_day(source, "1.csv", [row(i, "2024-01-01", amount=10) for i in range(3)])
    write_day(source, "2.csv", [row(i, "2024-01-02", amount=20) for i in range(3)] + [row(9, "2024-01-04", amount=5)])
    run()
    write_day(source, "3.csv", [row(8, "2024-01-01", amount=999), row(7, "2024-01-06", hour=12, amount=1)])
    run()
    got = {str(r["date"]): (float(r["revenue"]), r["transactions"]) for r in spark.read.parquet(str(out)).collect()}
    assert got == {"2024-01-01": (30.0, 3), "2024-01-02": (60.0, 3), "2024-01-04": (5.0, 1), "2024-01-06": (1.0, 1)}
    closed = (
        spark.read.schema(SCHEMAS["realtime_transactions"]).option("header", True).csv(str(source))
        .filter((F.col("amount") < 900) & (F.col("ts") < F.lit(dt.datetime(2024, 1, 7))))
        .groupBy(F.to_date("ts").alias("d")).agg(F.sum("amount").alias("a"))
    )
    assert {str(r["d"]): float(r["a"]) for r in closed.collect()} == {k: v[0] for k, v in got.items()}
