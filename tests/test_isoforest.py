"""Isolation trees draw from all rows, however many there are."""

from pyspark.sql import functions as F

from revenuelake.operators import isoforest


def test_draws_reach_every_part_of_a_large_table(spark):
    rows = spark.range(60_000).select(F.col("id").cast("string").alias("k"), F.rand(3).alias("x"), F.rand(4).alias("y"))
    nodes = isoforest.grow_trees(rows, ["x", "y"], "k", 60_000, trees=20, sample_rows=128)
    plan = nodes._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "TakeOrdered" not in plan and "GlobalLimit" not in plan
    sizes = nodes.groupBy("tree").count().collect()
    assert len(sizes) == 20 and all(r["count"] > 60 for r in sizes)


def test_small_tables_are_drawn_whole(spark):
    rows = spark.range(100).select(F.col("id").cast("string").alias("k"), (F.col("id") % 10).cast("double").alias("x"))
    far = rows.unionByName(spark.range(1).select(F.lit("far").alias("k"), F.lit(1000.0).alias("x")))
    scored = isoforest.isolation_scores(far, ["x"], "k", trees=50)
    assert scored.orderBy("anomaly_score").first()["k"] == "far"
