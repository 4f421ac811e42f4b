"""Skew-aware attach: heavy groups by bounded broadcast, light ones by join."""
from pyspark.sql import functions as F

from lmplake.operators.skew import attach_group_stats


def test_attach_matches_plain_join_with_heavy_and_light_groups(spark):
    rows = [("hot", i) for i in range(3000)] + [(f"g{i % 40}", i) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, v bigint")
    stats = df.groupBy("g").agg(F.min("v").alias("lo"), F.count(F.lit(1)).alias("_cnt"))
    got = attach_group_stats(df, stats, ["g"], max_heavy=4)  # threshold 850 rows: only "hot" is heavy
    ref = df.join(stats.drop("_cnt"), "g")
    assert sorted(got.collect()) == sorted(ref.collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_attach_semi_join_on_wider_key(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 11), ("b", 2, 12), ("b", 3, 13)], "g string, d int, v int")
    first = df.groupBy("g").agg(F.min("d").alias("d"), F.count(F.lit(1)).alias("_cnt"))
    got = attach_group_stats(df, first, ["g"], ["g", "d"], "left_semi", max_heavy=1)
    assert sorted(r.v for r in got.collect()) == [10, 12]
