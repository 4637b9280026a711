"""What keeps the ordered operators in proportion to their rows: folded bounds, small carries, no hot key in one task."""

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.operators import ordered as O


def test_bounds_are_folded_into_one_literal(spark):
    df = spark.range(5000).select("id", F.concat(F.lit("o'"), "id").alias("s"))
    bounds = O.range_bounds(df, ["s", "id"], 40)
    plan = df.select(O.range_of(df, ["s", "id"], bounds).alias("r"))._jdf.queryExecution().optimizedPlan().toString()
    assert len(bounds) == 39 and "arrays_zip" not in plan and "named_struct(n0, false" not in plan


def test_ranges_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(O, "RANGE_ROWS", 100)
    assert len(O.range_bounds(spark.range(5000), ["id"], 7)) > 40


def test_rows_are_placed_once(spark):
    df = spark.range(3000).select((F.col("id") * 7 % 1000).alias("o"), (F.col("id") % 13).alias("v"))
    plan = O.previous_in_order(df, "v", ["o"], None, "p", num_ranges=6)
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert "ReusedExchange" in plan.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


@pytest.mark.parametrize("size", [3, 400])
def test_small_and_large_groups(spark, size):
    df = spark.range(2400).select(F.when(F.col("id") >= size, F.floor(F.col("id") / size)).alias("g"), (F.col("id") * 11 % 2400).alias("o"), (F.col("id") % 5).alias("v"))
    want = df.withColumn("p", F.lag("v").over(W.partitionBy("g").orderBy("o")))
    got = O.previous_in_order(df, "v", ["o"], ["g"], "p", num_ranges=20)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("part", [["p"], []])
def test_totals_of_hot_keys_are_broadcast(spark, monkeypatch, part):
    monkeypatch.setattr(O, "HOT_ROWS", 50)
    df = spark.range(900).select((F.col("id") % 2).alias("p"), F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 400).alias("o"), "id")
    want = df.withColumn("t", F.sum("id").over(W.partitionBy(*part).orderBy(F.col("o").asc_nulls_last()).rangeBetween(W.unboundedPreceding, W.currentRow)))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = O.running_total(df, "id", part, "o", False, "t", num_ranges=5)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        sizes = [len(p) for p in got.select("o").rdd.glom().collect()]
        assert max(sizes) < (150 if part else 300)  # the rows that share a key
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
