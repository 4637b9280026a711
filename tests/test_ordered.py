"""Range-cut lag, refined quantiles and prefix sums against Spark's single-task forms."""

import math
import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.operators import ordered as O


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    data = [(rng.choice(["a", "b'\\", None]), rng.choice([None, rng.randrange(50), 7, 7]), rng.choice([None, rng.random() * 10, 3.0]), rng.choice("xy"))
            for _ in range(3000)]
    return spark.createDataFrame(data, "g string, o int, v double, e string").cache()


@pytest.mark.parametrize("group", [["g"], []])
@pytest.mark.parametrize("num_ranges", [1, 2, 40])
def test_previous_row(rows, group, num_ranges):
    rest = [] if group else ["g"]
    order = [F.col(c).asc_nulls_last() for c in ["o", "v", *rest, "e"]]
    want = rows.withColumn("p", F.lag("v").over(W.partitionBy(*group).orderBy(*order)))
    got = O.previous_in_order(rows, "v", ["o", "v"], group, "p", num_ranges=num_ranges)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_carry_passes_ranges_without_the_group(spark):
    df = spark.createDataFrame([("a", i) for i in range(100)] + [("b", 1000)], "g string, o int")
    got = O.previous_in_order(df, "o", ["o"], ["g"], "p", num_ranges=30)
    assert got.where("p = o - 1").count() == 99 and got.where("g = 'b' and p is null").count() == 1


def test_ranges_are_even_under_a_hot_key(spark):
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"), "id")
    bounds = O.range_bounds(df, ["k", "id"], 16)
    sizes = [r[0] for r in df.groupBy(O.range_of(df, ["k", "id"], bounds).alias("r")).count().select("count").collect()]
    assert len(sizes) == 16 and max(sizes) < 2.5 * 60_000 / 16


def test_equal_rows_are_one_row_per_task(spark):
    df = spark.createDataFrame([(5, 1.0)] * 4000 + [(i, 2.0) for i in range(100)], "k int, v double")
    counted = df.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    assert counted.count() == 101  # what is sorted
    out = O.previous_in_order(df, "v", ["k"], None, "p", num_ranges=4)
    assert out.count() == 4100 and out.where("k = 5 and v = 1 and p = 1").count() == 3999


def test_range_lookup_is_a_binary_search(spark):
    df = spark.range(-5, 400).select((F.col("id") / 2).alias("x"))
    bounds = [(str(float(b)),) for b in range(0, 150, 7)]
    got = {r["x"]: r["r"] for r in df.select("x", O.range_of(df, ["x"], bounds).alias("r")).collect()}
    assert all(r == sum(float(b[0]) <= x for b in bounds) for x, r in got.items())


@pytest.mark.parametrize("values", [
    [0.0] * 900 + [k / 7 - 40 for k in range(900)], [1.0 + k * 2**-52 for k in range(900)], [-5.0, 3.0], [2.0],
    [1e-300 * k for k in range(1, 60)] + [1e300] * 5 + [-1e-310], [float("inf"), 1.0, -float("inf")], [float("nan"), 1.0, 2.0, 3.0]], ids=range(7))
@pytest.mark.parametrize("quantile", [0.0, 0.3, 0.5, 1.0])
def test_quantile_equals_percentile(spark, values, quantile):
    df = spark.createDataFrame([(["a", None, "c"][k * k % 3], v) for k, v in enumerate(values)] + [("none", None)], "g string, v double")
    got = {r["g"]: r["quantile"] for r in O.group_quantile(df, "v", quantile, ["g"]).collect()}
    want = {r["g"]: r["q"] for r in df.where("v is not null").groupBy("g").agg(F.percentile("v", quantile).alias("q")).collect()}
    assert got.keys() == want.keys()
    for g, q in want.items():
        assert got[g] == q or math.isclose(got[g], q, rel_tol=1e-14) or math.isnan(got[g]) and math.isnan(q)


@pytest.mark.parametrize("part", [["p"], []])
@pytest.mark.parametrize("descending", [False, True])
def test_running_total(spark, part, descending):
    rng = random.Random(3)
    data = [(rng.choice(["a", None, "c"]), rng.choice([None, rng.randrange(20), 4]), rng.choice([None, rng.randrange(9)])) for _ in range(500)]
    df = spark.createDataFrame(data, "p string, o int, v int")
    order = F.col("o").desc_nulls_first() if descending else F.col("o").asc_nulls_last()
    want = df.withColumn("t", F.sum("v").over(W.partitionBy(*part).orderBy(order).rangeBetween(W.unboundedPreceding, W.currentRow)))
    for num_ranges in (1, 7):
        got = O.running_total(df, "v", part, "o", descending, "t", num_ranges)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_nothing_is_written_and_no_range_shuffle(spark, rows, monkeypatch):
    import tessera.session as session

    monkeypatch.setattr(session, "cut_lineage", lambda df: pytest.fail("a table was written"))
    for df in (O.previous_in_order(rows, "v", ["o"], ["g"], num_ranges=5), O.group_quantile(rows, "v", 0.5, ["g"]), O.running_total(rows, "v", [], "o", num_ranges=5)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan and df.count() > 0


def test_empty_input(spark):
    df = spark.createDataFrame([], "g string, o int, v double")
    assert O.previous_in_order(df, "v", ["o"], ["g"]).isEmpty()
    assert O.group_quantile(df, "v", 0.5, ["g"]).isEmpty() and O.running_total(df, "v", [], "o").isEmpty()
