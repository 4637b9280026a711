"""The fact summed in blocks of tracts against the fact by one shuffle of the fan-out."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import tract_hourly as TH
from tessera.plans import dag as P
from tessera.plans.present import present
from tessera.session import cut_lineage, scratch_scope

SMOKE = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in df.select(*TH.FACT_COLUMNS).collect())


def _inputs(spark, copies=1):
    """Hours of 12 stations, weights of 40 tracts in three blocks (one without a place), and the places."""
    rng = random.Random(5)
    hours = [(f"S{rng.randrange(12)}", None if i == 3 else i % 300, None if i % 5 == 0 else rng.random(), None if i % 7 == 0 else rng.random() * 180) for i in range(900)]
    h = spark.createDataFrame(hours, "station string, n int, v double, wind_direction double").select(
        "station", F.expr("timestampadd(HOUR, n * 20, timestamp_ntz '2024-01-01')").alias("floored_timestamp"), "wind_direction",
        *[(F.col("v") * (i + 1)).alias(m) for i, m in enumerate(TH.WEIGHTED_MEASURES)])
    sets = [(f"T{t}", s, sorted(rng.sample([f"S{k}" for k in range(14)], 3))) for t in range(40) for s in ("DJF", "MAM", "JJA", "SON")]
    weights = [(st, t, s, rng.random(), used) for t, s, used in sets for st in used] * copies
    w = spark.createDataFrame(weights, "station string, tract string, season string, final_weight double, stations_used array<string>")
    places = spark.createDataFrame([(f"T{t}", float(t % 3) * 5, None if t == 7 else 179.0 + t % 3) for t in range(39)], "tract string, centroid_lat double, centroid_lon double")
    return h.groupBy("station", "floored_timestamp").agg(*[F.max(c).alias(c) for c in h.columns[2:]]), w, places


@pytest.mark.parametrize("copies", [1, 2])
@pytest.mark.parametrize("slice_rows", [50, 10**6])
def test_blocks_give_the_same_fact(spark, monkeypatch, copies, slice_rows):
    monkeypatch.setattr(TH, "SLICE_ROWS", slice_rows)
    monkeypatch.setattr(TH, "PART_ROWS", 200)
    h, w, places = _inputs(spark, copies)
    want = _rows(TH.tract_hourly(h, w))
    assert want and _rows(TH.tract_hourly(h, w, places)) == want


def test_the_fan_out_is_not_shuffled(spark):
    plan = P.fact_tract_hourly(spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[-1]
    above = plan[: plan.index("Union")]  # what runs on hours beside weights
    assert above.count("Exchange") == 1 and "Generate" in above and "REPARTITION_BY_NUM" in above


def test_rows_with_nulls_give_the_same_fact(spark):
    h, w, places = _inputs(spark)
    n = F.abs(F.hash("station", "floored_timestamp")) % 11
    h = h.withColumn("floored_timestamp", F.when(n != 3, F.col("floored_timestamp"))).withColumn("station", F.when(n != 4, F.col("station")))
    h = h.withColumn("dry_bulb_temp", F.when(n == 5, float("nan")).otherwise(F.col("dry_bulb_temp")))
    k = F.abs(F.hash("station", "tract", "season")) % 13
    w = w.select(*[F.when(k != i, F.col(c)).alias(c) for i, c in enumerate(w.columns)])
    want = _rows(TH.tract_hourly(h, w))
    assert "None, " in want[0] + want[-1] and _rows(TH.tract_hourly(h, w, places)) == want


def test_a_tract_of_many_hours_comes_in_several_rows(spark, tmp_path):
    hours = spark.range(10000).select(F.lit("S0").alias("station"), F.expr("timestampadd(MINUTE, id, timestamp_ntz '2024-03-01')").alias("floored_timestamp"),
                                      F.lit(90.0).alias("wind_direction"), *[F.col("id").cast("double").alias(m) for m in TH.WEIGHTED_MEASURES])
    w = spark.createDataFrame([("S0", "T0", "MAM", 0.5, ["S0"])], "station string, tract string, season string, final_weight double, stations_used array<string>")
    places = spark.createDataFrame([("T0", 1.0, 1.0)], "tract string, centroid_lat double, centroid_lon double")
    got = TH.tract_hourly(hours, w, places, form_set=lambda s: F.array_join(s, ",")).agg(
        F.count("*"), F.count_distinct("floored_timestamp"), F.sum("weighted_visibility"), F.max("stations_used")).first()
    assert tuple(got) == (10000, 10000, 0.5 * 9999 * 5000, "S0")


def test_the_weights_are_not_written_whole(spark):
    with scratch_scope(spark) as paths:
        P.fact_tract_hourly(spark, SMOKE)
        written = [set(spark.read.parquet(p).columns) for p in paths]
    assert any("weights" in c for c in written) and not any(c & {"raw_weight", "final_weight", "stations_used"} for c in written)


def test_a_written_table_leaves_no_shuffle_files(spark):
    import time

    files = lambda: {str(f) for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}
    before = files()
    kept = cut_lineage(spark.range(1000).repartition(4, "id"))
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before
    assert kept.count() == 1000


def test_presented_values_are_those_of_round(spark):
    rng = random.Random(3)
    halves = [(2 * rng.randrange(-10**8, 10**8) + 1) / 2e6 for _ in range(2000)]
    values = halves + [rng.uniform(-1, 1) * 10 ** rng.randrange(-9, 17) for _ in range(4000)] + [0.0, -0.0, -1e-9, 2.5e-7, 5e-7, float("nan"), float("inf"), None, 1e308]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [str(r[0]) for r in present(df).collect()] == [str(r[0]) for r in df.select(F.round("v", 6)).collect()]
