"""Reading the driver tables and the logical inputs bound onto them.

The driver ships TPC-H-like tables without weather data, so the pipeline's
logical inputs are deterministic views over them. The same formulas are
written in SQL in ``tessera.plans.oracle`` so an independent engine can
recompute every result. Bindings use whole tables: every supplier is a
station, every customer a tract, every event an observation.

Fixed binding formulas (k = key):
    station  'S' || k (supplier)      lat 40 + ((37k) mod 101)/10     lon -125 + k/50     elev 180 + (97k mod 400)
    tract    'T' || k (customer)      lat 39.5 + ((79k) mod 1100)/100 lon -125.5 + k/730  elev 150 + (53k mod 500)
    obs      station 'S' || user_id, timestamp ts + (event_id mod 4)·91 days,
             wind direction ((37·event_id) mod 18)·10 — one half-plane, so no
             two observations cancel to a numerically undefined mean.
Stations and tracts both spread along longitude in proportion to their
count, so station density (≈4.5 within 50 km) stays constant across scale
factors and both the within-range and the nearest-station branches run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.geo import tract_bucket

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _d(c) -> F.Column:
    return c.cast("double")


def stg_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    return read_table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), k.cast("string")).alias("station"),
        F.col("s_name").alias("name"),
        (F.lit(40.0) + _d((k * 37) % 101) / 10).cast("float").alias("latitude"),
        (F.lit(-125.0) + _d(k) / 50).cast("float").alias("longitude"),
        F.lit(None).cast("float").alias("elevation"),
        (_d((k * 13) % 100) / 100).cast("float").alias("data_coverage"),
        F.make_date(F.lit(2020), (k % 12 + 1).cast("int"), F.lit(1)).alias("min_date"),
        F.make_date(F.lit(2024), F.lit(12), F.lit(31)).alias("max_date"),
    )


def stg_station_elevation(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    return read_table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), k.cast("string")).alias("station"),
        (F.lit(40.0) + _d((k * 37) % 101) / 10).cast("float").alias("latitude"),
        (F.lit(-125.0) + _d(k) / 50).cast("float").alias("longitude"),
        (F.lit(180) + (k * 97) % 400).cast("float").alias("elevation_m"),
    )


def stg_tracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    lat = (F.lit(39.5) + _d((k * 79) % 1100) / 100).cast("float")
    lon = (F.lit(-125.5) + _d(k) / 730).cast("float")
    return read_table(spark, sf_dir, "customer").select(
        F.concat(F.lit("T"), k.cast("string")).alias("tract"),
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("state_fips"),
        F.lpad((k % 1000).cast("string"), 3, "0").alias("county_fips"),
        k.cast("string").alias("tract_code"),
        lat.alias("centroid_lat"),
        lon.alias("centroid_lon"),
        (lon - F.lit(0.01)).cast("double").alias("bbox_minx"),
        (lat - F.lit(0.01)).cast("double").alias("bbox_miny"),
        (lon + F.lit(0.01)).cast("double").alias("bbox_maxx"),
        (lat + F.lit(0.01)).cast("double").alias("bbox_maxy"),
        F.lit(None).cast("binary").alias("geometry_wkb"),
    )


def stg_acs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A handful of demographic measures derived from customer columns."""
    k = F.col("c_custkey")
    return read_table(spark, sf_dir, "customer").select(
        F.concat(F.lit("T"), k.cast("string")).alias("tract"),
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("state_fips"),
        F.lpad((k % 1000).cast("string"), 3, "0").alias("county_fips"),
        k.cast("string").alias("tract_code"),
        (F.lit(1000) + (k * 7919) % 9000).cast("int").alias("population_total"),
        F.round(F.abs(F.col("c_acctbal")) * 10).cast("int").alias("median_household_income"),
        F.col("c_mktsegment").alias("segment"),
    )


def stg_tract_elevation(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return read_table(spark, sf_dir, "customer").select(
        F.concat(F.lit("T"), k.cast("string")).alias("tract"),
        (F.lit(150) + (k * 53) % 500).cast("float").alias("elevation_m"),
    )


def stg_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed sub-hourly observations (the staged weather table)."""
    e = read_table(spark, sf_dir, "events")
    v = F.col("value")
    eid = F.col("event_id")
    f32 = lambda c: c.cast("float")
    return e.select(
        F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("station"),
        F.timestamp_add("DAY", ((eid % 4) * 91).cast("int"), F.col("ts")).alias("timestamp"),
        f32(v).alias("dry_bulb_temp"),
        f32(v * 0.9).alias("wet_bulb_temp"),
        f32(v * 0.8).alias("dew_point_temp"),
        f32((eid * 7) % 101).alias("relative_humidity"),
        f32(v / 4).alias("wind_speed"),
        f32(((eid * 37) % 18) * 10).alias("wind_direction"),
        F.when(F.col("event_type").isin("click", "purchase"), f32(v / 2)).alias("wind_gust_speed"),
        F.when(F.col("event_type") != "error", f32(v / 100)).alias("precipitation"),
        f32(F.lit(10.0) - v / 10).alias("visibility"),
        f32(F.lit(29.0) + v / 100).alias("station_pressure"),
        f32(F.lit(30.0) - v / 200).alias("barometric_pressure"),
    )


def with_tract_bucket(df: DataFrame) -> DataFrame:
    return df.withColumn("tract_bucket", tract_bucket("tract"))


# --------------------------------------------------------------------------- generic sources / sinks


def preview(spark: SparkSession, path: str, n: int = 10) -> DataFrame:
    """SRC-10: query a Parquet path directly (a preview; the limit is the feature)."""
    return spark.sql(f"SELECT * FROM parquet.`{path}` LIMIT {int(n)}")


def describe_columns(df: DataFrame) -> DataFrame:
    """SRC-11: (position, column_name, data_type) of a relation, from its schema (no job)."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields, 1)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string")


def write_table(df: DataFrame, path: str, skip_if_exists: bool = False, fmt: str = "parquet") -> None:
    """SNK-02/04/05: full rebuild (overwrite), or leave an existing output untouched (``ignore``)."""
    df.write.mode("ignore" if skip_if_exists else "overwrite").format(fmt).save(path)
