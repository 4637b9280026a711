"""Registered queries of operators that other queries do not reach: all census variables, stagings, chunking, dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tessera.functions import calendar as C
from tessera.operators import calendar as OC
from tessera.operators import expectations as X
from tessera.operators import profile as PR
from tessera.plans.catalog import register
from tessera.plans.present import present
from tessera.plans.q_normalize import RAW_SQL, _num_sql, _station_payloads, raw_hourly_records, tract_polygons
from tessera.sources import normalize as N
from tessera.sources.schemas import ACS5_FLOAT_MEASURES, ACS5_VARIABLES
from tessera.sources.tables import read_table

# --- all census variables ------------------------------------------------------------------------------------------------


def _acs_raw(spark, d):
    """Every customer with all census variables as text: numbers with a fraction, blanks and junk."""
    k = F.col("c_custkey")
    values = [F.when((k + i) % 17 == 0, "(X)").when((k + i) % 23 == 0, "").otherwise(F.concat(((k * (i + 3)) % 9973).cast("string"), F.lit(".5" if i % 4 == 0 else ""))).alias(v)
              for i, v in enumerate(ACS5_VARIABLES)]
    return read_table(spark, d, "customer").select(F.col("c_nationkey").cast("string").alias("state"), (k % 1000).cast("string").alias("county"), k.cast("string").alias("tract"), *values)


_ACS_SQL = ("acs AS (SELECT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS state, lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') AS county, "
            "lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(6, length(CAST(c_custkey AS VARCHAR))) AS INTEGER), '0') AS tract_code, "
            + ", ".join(f"CASE WHEN (c_custkey + {i}) % 17 = 0 OR (c_custkey + {i}) % 23 = 0 THEN NULL ELSE CAST((c_custkey * {i + 3}) % 9973 AS DOUBLE){' + 0.5' if i % 4 == 0 else ''} END AS {n}"
                        for i, n in enumerate(ACS5_VARIABLES.values())) + " FROM customer)")


@register("norm_acs_all", f"WITH {_ACS_SQL} SELECT state, county, tract_code, state || county || tract_code AS tract, {', '.join(ACS5_VARIABLES.values())} FROM acs")
def q_acs_all(spark, sf_dir):
    """PRJ-10/12/13: all 63 variables of every tract, junk and blanks as NULL, in canonical order."""
    return N.normalize_acs(_acs_raw(spark, sf_dir))


@register("norm_acs_staged",
          f"WITH {_ACS_SQL} SELECT state || county || tract_code AS tract, state AS state_fips, county AS county_fips, tract_code, "
          + ", ".join(f"CAST({n} AS FLOAT) AS {n}" if n in ACS5_FLOAT_MEASURES else f"CAST(round({n}) AS INTEGER) AS {n}" for n in ACS5_VARIABLES.values()) + " FROM acs")
def q_acs_staged(spark, sf_dir):
    """PRJ-14: the census staging casts of all variables."""
    return N.stage_acs(N.normalize_acs(_acs_raw(spark, sf_dir)))


@register("norm_station_staged",
          "SELECT 'GHCND:' || CAST(s_suppkey AS VARCHAR) AS station, s_name AS name, CAST(40.0 + CAST((s_suppkey * 37) % 101 AS DOUBLE) / 10 AS FLOAT) AS latitude, "
          "CAST(-125.0 + CAST(s_suppkey AS DOUBLE) / 50 AS FLOAT) AS longitude, CASE WHEN s_suppkey % 3 <> 0 THEN CAST(180 + (s_suppkey * 97) % 400 AS FLOAT) END AS elevation, "
          "CAST(0.95 AS FLOAT) AS data_coverage, DATE '2020-01-01' AS min_date, DATE '2024-12-31' AS max_date FROM supplier")
def q_station_staged(spark, sf_dir):
    """PRJ-14: station metadata from paged payloads with its staging types."""
    return N.stage_station(N.parse_station_pages(_station_payloads(spark, sf_dir)))


@register("norm_elevation_staged",
          "SELECT CAST(s_suppkey AS VARCHAR) AS id, CAST(40.0 + CAST((s_suppkey * 37) % 101 AS DOUBLE) / 10 AS FLOAT) AS lat, CAST(-125.0 + CAST(s_suppkey AS DOUBLE) / 50 AS FLOAT) AS lon, "
          "CASE WHEN s_suppkey % 4 <> 0 THEN CAST(s_acctbal AS FLOAT) END AS elevation_m FROM supplier")
def q_elevation_staged(spark, sf_dir):
    """PRJ-11/14: coordinates with the elevation of a lookup's responses, some of them without a value."""
    k = F.col("s_suppkey")
    points = read_table(spark, sf_dir, "supplier").select(
        k.alias("id"), (F.lit(40.0) + ((k * 37) % 101).cast("double") / 10).alias("lat"), (F.lit(-125.0) + k.cast("double") / 50).alias("lon"),
        F.when(k % 4 == 0, "no data").otherwise(F.format_string('{"value": %s}', F.col("s_acctbal").cast("string"))).alias("body"))
    found = N.coordinate_triples(points, "id", "lat", "lon").join(points.select("id", N.parse_value_response("body").alias("elevation_m")), "id")
    return N.stage_elevation(found, "id")


@register("norm_files_one_station",
          "SELECT 'f' || CAST(event_id % 97 AS VARCHAR) || '.csv' AS source_file, count(DISTINCT user_id) AS n_stations FROM events GROUP BY 1 HAVING count(DISTINCT user_id) <> 1")
def q_files_one_station(spark, sf_dir):
    """PRJ-09: files whose rows do not all belong to one station."""
    e = read_table(spark, sf_dir, "events")
    rows = e.select(F.col("user_id").alias("station"), F.concat(F.lit("f"), (F.col("event_id") % 97).cast("string"), F.lit(".csv")).alias("source_file"))
    return N.files_with_station_count_not_one(rows)


@register("norm_years_to_process",
          "SELECT o_orderkey, concat_ws(',', year(o_orderdate) - 3, year(o_orderdate) - 2, year(o_orderdate) - 1) AS years FROM orders")
def q_years_to_process(spark, sf_dir):
    """PRJ-18: the three complete years before each order."""
    return present(read_table(spark, sf_dir, "orders").select("o_orderkey", N.years_to_process("o_orderdate", 3).alias("years")))


@register("norm_list_chunks",
          "WITH keys AS (SELECT l_orderkey, list_sort(list(l_linenumber)) AS k FROM lineitem GROUP BY 1) "
          "SELECT l_orderkey, CAST(i / 3 AS INTEGER) AS chunk, array_to_string(k[i + 1 : i + 3], ',') AS lines FROM (SELECT l_orderkey, k, unnest(range(0, len(k), 3)) AS i FROM keys)")
def q_list_chunks(spark, sf_dir):
    """PRJ-19: the line numbers of every order in lists of three."""
    keys = read_table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_linenumber")).alias("k"))
    return keys.select("l_orderkey", F.posexplode(N.chunk_list("k", 3)).alias("chunk", "lines")).withColumn("lines", F.array_join("lines", ","))


@register("norm_tract_wkb", "SELECT 'T' || CAST(c_custkey AS VARCHAR) AS tract, hex('0103' || c_name) AS wkb FROM customer")
def q_tract_wkb(spark, sf_dir):
    """GEO-15: the binary geometry passes through normalization unchanged."""
    raw = tract_polygons(spark, sf_dir).withColumn("geometry_wkb", F.concat(F.lit("0103"), F.col("NAME")).cast("binary"))
    return N.normalize_tracts(raw).select("tract", F.hex("geometry_wkb").alias("wkb"))


# --- profiles ------------------------------------------------------------------------------------------------------------

_SPARSE = {"HourlyWindSpeed": "signup", "HourlyWindDirection": "view", "HourlyWindGustSpeed": "purchase"}


@register("prof_daily_any_of",
          "SELECT CAST(ts AS DATE) AS date, CAST(count_if(event_type IN ('signup', 'view', 'purchase') AND NOT (event_type = 'signup')) AS BIGINT) AS daily_rows_with_values FROM events GROUP BY 1")
def q_daily_any_of(spark, sf_dir):
    """AGG-17/FLT-03: rows with any of three sparse fields, each filled for one kind of event only."""
    raw = read_table(spark, sf_dir, "events").select(
        F.col("ts"), *[F.when(F.col("event_type") == kind, "" if kind == "signup" else kind).alias(f) for f, kind in _SPARSE.items()])
    return PR.daily_populated_rows(raw, F.col("ts"), list(_SPARSE))


_MEASURES = {"HourlyDryBulbTemperature": "dry_bulb_temp", "HourlyPrecipitation": "precipitation", "HourlyAltimeterSetting": "barometric_pressure"}


@register("prof_measures_present", "WITH " + RAW_SQL + " SELECT " + ", ".join(f"count({_num_sql(r)}) AS {n}" for r, n in _MEASURES.items()) + " FROM raw")
def q_measures_present(spark, sf_dir):
    """PRJ-04/08: how many records keep a value after cleaning."""
    rows = N.normalize_hourly(raw_hourly_records(spark, sf_dir))
    return rows.agg(*[F.count(n).alias(n) for n in _MEASURES.values()])


# --- dates ---------------------------------------------------------------------------------------------------------------

_AT = dt.datetime(2024, 3, 10, 9, 30, 15)
_AT_SQL = "TIMESTAMP '2024-03-10 09:30:15'"
_ZONES = ("America/New_York", "Asia/Kolkata", "Pacific/Auckland")


@register("cal_now_zones",
          "SELECT n_nationkey, " + ", ".join(f"({_AT_SQL} AT TIME ZONE 'UTC') AT TIME ZONE '{z}' AS now_{i}, CAST(({_AT_SQL} AT TIME ZONE 'UTC') AT TIME ZONE '{z}' AS DATE) AS today_{i}"
                                            for i, z in enumerate(_ZONES)) + " FROM nation")
def q_now_zones(spark, sf_dir):
    """DAT-16: a given now, and its date, in three zones."""
    cols = [c for i, z in enumerate(_ZONES) for c in (C.now(z, _AT).alias(f"now_{i}"), C.today(z, _AT).alias(f"today_{i}"))]
    return read_table(spark, sf_dir, "nation").select("n_nationkey", *cols)


@register("cal_orders_since_now",
          f"SELECT o_orderkey, date_diff('day', o_orderdate, {_AT_SQL}) AS days, date_diff('month', o_orderdate, {_AT_SQL}) AS months FROM orders")
def q_since_now(spark, sf_dir):
    """DAT-16/22: periods from every order to a given now."""
    at = C.now(at=_AT)
    return read_table(spark, sf_dir, "orders").select("o_orderkey", C.periods_since("o_orderdate", "day", at).alias("days"), C.periods_since("o_orderdate", "month", at).alias("months"))


@register("cal_date_constructors",
          "SELECT r_regionkey, DATE '2024-02-29' AS d, TIMESTAMP '2024-02-29 23:59:58' AS t, "
          "(TIMESTAMP '2024-07-01 12:00:00' AT TIME ZONE 'America/Los_Angeles') AT TIME ZONE 'UTC' AS tz FROM region")
def q_date_constructors(spark, sf_dir):
    """DAT-24: dates and timestamps from their parts, one of them in a zone (as its UTC time)."""
    return read_table(spark, sf_dir, "region").select(
        "r_regionkey", C.date(2024, 2, 29).alias("d"), C.datetime(2024, 2, 29, 23, 59, 58).alias("t"), C.datetime(2024, 7, 1, 12, tz="America/Los_Angeles").alias("tz"))


@register("cal_orders_per_hour_dim",
          "WITH span AS (SELECT date_trunc('day', max(ts)) AS today FROM events), h AS (SELECT unnest(range(today - INTERVAL 28 DAY, today + INTERVAL 1 DAY, INTERVAL 1 HOUR)) AS date_hour FROM span) "
          "SELECT date_hour, count(event_id) AS n_events FROM h LEFT JOIN events ON date_trunc('hour', ts) = date_hour GROUP BY 1")
def q_per_hour(spark, sf_dir):
    """DAT-33: events per hour of the last day and the 28 before it, over the hour dimension."""
    e = read_table(spark, sf_dir, "events")
    today = e.agg(F.max("ts")).first()[0].date()
    hours = OC.dim_hour(spark, today)
    n = e.groupBy(C.date_trunc("hour", F.col("ts")).alias("date_hour")).agg(F.count("event_id").alias("n_events"))
    return hours.join(n, "date_hour", "left").select("date_hour", F.coalesce("n_events", F.lit(0)).alias("n_events"))


@register("cal_orders_per_week_dim",
          "WITH span AS (SELECT date_trunc('week', max(o_orderdate)) AS today FROM orders), w AS (SELECT unnest(range(CAST(today AS TIMESTAMP) - INTERVAL 364 DAY, CAST(today AS TIMESTAMP), INTERVAL 7 DAY)) AS date_week FROM span) "
          "SELECT date_week, count(o_orderkey) AS n_orders FROM w LEFT JOIN orders ON date_trunc('week', o_orderdate) = date_week GROUP BY 1")
def q_per_week(spark, sf_dir):
    """DAT-33: orders per week of the 52 before the week of the last order, over the week dimension."""
    orders = read_table(spark, sf_dir, "orders")
    today = orders.agg(F.max(C.date_trunc("week", F.col("o_orderdate")))).first()[0]
    weeks = OC.dim_week(spark, today.date() if hasattr(today, "date") else today)
    n = orders.groupBy(C.date_trunc("week", F.col("o_orderdate")).alias("date_week")).agg(F.count("o_orderkey").alias("n_orders"))
    return weeks.join(n, "date_week", "left").select("date_week", F.coalesce("n_orders", F.lit(0)).alias("n_orders"))


# --- small helpers ---------------------------------------------------------------------------------------------------------

@register("exp_regex_flag_alphabet",
          "SELECT c_custkey, regexp_matches(c_mktsegment, 'auto', 'i') AS i, regexp_matches(c_mktsegment, 'auto') AS c, regexp_matches(c_name || chr(10) || c_mktsegment, 'r.*a', 's') AS s, "
          "regexp_matches(lower(c_name || chr(10) || c_mktsegment), 'r#[^' || chr(10) || ']*bu') AS p FROM customer")
def q_regex_flags(spark, sf_dir):
    """FUN-05: flags of the checks' alphabet: i, c (after i), s, and p (after s) with i."""
    two = F.concat("c_name", F.lit("\n"), "c_mktsegment")
    m = lambda col, pattern, flags: col.rlike(X._regex(pattern, flags=flags))
    return read_table(spark, sf_dir, "customer").select(
        "c_custkey", m(F.col("c_mktsegment"), "auto", "i").alias("i"), m(F.col("c_mktsegment"), "auto", "ic").alias("c"), m(two, "r.*a", "s").alias("s"),
        m(two, "r#.*bu", "spi").alias("p"))


@register("exp_expression_for_column",
          "SELECT (l_quantity < 40) AS expression FROM lineitem WHERE l_returnflag = 'R' AND NOT (l_quantity < 40)")
def q_expression_for_column(spark, sf_dir):
    """EXP-69: rows that meet a condition and fail an expression on one column."""
    return X.expression_is_true_for_column(read_table(spark, sf_dir, "lineitem"), "l_quantity", "< 40", "l_returnflag = 'R'")


@register("fun_type_names",
          "SELECT o_orderkey, CAST('2024-01-02 03:04:05' AS TIMESTAMP) AS ts, 'timestamp_ntz' AS kind FROM orders")
def q_type_names(spark, sf_dir):
    """FUN-09: the type name casts text to the timestamps used throughout."""
    ts = F.lit("2024-01-02 03:04:05").cast(C.type_timestamp())
    return read_table(spark, sf_dir, "orders").select("o_orderkey", ts.alias("ts"), F.typeof(ts).alias("kind"))


@register("fun_seeded_rand",
          "SELECT count(*) AS n, count(*) AS inside, true AS again, true AS spread FROM lineitem")
def q_seeded_rand(spark, sf_dir):
    """FUN-02: a value in [0, 1) for every row, the same for the same seed, spread over the interval."""
    li = read_table(spark, sf_dir, "lineitem").select(X.seeded_rand(7).alias("a"), X.seeded_rand(7).alias("b"))
    inside = F.count_if((F.col("a") >= 0) & (F.col("a") < 1))
    return li.agg(F.count(F.lit(1)).alias("n"), inside.alias("inside"), (F.count_if(F.col("a") != F.col("b")) == 0).alias("again"),
                  (F.abs(F.avg("a") - 0.5) < 0.05).alias("spread"))
