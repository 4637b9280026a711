"""Registered profiling queries and the model check suite."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import expectations as X
from tessera.operators import profile as PR
from tessera.operators.suite import Check, Declared, run_declared, run_suite
from tessera.plans import dag as P
from tessera.plans.catalog import register
from tessera.plans.present import present
from tessera.plans.q_normalize import RAW_SQL, raw_hourly_records
from tessera.sources import tables as T
from tessera.sources.tables import TABLES, read_table

_FIELDS = ["HourlyDryBulbTemperature", "HourlyWetBulbTemperature", "HourlyDewPointTemperature", "HourlyRelativeHumidity",
           "HourlyWindSpeed", "HourlyWindDirection", "HourlyWindGustSpeed", "HourlyPrecipitation", "HourlyVisibility",
           "HourlyStationPressure", "HourlyAltimeterSetting"]

_DAILY_SQL = ("daily AS (SELECT CAST(TRY_CAST(DATE AS TIMESTAMP) AS DATE) AS date, "
              "CAST(count_if(coalesce(HourlyWindSpeed, '') <> '') AS BIGINT) AS daily_rows_with_values FROM raw GROUP BY 1)")


@register("prof_daily_populated", "WITH " + RAW_SQL + ", " + _DAILY_SQL + " SELECT * FROM daily")
def q_daily(spark, sf_dir):
    """AGG-17: rows with any populated (daily) field per date."""
    r = raw_hourly_records(spark, sf_dir)
    return PR.daily_populated_rows(r, F.col("DATE").try_cast("timestamp_ntz"), ["HourlyWindSpeed"])


_DUPES_SQL = "dupes AS (SELECT STATION, DATE, count(*) AS count FROM raw GROUP BY 1, 2 HAVING count(*) > 1)"


@register("prof_duplicate_timestamps", "WITH " + RAW_SQL + ", " + _DUPES_SQL + " SELECT * FROM dupes")
def q_dupes(spark, sf_dir):
    """AGG-16: duplicate (station, timestamp) records."""
    return PR.duplicate_keys(raw_hourly_records(spark, sf_dir), ["STATION", "DATE"])


_GAPS_SQL = (
    "obs AS (SELECT 'S' || CAST(user_id AS VARCHAR) AS station, ts + to_days(CAST((event_id % 4) * 91 AS INTEGER)) AS dt FROM events), "
    "lagged AS (SELECT station, dt, lag(dt) OVER (PARTITION BY station ORDER BY dt) AS prev_dt FROM obs), "
    "gaps AS (SELECT station, dt, prev_dt, CAST(floor((epoch_us(dt) - epoch_us(prev_dt)) / 1000000) AS BIGINT) AS delta_seconds "
    "FROM lagged WHERE prev_dt IS NOT NULL AND (epoch_us(dt) - epoch_us(prev_dt)) / 1000000 > 0)")


@register("prof_large_gaps",
          "WITH " + _GAPS_SQL + " SELECT * FROM gaps WHERE delta_seconds > 604800")
def q_gaps(spark, sf_dir):
    """WIN-13: observation gaps longer than 7 days per station."""
    return PR.large_gaps(T.stg_hourly(spark, sf_dir), "timestamp", 604800, ["station"]).withColumnRenamed(
        "station", "station")


@register(
    "prof_quality_summary",
    "WITH " + RAW_SQL + ", " + _DAILY_SQL + ", " + _DUPES_SQL + ", " + _GAPS_SQL
    + " SELECT (SELECT CAST(count_if(daily_rows_with_values = 0) AS BIGINT) FROM daily) AS days_with_zero_daily_rows, "
      "(SELECT CAST(count_if(daily_rows_with_values > 1) AS BIGINT) FROM daily) AS days_with_multiple_daily_rows, "
      "(SELECT count(*) FROM dupes) AS duplicate_timestamps, "
      "(SELECT count(*) FROM gaps WHERE delta_seconds > 604800) AS large_gaps",
)
def q_quality_summary(spark, sf_dir):
    """AGG-20: the four data-quality counters in one row."""
    r = raw_hourly_records(spark, sf_dir)
    daily = PR.daily_populated_rows(r, F.col("DATE").try_cast("timestamp_ntz"), ["HourlyWindSpeed"])
    dupes = PR.duplicate_keys(r, ["STATION", "DATE"])
    gaps = PR.large_gaps(T.stg_hourly(spark, sf_dir), "timestamp", 604800, ["station"])
    return PR.quality_summary(daily, dupes, gaps)


@register(
    "prof_column_population",
    "WITH " + RAW_SQL + " SELECT field, non_empty, empty, round(CAST(non_empty AS DOUBLE) / CAST(non_empty + empty AS DOUBLE) * 100, 6) "
    "AS pct_populated FROM (" + " UNION ALL ".join(
        f"SELECT '{f}' AS field, CAST(count_if({f} <> '') AS BIGINT) AS non_empty, CAST(count_if({f} = '') AS BIGINT) AS empty "
        f"FROM raw" for f in _FIELDS) + ")",
)
def q_population(spark, sf_dir):
    """AGG-18: per-column population profile."""
    return present(PR.column_population(raw_hourly_records(spark, sf_dir), _FIELDS))


@register(
    "prof_example_values",
    "WITH " + RAW_SQL + ", long AS (SELECT DISTINCT field, value FROM (" + " UNION ALL ".join(
        f"SELECT '{f}' AS field, {f} AS value FROM raw" for f in _FIELDS) + ") WHERE value <> '') "
    "SELECT field, value, rank FROM (SELECT *, row_number() OVER (PARTITION BY field ORDER BY value) AS rank FROM long) WHERE rank <= 5",
)
def q_examples(spark, sf_dir):
    """SRT-03: five example values per column."""
    return PR.example_values(raw_hourly_records(spark, sf_dir), _FIELDS, 5).select("field", "value", F.col("rank").cast("bigint"))


@register(
    "prof_top_elevation",
    "SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS station, s_name AS name, CAST(180 + (s_suppkey * 97) % 400 AS FLOAT) AS elevation_m "
    "FROM supplier ORDER BY elevation_m DESC, station ASC LIMIT 10",
)
def q_top_elevation(spark, sf_dir):
    """SRT-02: the ten highest stations (a top-k report)."""
    d = P.dim_station(spark, sf_dir).select("station", "name", "elevation_m")
    return PR.top_k(d, [F.desc("elevation_m"), F.asc("station")], 10)


@register(
    "prof_decade_histogram",
    "SELECT CAST(floor(CAST(substr(CAST(l_shipdate AS VARCHAR), 1, 4) AS INTEGER) / 10) * 10 AS INTEGER) AS decade, "
    "count(*) AS station_count FROM lineitem GROUP BY 1",
)
def q_decades(spark, sf_dir):
    """AGG-19: rows per decade of the date text."""
    li = read_table(spark, sf_dir, "lineitem")
    return PR.decade_histogram(li, F.col("l_shipdate").cast("string"))


@register("prof_row_counts", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES))
def q_row_counts(spark, sf_dir):
    """AGG-21: row count of every table."""
    return PR.row_counts({t: read_table(spark, sf_dir, t) for t in TABLES})


# The checks declared on the pipeline's models, as data: (kind, model, column(s), extra).
_MODEL_CHECKS = [
    ("not_null", "stg_hourly", "station", None), ("relationships", "stg_hourly", "station", ("stg_station", "station")),
    ("not_null", "stg_hourly", "timestamp", None),
    ("not_null", "stg_station", "station", None), ("unique", "stg_station", "station", None),
    ("not_null", "stg_tracts", "tract", None), ("unique", "stg_tracts", "tract", None),
    ("relationships", "stg_acs", "tract", ("stg_tracts", "tract")),
    ("not_null", "stg_tract_elevation", "tract", None), ("unique", "stg_tract_elevation", "tract", None),
    ("relationships", "stg_tract_elevation", "tract", ("stg_tracts", "tract")),
    ("not_null", "stg_station_elevation", "station", None), ("unique", "stg_station_elevation", "station", None),
    ("not_null", "dim_station", "station", None), ("unique", "dim_station", "station", None),
    ("relationships", "dim_station", "station", ("stg_station", "station")),
    ("relationships", "dim_station", "station", ("stg_station_elevation", "station")),
    *[("not_null", "dim_station", c, None) for c in ("latitude", "longitude", "elevation_m")],
    ("not_null", "dim_tract", "tract", None), ("unique", "dim_tract", "tract", None),
    ("relationships", "dim_tract", "tract", ("stg_tracts", "tract")), ("relationships", "dim_tract", "tract", ("stg_acs", "tract")),
    ("relationships", "dim_tract", "tract", ("stg_tract_elevation", "tract")),
    *[("not_null", "dim_tract", c, None) for c in ("tract_bucket", "elevation_m", "centroid_lat", "centroid_lon", "bbox_minx",
                                                   "bbox_miny", "bbox_maxx", "bbox_maxy")],
    ("between", "dim_tract", "tract_bucket", (0, 15)),
    ("not_null", "int_hourly", "station", None), ("relationships", "int_hourly", "station", ("stg_station", "station")),
    ("not_null", "int_hourly", "floored_timestamp", None),
    ("not_null", "prevailing_wind", "station", None),
    ("relationships", "prevailing_wind", "station", ("stg_station", "station")),
    ("not_null", "prevailing_wind", "season", None),
    ("accepted_values", "prevailing_wind", "season", ("DJF", "MAM", "JJA", "SON")),
    ("between", "prevailing_wind", "prevailing_wind_direction_deg", (0, 360)),
    ("unique", "prevailing_wind", ("station", "season"), None),
    *[("not_null", "rel_tract_station_distance", c, None) for c in ("station", "tract", "distance_m", "bearing_deg",
                                                                     "elevation_diff_m")],
    ("relationships", "rel_tract_station_distance", "station", ("dim_station", "station")),
    ("relationships", "rel_tract_station_distance", "tract", ("dim_tract", "tract")),
    ("between", "rel_tract_station_distance", "distance_m", (0, None)),
    ("between", "rel_tract_station_distance", "bearing_deg", (0, 360)),
    ("unique", "rel_tract_station_distance", ("station", "tract"), None),
    *[("not_null", "rel_station_weights", c, None) for c in ("station", "tract", "season", "wind_alignment",
                                                              "elevation_penalty", "distance_factor", "raw_weight",
                                                              "final_weight", "stations_used")],
    ("relationships", "rel_station_weights", "station", ("dim_station", "station")),
    ("relationships", "rel_station_weights", "tract", ("dim_tract", "tract")),
    ("accepted_values", "rel_station_weights", "season", ("DJF", "MAM", "JJA", "SON")),
    *[("between", "rel_station_weights", c, (0, 1)) for c in ("wind_alignment", "elevation_penalty", "distance_factor",
                                                               "raw_weight", "final_weight")],
    ("unique", "rel_station_weights", ("station", "tract", "season"), None),
    ("not_null", "fact_tract_hourly", "tract", None), ("relationships", "fact_tract_hourly", "tract", ("dim_tract", "tract")),
    ("not_null", "fact_tract_hourly", "floored_timestamp", None), ("not_null", "fact_tract_hourly", "stations_used", None),
    ("between", "fact_tract_hourly", "weighted_wind_direction", (0, 360)),
    ("unique", "fact_tract_hourly", ("tract", "floored_timestamp"), None),
]

def _declared() -> list[Declared]:
    return [Declared(kind, model, col if isinstance(col, tuple) else (col,), extra) for kind, model, col, extra in _MODEL_CHECKS]


_SQL_MODELS = {"stg_hourly": "stg_hourly", "stg_station": "stg_station", "stg_tracts": "stg_tracts", "stg_acs": "stg_acs",
               "stg_tract_elevation": "stg_tract_elevation", "stg_station_elevation": "stg_station_elevation",
               "dim_station": "dim_station", "dim_tract": "dim_tract", "int_hourly": "int_hourly",
               "prevailing_wind": "prevailing", "rel_tract_station_distance": "(SELECT * FROM geom WHERE distance_m <= 50000)",
               "rel_station_weights": "weights", "fact_tract_hourly": "fact"}


def _count_sql(kind, model, col, extra) -> str:
    m = _SQL_MODELS[model]
    if kind == "not_null":
        return f"SELECT count(*) FROM {m} WHERE {col} IS NULL"
    if kind == "unique":
        cols = ", ".join(col) if isinstance(col, tuple) else col
        key = " || '-' || ".join(f"CAST({c} AS VARCHAR)" for c in (col if isinstance(col, tuple) else (col,)))
        return f"SELECT count(*) FROM (SELECT {key} AS u FROM {m} WHERE {key} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)" \
            if isinstance(col, tuple) else \
            f"SELECT count(*) FROM (SELECT {cols} FROM {m} WHERE {cols} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
    if kind == "relationships":
        parent, field = extra
        return (f"SELECT count(*) FROM {m} WHERE {col} IS NOT NULL AND {col} NOT IN "
                f"(SELECT {field} FROM {_SQL_MODELS[parent]} WHERE {field} IS NOT NULL)")
    if kind == "accepted_values":
        vals = ", ".join(f"'{v}'" for v in extra)
        return f"SELECT count(*) FROM {m} WHERE {col} IS NOT NULL AND {col} NOT IN ({vals})"
    if kind == "between":
        lo, hi = extra
        cond = " AND ".join([f"{col} >= {lo}"] + ([f"{col} <= {hi}"] if hi is not None else []))
        return f"SELECT count(*) FROM {m} WHERE NOT ({cond})"
    raise ValueError(kind)


def _suite_sql() -> str:
    from tessera.plans import oracle as O

    parts = []
    for c, (kind, model, col, extra) in zip(_declared(), _MODEL_CHECKS, strict=True):
        parts.append(f"SELECT '{c.label}' AS \"check\", '{model}' AS model, n AS failures, CASE WHEN n <> 0 THEN 'error' ELSE 'pass' END AS status "
                     f"FROM (SELECT ({_count_sql(kind, model, col, extra)}) AS n)")
    return O.with_(O.FACT, " UNION ALL ".join(parts))


@register("model_suite", _suite_sql())
def q_model_suite(spark, sf_dir):
    """EXP-67/68: every check declared on the pipeline's models, as one report, with the declared severities.

    The computed models but the fact are written once; each model is then read at most twice (``run_declared``).
    """
    from tessera.operators import relations as R
    from tessera.session import cut_lineage

    models = {
        "stg_hourly": T.stg_hourly(spark, sf_dir), "stg_station": T.stg_station(spark, sf_dir),
        "stg_tracts": T.stg_tracts(spark, sf_dir), "stg_acs": T.stg_acs(spark, sf_dir),
        "stg_tract_elevation": T.stg_tract_elevation(spark, sf_dir),
        "stg_station_elevation": T.stg_station_elevation(spark, sf_dir),
        "dim_station": P.dim_station(spark, sf_dir), "dim_tract": P.dim_tract(spark, sf_dir),
    }
    h = cut_lineage(P.int_hourly(spark, sf_dir))
    pw = cut_lineage(R.prevailing_wind(h))
    w = cut_lineage(R.station_weights(models["dim_station"], models["dim_tract"], pw))
    models.update({
        "int_hourly": h, "prevailing_wind": pw, "rel_station_weights": w,
        "rel_tract_station_distance": cut_lineage(R.tract_station_distance(models["dim_station"], models["dim_tract"])),
        "fact_tract_hourly": P.fact_tract_hourly(spark, sf_dir, h, w, wanted=("tract", "floored_timestamp", "stations_used", "weighted_wind_direction")),  # computed in each pass: written it is far larger than its inputs
    })
    return run_declared(_declared(), models)


# Row and key checks whose failures a threshold or a fail_calc turns into a verdict, on the driver tables.
_THRESHOLDS = [
    Declared("expression", "lineitem", (), "l_discount < 0.09", error_if=">1000000", warn_if=">100", name="some discounts"),
    Declared("expression", "lineitem", (), "l_discount < 0.09", error_if=">100", name="too many discounts"),
    Declared("expression", "lineitem", (), "l_discount < 0.09", severity="warn", error_if=">100", name="many discounts, tolerated"),
    Declared("unique", "lineitem", ("l_orderkey", "l_linenumber"), None, name="line key"),
    Declared("unique", "lineitem", ("l_orderkey",), None, severity="warn", name="order key of lines"),
    Declared("relationships", "orders", ("o_custkey",), ("customer", "c_custkey"), name="customer of an order"),
    Declared("relationships", "customer", ("c_custkey",), ("orders", "o_custkey"), warn_if="<0", error_if=">= 1", name="customers without orders"),
    Declared("accepted_values", "orders", ("o_orderstatus",), ("F", "O"), warn_if="!=0", error_if="<0", name="order states"),
    Declared("between", "orders", ("o_totalprice",), (None, 400000), warn_if="> 0", error_if=">2", name="prices"),
]
_COUNTS = {
    "some discounts": "SELECT count(*) FROM lineitem WHERE NOT (l_discount < 0.09)",
    "line key": "SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)",
    "order key of lines": "SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1)",
    "customer of an order": "SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)",
    "customers without orders": "SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)",
    "order states": "SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')",
    "prices": "SELECT count(*) FROM orders WHERE o_totalprice > 400000",
}
_COUNTS |= dict.fromkeys(("too many discounts", "many discounts, tolerated"), _COUNTS["some discounts"])


def _threshold_sql() -> str:
    def verdict(c):
        op = lambda t: f"n {t.replace('!=', '<>')}"
        err = f"WHEN {op(c.error_if)} THEN 'error' " if c.severity == "error" else ""
        return f"CASE {err}WHEN {op(c.warn_if)} THEN 'warn' ELSE 'pass' END"

    return " UNION ALL ".join(f"SELECT '{c.name}' AS \"check\", '{c.model}' AS model, n AS failures, {verdict(c)} AS status FROM (SELECT ({_COUNTS[c.name]}) AS n)"
                              for c in _THRESHOLDS)


@register("suite_thresholds", _threshold_sql())
def q_suite_thresholds(spark, sf_dir):
    """EXP-68: warn and error thresholds over fused checks, NULL keys and parents included."""
    return run_declared(_THRESHOLDS, {t: read_table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer")})


_FLIPPED = "cast((count(*)=0) as int)"


@register("suite_fail_calc",
          "SELECT 'flipped, fails' AS \"check\", 'lineitem' AS model, CAST(count(*) = 0 AS BIGINT) AS failures, CASE WHEN count(*) = 0 THEN 'error' ELSE 'pass' END AS status "
          "FROM lineitem WHERE l_quantity > 49 "
          "UNION ALL SELECT 'flipped, holds', 'lineitem', CAST(count(*) = 0 AS BIGINT), CASE WHEN count(*) = 0 THEN 'error' ELSE 'pass' END FROM lineitem WHERE l_quantity < 0 "
          "UNION ALL SELECT 'largest excess', 'lineitem', CAST(max(expression) AS BIGINT), CASE WHEN max(expression) > 1000 THEN 'error' WHEN max(expression) <> 0 THEN 'warn' ELSE 'pass' END "
          "FROM (SELECT l_returnflag, count(*) AS expression FROM lineitem GROUP BY 1) WHERE expression > 100 "
          "UNION ALL SELECT 'no failing row', 'orders', 0, 'pass'")
def q_suite_fail_calc(spark, sf_dir):
    """EXP-68: ``fail_calc``, among others the flipped count of checks that are expected to fail."""
    li, orders = read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "orders")
    per_flag = li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("expression"))
    return run_suite([
        Check("flipped, fails", "lineitem", lambda: li.where("l_quantity > 49"), fail_calc=_FLIPPED),
        Check("flipped, holds", "lineitem", lambda: li.where("l_quantity < 0"), fail_calc=_FLIPPED),
        Check("largest excess", "lineitem", lambda: per_flag.where("expression > 100"), error_if="> 1000", fail_calc="max(expression)"),
        Check("no failing row", "orders", lambda: orders.where("o_orderkey < 0"), fail_calc="max(o_orderkey)"),
    ])
