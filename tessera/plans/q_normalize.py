"""Registered normalization queries over raw text records derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.sources import normalize as N
from tessera.plans.catalog import register
from tessera.plans.present import present
from tessera.sources.tables import read_table


def raw_hourly_records(spark, sf_dir):
    """Every event as a raw all-text observation record (the CSV shape), with sentinels and junk.

    Fixed binding: STATION 72600000000+user_id; measures carry the sentinels
    9999 / 999 / 99 / M / '' and non-numeric text (VRB, T, a trailing 's').
    """
    e = read_table(spark, sf_dir, "events")
    v = F.col("value").cast("string")
    eid, et = F.col("event_id"), F.col("event_type")
    s = lambda x: x.cast("string")
    return e.select(
        s(F.lit(72600000000) + F.col("user_id")).alias("STATION"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("DATE"),
        F.when(et == "error", F.lit("9999")).otherwise(v).alias("HourlyDryBulbTemperature"),
        F.when(eid % 7 == 0, F.concat(v, F.lit("s"))).otherwise(v).alias("HourlyWetBulbTemperature"),
        v.alias("HourlyDewPointTemperature"),
        F.when(F.col("user_id") % 10 == 0, F.lit("99")).otherwise(s(eid % 100)).alias("HourlyRelativeHumidity"),
        F.when(et == "signup", F.lit("")).otherwise(s(eid % 30)).alias("HourlyWindSpeed"),
        F.when(et == "view", F.lit("VRB")).otherwise(s((eid * 37 % 36) * 10)).alias("HourlyWindDirection"),
        F.when(et == "purchase", s(eid % 50)).otherwise(F.lit("999")).alias("HourlyWindGustSpeed"),
        F.when(et == "click", F.lit("T")).otherwise(F.concat(F.lit("0.0"), s(eid % 10))).alias("HourlyPrecipitation"),
        F.lit("10.00").alias("HourlyVisibility"),
        F.concat(F.lit("29."), F.lpad(s(eid % 100), 2, "0")).alias("HourlyStationPressure"),
        F.when(et == "error", F.lit("M")).otherwise(F.concat(F.lit("30."), F.lpad(s(eid % 100), 2, "0"))).alias(
            "HourlyAltimeterSetting"),
    )


RAW_SQL = """
raw AS (
  SELECT CAST(72600000000 + user_id AS VARCHAR) AS STATION, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS DATE,
    CASE WHEN event_type = 'error' THEN '9999' ELSE CAST(value AS VARCHAR) END AS HourlyDryBulbTemperature,
    CASE WHEN event_id % 7 = 0 THEN CAST(value AS VARCHAR) || 's' ELSE CAST(value AS VARCHAR) END AS HourlyWetBulbTemperature,
    CAST(value AS VARCHAR) AS HourlyDewPointTemperature,
    CASE WHEN user_id % 10 = 0 THEN '99' ELSE CAST(event_id % 100 AS VARCHAR) END AS HourlyRelativeHumidity,
    CASE WHEN event_type = 'signup' THEN '' ELSE CAST(event_id % 30 AS VARCHAR) END AS HourlyWindSpeed,
    CASE WHEN event_type = 'view' THEN 'VRB' ELSE CAST((event_id * 37 % 36) * 10 AS VARCHAR) END AS HourlyWindDirection,
    CASE WHEN event_type = 'purchase' THEN CAST(event_id % 50 AS VARCHAR) ELSE '999' END AS HourlyWindGustSpeed,
    CASE WHEN event_type = 'click' THEN 'T' ELSE '0.0' || CAST(event_id % 10 AS VARCHAR) END AS HourlyPrecipitation,
    '10.00' AS HourlyVisibility,
    '29.' || lpad(CAST(event_id % 100 AS VARCHAR), 2, '0') AS HourlyStationPressure,
    CASE WHEN event_type = 'error' THEN 'M' ELSE '30.' || lpad(CAST(event_id % 100 AS VARCHAR), 2, '0') END AS HourlyAltimeterSetting
  FROM events)"""

_RAW_COLS = [
    ("HourlyDryBulbTemperature", "dry_bulb_temp"), ("HourlyWetBulbTemperature", "wet_bulb_temp"),
    ("HourlyDewPointTemperature", "dew_point_temp"), ("HourlyRelativeHumidity", "relative_humidity"),
    ("HourlyWindSpeed", "wind_speed"), ("HourlyWindDirection", "wind_direction"),
    ("HourlyWindGustSpeed", "wind_gust_speed"), ("HourlyPrecipitation", "precipitation"),
    ("HourlyVisibility", "visibility"), ("HourlyStationPressure", "station_pressure"),
    ("HourlyAltimeterSetting", "barometric_pressure"),
]


def _num_sql(raw: str) -> str:
    cleaned = f"CASE WHEN {raw} IN ('9999', '999', '99', 'M', '') THEN NULL ELSE {raw} END"
    return (f"CASE WHEN regexp_full_match({cleaned}, '\\s*[+-]?(\\d+(\\.\\d*)?|\\.\\d+)([eE][+-]?\\d+)?\\s*') "
            f"THEN TRY_CAST(trim({cleaned}) AS DOUBLE) END")


_NORM_SQL = (
    "WITH " + RAW_SQL + """,
norm AS (
  SELECT CASE WHEN regexp_full_match('WBAN:' || lpad(right(trim(STATION), 5), 5, '0'), 'WBAN:\\d{5}')
              THEN 'WBAN:' || lpad(right(trim(STATION), 5), 5, '0') END AS station,
         TRY_CAST(DATE AS TIMESTAMP) AS timestamp, """
    + ", ".join(f"{_num_sql(r)} AS {n}" for r, n in _RAW_COLS)
    + " FROM raw)"
)


@register("norm_hourly_records", _NORM_SQL + " SELECT * FROM norm")
def q_norm_hourly(spark, sf_dir):
    """PRJ-01..08: rename, station id, timestamp parse, sentinels, station check, lenient numeric cast."""
    return N.normalize_hourly(raw_hourly_records(spark, sf_dir))


@register(
    "norm_hourly_staged",
    _NORM_SQL + " SELECT station, timestamp, " + ", ".join(f"CAST({n} AS FLOAT) AS {n}" for _, n in _RAW_COLS) + " FROM norm",
)
def q_norm_staged(spark, sf_dir):
    """PRJ-14: staging casts to float32."""
    return N.stage_hourly(N.normalize_hourly(raw_hourly_records(spark, sf_dir)))


@register(
    "norm_station_years",
    _NORM_SQL + " SELECT station, replace(station, ':', '_') AS station_id, CAST(year(timestamp) AS INTEGER) AS year, "
    "count(*) AS n_rows FROM norm GROUP BY ALL",
)
def q_norm_partitions(spark, sf_dir):
    """SNK-01 layout: the (station_id, year) partitions the write would create, with row counts."""
    n = N.normalize_hourly(raw_hourly_records(spark, sf_dir))
    return n.groupBy("station", F.translate("station", ":", "_").alias("station_id"),
                     F.year("timestamp").cast("int").alias("year")).agg(F.count(F.lit(1)).alias("n_rows"))


@register(
    "norm_value_response",
    "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k_value, "
    "TRY_CAST(json_extract_string(props, '$.value') AS DOUBLE) AS value FROM events",
)
def q_value_response(spark, sf_dir):
    """SRC-08: JSON value extraction with NULL for missing keys / bad JSON."""
    e = read_table(spark, sf_dir, "events")
    return e.select("event_id", F.get_json_object("props", "$.k").try_cast("double").alias("k_value"),
                    N.parse_value_response("props").alias("value"))


@register(
    "norm_page_links",
    "SELECT page_id, CAST(pos AS INTEGER) AS pos, link, right(regexp_replace(link, '\\.csv$', ''), 5) AS file_key FROM "
    "(SELECT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]+)\"', 1)) AS link, "
    "unnest(range(1, len(regexp_extract_all(html, 'href=\"([^\"]+)\"', 1)) + 1)) AS pos FROM pages)",
)
def q_page_links(spark, sf_dir):
    """SRC-09 + PRJ-17: every href of every page, in order, with the file-name key."""
    p = read_table(spark, sf_dir, "pages")
    ex = p.select("page_id", F.posexplode(N.extract_links("html", r'href="([^"]+)"')).alias("pos", "link"))
    return ex.select("page_id", (F.col("pos") + 1).cast("int").alias("pos"), "link",
                     N.file_station_key("link").alias("file_key"))


def _station_payloads(spark, sf_dir):
    s = read_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    item = F.struct(
        F.concat(F.lit("GHCND:"), k.cast("string")).alias("id"), F.col("s_name").alias("name"),
        (F.lit(40.0) + ((k * 37) % 101).cast("double") / 10).cast("string").alias("latitude"),
        (F.lit(-125.0) + k.cast("double") / 50).cast("string").alias("longitude"),
        F.when(k % 3 != 0, (F.lit(180) + (k * 97) % 400).cast("string")).alias("elevation"),
        F.lit("0.95").alias("datacoverage"), F.lit("2020-01-01").alias("mindate"), F.lit("2024-12-31").alias("maxdate"),
        F.lit("x").alias("extra_column"))
    return s.select(F.to_json(F.struct(F.array(item).alias("results"))).alias("body"))


@register(
    "norm_station_pages",
    "SELECT 'GHCND:' || CAST(s_suppkey AS VARCHAR) AS station, s_name AS name, "
    "CAST(40.0 + CAST((s_suppkey * 37) % 101 AS DOUBLE) / 10 AS VARCHAR) AS latitude, "
    "CAST(-125.0 + CAST(s_suppkey AS DOUBLE) / 50 AS VARCHAR) AS longitude, "
    "CASE WHEN s_suppkey % 3 <> 0 THEN CAST(180 + (s_suppkey * 97) % 400 AS VARCHAR) END AS elevation, "
    "'0.95' AS data_coverage, '2020-01-01' AS min_date, '2024-12-31' AS max_date FROM supplier",
)
def q_station_pages(spark, sf_dir):
    """SRC-06: paged station JSON → renamed rows keeping the known optional fields."""
    return N.parse_station_pages(_station_payloads(spark, sf_dir))


def _acs_payloads(spark, sf_dir):
    """Chunked census-style payloads of at most 100 rows each; chunk 2 re-sends var2 with a new value."""
    c = read_table(spark, sf_dir, "customer")
    row1 = F.array(F.col("c_custkey").cast("string"), (F.col("c_custkey") * 2).cast("string"),
                   F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.lit("001"), F.col("c_custkey").cast("string"))
    row2 = F.array((F.col("c_custkey") * 3).cast("string"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0"),
                   F.lit("001"), F.col("c_custkey").cast("string"))
    h1 = F.array(*[F.lit(x) for x in ("var1", "var2", "state", "county", "tract")])
    h2 = F.array(*[F.lit(x) for x in ("var2", "state", "county", "tract")])
    page = [F.col("c_nationkey"), F.floor(F.col("c_custkey") / 100).alias("page")]  # bounded payload size
    p1 = c.groupBy(*page).agg(F.collect_list(row1).alias("rows")).select(
        F.lit(1).alias("chunk_no"), F.to_json(F.concat(F.array(h1), F.col("rows"))).alias("body"))
    p2 = c.where(F.col("c_acctbal") > 0).groupBy(*page).agg(F.collect_list(row2).alias("rows")).select(
        F.lit(2).alias("chunk_no"), F.to_json(F.concat(F.array(h2), F.col("rows"))).alias("body"))
    return p1.unionByName(p2)


@register(
    "norm_table_chunk_merge",
    "SELECT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS state, '001' AS county, CAST(c_custkey AS VARCHAR) AS tract, "
    "CAST(c_custkey AS VARCHAR) AS var1, CASE WHEN c_acctbal > 0 THEN CAST(c_custkey * 3 AS VARCHAR) "
    "ELSE CAST(c_custkey * 2 AS VARCHAR) END AS var2 FROM customer",
)
def q_chunk_merge(spark, sf_dir):
    """SRC-07 + JOIN-12: chunked array-of-arrays payloads merged per geo key, later chunk wins."""
    long_rows = N.explode_table_payload(_acs_payloads(spark, sf_dir))
    return N.merge_table_chunks(long_rows, ["var1", "var2"])


@register(
    "norm_acs_geo_key",
    "SELECT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS state, lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') AS county, "
    "CASE WHEN length(CAST(c_custkey AS VARCHAR)) >= 6 THEN CAST(c_custkey AS VARCHAR) ELSE lpad(CAST(c_custkey AS VARCHAR), 6, '0') END AS tract_code, "
    "lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') || "
    "CASE WHEN length(CAST(c_custkey AS VARCHAR)) >= 6 THEN CAST(c_custkey AS VARCHAR) ELSE lpad(CAST(c_custkey AS VARCHAR), 6, '0') END AS tract, "
    "TRY_CAST(CAST(c_acctbal AS VARCHAR) AS DOUBLE) AS population_total, CAST(NULL AS DOUBLE) AS median_age FROM customer",
)
def q_acs_geo_key(spark, sf_dir):
    """PRJ-10/12/13: zero-filled geo key, numeric coercion (junk → NULL), canonical order."""
    c = read_table(spark, sf_dir, "customer")
    raw = c.select(F.col("c_nationkey").cast("string").alias("state"), (F.col("c_custkey") % 1000).cast("string").alias("county"),
                   F.col("c_custkey").cast("string").alias("tract"),
                   F.col("c_acctbal").cast("string").alias("B01001_001E"), F.col("c_name").alias("B01002_001E"))
    return N.normalize_acs(raw, {"B01001_001E": "population_total", "B01002_001E": "median_age"})




def tract_polygons(spark, sf_dir):
    """Every customer as a tract polygon: a 0.02° square around its bound point with a 0.01° square hole."""
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    lat = F.lit(39.5) + ((k * 79) % 1100).cast("double") / 100
    lon = F.lit(-125.5) + k.cast("double") / 730

    def sq(h):
        pts = [(-h, -h), (h, -h), (h, h), (-h, h), (-h, -h)]
        return F.array(*[F.struct((lon + dx).alias("x"), (lat + dy).alias("y")) for dx, dy in pts])

    return c.select(
        F.concat(F.lit("T"), k.cast("string")).alias("GEOID"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("STATEFP"),
        F.lpad((k % 1000).cast("string"), 3, "0").alias("COUNTYFP"), k.cast("string").alias("TRACTCE"),
        F.col("c_name").alias("NAME"), (k * 1000).alias("ALAND"), (k % 97).alias("AWATER"),
        F.array(sq(0.01), F.reverse(sq(0.005))).alias("rings"))


def _polygon_sql() -> str:
    """The tract-polygon metrics restated in DuckDB SQL: vertices unnested, projected, shoelace per ring."""
    import math

    from tessera.functions.geometry import CONUS_ALBERS as A

    n, c, rho0, qp = A.consts
    e2, e = A.e2, A.e
    e4, e6 = e2 * e2, e2 * e2 * e2
    c2, c4, c6 = e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040, 23 * e4 / 360 + 251 * e6 / 3780, 761 * e6 / 45360
    q = (f"((1 - {e2!r}) * (sin(radians(lat)) / (1 - {e2!r} * sin(radians(lat)) * sin(radians(lat))) "
         f"- (1 / (2 * {e!r})) * ln((1 - {e!r} * sin(radians(lat))) / (1 + {e!r} * sin(radians(lat))))))")
    rho = f"({A.a!r} * sqrt({c!r} - {n!r} * {q}) / {n!r})"
    theta = f"({n!r} * (radians(lon) - {math.radians(A.lon0)!r}))"
    sq = lambda h, ring, rev: [(ring, i, dx, dy) for i, (dx, dy) in enumerate(
        list(reversed([(-h, -h), (h, -h), (h, h), (-h, h), (-h, -h)])) if rev else [(-h, -h), (h, -h), (h, h), (-h, h), (-h, -h)])]
    verts = sq(0.01, 0, False) + sq(0.005, 1, True)
    vsql = " UNION ALL ".join(f"SELECT {r} AS ring, {i} AS idx, CAST({dx!r} AS DOUBLE) AS dx, CAST({dy!r} AS DOUBLE) AS dy"
                              for r, i, dx, dy in verts)
    return f"""
WITH verts AS ({vsql}),
t AS (SELECT c_custkey AS k, 'T' || CAST(c_custkey AS VARCHAR) AS tract, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS state_fips,
             lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') AS county_fips, CAST(c_custkey AS VARCHAR) AS tract_code,
             c_name AS name, c_custkey * 1000 AS aland, c_custkey % 97 AS awater,
             39.5 + CAST((c_custkey * 79) % 1100 AS DOUBLE) / 100 AS clat, -125.5 + CAST(c_custkey AS DOUBLE) / 730 AS clon
      FROM customer),
p AS (SELECT t.*, v.ring, v.idx, clon + v.dx AS lon, clat + v.dy AS lat FROM t, verts v),
xy AS (SELECT *, {rho} * sin({theta}) AS x, {rho0!r} - {rho} * cos({theta}) AS y FROM p),
o AS (SELECT k, x AS ox, y AS oy FROM xy WHERE ring = 0 AND idx = 0),
rel AS (SELECT xy.k, ring, idx, x - ox AS rx, y - oy AS ry FROM xy JOIN o USING (k)),
nxt AS (SELECT *, lead(rx) OVER (PARTITION BY k, ring ORDER BY idx) AS nx, lead(ry) OVER (PARTITION BY k, ring ORDER BY idx) AS ny FROM rel),
terms AS (SELECT k, ring, rx * ny - nx * ry AS cr, rx + nx AS sx, ry + ny AS sy FROM nxt WHERE nx IS NOT NULL),
rings AS (SELECT k, ring, sum(cr / 2) AS a, sum(sx * cr / 6) AS mx, sum(sy * cr / 6) AS my FROM terms GROUP BY k, ring),
tot AS (SELECT k, sum(CASE WHEN ring = 0 THEN 1.0 ELSE -1.0 END * abs(a)) AS a,
               sum(CASE WHEN ring = 0 THEN 1.0 ELSE -1.0 END * sign(a) * mx) AS mx,
               sum(CASE WHEN ring = 0 THEN 1.0 ELSE -1.0 END * sign(a) * my) AS my FROM rings GROUP BY k),
cen AS (SELECT tot.k, tot.a, tot.mx / tot.a + o.ox AS cx, tot.my / tot.a + o.oy AS cy FROM tot JOIN o USING (k)),
inv AS (SELECT k, a, sqrt(cx * cx + ({rho0!r} - cy) * ({rho0!r} - cy)) AS rho, atan2(cx, {rho0!r} - cy) AS theta FROM cen),
beta AS (SELECT k, a, theta, asin(least(1.0, greatest(-1.0, (({c!r} - rho * rho * {n * n!r} / {A.a * A.a!r}) / {n!r}) / {qp!r}))) AS b FROM inv),
bb AS (SELECT k, min(lon) AS minx, min(lat) AS miny, max(lon) AS maxx, max(lat) AS maxy FROM p GROUP BY k)
SELECT t.tract, t.state_fips, t.county_fips, t.tract_code, t.name, t.aland, t.awater,
  round(degrees(b + {c2!r} * sin(2 * b) + {c4!r} * sin(4 * b) + {c6!r} * sin(6 * b)), 6) AS centroid_lat,
  round(degrees(theta / {n!r}) + {A.lon0!r}, 6) AS centroid_lon,
  round(bb.minx, 6) AS bbox_minx, round(bb.miny, 6) AS bbox_miny, round(bb.maxx, 6) AS bbox_maxx, round(bb.maxy, 6) AS bbox_maxy,
  round(beta.a, 2) AS area_m2, CAST(NULL AS BLOB) AS geometry_wkb
FROM t JOIN beta USING (k) JOIN bb USING (k)"""


@register("norm_tract_polygons", _polygon_sql())
def q_tract_polygons(spark, sf_dir):
    """PRJ-16 + GEO-12..15: equal-area centroid/area and bbox for every tract polygon.

    The area is compared at cm² precision: projected coordinates are ~1e6 m, so
    last-ulp differences between math libraries and summation order move the
    area by ~1e-6 m² (~1e-12 relative) and finer roundings hit boundary cases
    (7 of 15,000 tracts at mm² on sf0.1). Also checked analytically in tests.
    """
    out = present(N.normalize_tracts(tract_polygons(spark, sf_dir)))
    return out.withColumn("area_m2", F.round("area_m2", 2))
