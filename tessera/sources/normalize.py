"""Raw string records → typed, validated, partitioned tables (one scan, one plan).

The reference normalizes one file at a time in a driver loop; here one CSV
scan covers every file and year, each cleaning step is a ``DataFrame ->
DataFrame`` transform, and a single ``partitionBy`` write lays out
``station_id=…/year=…``. Payload parsing (station pages, chunked census
tables, elevation responses, directory listings) is re-aimed as DataFrame
JSON/regex parsing so it runs distributed over however many payloads exist.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources.schemas import (
    ACS5_VARIABLES,
    HOURLY_MEASURES,
    HOURLY_SENTINELS,
    HOURLY_VARIABLES,
    STATION_KEEP,
    STATION_RENAME,
    STG_HOURLY,
)

# Station id pattern and the numeric text accepted by the lenient cast.
WBAN_PATTERN = r"^WBAN:\d{5}$"
NUMERIC_PATTERN = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
CSV_LINK_PATTERN = r'href="([^"]+\.csv)"'


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --------------------------------------------------------------------------- column rules


def zfill(col, width: int) -> Column:
    """Left-pad with zeros to ``width``; longer strings are kept whole (unlike ``lpad``)."""
    c = _c(col)
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, "0"))


def normalize_station_id(col) -> Column:
    """PRJ-02: strip, last five characters, zero-pad to five, prefix ``WBAN:``."""
    return F.concat(F.lit("WBAN:"), zfill(F.right(F.btrim(_c(col), F.lit(" \t\n\r\x0b\f")), F.lit(5)), 5))


def validate_station(col) -> Column:
    """PRJ-06: ids not matching ``WBAN:ddddd`` become NULL."""
    c = _c(col)
    return F.when(c.rlike(WBAN_PATTERN), c)


def parse_timestamp(col) -> Column:
    """PRJ-03: lenient ISO-8601 parse to a naive timestamp; unparsable text → NULL."""
    return _c(col).try_cast("timestamp_ntz")


def clean_sentinel(col, sentinels: Sequence[str] = HOURLY_SENTINELS) -> Column:
    """PRJ-04: exact string equality with a sentinel → NULL (before any numeric cast)."""
    c = _c(col)
    return F.when(c.isin(*sentinels), F.lit(None).cast("string")).otherwise(c)


def to_number(col) -> Column:
    """PRJ-08/12: lenient text → double. Non-numeric text (``32s``, ``T``, ``VRB``) → NULL.

    The regex guard matters: Spark itself would accept ``32d``/``32f`` as 32.0.
    """
    c = _c(col)
    return F.when(c.rlike(NUMERIC_PATTERN), F.trim(c).try_cast("double"))


# --------------------------------------------------------------------------- hourly observations


def read_raw_hourly_csv(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """SRC-01/02: one header-CSV scan over every file, every column read as text.

    Columns are named by the header (no type inference, so all text); with
    ``enforceSchema=false`` every file's header is checked against the first
    file's, so a file with a different column order fails loudly instead of
    being read positionally. ``source_file`` and ``year`` come from the path
    (``…/<year>/<file>.csv``).
    """
    df = spark.read.option("header", True).option("enforceSchema", False).option("inferSchema", False).csv(paths)
    path = F.col("_metadata.file_path")
    return df.withColumn("source_file", path).withColumn(
        "year", F.regexp_extract(path, r"/(\d{4})/[^/]+$", 1).try_cast("int"))


def read_text_csv(spark: SparkSession, paths) -> DataFrame:
    """SRC-03: header CSV with every column read as text (no inference), named by the header."""
    return spark.read.option("header", True).option("enforceSchema", False).option("inferSchema", False).csv(paths)


def read_staged(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """SRC-05: a staged table read with its declared schema, every column cast leniently."""
    df = spark.read.parquet(path)
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def raw_paths_for_years(spark: SparkSession, base_dir: str, years) -> list[str]:
    """SRC-02: ``<base>/<year>/*.csv`` globs for the requested years whose folder exists (sorted).

    Checked through the Hadoop FileSystem, so it works on cluster storage; the
    list has one entry per year, never per file.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for y in sorted(set(int(v) for v in years)):
        folder = jvm.org.apache.hadoop.fs.Path(f"{base_dir.rstrip('/')}/{y}")
        if folder.getFileSystem(conf).exists(folder):
            out.append(f"{base_dir.rstrip('/')}/{y}/*.csv")
    return out


def select_and_rename(df: DataFrame, mapping: dict[str, str] = HOURLY_VARIABLES, keep: Sequence[str] = ()) -> DataFrame:
    """PRJ-01: project and rename by the ordered map; a missing raw column is an error."""
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise ValueError(f"missing raw columns: {missing}")
    return df.select(*[F.col(f"`{r}`").alias(n) for r, n in mapping.items()], *keep)


def normalize_hourly(raw: DataFrame, sentinels: Sequence[str] = HOURLY_SENTINELS, keep: Sequence[str] = ()) -> DataFrame:
    """PRJ-07: rename → station id → timestamp → sentinels → station check → numeric cast."""
    df = select_and_rename(raw, keep=keep)
    return df.select(
        validate_station(normalize_station_id("station")).alias("station"),
        parse_timestamp("timestamp").alias("timestamp"),
        *[to_number(clean_sentinel(m, sentinels)).alias(m) for m in HOURLY_MEASURES],
        *keep,
    )


def stage_hourly(normalized: DataFrame) -> DataFrame:
    """PRJ-14: staging casts (measures to float32), explicit and lenient."""
    return normalized.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in STG_HOURLY.fields])


def files_with_station_count_not_one(normalized_with_file: DataFrame, file_col: str = "source_file") -> DataFrame:
    """PRJ-09: files whose rows do not carry exactly one distinct station (each should be one station)."""
    return normalized_with_file.groupBy(file_col).agg(F.count_distinct("station").alias("n_stations")).where(
        F.col("n_stations") != 1)


def write_partitioned_hourly(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK-01: ``station_id=<station with ':'→'_'>/year=<y>`` layout, dynamic partition overwrite.

    Rows are clustered by the partition columns first so each task writes few
    files; the ``rebalance`` hint lets AQE split a hot station-year (say a third
    of all rows) over several writer tasks instead of one.
    """
    out = df.withColumn("station_id", F.translate("station", ":", "_"))
    if "year" not in out.columns:
        out = out.withColumn("year", F.year("timestamp"))
    (out.hint("rebalance", "station_id", "year").write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy("station_id", "year").parquet(path))


def read_partitioned_hourly(spark: SparkSession, path: str) -> DataFrame:
    """SRC-04: partition discovery; filters on ``station_id``/``year`` prune directories."""
    return spark.read.parquet(path)


def merge_years(old: Column, new: Column) -> Column:
    """SNK-08: sorted set union of processed years."""
    return F.array_sort(F.array_union(old, new))


def years_to_process(as_of, n_years: int) -> Column:
    """PRJ-18: the ``n_years`` complete years before the year of ``as_of``."""
    y = F.year(_c(as_of))
    return F.sequence(y - F.lit(n_years), y - F.lit(1))


# --------------------------------------------------------------------------- run state


STATE_SCHEMA = T.StructType([
    T.StructField("dataset", T.StringType()), T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()), T.StructField("updated_at", T.TimestampNTZType()),
])


def state_latest(state_log: DataFrame) -> DataFrame:
    """SNK-07: last-write-wins view of an append-only (dataset, key, value, updated_at) log; of entries that were noted
    at one time the greatest value counts."""
    return state_log.groupBy("dataset", "key").agg(
        F.max_by("value", F.struct("updated_at", "value")).alias("value"), F.max("updated_at").alias("updated_at"))


# --------------------------------------------------------------------------- payload parsing


def parse_station_pages(pages: DataFrame, body_col: str = "body") -> DataFrame:
    """SRC-06: paged JSON ``{"metadata":…, "results":[{…}]}`` → one row per station.

    Keeps whichever of the optional fields exist in the payloads, renamed.
    """
    parsed = pages.select(F.from_json(F.col(body_col), "results array<map<string,string>>").alias("p"))
    items = parsed.select(F.explode("p.results").alias("r"))
    present = items.select(F.explode(F.map_keys("r")).alias("k")).distinct()
    keys = [r["k"] for r in present.where(F.col("k").isin(*STATION_KEEP)).collect()]  # ≤ 8 names
    cols = [F.col("r")[k].alias(STATION_RENAME.get(k, k)) for k in STATION_KEEP if k in keys]
    return items.select(*cols)


def normalize_station_metadata(stations: DataFrame) -> DataFrame:
    """SRC-06 (frame form): keep the optional fields that exist, rename id/coverage/dates."""
    cols = [F.col(k).alias(STATION_RENAME.get(k, k)) for k in STATION_KEEP if k in stations.columns]
    return stations.select(*cols)


def parse_value_response(body) -> Column:
    """SRC-08: JSON ``{"value": x}`` → double; missing key, non-JSON or non-numeric → NULL."""
    return F.get_json_object(_c(body), "$.value").try_cast("double")


def extract_links(html, pattern: str = CSV_LINK_PATTERN) -> Column:
    """SRC-09: every capture of ``pattern`` in the page, in order."""
    return F.regexp_extract_all(_c(html), F.lit(pattern), 1)


def file_station_key(filename) -> Column:
    """PRJ-17: ``<id>.csv`` → last five characters of the id."""
    return F.right(F.regexp_replace(_c(filename), r"\.csv$", ""), F.lit(5))


def wanted_key_from_station(station) -> Column:
    return F.regexp_replace(_c(station), "WBAN:", "")


def missing_files(listing: DataFrame, wanted: DataFrame, existing: DataFrame, year) -> DataFrame:
    """SNK-06: listed files of wanted stations not already present as ``<id>-<year>.csv``.

    listing: filename; wanted: key; existing: filename. Semi/anti joins, no driver sets.
    """
    lst = listing.withColumn("key", file_station_key("filename"))
    target = F.concat(F.regexp_replace("filename", r"\.csv$", ""), F.lit("-"), F.lit(str(year)), F.lit(".csv"))
    lst = lst.join(wanted.select("key").distinct(), "key", "left_semi").withColumn("target", target)
    return lst.join(existing.select(F.col("filename").alias("target")), "target", "left_anti").select("filename", "target")


def chunk_list(arr, size: int) -> Column:
    """PRJ-19: fixed-size consecutive slices of an array column."""
    a = _c(arr)
    return F.transform(F.sequence(F.lit(0), F.size(a) - 1, F.lit(size)), lambda i: F.slice(a, i + 1, F.lit(size)))


def explode_table_payload(payloads: DataFrame, body_col: str = "body", chunk_col: str = "chunk_no") -> DataFrame:
    """SRC-07: ``[[header…], [row…], …]`` → long rows (state, county, tract, variable, value, chunk_no).

    Columns are located by header name, so chunk layouts may differ.
    """
    arr = F.from_json(F.col(body_col), "array<array<string>>")
    p = payloads.select(F.col(chunk_col).alias("chunk_no"), arr.alias("t")).where(F.size("t") > 0)
    p = p.select("chunk_no", F.col("t")[0].alias("header"), F.posexplode("t").alias("i", "row")).where("i > 0")
    m = p.select("chunk_no", "header", F.map_from_arrays("header", "row").alias("m"))
    geo = ("state", "county", "tract")
    return m.select(
        "chunk_no", *[F.col("m")[g].alias(g) for g in geo],
        F.explode(F.map_filter("m", lambda k, v: ~k.isin(*geo))).alias("variable", "value"))


def merge_table_chunks(long_rows: DataFrame, variables: Sequence[str]) -> DataFrame:
    """JOIN-12: one wide row per (state, county, tract); a later chunk overwrites a variable.

    ``pivot`` with the declared variable list (no distinct-value discovery job).
    """
    g = long_rows.groupBy("state", "county", "tract").pivot("variable", list(variables)).agg(
        F.max_by("value", "chunk_no"))
    return g.select("state", "county", "tract", *variables)


def write_merged_csv(wide: DataFrame, path: str) -> None:
    """SNK-03: header CSV; missing values written as empty fields."""
    wide.write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def normalize_acs(raw: DataFrame, variables: dict[str, str] = ACS5_VARIABLES) -> DataFrame:
    """PRJ-10..13: zero-filled geo key, renamed numeric measures, canonical column order.

    Raises before any job when a geo column or a configured variable is missing.
    """
    for col in ("state", "county", "tract"):
        if col not in raw.columns:
            raise ValueError(f"census input has no column {col!r}")
    missing = [v for v in variables if v not in raw.columns]
    if missing:
        raise ValueError(f"census input lacks the variables {missing}")
    state, county, tract_code = zfill("state", 2), zfill("county", 3), zfill(F.col("tract").cast("string"), 6)
    return raw.select(
        state.alias("state"), county.alias("county"), tract_code.alias("tract_code"),
        F.concat(state, county, tract_code).alias("tract"),
        *[to_number(F.col(f"`{k}`")).alias(v) for k, v in variables.items()],
    )


def stage_acs(normalized: DataFrame, variables: dict[str, str] = ACS5_VARIABLES) -> DataFrame:
    """PRJ-14 (census): ids renamed, counts as int (rounded first: the reference engine's cast rounds,
    Spark's truncates), the four median measures as float32."""
    from tessera.sources.schemas import ACS5_FLOAT_MEASURES

    def typed(name: str) -> Column:
        if name in ACS5_FLOAT_MEASURES:
            return F.col(name).try_cast("float")
        return F.round(F.col(name)).try_cast("int")

    return normalized.select(
        F.col("tract").cast("string").alias("tract"), F.col("state").cast("string").alias("state_fips"),
        F.col("county").cast("string").alias("county_fips"), F.col("tract_code").cast("string").alias("tract_code"),
        *[typed(v).alias(v) for v in variables.values()],
    )


def stage_station(stations: DataFrame) -> DataFrame:
    """PRJ-14 (stations): declared staging types; absent optional fields become typed NULL columns."""
    from tessera.sources.schemas import STG_STATION

    return stations.select(*[
        (F.col(f.name) if f.name in stations.columns else F.lit(None)).try_cast(f.dataType).alias(f.name)
        for f in STG_STATION.fields])


def stage_elevation(points: DataFrame, id_col: str) -> DataFrame:
    """PRJ-14 (elevation points): (id, lat, lon, elevation_m) as text id and float32 values."""
    return points.select(F.col(id_col).cast("string").alias(id_col),
                         *[F.col(c).try_cast("float").alias(c) for c in ("lat", "lon", "elevation_m")])


def coordinate_triples(points: DataFrame, id_col: str, lat_col: str, lon_col: str) -> DataFrame:
    """(id, lat, lon) rows for an elevation lookup; a missing column fails before any job (PRJ-11)."""
    require_columns(points, [id_col, lat_col, lon_col], "coordinate input")
    return points.select(F.col(id_col).alias("id"), F.col(lat_col).cast("double").alias("lat"),
                         F.col(lon_col).cast("double").alias("lon"))


def require_columns(df: DataFrame, columns: Sequence[str], what: str = "input") -> None:
    """PRJ-11: fail fast, before any job, when required columns are absent."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} is missing required columns: {missing}")


def any_populated(cols: Sequence[str]) -> Column:
    """FLT-03: true when any of the text columns is non-empty."""
    return F.exists(F.array(*[F.coalesce(F.col(c), F.lit("")) for c in cols]), lambda x: x != F.lit(""))


# --------------------------------------------------------------------------- tract polygons

TRACT_REQUIRED = ("GEOID", "STATEFP", "COUNTYFP", "TRACTCE", "NAME", "ALAND", "AWATER", "rings")


def normalize_tracts(raw: DataFrame, rings_col: str = "rings", wkb_col: str | None = "geometry_wkb") -> DataFrame:
    """PRJ-16 + GEO-12..15: identifiers, equal-area centroid and area, geographic bbox, WKB pass-through.

    ``rings`` holds the polygon as ``array<array<struct<x,y>>>`` (exterior first).
    """
    from tessera.functions.geometry import with_polygon_metrics

    missing = [c for c in TRACT_REQUIRED if c not in raw.columns and not (c == "rings" and rings_col in raw.columns)]
    if missing:
        raise ValueError(f"tract input lacks the columns {missing}")
    wkb = F.col(wkb_col) if wkb_col and wkb_col in raw.columns else F.lit(None).cast("binary")
    return with_polygon_metrics(raw, rings_col, "m").select(
        F.col("GEOID").alias("tract"), F.col("STATEFP").alias("state_fips"), F.col("COUNTYFP").alias("county_fips"),
        F.col("TRACTCE").alias("tract_code"), F.col("NAME").alias("name"), F.col("ALAND").alias("aland"),
        F.col("AWATER").alias("awater"), "m", wkb.alias("geometry_wkb"),
    ).select("tract", "state_fips", "county_fips", "tract_code", "name", "aland", "awater", "m.centroid_lat",
             "m.centroid_lon", "m.bbox_minx", "m.bbox_miny", "m.bbox_maxx", "m.bbox_maxy", "m.area_m2", "geometry_wkb")
