import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from tessera.sources import normalize as N
from tessera.sources.schemas import ACS5_VARIABLES, HOURLY_VARIABLES

RAW_COLS = list(HOURLY_VARIABLES)
ROW1 = ["2025-01-01T00:00:00", "72662604864", "32", "30", "28", "80", "5", "180", "10", "0.0", "10.0", "1012", "29.92"]
ROW2 = ["2025-01-01T01:00:00", "72662604864", "9999", "9999", "9999", "99", "999", "999", "999", "9999", "9999", "9999", "9999"]
CSV_ORDER = ["DATE", "STATION", "HourlyDryBulbTemperature", "HourlyWetBulbTemperature", "HourlyDewPointTemperature",
             "HourlyRelativeHumidity", "HourlyWindSpeed", "HourlyWindDirection", "HourlyWindGustSpeed",
             "HourlyPrecipitation", "HourlyVisibility", "HourlyStationPressure", "HourlyAltimeterSetting"]


def _raw(spark):
    return spark.createDataFrame([ROW1, ROW2], CSV_ORDER)


def test_normalize_hourly_rows(spark):
    out = N.normalize_hourly(_raw(spark)).orderBy("timestamp").collect()
    assert len(out) == 2
    assert out[0]["station"] == "WBAN:04864"
    assert out[0]["timestamp"] == dt.datetime(2025, 1, 1, 0, 0)
    assert out[0]["dry_bulb_temp"] == 32.0
    assert out[1]["dry_bulb_temp"] is None and out[1]["wind_speed"] is None and out[1]["precipitation"] is None


def test_lenient_numeric_cast(spark):
    df = spark.createDataFrame([("32s",), ("T",), ("VRB",), ("32d",), (" 12.5 ",), ("-3",), ("1e2",)], ["x"])
    got = [r[0] for r in df.select(N.to_number("x")).collect()]
    assert got == [None, None, None, None, 12.5, -3.0, 100.0]


def test_station_id_rules(spark):
    df = spark.createDataFrame([(" 72662604864 ",), ("123",), ("ABCDEFG",)], ["s"])
    got = [r[0] for r in df.select(N.validate_station(N.normalize_station_id("s"))).collect()]
    assert got == ["WBAN:04864", "WBAN:00123", None]


def test_missing_raw_column_is_error(spark):
    with pytest.raises(ValueError):
        N.normalize_hourly(_raw(spark).drop("HourlyVisibility"))


def test_partitioned_write_layout(spark, tmp_path):
    out = str(tmp_path / "norm")
    N.write_partitioned_hourly(N.normalize_hourly(_raw(spark)), out)
    parts = glob.glob(os.path.join(out, "station_id=*", "year=*"))
    assert [os.path.relpath(p, out) for p in parts] == ["station_id=WBAN_04864/year=2025"]
    back = N.read_partitioned_hourly(spark, out).where("year = 2025")
    assert back.count() == 2


def test_csv_scan_year_from_path(spark, tmp_path):
    d = tmp_path / "raw" / "2025"
    d.mkdir(parents=True)
    (d / "72662604864.csv").write_text(",".join(CSV_ORDER) + "\n" + ",".join(ROW1) + "\n" + ",".join(ROW2) + "\n")
    paths = N.raw_paths_for_years(spark, str(tmp_path / "raw"), [2024, 2025])  # 2024 absent → skipped
    assert paths == [str(tmp_path / "raw" / "2025" / "*.csv")]
    raw = N.read_raw_hourly_csv(spark, paths)
    rows = raw.select("year", "STATION").distinct().collect()
    assert [(r["year"], r["STATION"]) for r in rows] == [(2025, "72662604864")]
    norm = N.normalize_hourly(raw, keep=["source_file"])
    assert N.files_with_station_count_not_one(norm).count() == 0


def test_years_merge_and_range(spark):
    df = spark.createDataFrame([([2024], [2025])], "old array<int>, new array<int>")
    assert df.select(N.merge_years(F.col("old"), F.col("new"))).first()[0] == [2024, 2025]
    d = spark.createDataFrame([(dt.date(2026, 3, 1),)], ["d"])
    assert d.select(N.years_to_process(F.col("d"), 2)).first()[0] == [2024, 2025]


def _acs_raw(spark, value="10", drop=None):
    cols = ["state", "county", "tract"] + list(ACS5_VARIABLES)
    row = ["55", "001", "000100"] + [value] * len(ACS5_VARIABLES)
    df = spark.createDataFrame([row], cols)
    return df.drop(drop) if drop else df


def test_acs_success_and_order(spark):
    out = N.normalize_acs(_acs_raw(spark))
    r = out.first()
    assert r["tract"] == "55001000100" and r["tract_code"] == "000100"
    assert out.columns == ["state", "county", "tract_code", "tract"] + list(ACS5_VARIABLES.values())
    assert r["population_total"] == 10.0


def test_acs_coercion(spark):
    r = N.normalize_acs(_acs_raw(spark, "not_a_number")).first()
    assert all(r[v] is None for v in ACS5_VARIABLES.values())


def test_acs_missing_columns(spark):
    with pytest.raises(ValueError, match="tract"):
        N.normalize_acs(_acs_raw(spark, drop="tract"))
    with pytest.raises(ValueError, match=list(ACS5_VARIABLES)[-1]):
        N.normalize_acs(_acs_raw(spark, drop=list(ACS5_VARIABLES)[-1]))


def test_chunk_merge_overwrite_and_empty(spark, tmp_path):
    payloads = spark.createDataFrame([
        (1, '[["var1","var2","state","county","tract"],["10","20","55","001","000100"]]'),
        (2, '[["var2","state","county","tract"],["99","55","001","000100"]]'),
        (3, '[]'),
    ], ["chunk_no", "body"])
    wide = N.merge_table_chunks(N.explode_table_payload(payloads), ["var1", "var2"])
    r = wide.collect()
    assert [(x["state"], x["county"], x["tract"], x["var1"], x["var2"]) for x in r] == [("55", "001", "000100", "10", "99")]
    first_only = N.merge_table_chunks(N.explode_table_payload(payloads.where("chunk_no = 1")), ["var1", "var2"])
    assert first_only.first()["var2"] == "20"


def test_merged_csv_lines(spark, tmp_path):
    wide = spark.createDataFrame([("55", "001", "000100", "10", "20"), ("55", "001", "000200", "30", "40")],
                                 ["state", "county", "tract", "A", "B"])
    out = str(tmp_path / "csv")
    N.write_merged_csv(wide.coalesce(1), out)
    text = open(glob.glob(out + "/*.csv")[0]).read().splitlines()
    assert text == ["state,county,tract,A,B", "55,001,000100,10,20", "55,001,000200,30,40"]


def test_chunk_list(spark):
    df = spark.createDataFrame([(["A", "B", "C", "D", "E"],)], ["a"])
    assert df.select(N.chunk_list("a", 2)).first()[0] == [["A", "B"], ["C", "D"], ["E"]]


def test_station_metadata(spark):
    rows = [{"id": "GHCND:1", "name": "A", "latitude": 1.0, "longitude": 2.0, "datacoverage": 0.9,
             "mindate": "2020-01-01", "maxdate": "2024-01-01", "extra_column": "x"}]
    df = spark.createDataFrame(rows)
    out = N.normalize_station_metadata(df)
    assert sorted(out.columns) == sorted(["station", "name", "latitude", "longitude", "data_coverage", "min_date",
                                          "max_date"])
    pages = spark.createDataFrame([('{"metadata":{"resultset":{"count":2,"limit":1,"offset":1}},'
                                    '"results":[{"id":"A","name":"n","latitude":"44.1"}]}',),
                                   ('{"results":[{"id":"B","name":"m","latitude":"44.2","elevation":"3"}]}',)], ["body"])
    got = N.parse_station_pages(pages)
    assert got.count() == 2 and "elevation" in got.columns and "station" in got.columns


def test_value_response(spark):
    df = spark.createDataFrame([('{"value": 123.45}',), ('{"foo": "bar"}',), ("not json",)], ["b"])
    assert [r[0] for r in df.select(N.parse_value_response("b")).collect()] == [123.45, None, None]


def test_links_keys_and_missing(spark):
    html = '<a href="01001099999.csv">x</a><a href="72640014839.csv">y</a><a href="readme.txt">z</a>'
    df = spark.createDataFrame([(html,)], ["html"])
    links = df.select(F.explode(N.extract_links("html")).alias("filename"))
    assert [r[0] for r in links.collect()] == ["01001099999.csv", "72640014839.csv"]
    assert [r[0] for r in links.select(N.file_station_key("filename")).collect()] == ["99999", "14839"]
    wanted = spark.createDataFrame([("99999",), ("14839",)], ["key"])
    existing = spark.createDataFrame([("01001099999-2025.csv",)], ["filename"])
    miss = N.missing_files(links, wanted, existing, 2025).collect()
    assert [(r["filename"], r["target"]) for r in miss] == [("72640014839.csv", "72640014839-2025.csv")]


def test_state_last_write_wins(spark):
    log = spark.createDataFrame([("lcd", "years", "[2024]", dt.datetime(2025, 1, 1)),
                                 ("lcd", "years", "[2024,2025]", dt.datetime(2025, 6, 1))], N.STATE_SCHEMA)
    assert N.state_latest(log).first()["value"] == "[2024,2025]"


def test_sinks_and_preview(spark, tmp_path):
    from tessera.sources import tables as T

    path = str(tmp_path / "t")
    T.write_table(spark.range(5), path)
    T.write_table(spark.range(9), path, skip_if_exists=True)  # existing output left alone
    assert T.preview(spark, path, 100).count() == 5
    assert [r.column_name for r in T.describe_columns(spark.read.parquet(path)).collect()] == ["id"]


def test_acs_csv_roundtrip(spark, tmp_path):
    from tessera.sources.schemas import ACS5_VARIABLES as V

    head = ["state", "county", "tract"] + list(V)
    (tmp_path / "acs.csv").write_text(",".join(head) + "\n" + ",".join(["55", "1", "100"] + ["10"] * len(V)) + "\n")
    out = N.normalize_acs(N.read_text_csv(spark, str(tmp_path / "acs.csv"))).first()
    assert (out.state, out.county, out.tract_code, out.tract) == ("55", "001", "000100", "55001000100")
    staged = str(tmp_path / "staged")
    N.normalize_hourly(spark.createDataFrame([ROW1], CSV_ORDER)).write.parquet(staged)
    from tessera.sources.schemas import STG_HOURLY

    typed = N.read_staged(spark, staged, STG_HOURLY)
    assert typed.schema == STG_HOURLY and typed.first().dry_bulb_temp == 32.0


def test_stage_acs_types_and_rounding(spark):
    from pyspark.sql import types as T

    out = N.stage_acs(N.normalize_acs(_acs_raw(spark, "2.5")))
    r = out.first()
    assert out.columns[:4] == ["tract", "state_fips", "county_fips", "tract_code"]
    assert r.population_total == 3 and abs(r.median_age - 2.5) < 1e-6  # count rounded, median kept
    assert isinstance(out.schema["population_total"].dataType, T.IntegerType)
    assert isinstance(out.schema["median_age"].dataType, T.FloatType)


def test_stage_station_and_elevation(spark):
    import datetime as dt

    pages = spark.createDataFrame([('{"results":[{"id":"A","name":"n","latitude":"44.1","longitude":"-88.1",'
                                    '"datacoverage":"0.9","mindate":"2020-01-01","maxdate":"2024-12-31"}]}',)], ["body"])
    st = N.stage_station(N.parse_station_pages(pages)).first()
    assert st.station == "A" and abs(st.latitude - 44.1) < 1e-5 and st.elevation is None
    assert st.min_date == dt.date(2020, 1, 1)
    pts = spark.createDataFrame([("A", "44.1", "-88.1", "123.45")], "station string, lat string, lon string, elevation_m string")
    e = N.stage_elevation(pts, "station").first()
    assert abs(e.elevation_m - 123.45) < 1e-3


def test_coordinate_triples(spark):
    st = spark.createDataFrame([("A", 44.1, -88.1), ("B", 44.2, -88.2)], "station string, latitude double, longitude double")
    assert [tuple(r) for r in N.coordinate_triples(st, "station", "latitude", "longitude").collect()] == [
        ("A", 44.1, -88.1), ("B", 44.2, -88.2)]
    tr = spark.createDataFrame([("T1", 44.0)], "tract string, centroid_lat double")
    with pytest.raises(ValueError, match="centroid_lon"):
        N.coordinate_triples(tr, "tract", "centroid_lat", "centroid_lon")
