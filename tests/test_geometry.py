import math

import pytest
from pyspark.sql import functions as F

from tessera.functions.geometry import CONUS_ALBERS, Albers, albers_forward, albers_inverse, with_polygon_metrics
from tessera.sources import normalize as N

RING_SCHEMA = "rings array<array<struct<x: double, y: double>>>"


def test_snyder_worked_example(spark):
    clarke = Albers(a=6378206.4, inv_f=294.978698214)
    x, y = albers_forward(F.lit(-75.0), F.lit(35.0), clarke)
    r = spark.range(1).select(x.alias("x"), y.alias("y")).first()
    assert abs(r.x - 1885472.7) < 0.1 and abs(r.y - 1535925.0) < 0.1
    lon, lat = albers_inverse(F.lit(r.x), F.lit(r.y), clarke)
    back = spark.range(1).select(lon.alias("lon"), lat.alias("lat")).first()
    assert abs(back.lon + 75.0) < 1e-9 and abs(back.lat - 35.0) < 1e-7


def _cell(lon0, lat0, d, steps=200):
    pts = [(lon0 + d * i / steps, lat0) for i in range(steps)] + [(lon0 + d, lat0 + d * i / steps) for i in range(steps)]
    pts += [(lon0 + d - d * i / steps, lat0 + d) for i in range(steps)] + [(lon0, lat0 + d - d * i / steps) for i in range(steps)]
    return pts + [pts[0]]


def test_area_matches_ellipsoid_and_holes_subtract(spark):
    p = CONUS_ALBERS
    outer = _cell(-90.0, 40.0, 1.0)
    hole = list(reversed(_cell(-89.75, 40.25, 0.5)))
    df = spark.createDataFrame([([[{"x": x, "y": y} for x, y in outer]],),
                                ([[{"x": x, "y": y} for x, y in outer], [{"x": x, "y": y} for x, y in hole]],)], RING_SCHEMA)
    a1, a2 = [r.m.area_m2 for r in with_polygon_metrics(df).select("m").collect()]
    q = lambda deg: p._q(math.radians(deg))
    exact = lambda lat0, lat1, dlon: p.a ** 2 * math.radians(dlon) * (q(lat1) - q(lat0)) / 2
    assert abs(a1 - exact(40.0, 41.0, 1.0)) / a1 < 1e-5
    assert abs(a2 - (exact(40.0, 41.0, 1.0) - exact(40.25, 40.75, 0.5))) / a2 < 1e-5


def test_centroid_symmetric_and_bbox(spark):
    sq = [(-96.5, 30.0), (-95.5, 30.0), (-95.5, 31.0), (-96.5, 31.0), (-96.5, 30.0)]
    df = spark.createDataFrame([([[{"x": x, "y": y} for x, y in sq]],)], RING_SCHEMA)
    m = with_polygon_metrics(df).select("m").first().m
    assert abs(m.centroid_lon + 96.0) < 1e-9  # symmetric about the central meridian
    assert 30.4 < m.centroid_lat < 30.6
    assert (m.bbox_minx, m.bbox_miny, m.bbox_maxx, m.bbox_maxy) == (-96.5, 30.0, -95.5, 31.0)


def test_normalize_tracts_fixture(spark):
    unit = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]
    df = spark.createDataFrame([("55001000100", "55", "001", "000100", "Tract 100", 12345, 678,
                                 [[{"x": x, "y": y} for x, y in unit]], bytearray(b"\x01"))],
                               "GEOID string, STATEFP string, COUNTYFP string, TRACTCE string, NAME string, ALAND long, "
                               "AWATER long, rings array<array<struct<x: double, y: double>>>, geometry_wkb binary")
    r = N.normalize_tracts(df).first()
    assert (r.tract, r.state_fips, r.county_fips, r.tract_code, r.aland, r.awater) == ("55001000100", "55", "001", "000100", 12345, 678)
    assert 0.4 < r.centroid_lon < 0.6 and 0.4 < r.centroid_lat < 0.6 and r.area_m2 > 1.2e10
    assert bytes(r.geometry_wkb) == b"\x01"
    with pytest.raises(ValueError, match="GEOID"):
        N.normalize_tracts(df.drop("GEOID"))


def test_multipolygon_parts_add(spark):
    a = [(-96.5, 30.0), (-96.4, 30.0), (-96.4, 30.1), (-96.5, 30.1), (-96.5, 30.0)]
    b = [(-95.6, 30.0), (-95.5, 30.0), (-95.5, 30.1), (-95.6, 30.1), (-95.6, 30.0)]
    pt = lambda ring: [{"x": x, "y": y} for x, y in ring]
    single = spark.createDataFrame([([pt(a)],), ([pt(b)],)], RING_SCHEMA)
    sa, sb = [r.m for r in with_polygon_metrics(single).select("m").collect()]
    multi = spark.createDataFrame([([[pt(a)], [pt(b)]],)], "rings array<array<array<struct<x: double, y: double>>>>")
    m = with_polygon_metrics(multi).select("m").first().m
    assert abs(m.area_m2 - (sa.area_m2 + sb.area_m2)) < 1e-3
    assert abs(m.centroid_lon + 96.0) < 1e-6  # two mirror-image squares about the central meridian
    assert (m.bbox_minx, m.bbox_maxx) == (-96.5, -95.5)
