"""Polygon metrics on ring arrays, computed in an equal-area projection (JVM-side).

Geometry is carried as ``rings: array<array<struct<x: double, y: double>>>``
(longitude/latitude degrees; ring 0 is the exterior, the rest are holes).
Centroid and area are computed in the Albers equal-area conic projection —
forward and inverse formulas from Snyder (1987), "Map Projections: A Working
Manual", ch. 14 — with higher-order array functions, so there is no per-row
Python and no geometry library.

Fixed values (the CONUS Albers definition, EPSG:5070, on the GRS80 ellipsoid):
    standard parallels 29.5°N and 45.5°N, latitude of origin 23°N,
    central meridian 96°W, false easting/northing 0,
    semi-major axis 6378137 m, inverse flattening 298.257222101
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Albers:
    lat1: float = 29.5
    lat2: float = 45.5
    lat0: float = 23.0
    lon0: float = -96.0
    a: float = 6378137.0
    inv_f: float = 298.257222101

    @property
    def e2(self) -> float:
        f = 1.0 / self.inv_f
        return 2 * f - f * f

    @property
    def e(self) -> float:
        return math.sqrt(self.e2)

    def _m(self, phi: float) -> float:
        return math.cos(phi) / math.sqrt(1 - self.e2 * math.sin(phi) ** 2)

    def _q(self, phi: float) -> float:
        e, e2, s = self.e, self.e2, math.sin(phi)
        return (1 - e2) * (s / (1 - e2 * s * s) - (1 / (2 * e)) * math.log((1 - e * s) / (1 + e * s)))

    @property
    def consts(self) -> tuple[float, float, float, float]:
        p1, p2, p0 = (math.radians(v) for v in (self.lat1, self.lat2, self.lat0))
        m1, m2 = self._m(p1), self._m(p2)
        q1, q2, q0 = self._q(p1), self._q(p2), self._q(p0)
        n = (m1 * m1 - m2 * m2) / (q2 - q1)
        c = m1 * m1 + n * q1
        rho0 = self.a * math.sqrt(c - n * q0) / n
        qp = self._q(math.pi / 2)
        return n, c, rho0, qp


CONUS_ALBERS = Albers()


def _q_col(phi: Column, p: Albers) -> Column:
    e, e2 = p.e, p.e2
    s = F.sin(phi)
    return F.lit(1 - e2) * (s / (F.lit(1.0) - F.lit(e2) * s * s)
                            - F.lit(1 / (2 * e)) * F.log((F.lit(1.0) - F.lit(e) * s) / (F.lit(1.0) + F.lit(e) * s)))


def albers_forward(lon: Column, lat: Column, p: Albers = CONUS_ALBERS) -> tuple[Column, Column]:
    """(lon, lat) degrees → (x, y) metres."""
    n, c, rho0, _ = p.consts
    q = _q_col(F.radians(lat), p)
    rho = F.lit(p.a) * F.sqrt(F.lit(c) - F.lit(n) * q) / F.lit(n)
    theta = F.lit(n) * (F.radians(lon) - F.lit(math.radians(p.lon0)))
    return rho * F.sin(theta), F.lit(rho0) - rho * F.cos(theta)


def albers_inverse(x: Column, y: Column, p: Albers = CONUS_ALBERS) -> tuple[Column, Column]:
    """(x, y) metres → (lon, lat) degrees, via the authalic latitude series (Snyder eq. 3-18)."""
    n, c, rho0, qp = p.consts
    e2 = p.e2
    dy = F.lit(rho0) - y
    rho = F.sqrt(x * x + dy * dy)
    theta = F.atan2(x, dy)
    q = (F.lit(c) - rho * rho * F.lit(n * n) / F.lit(p.a * p.a)) / F.lit(n)
    beta = F.asin(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), q / F.lit(qp))))
    e4, e6 = e2 * e2, e2 * e2 * e2
    phi = (beta + F.lit(e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) * F.sin(2 * beta)
           + F.lit(23 * e4 / 360 + 251 * e6 / 3780) * F.sin(4 * beta) + F.lit(761 * e6 / 45360) * F.sin(6 * beta))
    lon = F.degrees(theta / F.lit(n)) + F.lit(p.lon0)
    return lon, F.degrees(phi)


def _project_ring(ring: Column, p: Albers) -> Column:
    def proj(pt):
        x, y = albers_forward(pt["x"], pt["y"], p)
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(ring, proj)


def _ring_moments(ring: Column, ox: Column, oy: Column) -> Column:
    """struct(a, mx, my): shoelace area and first moments of a ring, relative to (ox, oy)."""
    rel = F.transform(ring, lambda pt: F.struct((pt["x"] - ox).alias("x"), (pt["y"] - oy).alias("y")))
    nxt = F.concat(F.slice(rel, 2, F.size(rel)), F.slice(rel, 1, 1))
    terms = F.zip_with(rel, nxt, lambda p0, p1: F.struct(
        (p0["x"] * p1["y"] - p1["x"] * p0["y"]).alias("cr"), (p0["x"] + p1["x"]).alias("sx"),
        (p0["y"] + p1["y"]).alias("sy")))
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))
    return F.aggregate(terms, zero, lambda acc, t: F.struct(
        (acc["a"] + t["cr"] / 2).alias("a"), (acc["mx"] + t["sx"] * t["cr"] / 6).alias("mx"),
        (acc["my"] + t["sy"] * t["cr"] / 6).alias("my")))


def with_polygon_metrics(df: DataFrame, rings: str = "rings", out: str = "m", p: Albers = CONUS_ALBERS) -> DataFrame:
    """GEO-12/13/14: add struct ``out`` = (area_m2, centroid_lat, centroid_lon, bbox_minx, bbox_miny, bbox_maxx, bbox_maxy).

    ``rings`` is a polygon (``array<array<struct<x,y>>>``, exterior first) or a
    multi-polygon (``array<array<array<struct<x,y>>>>``, one polygon per part);
    parts add their area-weighted moments. Staged projections keep every
    intermediate (projected rings, origin, ring moments, authalic latitude)
    computed once per row. Holes subtract whatever their stored orientation;
    NULL or empty rings give NULL metrics.
    """
    n, c, rho0, qp = p.consts
    e2 = p.e2
    e4, e6 = e2 * e2, e2 * e2 * e2
    from pyspark.sql import types as T

    dtype = df.schema[rings].dataType
    multi = isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.ArrayType) and isinstance(
        dtype.elementType.elementType, T.ArrayType)
    # one list of (role, ring): +1 for each part's exterior ring, -1 for its holes
    tagged = (F.flatten(F.transform(F.col(rings), lambda part: F.transform(
        part, lambda ring, i: F.struct(F.when(i == 0, F.lit(1.0)).otherwise(F.lit(-1.0)).alias("role"),
                                       ring.alias("ring"))))) if multi else
        F.transform(F.col(rings), lambda ring, i: F.struct(
            F.when(i == 0, F.lit(1.0)).otherwise(F.lit(-1.0)).alias("role"), ring.alias("ring"))))
    r = F.transform(tagged, lambda t: t["ring"])
    d = df.withColumn("_tagged", tagged)
    d = d.withColumn("_proj", F.transform(F.col("_tagged"), lambda t: F.struct(
        t["role"].alias("role"), _project_ring(t["ring"], p).alias("ring"))))
    d = d.withColumn("_o", F.col("_proj")[0]["ring"][0])
    ox, oy = F.col("_o")["x"], F.col("_o")["y"]
    mom = F.transform(F.col("_proj"), lambda t: F.struct(t["role"].alias("role"),
                                                          _ring_moments(t["ring"], ox, oy).alias("m")))
    d = d.withColumn("_mom", mom)
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))
    tot = F.aggregate(F.col("_mom"), zero, lambda acc, t: F.struct(
        (acc["a"] + t["role"] * F.abs(t["m"]["a"])).alias("a"),
        (acc["mx"] + t["role"] * F.signum(t["m"]["a"]) * t["m"]["mx"]).alias("mx"),
        (acc["my"] + t["role"] * F.signum(t["m"]["a"]) * t["m"]["my"]).alias("my")))
    d = d.withColumn("_tot", tot)
    d = d.withColumn("_cx", F.try_divide(F.col("_tot")["mx"], F.col("_tot")["a"]) + ox).withColumn(
        "_cy", F.try_divide(F.col("_tot")["my"], F.col("_tot")["a"]) + oy)
    dy = F.lit(rho0) - F.col("_cy")
    d = d.withColumn("_rho", F.sqrt(F.col("_cx") * F.col("_cx") + dy * dy)).withColumn("_theta", F.atan2(F.col("_cx"), dy))
    q = (F.lit(c) - F.col("_rho") * F.col("_rho") * F.lit(n * n) / F.lit(p.a * p.a)) / F.lit(n)
    d = d.withColumn("_beta", F.asin(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), q / F.lit(qp)))))
    b = F.col("_beta")
    phi = (b + F.lit(e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) * F.sin(2 * b)
           + F.lit(23 * e4 / 360 + 251 * e6 / 3780) * F.sin(4 * b) + F.lit(761 * e6 / 45360) * F.sin(6 * b))
    pts = F.flatten(r)
    xs = F.transform(pts, lambda pt: pt["x"])
    ys = F.transform(pts, lambda pt: pt["y"])
    d = d.withColumn(out, F.struct(
        F.col("_tot")["a"].alias("area_m2"), F.degrees(phi).alias("centroid_lat"),
        (F.degrees(F.col("_theta") / F.lit(n)) + F.lit(p.lon0)).alias("centroid_lon"),
        F.array_min(xs).alias("bbox_minx"), F.array_min(ys).alias("bbox_miny"),
        F.array_max(xs).alias("bbox_maxx"), F.array_max(ys).alias("bbox_maxy"),
    ))
    return d.drop("_tagged", "_proj", "_o", "_mom", "_tot", "_cx", "_cy", "_rho", "_theta", "_beta")
