"""Geometry as column expressions on plain structs and arrays.

A point is ``struct<x, y>``, a line ``array<point>``, a multipolygon
``array<array<array<point>>>`` (polygons, rings, vertices; the first ring is the outer one).
"""

from __future__ import annotations

import math

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINT = "struct<x:double,y:double>"
LINE = f"array<{POINT}>"
MULTIPOLYGON = f"array<array<{LINE}>>"

# Mean earth radius, WGS84 and Airy 1830 ellipsoids, British grid and its datum shift
EARTH_RADIUS = 6371008.8
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
AIRY_A = 6377563.396
AIRY_B = 6356256.909
GRID_F0 = 0.9996012717
GRID_LAT0 = 49.0
GRID_LON0 = -2.0
GRID_E0 = 400000.0
GRID_N0 = -100000.0
SHIFT_METRES = (446.448, -125.157, 542.060)
SHIFT_SECONDS = (0.1502, 0.2470, 0.8421)
SHIFT_PPM = -20.4894


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def dist_euclid(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt((x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2))


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    u = F.sin((p2 - p1) / 2)
    v = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    h = u * u + F.cos(p1) * F.cos(p2) * v * v
    return F.lit(2 * EARTH_RADIUS) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def sphere_xyz(lat: Column, lon: Column) -> list[Column]:
    """Cartesian metres on the sphere; straight-line distance grows with great-circle distance."""
    p, q = F.radians(lat), F.radians(lon)
    r = F.lit(EARTH_RADIUS)
    return [r * F.cos(p) * F.cos(q), r * F.cos(p) * F.sin(q), r * F.sin(p)]


def geodesic_m(lat1: Column | str, lon1: Column | str, lat2: Column | str, lon2: Column | str) -> Column:
    """Distance on the WGS84 spheroid in metres; null where a coordinate is."""
    ends = [F.col(c) if isinstance(c, str) else c for c in (lat1, lon1, lat2, lon2)]
    known = reduce(lambda a, b: a & b, [c.isNotNull() for c in ends])
    return F.when(known, _geodesic(*ends))


@F.pandas_udf(T.DoubleType())
def _geodesic(lat1: pd.Series, lon1: pd.Series, lat2: pd.Series, lon2: pd.Series) -> pd.Series:
    """Distance on the WGS84 spheroid in metres, by Vincenty's inverse formula.

    The formula iterates on intermediate values, which a column expression would copy into each
    use; whole Arrow batches are computed at once instead.
    """
    f, b = WGS84_F, WGS84_A * (1 - WGS84_F)
    u1, u2 = (np.arctan((1 - f) * np.tan(np.radians(v.to_numpy(float)))) for v in (lat1, lat2))
    s1, c1, s2, c2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    reach = np.radians(lon2.to_numpy(float) - lon1.to_numpy(float))
    lam = reach
    for _ in range(12):
        across = c2 * np.sin(lam)
        along = c1 * s2 - s1 * c2 * np.cos(lam)
        sin_s, cos_s = np.hypot(across, along), s1 * s2 + c1 * c2 * np.cos(lam)
        sigma = np.arctan2(sin_s, cos_s)
        sin_a = np.divide(c1 * across, sin_s, out=np.zeros_like(sin_s), where=sin_s > 0)
        cos2_a = 1 - sin_a**2
        # on the equator the midpoint term vanishes
        mid = cos_s - np.divide(2 * s1 * s2, cos2_a, out=cos_s.copy(), where=cos2_a > 1e-15)
        c = f / 16 * cos2_a * (4 + f * (4 - 3 * cos2_a))
        lam = reach + (1 - c) * f * sin_a * (sigma + c * sin_s * (mid + c * cos_s * (2 * mid**2 - 1)))
    u = cos2_a * (WGS84_A**2 / b**2 - 1)
    big_a = 1 + u / 16384 * (4096 + u * (u * (320 - 175 * u) - 768))
    big_b = u / 1024 * (256 + u * (u * (74 - 47 * u) - 128))
    tail = cos_s * (2 * mid**2 - 1) - big_b / 6 * mid * (4 * sin_s**2 - 3) * (4 * mid**2 - 3)
    return pd.Series(b * big_a * (sigma - big_b * sin_s * (mid + big_b / 4 * tail)))


def mercator_to_wgs84(x: Column, y: Column) -> Column:
    """Spherical (web) Mercator metres to degrees."""
    r = F.lit(WGS84_A)
    return point(F.degrees(x / r), F.degrees(2 * F.atan(F.exp(y / r)) - F.lit(math.pi / 2)))


def osgb_to_wgs84(easting: Column, northing: Column) -> Column:
    """British National Grid metres to WGS84 degrees, ``x`` longitude and ``y`` latitude.

    Inverse transverse Mercator on Airy 1830 (footpoint latitude by the rectifying-latitude
    series), then the seven-parameter datum shift in Cartesian coordinates.
    """
    a, b = AIRY_A * GRID_F0, AIRY_B * GRID_F0
    n = (a - b) / (a + b)
    e2 = 1 - (AIRY_B / AIRY_A) ** 2
    lat0 = math.radians(GRID_LAT0)
    # meridian arc from the equator to the true origin
    mean = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    arc0 = b * (
        (1 + n + 5 / 4 * (n**2 + n**3)) * lat0
        - (3 * n + 3 * n**2 + 21 / 8 * n**3) * math.sin(lat0) * math.cos(lat0)
        + 15 / 8 * (n**2 + n**3) * math.sin(2 * lat0) * math.cos(2 * lat0)
        - 35 / 24 * n**3 * math.sin(3 * lat0) * math.cos(3 * lat0)
    )
    mu = (northing.cast("double") - F.lit(GRID_N0) + F.lit(arc0)) / F.lit(mean)
    foot = (
        mu
        + F.lit(3 * n / 2 - 27 * n**3 / 32) * F.sin(2 * mu)
        + F.lit(21 * n**2 / 16 - 55 * n**4 / 32) * F.sin(4 * mu)
        + F.lit(151 * n**3 / 96) * F.sin(6 * mu)
        + F.lit(1097 * n**4 / 512) * F.sin(8 * mu)
    )
    d = easting.cast("double") - F.lit(GRID_E0)

    def project(phi: Column) -> Column:
        w = 1 - F.lit(e2) * F.sin(phi) * F.sin(phi)
        nu = F.lit(a) / F.sqrt(w)
        eta2 = w / F.lit(1 - e2) - 1
        t2 = F.tan(phi) * F.tan(phi)
        r = d / nu
        r2 = r * r
        drop = F.tan(phi) * (1 + eta2) * r2 * (
            F.lit(0.5)
            - r2 / 24 * (5 + 3 * t2 + eta2 * (1 - 9 * t2))
            + r2 * r2 / 720 * (61 + 90 * t2 + 45 * t2 * t2)
        )
        turn = r / F.cos(phi) * (
            1
            - r2 / 6 * (1 + eta2 + 2 * t2)
            + r2 * r2 / 120 * (5 + 28 * t2 + 24 * t2 * t2)
            - r2 * r2 * r2 / 5040 * (61 + 662 * t2 + 1320 * t2 * t2 + 720 * t2 * t2 * t2)
        )
        return F.struct((phi - drop).alias("lat"), (F.lit(math.radians(GRID_LON0)) + turn).alias("lon"))

    def shift(p: Column) -> Column:
        lat, lon = p["lat"], p["lon"]
        nu = F.lit(AIRY_A) / F.sqrt(1 - F.lit(e2) * F.sin(lat) * F.sin(lat))
        x, y, z = nu * F.cos(lat) * F.cos(lon), nu * F.cos(lat) * F.sin(lon), nu * F.lit(1 - e2) * F.sin(lat)
        rx, ry, rz = (math.radians(s / 3600) for s in SHIFT_SECONDS)
        tx, ty, tz = SHIFT_METRES
        s = 1 + SHIFT_PPM * 1e-6
        return F.struct(
            (F.lit(tx) + F.lit(s) * x - F.lit(rz) * y + F.lit(ry) * z).alias("x"),
            (F.lit(ty) + F.lit(rz) * x + F.lit(s) * y - F.lit(rx) * z).alias("y"),
            (F.lit(tz) - F.lit(ry) * x + F.lit(rx) * y + F.lit(s) * z).alias("z"),
        )

    def degrees(c: Column) -> Column:
        # Bowring's closed form, far below a millimetre near the surface
        wb = WGS84_A * (1 - WGS84_F)
        we2 = WGS84_F * (2 - WGS84_F)
        p = F.sqrt(c["x"] * c["x"] + c["y"] * c["y"])
        beta = F.atan2(c["z"] * F.lit(WGS84_A), p * F.lit(wb))
        up = c["z"] + F.lit(we2 / (1 - we2) * wb) * F.pow(F.sin(beta), F.lit(3))
        out = p - F.lit(we2 * WGS84_A) * F.pow(F.cos(beta), F.lit(3))
        return point(F.degrees(F.atan2(c["y"], c["x"])), F.degrees(F.atan2(up, out)))

    # each stage reads its input several times, so pass it on as a value, not as a copied expression
    staged = F.transform(F.transform(F.transform(F.array(foot), project), shift), degrees)
    return staged[0]


def _edges(ring: Column) -> Column:
    """Consecutive vertex pairs, closing the ring (a repeated last vertex gives an empty edge)."""
    following = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    return F.arrays_zip(ring.alias("a"), following.alias("b"))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def centroid(polygons: Column) -> Column:
    """Area centroid of a multipolygon; holes count negative whatever their direction."""
    origin = polygons[0][0][0]

    def ring_sums(ring: Column, index: Column) -> Column:
        def wedge(e: Column) -> Column:
            ax, ay = e["a"]["x"] - origin["x"], e["a"]["y"] - origin["y"]
            bx, by = e["b"]["x"] - origin["x"], e["b"]["y"] - origin["y"]
            cross = ax * by - bx * ay
            return F.struct(cross.alias("area"), ((ax + bx) * cross).alias("mx"), ((ay + by) * cross).alias("my"))

        wedges = F.transform(_edges(ring), wedge)
        area = _total(F.transform(wedges, lambda w: w["area"]))
        sign = F.when(index == 0, F.lit(1.0)).otherwise(F.lit(-1.0)) * F.signum(area)
        return F.struct(
            (sign * area).alias("area"),
            (sign * _total(F.transform(wedges, lambda w: w["mx"]))).alias("mx"),
            (sign * _total(F.transform(wedges, lambda w: w["my"]))).alias("my"),
        )

    rings = F.flatten(F.transform(polygons, lambda poly: F.transform(poly, ring_sums)))
    area = _total(F.transform(rings, lambda r: r["area"]))
    mx = _total(F.transform(rings, lambda r: r["mx"]))
    my = _total(F.transform(rings, lambda r: r["my"]))
    return point(origin["x"] + F.try_divide(mx, 3 * area), origin["y"] + F.try_divide(my, 3 * area))


def on_segment(pt: Column, a: Column, b: Column) -> Column:
    """Nearest point to ``pt`` on the segment from ``a`` to ``b``."""
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    along = F.try_divide((pt["x"] - a["x"]) * dx + (pt["y"] - a["y"]) * dy, dx * dx + dy * dy)
    t = F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), along)), F.lit(0.0))
    return point(a["x"] + t * dx, a["y"] + t * dy)


def closest_point(line: Column, pt: Column) -> Column:
    """Nearest point to ``pt`` on a polyline; of equally near ones that of the first segment."""
    last = F.greatest(F.size(line) - 1, F.lit(1))
    ends = F.arrays_zip(F.slice(line, 1, last).alias("a"), F.slice(F.concat(line, F.slice(line, 1, 1)), 2, last).alias("b"))

    def candidate(e: Column, i: Column) -> Column:
        on = on_segment(pt, e["a"], e["b"])
        return F.struct(dist_euclid(pt["x"], pt["y"], on["x"], on["y"]).alias("d"), i.alias("i"), on.alias("p"))

    return F.array_min(F.transform(ends, candidate))["p"]


def bounds(polygons: Column) -> Column:
    """``struct<xmin, ymin, xmax, ymax>`` of a multipolygon."""
    pts = F.flatten(F.flatten(polygons))
    xs, ys = F.transform(pts, lambda p: p["x"]), F.transform(pts, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"), F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax")
    )


def edges(polygons: Column) -> Column:
    """All edges of a multipolygon as ``array<struct<a, b>>``."""
    return F.flatten(ring_edges(polygons))


def ring_edges(polygons: Column) -> Column:
    """The edges of each ring of a multipolygon."""
    return F.transform(F.flatten(polygons), _edges)


# kept from the first edge the point lies on; even, and above any number of crossings
ON_EDGE = 1 << 30


def _meets(pt: Column, e: Column) -> tuple[Column, Column]:
    """Whether a point lies on an edge, and whether the edge is crossed to the right of it."""
    px, py = pt["x"], pt["y"]
    ax, ay, bx, by = e["a"]["x"], e["a"]["y"], e["b"]["x"], e["b"]["y"]
    cross = (bx - ax) * (py - ay) - (by - ay) * (px - ax)
    touches = (cross == 0) & px.between(F.least(ax, bx), F.greatest(ax, bx)) & py.between(F.least(ay, by), F.greatest(ay, by))
    return touches, ((ay > py) != (by > py)) & ((by > ay) == (cross > 0))


def crossings(pt: Column, edge_list: Column) -> Column:
    """Number of edges crossed to the right of a point; ``ON_EDGE`` where it lies on one."""

    def count(acc: Column, e: Column) -> Column:
        touches, crosses = _meets(pt, e)
        return F.when(touches, F.lit(ON_EDGE)).when(crosses, acc + 1).otherwise(acc)

    return F.aggregate(edge_list, F.lit(0), lambda acc, e: F.when(acc == ON_EDGE, acc).otherwise(count(acc, e)))


def within_edges(pt: Column, edge_list: Column) -> Column:
    """Strictly inside: an odd number of edges crossed to the right, and not on any edge."""
    return crossings(pt, edge_list) % 2 == 1


def within_few_edges(pt: Column, edge_list: Column, most: int) -> Column:
    """As :func:`within_edges` for lists of at most ``most`` edges, written out edge by edge, which Spark compiles."""
    odd, on = F.lit(False), F.lit(False)
    for i in range(most):
        touches, crosses = _meets(pt, F.get(edge_list, F.lit(i)))
        odd, on = odd != F.coalesce(crosses, F.lit(False)), on | F.coalesce(touches, F.lit(False))
    return odd & ~on


def within(pt: Column, polygons: Column) -> Column:
    """Strictly inside a multipolygon."""
    return within_edges(pt, edges(polygons))
