"""Queries over the spatial operators."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from fairreach.catalog.fixtures import K_BY_TYPE, Tables
from fairreach.catalog.registry import query
from fairreach.functions import geo
from fairreach.operators.containment import points_in_polygons
from fairreach.operators.nearest import k_nearest, k_nearest_planar, nearest_line

_K_VALUES = ", ".join(f"('{name}', {k or 3})" for name, k in K_BY_TYPE.items())


def _haversine(a: str, b: str) -> str:
    lat = f"sin(radians({b}.lat - {a}.lat) / 2)"
    lon = f"sin(radians({b}.lon - {a}.lon) / 2)"
    return f"2 * 6371008.8e0 * asin(sqrt({lat} * {lat} + cos(radians({a}.lat)) * cos(radians({b}.lat)) * {lon} * {lon}))"


_RANKED = f"""ranked AS (SELECT o.oa_id, p.poi_id, p.type AS poi_type, round({_haversine('o', 'p')}, 3) AS m,
    rank() OVER (PARTITION BY o.oa_id, p.type ORDER BY round({_haversine('o', 'p')}, 3)) AS rank FROM fx_oa o, fx_poi p),
    k AS (SELECT * FROM (VALUES {_K_VALUES}) v(poi_type, k))"""


def _vincenty_sql(rounds: int, keys: str, pairs: str) -> str:
    """Vincenty's inverse formula as a chain of subqueries, one per round; ``metres`` of the keys of ``pairs``, joined as o and p."""
    f, names = "(1 / 298.257223563e0)", ", ".join(k.split(".")[-1] for k in keys.split(", "))
    out = f"""v AS (SELECT {keys}, atan((1 - {f}) * tan(radians(o.lat))) AS u1, atan((1 - {f}) * tan(radians(p.lat))) AS u2,
        radians(p.lon - o.lon) AS l FROM {pairs}), r0 AS (SELECT *, l AS lam FROM v)"""
    for i in range(rounds):
        out += f""", s{i} AS (SELECT *, sqrt((cos(u2) * sin(lam)) ** 2 + (cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam)) ** 2) AS ss,
            sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam) AS cs FROM r{i}),
            a{i} AS (SELECT *, atan2(ss, cs) AS sg, CASE WHEN ss = 0 THEN 0e0 ELSE cos(u1) * cos(u2) * sin(lam) / ss END AS sa FROM s{i}),
            m{i} AS (SELECT *, 1 - sa * sa AS c2, cs - 2 * sin(u1) * sin(u2) / (1 - sa * sa) AS cm FROM a{i}),
            k{i} AS (SELECT *, {f} / 16 * c2 * (4 + {f} * (4 - 3 * c2)) AS c FROM m{i}),
            r{i + 1} AS (SELECT {names}, u1, u2, l, ss AS ss_, cs AS cs_, sg AS sg_, c2 AS c2_, cm AS cm_,
            l + (1 - c) * {f} * sa * (sg + c * ss * (cm + c * cs * (2 * cm * cm - 1))) AS lam FROM k{i})"""
    return out + f""", e AS (SELECT *, c2_ * ((6378137e0 ** 2 - (6378137e0 * (1 - {f})) ** 2) / (6378137e0 * (1 - {f})) ** 2) AS u FROM r{rounds}),
        g AS (SELECT *, 1 + u / 16384 * (4096 + u * (-768 + u * (320 - 175 * u))) AS ba, u / 1024 * (256 + u * (-128 + u * (74 - 47 * u))) AS bb FROM e)
        SELECT {names}, round(6378137e0 * (1 - {f}) * ba * (sg_ - bb * ss_ * (cm_ + bb / 4 * (cs_ * (2 * cm_ * cm_ - 1)
        - bb / 6 * cm_ * (4 * ss_ * ss_ - 3) * (4 * cm_ * cm_ - 3)))), 1) AS metres FROM g"""


@query(
    "knn_poi",
    f"""WITH {_RANKED}, near AS (SELECT oa_id, poi_id, poi_type, rank, m FROM ranked JOIN k USING (poi_type) WHERE rank <= k),
    d AS (WITH {_vincenty_sql(6, "n.oa_id, n.poi_id, n.poi_type, n.rank, n.m", "near n JOIN fx_oa o ON n.oa_id = o.oa_id JOIN fx_poi p ON n.poi_id = p.poi_id")})
    SELECT oa_id, poi_id, poi_type, rank, round(m, 1) AS metres, metres AS distance FROM d""",
)
def _(t: Tables):
    near = k_nearest(t.fx_oa(), t.fx_poi(), K_BY_TYPE)
    return near.select("oa_id", "poi_id", "poi_type", "rank", F.round("sphere_m", 1).alias("metres"), F.round("distance", 1).alias("distance"))


@query("join_lateral_topk", f"WITH {_RANKED} SELECT oa_id, poi_id FROM ranked WHERE poi_type = 'School' AND rank <= 5")
def _(t: Tables):
    return k_nearest(t.fx_oa(), t.fx_poi(), {"School": 5}, spheroid=False).select("oa_id", "poi_id")


@query("win_rank_topk", f"WITH {_RANKED} SELECT poi_id, poi_type, rank, count(*) AS areas FROM ranked WHERE rank <= 3 GROUP BY 1, 2, 3")
def _(t: Tables):
    near = k_nearest(t.fx_oa(), t.fx_poi(), dict.fromkeys(K_BY_TYPE, 3), spheroid=False)
    return near.groupBy("poi_id", "poi_type", "rank").agg(F.count("*").alias("areas"))


@query(
    "knn_poi_planar",
    """SELECT oa_id, poi_id, rank, round(dist, 9) AS dist FROM (SELECT o.oa_id, p.poi_id,
       sqrt((o.lat - p.lat) * (o.lat - p.lat) + (o.lon - p.lon) * (o.lon - p.lon)) AS dist,
       row_number() OVER (PARTITION BY o.oa_id ORDER BY sqrt((o.lat - p.lat) * (o.lat - p.lat) + (o.lon - p.lon) * (o.lon - p.lon)), p.poi_id) AS rank
       FROM fx_oa o, fx_poi p WHERE p.type IN ('School', 'Hospital')) WHERE rank <= 3""",
)
def _(t: Tables):
    pois = t.fx_poi().where(F.col("type").isin("School", "Hospital"))
    near = k_nearest_planar(t.fx_oa(), pois, 3)
    return near.select("oa_id", "poi_id", F.col("rank").cast("bigint").alias("rank"), F.round("dist", 9).alias("dist"))


_SNAP = """hits AS (SELECT point_id, line_id, seg, ax + w * (zx - ax) AS sx, ay + w * (zy - ay) AS sy, x, y FROM
    (SELECT p.*, s.*, greatest(0e0, least(1e0, ((x - ax) * (zx - ax) + (y - ay) * (zy - ay)) / ((zx - ax) * (zx - ax) + (zy - ay) * (zy - ay)))) AS w
    FROM fx_points p, fx_segments s)),
    near AS (SELECT *, row_number() OVER (PARTITION BY point_id ORDER BY (x - sx) * (x - sx) + (y - sy) * (y - sy), line_id, seg) AS n FROM hits)"""


@query("knn_nearest_road", f"WITH {_SNAP} SELECT point_id, line_id, round(sx, 9) AS sx, round(sy, 9) AS sy FROM near WHERE n = 1")
def _(t: Tables):
    snapped = nearest_line(t.fx_points(), t.fx_roads())
    return snapped.select("point_id", "line_id", F.round("snapped.x", 9).alias("sx"), F.round("snapped.y", 9).alias("sy"))


@query("join_lateral_knn1", f"WITH {_SNAP} SELECT line_id, count(*) AS points FROM near WHERE n = 1 GROUP BY 1")
def _(t: Tables):
    return nearest_line(t.fx_points(), t.fx_roads()).groupBy("line_id").agg(F.count("*").alias("points"))


_INSIDE = """(x2 - x1) * (y - y1) - (y2 - y1) * (x - x1) > 0 AND (x3 - x2) * (y - y2) - (y3 - y2) * (x - x2) > 0
    AND (x1 - x3) * (y - y3) - (y1 - y3) * (x - x3) > 0"""
_PLACES = "(SELECT oa_id AS point_id, lon AS x, lat AS y FROM fx_oa)"


def _places(t: Tables):
    return t.fx_oa().select(F.col("oa_id").alias("point_id"), F.col("lon").alias("x"), F.col("lat").alias("y"))


@query("join_within", f"SELECT point_id, poly_id FROM {_PLACES}, fx_tri WHERE {_INSIDE}")
def _(t: Tables):
    return points_in_polygons(_places(t), t.fx_polys(), workers=t.spark.sparkContext.defaultParallelism).select("point_id", "poly_id")


@query(
    "geo_within",
    f"SELECT c_custkey, {_INSIDE} AS inside FROM (SELECT c.*, c_custkey, lon AS x, lat AS y FROM fx_oa o JOIN customer c ON o.oa_id = c.c_custkey) JOIN fx_tri ON c_nationkey = poly_id",
)
def _(t: Tables):
    located = t.customer.join(t.fx_oa(), F.col("c_custkey") == F.col("oa_id"))
    joined = located.join(t.fx_polys(), F.col("c_nationkey") == F.col("poly_id"))
    return joined.select("c_custkey", geo.within(geo.point(F.col("lon"), F.col("lat")), F.col("geometry")).alias("inside"))


@query("geo_centroid", "SELECT poly_id, round((x1 + x2 + x3) / 3, 6) AS x, round((y1 + y2 + y3) / 3, 6) AS y FROM fx_tri")
def _(t: Tables):
    middle = geo.centroid(F.col("geometry"))
    return t.fx_polys().select("poly_id", F.round(middle["x"], 6).alias("x"), F.round(middle["y"], 6).alias("y"))


@query(
    "geo_closest_point",
    """WITH hits AS (SELECT point_id, seg, x, y, ax + w * (zx - ax) AS sx, ay + w * (zy - ay) AS sy FROM
       (SELECT p.*, s.*, greatest(0e0, least(1e0, ((x - ax) * (zx - ax) + (y - ay) * (zy - ay)) / ((zx - ax) * (zx - ax) + (zy - ay) * (zy - ay)))) AS w
       FROM fx_points p JOIN fx_segments s ON p.point_id = s.line_id))
       SELECT point_id, round(sx, 9) AS sx, round(sy, 9) AS sy FROM
       (SELECT *, row_number() OVER (PARTITION BY point_id ORDER BY (x - sx) * (x - sx) + (y - sy) * (y - sy), seg) AS n FROM hits) WHERE n = 1""",
)
def _(t: Tables):
    joined = t.fx_points().join(t.fx_roads(), F.col("point_id") == F.col("line_id"))
    on = geo.closest_point(F.col("way"), geo.point(F.col("x"), F.col("y")))
    return joined.select("point_id", F.round(on["x"], 9).alias("sx"), F.round(on["y"], 9).alias("sy"))


@query("geo_point", "SELECT oa_id, lon AS x, lat AS y FROM fx_oa")
def _(t: Tables):
    return t.fx_oa().select("oa_id", geo.point(F.col("lon"), F.col("lat")).alias("p")).select("oa_id", "p.x", "p.y")


@query("geo_xy", "SELECT point_id, y AS latitude, x AS longitude FROM fx_points")
def _(t: Tables):
    located = t.fx_points().select("point_id", geo.point(F.col("x"), F.col("y")).alias("p"))
    return located.select("point_id", F.col("p").getField("y").alias("latitude"), F.col("p").getField("x").alias("longitude"))


@query(
    "geo_reproject",
    """SELECT l_orderkey, l_partkey, round(degrees(-l_extendedprice / 6378137e0), 9) AS lon,
       round(degrees(2 * atan(exp((l_extendedprice * 60) / 6378137e0)) - pi() / 2), 9) AS lat FROM lineitem""",
)
def _(t: Tables):
    price = F.col("l_extendedprice")
    at = geo.mercator_to_wgs84(-price, price * 60)
    return t.lineitem.select("l_orderkey", "l_partkey", F.round(at["x"], 9).alias("lon"), F.round(at["y"], 9).alias("lat"))


def grid_sql(source: str, rounds: int = 7) -> str:
    """National grid to degrees as chained subqueries, ending in ``grid(id, lon, lat)``.

    ``source`` yields id, e, n. The latitude after the datum shift is found by iteration, other than in the operator.
    """
    num = lambda x: f"({x:.17e})"  # noqa: E731  an exponent makes it a double
    a, b = geo.AIRY_A * geo.GRID_F0, geo.AIRY_B * geo.GRID_F0
    m, e2 = (a - b) / (a + b), 1 - (geo.AIRY_B / geo.AIRY_A) ** 2
    origin = math.radians(geo.GRID_LAT0)
    terms = [1 + m + 1.25 * (m**2 + m**3), 3 * m + 3 * m**2 + 2.625 * m**3, 1.875 * (m**2 + m**3), 35 / 24 * m**3]
    waves = [math.sin(k * origin) * math.cos(k * origin) for k in (1, 2, 3)]
    arc = b * (terms[0] * origin - terms[1] * waves[0] + terms[2] * waves[1] - terms[3] * waves[2])
    mean = a / (1 + m) * (1 + m**2 / 4 + m**4 / 64)
    series = [1.5 * m - 27 / 32 * m**3, 21 / 16 * m**2 - 55 / 32 * m**4, 151 / 96 * m**3, 1097 / 512 * m**4]
    foot = " + ".join(f"{num(c)} * sin({2 * k} * mu)" for k, c in enumerate(series, 1))
    out = f"""p0 AS (SELECT id, e - {num(geo.GRID_E0)} AS d, (n - {num(geo.GRID_N0)} + {num(arc)}) / {num(mean)} AS mu FROM ({source})),
        foot AS (SELECT id, d, mu + {foot} AS p FROM p0)"""
    out += f""", nu AS (SELECT id, p, d / ({num(a)} / sqrt(1 - {num(e2)} * sin(p) ** 2)) AS r, (1 - {num(e2)} * sin(p) ** 2) / (1 - {num(e2)}) AS q, tan(p) ** 2 AS t FROM foot),
        airy AS (SELECT id, p - tan(p) * q * (r ** 2 / 2 - r ** 4 / 24 * (5 + 3 * t + (q - 1) - 9 * t * (q - 1)) + r ** 6 / 720 * (61 + 90 * t + 45 * t ** 2)) AS f,
        {num(math.radians(geo.GRID_LON0))} + (r - r ** 3 / 6 * (q + 2 * t) + r ** 5 / 120 * (5 + 28 * t + 24 * t ** 2) - r ** 7 / 5040 * (61 + 662 * t + 1320 * t ** 2 + 720 * t ** 3)) / cos(p) AS l FROM nu),
        old AS (SELECT id, v * cos(f) * cos(l) AS x, v * cos(f) * sin(l) AS y, v * {num(1 - e2)} * sin(f) AS z FROM (SELECT *, {num(geo.AIRY_A)} / sqrt(1 - {num(e2)} * sin(f) ** 2) AS v FROM airy))"""
    rx, ry, rz = (num(math.radians(s / 3600)) for s in geo.SHIFT_SECONDS)
    tx, ty, tz = (num(v) for v in geo.SHIFT_METRES)
    s, w2 = num(1 + geo.SHIFT_PPM * 1e-6), num(geo.WGS84_F * (2 - geo.WGS84_F))
    out += f""", new AS (SELECT id, {tx} + {s} * x - {rz} * y + {ry} * z AS x, {ty} + {rz} * x + {s} * y - {rx} * z AS y, {tz} - {ry} * x + {rx} * y + {s} * z AS z FROM old),
        b0 AS (SELECT id, z, atan2(y, x) AS l, sqrt(x * x + y * y) AS h, atan2(z, sqrt(x * x + y * y) * (1 - {w2})) AS f FROM new)"""
    for k in range(rounds):
        out += f", b{k + 1} AS (SELECT id, z, l, h, atan2(z + {w2} * {num(geo.WGS84_A)} / sqrt(1 - {w2} * sin(f) ** 2) * sin(f), h) AS f FROM b{k})"
    return out + f", grid AS (SELECT id, degrees(l) AS lon, degrees(f) AS lat FROM b{rounds})"


_GRID_ORDERS = grid_sql("SELECT o_orderkey AS id, 380000 + o_orderkey * 7919 % 60000 AS e, 270000 + o_orderkey * 104729 % 40000 AS n FROM orders")


@query("geo_reproject_grid", f"WITH {_GRID_ORDERS} SELECT id AS o_orderkey, round(lon, 7) AS lon, round(lat, 7) AS lat FROM grid")
def _(t: Tables):
    """National grid coordinates spread over the county from the order table; unit tests check the values."""
    east = F.lit(380000) + F.col("o_orderkey") * 7919 % 60000
    north = F.lit(270000) + F.col("o_orderkey") * 104729 % 40000
    at = geo.osgb_to_wgs84(east, north)
    return t.orders.select("o_orderkey", F.round(at["x"], 7).alias("lon"), F.round(at["y"], 7).alias("lat"))


_PAIRS = "fx_trips t JOIN fx_oa o ON t.oa_id = o.oa_id JOIN fx_poi p ON t.poi_id = p.poi_id"


def _ends(t: Tables):
    start = t.fx_oa().select("oa_id", F.col("lat").alias("a"), F.col("lon").alias("b"))
    return t.fx_trips().join(start, "oa_id").join(t.fx_poi(), "poi_id")


@query("dist_sphere", f"SELECT trip_id, round({_haversine('o', 'p')}, 2) AS metres FROM {_PAIRS}")
def _(t: Tables):
    metres = geo.haversine_m(F.col("a"), F.col("b"), F.col("lat"), F.col("lon"))
    return _ends(t).select("trip_id", F.round(metres, 2).alias("metres"))


@query("dist_euclid", f"SELECT trip_id, round(sqrt((o.lat - p.lat) * (o.lat - p.lat) + (o.lon - p.lon) * (o.lon - p.lon)), 9) AS degrees FROM {_PAIRS}")
def _(t: Tables):
    degrees = geo.dist_euclid(F.col("a"), F.col("b"), F.col("lat"), F.col("lon"))
    return _ends(t).select("trip_id", F.round(degrees, 9).alias("degrees"))


@query("dist_spheroid", "WITH " + _vincenty_sql(5, "trip_id", _PAIRS))
def _(t: Tables):
    metres = geo.geodesic_m(F.col("a"), F.col("b"), F.col("lat"), F.col("lon"))
    return _ends(t).select("trip_id", F.round(metres, 1).alias("metres"))
