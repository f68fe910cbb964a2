import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fairreach.functions import geo
from fairreach.operators import containment, nearest
from fairreach.operators import spread as operators_spread
from fairreach.operators.containment import points_in_polygons
from fairreach.operators.nearest import k_nearest, k_nearest_planar, nearest_line

SQUARE = [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]]
HOLED = [*SQUARE, [(1.0, 1.0), (1.0, 3.0), (3.0, 3.0), (3.0, 1.0), (1.0, 1.0)]]


def polygons(spark, *shapes):
    rows = [(i, [[[(float(x), float(y)) for x, y in ring] for ring in poly] for poly in shape]) for i, shape in enumerate(shapes)]
    return spark.createDataFrame(rows, f"poly_id int, geometry {geo.MULTIPOLYGON}")


def one(spark, c):
    return spark.range(1).select(c.alias("v")).first()["v"]


def test_grid_reference(spark):
    # the published worked example of the national mapping agency, to the accuracy of the datum shift
    p = one(spark, geo.osgb_to_wgs84(F.lit(651409.903), F.lit(313177.270)))
    assert p["y"] == pytest.approx(52.65798, abs=5e-5)
    assert p["x"] == pytest.approx(1.71605, abs=5e-5)


def test_spheroid_distance(spark):
    # Flinders Peak to Buninyong, the published test pair
    df = spark.createDataFrame([(-37.95103341666667, 144.42486788888888, -37.65282113888889, 143.92649552777777)], "a double, b double, c double, d double")
    assert df.select(geo.geodesic_m("a", "b", "c", "d")).first()[0] == pytest.approx(54972.271, abs=0.01)
    zero = df.select(geo.geodesic_m("a", "b", "a", "b")).first()[0]
    assert zero == pytest.approx(0, abs=1e-6)


def test_mercator(spark):
    p = one(spark, geo.mercator_to_wgs84(F.lit(-222638.98158654713), F.lit(6800125.454397307)))
    assert (p["x"], p["y"]) == (pytest.approx(-2.0), pytest.approx(52.0, abs=0.03))


def test_centroid(spark):
    wide = [[(10.0, 0.0), (12.0, 0.0), (12.0, 2.0), (10.0, 2.0)]]
    lopsided = [*SQUARE, [(0.0, 0.0), (0.0, 2.0), (2.0, 2.0), (2.0, 0.0), (0.0, 0.0)]]
    df = polygons(spark, [SQUARE], [HOLED], [SQUARE, wide], [lopsided]).select("poly_id", geo.centroid(F.col("geometry")).alias("c"))
    got = {r["poly_id"]: (r["c"]["x"], r["c"]["y"]) for r in df.collect()}
    assert got[0] == got[1] == (2.0, 2.0)
    assert got[2] == (pytest.approx((2 * 16 + 11 * 4) / 20), pytest.approx((2 * 16 + 4) / 20))
    assert got[3] == (pytest.approx((2 * 16 - 4) / 12), pytest.approx((2 * 16 - 4) / 12))


def test_within_leaves_out_edges_and_holes(spark):
    cases = {(0.5, 0.5): True, (2, 2): False, (0, 2): False, (4, 4): False, (1, 2): False, (5, 1): False, (0.5, 4): False, (3.5, 3): True}
    df = polygons(spark, [HOLED]).crossJoin(spark.createDataFrame([(float(x), float(y)) for x, y in cases], "x double, y double"))
    got = {(r["x"], r["y"]): r["w"] for r in df.select("x", "y", geo.within(F.struct("x", "y"), F.col("geometry")).alias("w")).collect()}
    assert got == {(float(x), float(y)): w for (x, y), w in cases.items()}


def test_closest_point(spark):
    line = F.array(geo.point(F.lit(0), F.lit(0)), geo.point(F.lit(4), F.lit(0)), geo.point(F.lit(4), F.lit(4)))
    for x, y, want in [(2, 1, (2, 0)), (-1, 0, (0, 0)), (5, 3, (4, 3)), (5, 9, (4, 4))]:
        p = one(spark, geo.closest_point(line, geo.point(F.lit(x), F.lit(y))))
        assert (p["x"], p["y"]) == want
    p = one(spark, geo.closest_point(F.array(geo.point(F.lit(1), F.lit(1))), geo.point(F.lit(0), F.lit(0))))
    assert (p["x"], p["y"]) == (1, 1)


def places(seed, n, hot=0.34):
    """Points of which a third share one position and many lie in a small cluster."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        u = rnd.random()
        if u < hot:
            out.append((i, 52.5, -1.9))
        elif u < 0.7:
            out.append((i, 52.4 + rnd.random() / 1000, -1.8 + rnd.random() / 1000))
        else:
            out.append((i, 52 + rnd.random(), -2.5 + rnd.random()))
    return out


def test_k_nearest_matches_brute_force(spark):
    oa = spark.createDataFrame(places(1, 60), "oa_id int, lat double, lon double")
    rows = [(i, "ab"[i % 2] if i % 11 else "c", la, lo) for i, la, lo in places(2, 400)]
    poi = spark.createDataFrame(rows, "poi_id int, type string, lat double, lon double")
    ks = {"a": 3, "b": None, "c": 1, "absent": 2}
    got = {(r["oa_id"], r["poi_id"], r["rank"]) for r in k_nearest(oa, poi, ks, default_k=2).collect()}
    want = set()
    pairs = oa.withColumnsRenamed({"lat": "a", "lon": "b"}).crossJoin(poi)
    pairs = pairs.withColumn("d", F.round(geo.haversine_m(F.col("a"), F.col("b"), F.col("lat"), F.col("lon")), 3)).collect()
    by = {}
    for r in pairs:
        by.setdefault((r["oa_id"], r["type"]), []).append((r["d"], r["poi_id"]))
    for (oa_id, kind), ds in by.items():
        for d, poi_id in ds:
            rank = 1 + sum(e < d for e, _ in ds)
            if rank <= (ks[kind] or 2):
                want.add((oa_id, poi_id, rank))
    assert got == want


def test_k_nearest_planar_matches_brute_force(spark):
    oas, pois = places(3, 50), places(4, 300)
    oa = spark.createDataFrame(oas, "oa_id int, lat double, lon double")
    poi = spark.createDataFrame([(i, "t", la, lo) for i, la, lo in pois], "poi_id int, type string, lat double, lon double")
    got = {(r["oa_id"], r["rank"]): r["poi_id"] for r in k_nearest_planar(oa, poi, 4).collect()}
    want = {}
    for o, la, lo in oas:
        order = sorted(pois, key=lambda p: (math.sqrt((la - p[1]) * (la - p[1]) + (lo - p[2]) * (lo - p[2])), p[0]))
        want |= {(o, n + 1): p[0] for n, p in enumerate(order[:4])}
    assert got == want
    assert k_nearest_planar(oa, poi.limit(0), 4).count() == 0


def test_nearest_line_matches_brute_force(spark):
    rnd = random.Random(5)
    pts = [(i, rnd.random() * 3 - 1, rnd.random() * 3 - 1) for i in range(80)]
    lines = [(i, [(rnd.random(), rnd.random()) for _ in range(rnd.choice([1, 2, 3, 5]))]) for i in range(60)] + [(99, [(-5.0, 0.3), (5.0, 0.4)])]
    points = spark.createDataFrame(pts, "point_id int, x double, y double")
    roads = spark.createDataFrame(lines, f"line_id int, way {geo.LINE}")
    got = {r["point_id"]: (r["line_id"], r["dist"]) for r in nearest_line(points, roads).collect()}

    def gap(p, a, b):
        dx, dy = b[0] - a[0], b[1] - a[1]
        n = dx * dx + dy * dy
        t = max(0, min(1, ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / n)) if n else 0
        return math.hypot(p[0] - a[0] - t * dx, p[1] - a[1] - t * dy)

    for i, x, y in pts:
        d = {n: min(gap((x, y), a, b) for a, b in zip(w, w[1:] or w)) for n, w in lines}
        assert got[i][1] == pytest.approx(min(d.values()), abs=1e-12)
        assert d[got[i][0]] == pytest.approx(got[i][1], abs=1e-12)


@pytest.mark.parametrize(("cell_points", "split"), [(50_000, 10_000), (10, 10_000), (10, 3)])
def test_points_in_polygons_of_all_sizes(spark, monkeypatch, cell_points, split):
    rnd = random.Random(6)
    shapes = []
    for _ in range(40):
        h, x, y = 10 ** rnd.uniform(-3, 1.2), rnd.uniform(-2, 2), rnd.uniform(-2, 2)
        shapes.append([[[(x - h, y - h), (x + h, y - h), (x + h, y + h), (x - h, y + h)]]])
    pts = [(i, rnd.uniform(-3, 3), rnd.uniform(-3, 3)) for i in range(300)]
    points = spark.createDataFrame(pts, "point_id int, x double, y double")
    want = set()
    for j, shape in enumerate(shapes):
        (x0, y0), _, (x1, y1), _ = shape[0][0]
        want |= {(i, j) for i, x, y in pts if x0 < x < x1 and y0 < y < y1}
    monkeypatch.setattr(operators_spread, "MOST_SPLIT", split)
    rows = points_in_polygons(points, polygons(spark, *shapes), cell_points).collect()
    assert len(rows) == len(want) and {(r["point_id"], r["poly_id"]) for r in rows} == want


def test_few_edges_written_out_give_the_same(spark):
    """On a lattice, so that points fall on edges and vertices; with holes, repeated and unknown vertices, and more places than edges."""
    rings = [[[(0, 0), (3, 1), (1, 3)]], [[(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]], [[(0, 0), (4, 0), (0, 4)], [(1, 1), (2, 1), (1, 2)]], [[(0, 0), (0, 0)]], [[(1, 1), (3, None), (2, 4)]], [[]]]
    shapes = [(k, [[[tuple(None if c is None else float(c) for c in p) for p in r] for r in own]]) for k, own in enumerate(rings)]
    polys = spark.createDataFrame(shapes, "poly_id int, geometry array<array<array<struct<x: double, y: double>>>>")
    cases = [(x / 2, y / 2) for x in range(-1, 10) for y in range(-1, 10)] + [(None, 1.0), (1.0, float("nan"))]
    pt, own = F.struct("x", "y"), geo.edges(F.col("geometry"))
    both = polys.crossJoin(spark.createDataFrame(cases, "x double, y double")).select("poly_id", "x", "y", geo.within_edges(pt, own).alias("a"), geo.within_few_edges(pt, own, 6).alias("b")).collect()
    assert [(r.poly_id, r.x, r.y) for r in both if r.a is not r.b and (r.a or r.b)] == []
    assert sum(bool(r.b) for r in both) > 20


def test_pairs_of_few_rows_spread_over_tasks(spark, monkeypatch):
    """Two small tables of one part each, nearly all in one cell: their pairs are dealt over tasks."""
    monkeypatch.setattr(containment, "TASK_PAIRS", 2_000)
    rnd = random.Random(7)
    squares = [(rnd.uniform(0.2, 0.3), rnd.uniform(0.2, 0.3)) for _ in range(150)]
    polys = polygons(spark, *[[[[(x - 0.3, y - 0.3), (x + 0.3, y - 0.3), (x + 0.3, y + 0.3), (x - 0.3, y + 0.3)]]] for x, y in squares]).coalesce(1)
    pts = [(i, rnd.uniform(-0.2, 0.8), rnd.uniform(-0.2, 0.8)) for i in range(1_000)] + [(-1, None, 0.1), (-2, 0.1, None)]
    points = spark.createDataFrame(pts, "point_id int, x double, y double").coalesce(1)
    want = {(i, j) for i, x, y in pts[:-2] for j, (a, b) in enumerate(squares) if a - 0.3 < x < a + 0.3 and b - 0.3 < y < b + 0.3}
    rows = points_in_polygons(points, polys).withColumn("task", F.spark_partition_id()).collect()
    assert len(rows) == len(want) > 20_000 and {(r["point_id"], r["poly_id"]) for r in rows} == want
    most = max(Counter(r["task"] for r in rows).values())
    assert most < len(rows) / 5


def ring(rnd, n, x, y, size):
    """A star-shaped ring of n vertices on a coarse lattice, so that points fall on edges and vertices too."""
    turns = sorted(rnd.random() * 2 * math.pi for _ in range(n))
    return [(round(x + size * rnd.uniform(0.3, 1) * math.cos(t), 1), round(y + size * rnd.uniform(0.3, 1) * math.sin(t), 1)) for t in turns]


@pytest.mark.parametrize("cell_points", [50_000, 20])
def test_outlines_in_pieces_give_the_same_points(spark, monkeypatch, cell_points):
    rnd = random.Random(8)
    shapes = [[[ring(rnd, rnd.choice([3, 9, 40, 200]), rnd.uniform(-2, 2), rnd.uniform(-2, 2), rnd.uniform(0.5, 4)) for _ in range(rnd.randrange(1, 4))] for _ in range(2)] for _ in range(12)]
    shapes.append([HOLED[:1], [HOLED[1]]])
    pts = [(i, round(rnd.uniform(-5, 5), 1), round(rnd.uniform(-5, 5), 1)) for i in range(400)]
    points = spark.createDataFrame(pts + pts[:5], "point_id int, x double, y double")
    polys = polygons(spark, *shapes).withColumn("label", F.lit("p"))
    both = points.crossJoin(polys).where(geo.within(F.struct("x", "y"), F.col("geometry"))).select("point_id", "x", "y", "poly_id", "label")
    want = sorted(map(tuple, both.collect()))
    assert len(want) > 300
    for name, value in [("PIECE", 4), ("WHOLE_EDGES", 5)]:
        monkeypatch.setattr(containment, name, value)
    got = points_in_polygons(points, polys, cell_points)
    assert sorted(map(tuple, got.select("point_id", "x", "y", "poly_id", "label").collect())) == want
    assert points_in_polygons(points, polys.limit(0)).count() == points_in_polygons(points.limit(0), polys).count() == 0


def test_a_large_outline_is_many_rows(spark, monkeypatch):
    """100,000 vertices: a point meets the edges of a few pieces, whatever task they are on."""
    n = 100_000
    outline = [(math.cos(t) * (2 + math.sin(50 * t)), math.sin(t) * (2 + math.sin(50 * t))) for t in (2 * math.pi * k / n for k in range(n))]
    polys = polygons(spark, [[outline]])
    rnd = random.Random(2)
    pts = [(i, rnd.uniform(-3, 3), rnd.uniform(-3, 3)) for i in range(500)]
    tested = []
    join = containment._join_salted

    def counting(rows, kept, keys, each):
        out = join(rows, kept, keys, each)
        if keys[-1] == "_piece":
            tested.append(out.groupBy("_row").agg(F.sum(F.size("run")).alias("n")).agg(F.max("n"), F.count("*")).first())
            tested.append(rows.sparkSession.createDataFrame(kept.select(*keys).distinct().collect()).repartition(8, *keys).groupBy(F.spark_partition_id()).count().count())
        return out

    monkeypatch.setattr(containment, "_join_salted", counting)
    got = {r["point_id"] for r in points_in_polygons(spark.createDataFrame(pts, "point_id int, x double, y double"), polys).collect()}
    assert got == {i for i, x, y in pts if math.hypot(x, y) < 2 + math.sin(50 * math.atan2(y, x))}
    (most, rows), tasks = tested
    assert most <= 4 * containment.PIECE and rows < 200 and tasks == 8


def _candidates(spark, targets, searches):
    boxes = nearest._point_boxes([F.col("x"), F.col("y")])
    found = nearest._open_cells(
        searches.select(F.col("id").alias("_search"), F.lit(1).alias("_group"), F.lit(3).alias("_k"), F.col("x").alias("_q0"), F.col("y").alias("_q1")),
        targets.select(F.lit(1).alias("_group"), "id").withColumns({}).join(targets, "id").select("_group", "id", *[c.alias(n) for n, c in boxes.items()]),
        2,
        0.0,
    )
    return found.count()


def test_outliers_and_towns_open_few_cells(spark):
    even = spark.range(4096).select("id", (F.col("id") % 64).cast("double").alias("x"), F.floor(F.col("id") / 64).cast("double").alias("y"))
    searches = spark.range(500).select("id", (F.col("id") % 25 * 2.5).alias("x"), (F.floor(F.col("id") / 25) * 3.1).alias("y"))
    far = spark.createDataFrame([(9999, 1e7, 1e7)], "id long, x double, y double")
    town = spark.range(10000, 12000).select("id", (30 + F.col("id") % 45 / 1e4).alias("x"), (30 + F.floor((F.col("id") - 10000) / 45) / 1e4).alias("y"))
    assert _candidates(spark, even.union(far), searches) < 500 * 40
    assert _candidates(spark, even.union(town), searches) < 500 * 80


@pytest.mark.parametrize("searches", [100_000])
def test_one_crowded_place_spreads_over_all_partitions(spark, monkeypatch, searches):
    side = 141
    even = spark.range(side * side).select("id", (F.col("id") % side).cast("double").alias("x"), F.floor(F.col("id") / side).cast("double").alias("y"))
    town = spark.range(searches).select("id", (70 + F.rand(1)).alias("x"), (70 + F.rand(2)).alias("y"))
    seen = []
    prune = nearest._prune

    def counting(frontier, dims, slack):
        seen.append(frontier.count())
        return prune(frontier, dims, slack)

    monkeypatch.setattr(nearest, "_prune", counting)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        boxes = nearest._point_boxes([F.col("x"), F.col("y")])
        asked = town.select(F.col("id").alias("_search"), F.lit(1).alias("_group"), F.lit(3).alias("_k"), F.col("x").alias("_q0"), F.col("y").alias("_q1"))
        found = nearest._open_cells(asked, even.select(F.lit(1).alias("_group"), "id", *[c.alias(n) for n, c in boxes.items()]), 2, 0.0)
        parts = [r["count"] for r in found.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    # rounds are over some 400 blocks, with up to 192 cells each; what the searches themselves read is a small multiple of k
    assert max(seen) < searches
    assert sum(parts) < 3 * 8 * searches
    assert len(parts) == 16 and max(parts) < 2 * sum(parts) / 16


def test_an_index_is_built_once_and_searched_often(spark, tmp_path, monkeypatch):
    rnd = random.Random(11)
    spot = lambda: (52 + rnd.random(), -2 + rnd.random())
    poi = spark.createDataFrame([(i, "School" if i % 3 else "Hospital", *spot()) for i in range(300)] + [(999, "School", None, None)], "poi_id int, type string, lat double, lon double")
    oa = spark.createDataFrame([(i, *spot()) for i in range(60)], "oa_id int, lat double, lon double")
    nearest.PlaceIndex.build(poi, str(tmp_path / "places"))
    lines = spark.createDataFrame([(i, [spot(), spot(), spot()]) for i in range(80)], f"line_id int, way {geo.LINE}")
    nearest.LineIndex.build(lines, str(tmp_path / "lines"))
    points = oa.selectExpr("oa_id as point_id", "lat as x", "lon as y")
    rows = lambda df: sorted(map(tuple, df.collect()))
    wanted = {"School": 4, "Hospital": None}
    want = rows(k_nearest(oa, poi, wanted, spheroid=False)), rows(nearest_line(points, lines).select("point_id", "line_id", "dist"))

    def build(*_):
        raise AssertionError("built again")

    monkeypatch.setattr(nearest._Index, "build", build)
    places, roads = nearest.PlaceIndex(spark, str(tmp_path / "places")), nearest.LineIndex(spark, str(tmp_path / "lines"))
    for _ in range(2):
        assert rows(k_nearest(oa, places, wanted, spheroid=False)) == want[0]
        assert rows(nearest_line(points, roads).select("point_id", "line_id", "dist")) == want[1]
    assert rows(k_nearest(oa.limit(5), places, {"School": 1}, spheroid=False)) == [r for r in rows(k_nearest(oa.limit(5), places, {"School": 1}, spheroid=False)) if r[2] == "School"]


def test_an_index_of_nothing(spark, tmp_path):
    oa = spark.createDataFrame([(1, 52.0, -2.0)], "oa_id int, lat double, lon double")
    none = nearest.PlaceIndex.build(spark.createDataFrame([], "poi_id int, type string, lat double, lon double"), str(tmp_path / "places"))
    assert k_nearest(oa, none, {"School": 3}).count() == 0
    roads = nearest.LineIndex.build(spark.createDataFrame([], f"line_id int, way {geo.LINE}"), str(tmp_path / "lines"))
    assert nearest_line(oa.selectExpr("oa_id as point_id", "lat as x", "lon as y"), roads).count() == 0


def test_long_crossing_lines_are_looked_at_by_few_searches(spark, monkeypatch):
    draw = lambda seed: F.round(F.randn(seed) * 0.1, 6)
    made = spark.range(0, 1500, 1, 4).select("id", *[draw(i).alias(f"v{i}") for i in range(6)]).localCheckpoint()
    points = made.select(F.col("id").alias("point_id"), F.col("v0").alias("x"), F.col("v1").alias("y"))
    lines = made.select(F.col("id").alias("line_id"), F.array(geo.point(F.col("v2"), F.col("v3")), geo.point(F.col("v4"), F.col("v5"))).alias("way"))
    asked = []
    opened = nearest._open_cells
    monkeypatch.setattr(nearest, "_open_cells", lambda *a, **b: asked.append(opened(*a, **b)) or asked[-1])
    found = {r["point_id"]: r for r in nearest_line(points, lines).collect()}
    # boxes alone leave some 500 pieces for a search here
    assert asked[0].count() < 40 * 1500
    rows = np.array([tuple(r) for r in made.orderBy("id").collect()])
    a, b = rows[:, 3:5], rows[:, 5:7]
    for row in rows[::25]:
        p = row[1:3]
        w = np.clip(((p - a) * (b - a)).sum(1) / ((b - a) ** 2).sum(1), 0, 1)
        away = np.hypot(*(a + w[:, None] * (b - a) - p).T)
        assert found[int(row[0])]["dist"] == pytest.approx(away.min(), abs=1e-12)
        assert found[int(row[0])]["line_id"] == int(away.argmin())


def test_pieces_beyond_the_reach_are_left_out_before_the_shuffle(spark, monkeypatch):
    draw = lambda seed: F.round(F.randn(seed) * 0.1, 6)
    made = spark.range(0, 1500, 1, 4).select("id", *[draw(i).alias(f"v{i}") for i in range(6)]).localCheckpoint()
    points = made.select(F.col("id").alias("point_id"), F.col("v0").alias("x"), F.col("v1").alias("y"))
    lines = made.select(F.col("id").alias("line_id"), F.array(geo.point(F.col("v2"), F.col("v3")), geo.point(F.col("v4"), F.col("v5"))).alias("way"))
    pruned, shuffled = nearest._prune, []
    monkeypatch.setattr(nearest, "_prune", lambda frontier, *a: shuffled.append(frontier) or pruned(frontier, *a))
    assert nearest_line(points, lines).count() == 1500
    # the last frontier holds pieces; a box may be near while the segment in it is not
    mx, my = (F.col("_from0") + F.col("_to0")) / 2, (F.col("_from1") + F.col("_to1")) / 2
    foot = geo.on_segment(geo.point(mx, my), geo.point(F.col("ax"), F.col("ay")), geo.point(F.col("bx"), F.col("by")))
    half = geo.dist_euclid(F.col("_from0"), F.col("_from1"), F.col("_to0"), F.col("_to1")) / 2
    beyond = geo.dist_euclid(mx, my, foot["x"], foot["y"]) > (F.col("_reach") + half) * (1 + 1e-6) + 1e-6
    assert shuffled[-1].where("_reach < 10").count() >= 1000 and shuffled[-1].where(beyond).count() == 0
