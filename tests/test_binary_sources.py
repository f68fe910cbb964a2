"""Binary layers and extracts: written, read back, and by ranges."""

import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fairreach.functions import geo
from fairreach.sources import osm_blocks, shapefile

SQUARE = [(0.0, 0.0), (0.0, 4.0), (4.0, 4.0), (4.0, 0.0)]
HOLE = [(1.0, 1.0), (3.0, 1.0), (3.0, 3.0), (1.0, 3.0)]
FAR = [(10.0, 0.0), (10.0, 1.0), (11.0, 1.0)]


def shape(*polys):
    return [[[(float(x), float(y)) for x, y in ring] for ring in poly] for poly in polys]


def test_shapefile_round_trip(spark, tmp_path):
    rnd = random.Random(4)
    rows = [(k, "é" * (k % 5) or None, shape([[(k + dx * rnd.random(), dy) for dx, dy in FAR]])) for k in range(50)]
    rows += [(50, "holes", shape([SQUARE, HOLE], [FAR])), (51, "no shape", None), (52, "other way", shape([SQUARE[::-1], HOLE[::-1]]))]
    df = spark.createDataFrame(rows, f"code int, name string, geometry {geo.MULTIPOLYGON}").repartition(3)
    path = str(tmp_path / "layer")
    shapefile.write_shapefile(df, path)
    back = shapefile.read_shapefile(spark, path, 27700, "code int, name string", records=5)
    assert back.schema["geometry"].metadata == {"srid": 27700} and back.rdd.getNumPartitions() >= 12
    ways = lambda g: g and [{frozenset((p["x"], p["y"]) for p in ring) for ring in poly} for poly in g]
    got = {r["properties"]["code"]: (r["properties"]["name"], ways(r["geometry"])) for r in back.collect()}
    want = {r["code"]: (r["name"], ways(r["geometry"])) for r in df.collect()}
    assert got == want
    area = back.where("properties.code in (50, 52)").select(F.col("properties.code").alias("c"), geo.within(geo.point(F.lit(2.0), F.lit(2.0)), F.col("geometry")).alias("hole"), geo.within(geo.point(F.lit(0.5), F.lit(0.5)), F.col("geometry")).alias("in"))
    assert {tuple(r) for r in area.collect()} == {(50, False, True), (52, False, True)}
    one = sorted(tmp_path.glob("layer/*.shp"))[0]
    plain = shapefile.read_shapefile(spark, str(one)).first()
    assert set(plain["properties"]) == {"code", "name"}


def test_shapefile_of_nothing(spark, tmp_path):
    path = str(tmp_path / "layer")
    shapefile.write_shapefile(spark.createDataFrame([], f"code int, geometry {geo.MULTIPOLYGON}").coalesce(1), path)
    assert shapefile.read_shapefile(spark, path).count() == 0
    with pytest.raises(Exception, match="ten letters"):
        shapefile.write_shapefile(spark.createDataFrame([], f"abcdefghij1 int, abcdefghij2 int, geometry {geo.MULTIPOLYGON}"), path)


def test_other_shapes_raise():
    with pytest.raises(ValueError, match="no polygon"):
        shapefile._rings(struct.pack("<i2d", 1, 0.0, 0.0))


def test_numbers():
    rng = np.random.default_rng(1)
    values = np.concatenate([np.array([0, 1, 127, 128, 2**63, 2**64 - 1], np.uint64), rng.integers(0, 1 << 62, 100).astype(np.uint64)])
    assert osm_blocks.varints(osm_blocks.packed(values)).tolist() == values.tolist()
    assert osm_blocks.varints(b"").tolist() == []
    steps = [5, -3, 2**40, 0]
    assert np.cumsum(osm_blocks.signed(osm_blocks.varints(osm_blocks._deltas(steps)))).tolist() == steps


def test_blocks_round_trip(spark, tmp_path):
    rnd = random.Random(5)
    nodes = [(k * 7 - 300, round(rnd.uniform(-90, 90), 7), round(rnd.uniform(-180, 180), 7)) for k in range(1000)]
    ids = [n for n, *_ in nodes]
    ways = [(k, {"amenity": "road", "name": f"é{k % 3}"} if k % 2 else {}, rnd.choices(ids, k=rnd.randrange(1, 9))) for k in range(300)]
    path = str(tmp_path / "extract")
    osm_blocks.write_blocks(spark.createDataFrame(nodes, osm_blocks.NODE_SCHEMA).repartition(2), path, block_rows=50)
    osm_blocks.write_blocks(spark.createDataFrame(ways, osm_blocks.WAY_SCHEMA).coalesce(1), path, block_rows=20)
    read = lambda element: spark.read.format("osm_blocks").option("element", element).option("task_bytes", 1).load(path)
    assert read("nodes").rdd.getNumPartitions() >= 35  # a task a block
    assert sorted(tuple(r) for r in read("nodes").collect()) == [(i, pytest.approx(a, abs=1e-9), pytest.approx(b, abs=1e-9)) for i, a, b in sorted(nodes)]
    assert sorted((r["id"], r["tags"], r["refs"]) for r in read("ways").collect()) == ways
    place = {i: (lat, lon) for i, lat, lon in nodes}
    found = {r["osm_id"]: r for r in osm_blocks.read_way_blocks(spark, path).collect()}
    assert len(found) == len(ways)
    for i, tags, refs in ways:
        assert [(p["y"], p["x"]) for p in found[i]["way"]] == [(pytest.approx(place[r][0], abs=1e-9), pytest.approx(place[r][1], abs=1e-9)) for r in refs]
        assert found[i]["amenity"] == tags.get("amenity") and found[i]["tags"] == tags


def test_single_nodes_raw_blobs_and_scales():
    """What other writers use: nodes one by one, other granularity and offsets, blobs that are not packed."""
    zig = lambda v: (v << 1) ^ (v >> 63)
    node = osm_blocks._field(1, zig(-5)) + osm_blocks._field(8, zig(100)) + osm_blocks._field(9, zig(-7))
    data = osm_blocks._field(2, osm_blocks._field(1, node)) + osm_blocks._field(17, 1000) + osm_blocks._field(19, -500) + osm_blocks._field(20, 2000)
    for blob in (osm_blocks._field(1, data), osm_blocks._field(3, zlib.compress(data))):
        (batch,) = osm_blocks.Block(osm_blocks._unpacked(blob)).nodes()
        assert batch.to_pylist() == [{"id": -5, "lat": pytest.approx(99_500e-9), "lon": pytest.approx(-5_000e-9)}]
    with pytest.raises(ValueError, match="unknown method"):
        osm_blocks._unpacked(osm_blocks._field(4, b"x"))


def test_the_references_of_a_block_are_packed_together(monkeypatch):
    """As many passes over arrays for a thousand ways as for one, and the same bytes and rows."""
    import pyarrow as pa

    kind = pa.schema([("id", pa.int64()), ("tags", pa.map_(pa.string(), pa.string())), ("refs", pa.list_(pa.int64()))])
    table = lambda rows: pa.Table.from_pylist([r | {"tags": r["tags"] and list(r["tags"].items())} for r in rows], kind)
    lists = [[(i * 7919 % 1000 - 500) * 10 ** (i % 15) for i in range(n % 9)] for n in range(1000)]
    lists[3] = [-(1 << 62), (1 << 62) - 1]
    rows = [{"id": -i, "tags": {"k": str(i % 300), "": "v"} if i % 3 else None, "refs": refs or None} for i, refs in enumerate(lists)]
    calls, plain, unpack = [], osm_blocks.packed, osm_blocks.varints
    monkeypatch.setattr(osm_blocks, "packed", lambda n: calls.append(1) or plain(n))
    monkeypatch.setattr(osm_blocks, "varints", lambda n: calls.append(1) or unpack(n))
    data = osm_blocks.way_block(table(rows))
    (batch,) = osm_blocks.Block(data).ways()
    assert len(calls) == 2
    assert batch.column("refs").to_pylist() == lists and batch.column("id").to_pylist() == [r["id"] for r in rows]
    assert [dict(t) for t in batch.column("tags").to_pylist()] == [r["tags"] or {} for r in rows]
    assert osm_blocks._each_deltas(lists) == [osm_blocks._deltas(v) for v in lists]
    for v in (0, 127, 128, 300, (1 << 64) - 1):
        assert osm_blocks._varint(v) == plain(np.array([v], np.uint64))
    assert list(osm_blocks.Block(osm_blocks.way_block(table([]))).ways())[0].num_rows == 0
    for bad in (None, float("nan"), float("inf")):
        with pytest.raises(ValueError):
            osm_blocks.node_block(pa.table({"id": [1, 2], "lat": [1.0, bad], "lon": [1.0, 2.0]}))
