"""Area boundaries and roads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairreach.functions.geo import point


def read_features(spark: SparkSession, path: str, properties: str | None = None) -> DataFrame:
    """One row per feature of a GeoJSON FeatureCollection: ``type``, ``properties``, ``geometry``.

    ``geometry`` keeps ``coordinates`` as JSON text, since their depth depends on the shape.
    A collection is one JSON value and is read by one task; split large layers into several files.
    """
    props = f"struct<{properties}>" if properties else "map<string,string>"
    feature = f"struct<type:string,properties:{props},geometry:struct<type:string,coordinates:string>>"
    rows = spark.read.schema(f"type string, features array<{feature}>").option("multiLine", True).json(path)
    return rows.select(F.inline("features"))


def read_boundaries(spark: SparkSession, path: str, srid: int = 4326, properties: str | None = None) -> DataFrame:
    """Features as ``geometry`` (multipolygon of points) with their properties.

    The reference system is kept in the metadata of the geometry column.
    """
    features = read_features(spark, path, properties)
    coords = F.col("geometry.coordinates")
    one = F.array(F.from_json(coords, "array<array<array<double>>>"))
    many = F.from_json(coords, "array<array<array<array<double>>>>")
    shape = F.when(F.col("geometry.type") == "Polygon", one).when(F.col("geometry.type") == "MultiPolygon", many)
    polygons = F.transform(
        shape, lambda poly: F.transform(poly, lambda ring: F.transform(ring, lambda p: point(p[0], p[1])))
    )
    return features.select("properties", polygons.alias("geometry")).withMetadata("geometry", {"srid": srid})


_TAGS = "tag array<struct<_k:string,_v:string>>"
_WAY_SCHEMA = f"_id bigint, nd array<struct<_ref:bigint>>, {_TAGS}"
_NODE_SCHEMA = "_id bigint, _lat double, _lon double"


def read_ways(spark: SparkSession, path: str) -> DataFrame:
    """``(osm_id, amenity, area, tags, way)`` per way of OSM XML files, ``way`` in node order.

    A document is read by one task; large extracts come as several files under one path.
    """
    ways = spark.read.format("xml").schema(_WAY_SCHEMA).option("rowTag", "way").load(path)
    nodes = spark.read.format("xml").schema(_NODE_SCHEMA).option("rowTag", "node").load(path)
    entries = F.transform("tag", lambda t: F.struct(t["_k"].alias("key"), t["_v"].alias("value")))
    tags = F.coalesce(F.map_from_entries(entries), F.map_from_arrays(F.array(), F.array()).cast("map<string,string>"))
    listed = ways.select(F.col("_id").alias("osm_id"), tags.alias("tags"), F.col("nd._ref").alias("nodes"))
    return located_ways(listed, nodes.select(F.col("_id").alias("node"), "_lat", "_lon"))


def located_ways(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(osm_id, amenity, area, tags, way)`` of ways ``(osm_id, tags, nodes)`` whose nodes ``(node, _lat, _lon)`` are known."""
    refs = ways.select("osm_id", F.posexplode("nodes").alias("at", "node"))
    located = refs.join(nodes, "node")
    # a way has a bounded number of nodes in the OSM data model
    vertex = F.struct("at", point(F.col("_lon"), F.col("_lat")).alias("p"))
    paths = located.groupBy("osm_id").agg(F.transform(F.sort_array(F.collect_list(vertex)), lambda v: v["p"]).alias("way"))
    return ways.select("osm_id", "tags").join(paths, "osm_id").select(
        "osm_id", F.col("tags")["amenity"].alias("amenity"), F.col("tags")["area"].alias("area"), "tags", "way"
    )
