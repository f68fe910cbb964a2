"""Queries through files: the given tables written in each format and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from fairreach.catalog.fixtures import Tables
from fairreach.catalog.registry import query
from fairreach.functions.geo import centroid
from fairreach.session import scratch_path
from fairreach.sources import osm_blocks, shapefile, spatial, tables

_ORDER_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"


def _orders(t: Tables):
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


@query("src_csv", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def _(t: Tables):
    path = scratch_path(t.spark, "orders-csv")
    _orders(t).write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return tables.read_delimited(t.spark, path, _ORDER_SCHEMA)


@query(
    "src_manifest",
    "SELECT c_mktsegment, n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2",
)
def _(t: Tables):
    root = scratch_path(t.spark, "manifest")
    t.nation.write.option("header", True).csv(f"{root}/nation.csv")
    t.customer.write.option("header", True).csv(f"{root}/customer.txt")
    loaded = tables.load_manifest(t.spark, root, {"nation.csv": "raw_nation", "customer.txt": "raw_customer"})
    joined = loaded["raw_customer"].join(loaded["raw_nation"], F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("c_mktsegment", "n_name").agg(F.count("*").alias("n"))


@query("src_chunked", "SELECT event_id, user_id, event_type, value FROM events")
def _(t: Tables):
    """Files that arrive in three portions; the last run finds nothing new."""
    parts = t.events.select("event_id", "user_id", "event_type", "value")
    folder, table, state = (scratch_path(t.spark, f"events-{what}") for what in ("files", "table", "state"))
    for i in [0, 1, 2, None]:
        if i is not None:
            parts.where(F.col("event_id") % 3 == i).write.mode("append").option("header", True).csv(folder)
        loaded = tables.take_in(t.spark, folder, "event_id bigint, user_id bigint, event_type string, value double", table, state)
    return loaded


@query("sink_csv", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def _(t: Tables):
    path = scratch_path(t.spark, "supplier-csv")
    tables.export_csv(t.supplier.select("s_suppkey", "s_name", "s_acctbal"), path)
    return tables.read_delimited(t.spark, path, "s_suppkey bigint, s_name string, s_acctbal double")


@query("sink_table", "SELECT p_partkey, p_type, p_size FROM part")
def _(t: Tables):
    name = scratch_path(t.spark, "fairreach_part").rsplit("/", 1)[1].replace("-", "_")
    path = scratch_path(t.spark, "part-table")
    # the table's files belong in the shared folder, not in the default warehouse
    t.spark.sql(f"CREATE TABLE {name} (p_partkey BIGINT, p_type STRING, p_size INT) USING parquet LOCATION '{path}'")
    tables.write_table(t.part.select("p_partkey", "p_type", "p_size"), name, mode="append")
    return t.spark.table(name)


@query("sink_full_refresh", "SELECT count(*) AS rows_written, count(DISTINCT oa_id) AS areas FROM fx_cube")
def _(t: Tables):
    path = scratch_path(t.spark, "cube")
    tables.refresh_summary(t.fx_cube().limit(0), path)
    written = tables.refresh_summary(t.fx_cube(), path)
    stored = tables.read_summary(t.spark, path)
    return stored.agg(F.lit(written).cast("bigint").alias("rows_written"), F.countDistinct("oa_id").alias("areas"))


@query("count_rows", "SELECT count(*) AS n FROM lineitem")
def _(t: Tables):
    return tables.count_rows(t.lineitem)


def _geojson(t: Tables) -> str:
    """The polygons as one FeatureCollection per partition of the supplier table."""
    path = scratch_path(t.spark, "areas-geojson")
    ring = F.transform(F.col("geometry")[0][0], lambda p: F.array(p["x"], p["y"]))
    closed = F.concat(ring, F.slice(ring, 1, 1))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.col("poly_id").cast("string").alias("oa11cd")).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), F.array(closed).alias("coordinates")).alias("geometry"),
    )
    # a collection holds 500 areas, so its size does not grow with the table
    batches = t.fx_polys().groupBy(F.floor(F.col("poly_id") / 500).alias("b")).agg(F.collect_list(feature).alias("features"))
    body = F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features"))
    batches.select("b", body.alias("value")).write.partitionBy("b").text(path)
    return f"{path}/b=*"


@query("src_geojson", "SELECT 'Feature' AS type, CAST(s_suppkey AS VARCHAR) AS oa11cd, 'Polygon' AS shape FROM supplier")
def _(t: Tables):
    features = spatial.read_features(t.spark, _geojson(t), "oa11cd string")
    return features.select("type", "properties.oa11cd", F.col("geometry.type").alias("shape"))


@query("q_output_areas", "SELECT CAST(poly_id AS VARCHAR) AS oa11cd FROM fx_tri")
def _(t: Tables):
    from fairreach.plans.serving import output_areas

    return output_areas(t.spark, _geojson(t)).select(F.col("properties")["oa11cd"].alias("oa11cd"))


@query(
    "src_boundaries",
    "SELECT CAST(poly_id AS VARCHAR) AS oa11cd, round((x1 + x2 + x3) / 3, 6) AS x, round((y1 + y2 + y3) / 3, 6) AS y FROM fx_tri",
)
def _(t: Tables):
    areas = spatial.read_boundaries(t.spark, _geojson(t), properties="oa11cd string")
    middle = centroid(F.col("geometry"))
    return areas.select("properties.oa11cd", F.round(middle["x"], 6).alias("x"), F.round(middle["y"], 6).alias("y"))


@query(
    "src_roads",
    """SELECT o_custkey AS osm_id, 'road' AS amenity, count(*) AS vertices, round(sum(o_totalprice / 1000), 6) AS x_sum
       FROM orders GROUP BY 1""",
)
def _(t: Tables):
    """Each customer's orders as an OSM way whose nodes are the orders."""
    path = scratch_path(t.spark, "roads")
    node = F.format_string('<node id="%d" lat="52.5" lon="%.5f"></node>', "o_orderkey", F.col("o_totalprice") / 1000)
    ref = F.format_string('<nd ref="%d"/>', "o_orderkey")
    ways = t.orders.groupBy("o_custkey").agg(F.array_join(F.sort_array(F.collect_list(ref)), "").alias("nds"))
    way = F.concat(F.format_string('<way id="%d">', "o_custkey"), "nds", F.lit('<tag k="amenity" v="road"/></way>'))
    parts = t.orders.select(F.concat(F.lit("n"), F.floor(F.col("o_orderkey") / 2000)).alias("b"), node.alias("value")).unionByName(
        ways.select(F.concat(F.lit("w"), F.floor(F.col("o_custkey") / 500)).alias("b"), way.alias("value"))
    )
    # a document holds a fixed number of nodes or ways, so its size does not grow with the table
    document = F.concat(F.lit("<osm>"), F.array_join(F.collect_list("value"), ""), F.lit("</osm>"))
    parts.groupBy("b").agg(document.alias("value")).write.partitionBy("b").text(path)
    path = f"{path}/b=*"
    roads = spatial.read_ways(t.spark, path)
    x_sum = F.aggregate("way", F.lit(0.0), lambda acc, p: acc + p["x"])
    return roads.select("osm_id", "amenity", F.size("way").cast("bigint").alias("vertices"), F.round(x_sum, 6).alias("x_sum"))


@query(
    "src_boundaries_shapefile",
    "SELECT CAST(poly_id AS VARCHAR) AS oa11cd, round((x1 + x2 + x3) / 3, 6) AS x, round((y1 + y2 + y3) / 3, 6) AS y FROM fx_tri",
)
def _(t: Tables):
    """The polygons written as a binary layer and read back, some records a task."""
    path = scratch_path(t.spark, "areas-shapefile")
    shapefile.write_shapefile(t.fx_polys().select(F.col("poly_id").alias("oa11cd"), "geometry"), path)
    areas = shapefile.read_shapefile(t.spark, path, properties="oa11cd string", records=max(1, t.supplier.count() // 4))
    middle = centroid(F.col("geometry"))
    return areas.select("properties.oa11cd", F.round(middle["x"], 6).alias("x"), F.round(middle["y"], 6).alias("y"))


@query(
    "src_roads_blocks",
    """SELECT o_custkey AS osm_id, 'road' AS amenity, count(*) AS vertices, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS x_sum
       FROM orders GROUP BY 1""",
)
def _(t: Tables):
    """Each customer's orders as a way of a binary extract whose nodes are the orders."""
    path = scratch_path(t.spark, "roads-blocks")
    nodes = t.orders.select(F.col("o_orderkey").alias("id"), F.lit(52.5).alias("lat"), F.round(F.col("o_totalprice") / 1000, 5).alias("lon"))
    refs = F.sort_array(F.collect_list("o_orderkey")).alias("refs")
    ways = t.orders.groupBy(F.col("o_custkey").alias("id")).agg(refs).select("id", F.create_map(F.lit("amenity"), F.lit("road")).alias("tags"), "refs")
    for rows in (nodes, ways):
        osm_blocks.write_blocks(rows, path, block_rows=500)
    roads = osm_blocks.read_way_blocks(t.spark, path, task_bytes=1 << 16)
    x_sum = F.aggregate("way", F.lit(0).cast("bigint"), lambda acc, p: acc + F.round(p["x"] * 100_000).cast("bigint"))
    return roads.select("osm_id", "amenity", F.size("way").cast("bigint").alias("vertices"), x_sum.alias("x_sum"))
