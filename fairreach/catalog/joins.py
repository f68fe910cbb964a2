"""Queries over the joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from fairreach.catalog.fixtures import K_BY_TYPE, Tables
from fairreach.catalog.registry import query
from fairreach.operators import combine, cube, reshape

_K_VALUES = ", ".join(f"('{name}', {k or 3})" for name, k in K_BY_TYPE.items())


@query("join_inner_lookup", "SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def _(t: Tables):
    named = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return combine.lookup(t.customer, named, "c_nationkey").select("c_custkey", "n_name")


@query(
    "join_semi_scope",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)",
)
def _(t: Tables):
    scope = t.lineitem.where("l_quantity > 45").select(F.col("l_partkey").alias("o_custkey"))
    return combine.in_scope(t.orders.select("o_orderkey", "o_custkey"), scope, "o_custkey")


@query(
    "join_left_geocode",
    "SELECT c_custkey, lat, lon FROM customer LEFT JOIN fx_poi ON c_custkey = poi_id",
)
def _(t: Tables):
    centroids = t.fx_poi().select(F.col("poi_id").alias("c_custkey"), "lat", "lon")
    return combine.geocode(t.customer.select("c_custkey"), centroids, "c_custkey")


@query(
    "join_full_using",
    """WITH a AS (SELECT o_custkey AS oa11, date_part('year', o_orderdate) AS year, count(*) AS orders_all FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2),
       b AS (SELECT o_custkey AS oa11, date_part('year', o_orderdate) AS year, count(*) AS urgent_all FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2),
       c AS (SELECT c_custkey AS oa11, 1998 AS year, c_acctbal AS balance FROM customer)
       SELECT oa11, CAST(year AS INTEGER) AS year, orders_all, urgent_all, balance FROM a FULL JOIN b USING (oa11, year) FULL JOIN c USING (oa11, year)""",
)
def _(t: Tables):
    dated = t.orders.select(F.col("o_custkey").alias("oa11"), F.year("o_orderdate").alias("year"), "o_orderstatus", "o_orderpriority")
    finished = dated.where("o_orderstatus = 'F'").groupBy("oa11", "year").agg(F.count("*").alias("orders_all"))
    urgent = dated.where("o_orderpriority = '1-URGENT'").groupBy("oa11", "year").agg(F.count("*").alias("urgent_all"))
    balance = t.customer.select(F.col("c_custkey").alias("oa11"), F.lit(1998).alias("year"), F.col("c_acctbal").alias("balance"))
    return combine.entity({"finished": finished, "urgent": urgent, "balance": balance}, ["oa11", "year"])


@query("join_left_chain", "SELECT trip_id, oa_id, poi_id, poi_type, stratum, total_time FROM fx_labelled")
def _(t: Tables):
    labelled = cube.label_results(t.fx_results(), t.fx_trips(), t.fx_poi(), t.fx_strata())
    return labelled.select("trip_id", "oa_id", "poi_id", "poi_type", "stratum", "total_time")


@query(
    "join_inner_chain",
    """SELECT e.oa_id, e.poi_id, e.date, e.time, e.trip_id, o.lat AS oa_lat, o.lon AS oa_lon, p.lat AS poi_lat, p.lon AS poi_lon
       FROM fx_trips e JOIN fx_oa o ON e.oa_id = o.oa_id JOIN fx_poi p ON e.poi_id = p.poi_id WHERE e.computed = 0""",
)
def _(t: Tables):
    return combine.otp_trips(t.fx_trips(), t.fx_oa(), t.fx_poi())


@query(
    "join_using_multi",
    """SELECT r.trip_id, r.metric, r.value, m.oa_id, m.poi_id, p.poi_type, s.stratum FROM fx_long r JOIN fx_trips m ON r.trip_id = m.trip_id
       JOIN (SELECT DISTINCT date, time, stratum FROM fx_trips JOIN fx_strata USING (trip_id)) s ON m.date = s.date AND m.time = s.time
       JOIN fx_k_poi p ON m.oa_id = p.oa_id AND m.poi_id = p.poi_id""",
)
def _(t: Tables):
    stamps = t.fx_trips().join(t.fx_strata(), "trip_id").select("date", "time", "stratum").distinct()
    return combine.full_results(t.fx_long(), t.fx_trips(), stamps, t.fx_k_poi())


@query(
    "join_left_agg",
    """SELECT s.oa_id, round(s.metric, 6) AS metric, p.population, p.count FROM
       (SELECT oa_id, sum(sum_fare) / sum(num_trips) AS metric FROM fx_cube GROUP BY 1) s LEFT JOIN fx_pop p ON s.oa_id = p.oa_id""",
)
def _(t: Tables):
    joined = combine_population(t)
    return joined.select("oa_id", F.round("metric", 6).alias("metric"), "population", "count")


def combine_population(t: Tables):
    return cube.with_population(cube.access_metric(t.fx_cube(), "fare"), t.fx_pop())


@query(
    "join_lateral_unnest",
    f"SELECT oa_id, poi_type, k FROM fx_oa, (VALUES {_K_VALUES}) v(poi_type, k)",
)
def _(t: Tables):
    return reshape.per_type_k(t.fx_oa(), K_BY_TYPE).select("oa_id", "poi_type", "k")


@query("join_fk_check", "SELECT DISTINCT l_partkey AS oa_id FROM lineitem WHERE l_partkey NOT IN (SELECT c_custkey FROM customer)")
def _(t: Tables):
    child = t.lineitem.select(F.col("l_partkey").alias("oa_id"))
    return combine.missing_keys(child, t.customer, "oa_id", "c_custkey")
