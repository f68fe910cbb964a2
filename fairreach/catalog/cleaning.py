"""Queries over the cleaning, text and clock operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from fairreach.catalog.fixtures import GROUPS
from fairreach.catalog.registry import query
from fairreach.functions import clock, text
from fairreach.functions.cost import fare, generalised_cost
from fairreach.operators import clean, reshape
from fairreach.operators.medians import scale_metrics
from fairreach.operators.numbering import mark_computed

_FLAG = "CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END"


@query(
    "cast_columns",
    "SELECT o_orderkey AS id, CAST(o_custkey AS INTEGER) AS oa, o_totalprice AS price FROM orders",
)
def _(t):
    raw = t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").cast("string").alias("oa"),
        F.col("o_totalprice").cast("string").alias("price"),
    )
    return clean.cast_columns(raw, {"oa": "int", "price": "double"})


@query("rename_columns", "SELECT c_custkey AS oa11, c_acctbal AS balance_all, c_mktsegment AS balance_segment FROM customer")
def _(t):
    mapping = {"c_custkey": "oa11", "c_acctbal": "balance_all", "c_mktsegment": "balance_segment"}
    return clean.rename_theme(t.customer.drop("c_name", "c_nationkey"), mapping)


@query("project_drop", "SELECT p_partkey, p_name, p_type FROM part")
def _(t):
    return clean.keep_columns(t.part, ["p_partkey", "p_name", "p_type"])


@query("filter_county", "SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE'")
def _(t):
    named = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    return clean.authorities_in(named, "EUROPE", "r_name")


@query("filter_not_null", "SELECT o_orderkey, s_name FROM orders JOIN supplier ON o_custkey = s_suppkey WHERE s_name IS NOT NULL")
def _(t):
    joined = t.orders.join(t.supplier, F.col("o_custkey") == F.col("s_suppkey"), "left").select("o_orderkey", "s_name")
    return clean.require(joined, "s_name")


@query("filter_ids", "SELECT oa_id, poi_id FROM fx_trips WHERE oa_id IN (1, 2, 3, 5, 8, 13, 21, 34) AND poi_id IN (SELECT poi_id FROM fx_poi WHERE type IN ('School', 'Childcare'))")
def _(t):
    areas = clean.select_areas(t.fx_trips(), [1, 2, 3, 5, 8, 13, 21, 34])
    return areas.join(clean.select_pois(t.fx_poi(), ["School", "Childcare"]), "poi_id", "left_semi").select("oa_id", "poi_id")


@query("filter_pending", "SELECT trip_id, oa_id, poi_id FROM fx_trips WHERE computed = 0")
def _(t):
    return clean.pending(t.fx_trips()).select("trip_id", "oa_id", "poi_id")


@query("filter_except_total", "SELECT oa_id, population, count FROM fx_pop WHERE population <> 'total'")
def _(t):
    return clean.groups(t.fx_pop())


@query("const_column", "SELECT s_suppkey, s_name, 'Childcare' AS type FROM supplier")
def _(t):
    return clean.with_label(t.supplier.select("s_suppkey", "s_name"), "type", "Childcare")


@query("null_default", "SELECT oa11, coalesce(flag_a, 0) + coalesce(flag_r, 0) AS heads FROM fx_wide")
def _(t):
    return t.fx_wide().select("oa11", reshape.group_sum(["flag_a", "flag_r"]).alias("heads"))


@query(
    "override_values",
    """WITH last AS (SELECT o_custkey AS oa_id, arg_max(o_totalprice, o_orderkey) AS lat, arg_max(o_totalprice / 2, o_orderkey) AS lon
       FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
       SELECT a.oa_id, coalesce(b.lat, a.lat) AS lat, coalesce(b.lon, a.lon) AS lon FROM fx_oa a LEFT JOIN last b ON a.oa_id = b.oa_id""",
)
def _(t):
    fixes = t.orders.where("o_orderpriority = '1-URGENT'").select(
        F.col("o_custkey").alias("oa_id"),
        F.col("o_totalprice").alias("lat"),
        (F.col("o_totalprice") / 2).alias("lon"),
        F.col("o_orderkey").alias("seq"),
    )
    return clean.apply_overrides(t.fx_oa(), fixes, "oa_id", ["lat", "lon"])


@query("update_scale", "SELECT trip_id, metric, CASE WHEN metric IN ('total_time', 'transit_time') THEN value / 60 ELSE value END AS value FROM fx_long")
def _(t):
    return scale_metrics(t.fx_long(), ["total_time", "transit_time"])


@query(
    "mark_computed",
    """SELECT trip_id, CASE WHEN n BETWEEN 101 AND 600 THEN 1 ELSE computed END AS computed
       FROM (SELECT *, row_number() OVER (ORDER BY trip_id) AS n FROM fx_trips)""",
)
def _(t):
    return mark_computed(t.fx_trips(), 500, 100).select("trip_id", "computed")


@query(
    "mark_computed_stored",
    """SELECT trip_id, CASE WHEN n BETWEEN size // 2 + 1 AND size // 2 + 500 THEN 1 ELSE computed END AS computed
       FROM (SELECT *, row_number() OVER (ORDER BY trip_id) AS n, count(*) OVER () AS size FROM fx_trips)""",
)
def _(t):
    """A page in the middle of the stored trips."""
    stored = t.paged_trips()
    stored.update_page(500, t.orders.count() // 2, computed=F.lit(1))
    return stored.read().select("trip_id", "computed")


@query("nonnull_row_check", "SELECT trip_id, total_time, fare FROM (SELECT trip_id, total_time, CASE WHEN num_transfers = 3 THEN NULL ELSE fare END AS fare FROM fx_results) WHERE fare IS NOT NULL AND total_time IS NOT NULL")
def _(t):
    holes = F.when(F.col("num_transfers") == 3, F.lit(None)).otherwise(F.col("fare")).alias("fare")
    return clean.valid_trips(t.fx_results().select("trip_id", "total_time", holes))


@query("str_squeeze", r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM documents")
def _(t):
    return t.documents.select("doc_id", text.squeeze(F.col("text")).alias("text"))


@query(
    "str_initcap",
    """SELECT p_partkey, array_to_string(list_transform(string_split(lower(p_type), ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS type,
       array_to_string(list_transform(string_split(lower(p_name), ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS name FROM part""",
)
def _(t):
    return t.part.select(
        "p_partkey", text.title_words(F.col("p_type")).alias("type"), text.title_words(F.col("p_name")).alias("name")
    )


_WORDS = "list_transform(string_split({0}, '_'), lambda w: CASE WHEN w IN ('am', 'pm', 'uk') THEN upper(w) ELSE upper(w[1]) || w[2:] END)"
_NAMES = "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_type ELSE event_type || '_am_score' END AS name FROM events"


@query("str_humanise", f"SELECT event_id, array_to_string({_WORDS.format('name')}, ' ') AS label FROM ({_NAMES})")
def _(t):
    name = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(F.concat("event_type", F.lit("_am_score")))
    return t.events.select("event_id", text.humanise(name).alias("label"))


@query("str_is_snake", "SELECT c_custkey, (contains(c_name, '_') OR c_name[1] <> upper(c_name[1])) AS by_name, (lower(c_mktsegment)[1] <> upper(lower(c_mktsegment)[1])) AS by_segment FROM customer")
def _(t):
    lower = F.lower("c_mktsegment")
    return t.customer.select("c_custkey", text.is_snake(F.col("c_name")).alias("by_name"), text.is_snake(lower).alias("by_segment"))


@query("kv_pairs", f"SELECT DISTINCT event_type AS key, array_to_string({_WORDS.format('event_type')}, ' ') AS value FROM events")
def _(t):
    return text.kv_pairs(clean.distinct_values(t.events, "event_type"), "event_type")


@query(
    "agg_common_prefix",
    """WITH ends AS (SELECT min(c_name) AS lo, max(c_name) AS hi FROM customer),
       cut AS (SELECT lo[1:coalesce(max(i) FILTER (WHERE lo[1:i] = hi[1:i]), 0)] AS prefix
               FROM ends, range(1, 200) r(i) WHERE i <= least(length(lo), length(hi)) GROUP BY lo)
       SELECT c_custkey, replace(c_name, prefix, '') AS c_name FROM customer, cut""",
)
def _(t):
    return text.strip_common_prefix(t.customer.select("c_custkey", "c_name"), "c_name")


@query("gc_cost", "SELECT trip_id, round(generalised_cost, 6) AS generalised_cost FROM fx_costed")
def _(t):
    return generalised_cost(t.fx_results()).select("trip_id", F.round("generalised_cost", 6).alias("generalised_cost"))


@query(
    "gc_cost_nowait",
    "SELECT trip_id, round((1.5e0 * total_time - 0.5e0 * transit_time + fare * 3600 / 6.7e0 + 10 * num_transfers) / 60, 6) AS generalised_cost FROM fx_results",
)
def _(t):
    costed = generalised_cost(t.fx_results(), with_wait=False)
    return costed.select("trip_id", F.round("generalised_cost", 6).alias("generalised_cost"))


@query("fare_flat", "SELECT trip_id, num_transfers, round(fare, 4) AS fare FROM fx_results")
def _(t):
    rule = fare(F.col("num_transfers"), F.col("walk_time"), F.col("total_time"))
    return t.fx_results().select("trip_id", "num_transfers", F.round(rule, 4).alias("fare"))


@query("fare_xml", "SELECT trip_id, round(CASE WHEN total_time % 2 = 0 THEN total_time / 100 ELSE fare END, 4) AS fare FROM fx_results")
def _(t):
    cents = F.when(F.col("total_time") % 2 == 0, F.col("total_time"))
    price = fare(F.col("num_transfers"), F.col("walk_time"), F.col("total_time"), cents)
    return t.fx_results().select("trip_id", F.round(price, 4).alias("fare"))


@query(
    "bool_parse",
    """SELECT l_orderkey, l_partkey, CASE l_linenumber % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true ELSE NULL END AS flag
       FROM lineitem""",
)
def _(t):
    word = F.element_at(F.array(F.lit("1"), F.lit("off"), F.lit(" Yes "), F.lit(None)), F.col("l_linenumber") % 4 + 1)
    return t.lineitem.select("l_orderkey", "l_partkey", text.parse_bool(word).alias("flag"))


@query(
    "time_format",
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H:%M') AS time,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp FROM events""",
)
def _(t):
    ts = F.col("ts")
    return t.events.select(
        "event_id",
        clock.fmt(ts, clock.DATE_FORMAT).alias("date"),
        clock.fmt(ts, clock.MINUTE_FORMAT).alias("time"),
        clock.fmt(ts, clock.STAMP_FORMAT).alias("stamp"),
    )


@query(
    "time_parse",
    """SELECT trip_id, strftime(strptime(date || ' ' || time, '%Y-%m-%d %H:%M') + INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M:%S') AS stamp,
       CAST(split_part(time, ':', 1) AS INTEGER) * 3600 + CAST(split_part(time, ':', 2) AS INTEGER) * 60 AS first_second,
       86340 AS last_second FROM fx_trips""",
)
def _(t):
    slot = clock.parse_slot(F.concat("time", F.lit("-23:59")))
    later = clock.stamp(F.col("date"), F.col("time")) + F.expr("INTERVAL 1 MINUTE")
    return t.fx_trips().select(
        "trip_id",
        F.date_format(later, clock.STAMP_FORMAT).alias("stamp"),
        slot["first_second"].alias("first_second"),
        slot["last_second"].alias("last_second"),
    )


@query(
    "epoch_shift",
    "SELECT event_id, strftime(date_trunc('second', ts) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS local FROM events",
)
def _(t):
    ms = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.date_trunc("second", F.col("ts")).cast("timestamp_ntz")) * 1000
    return t.events.select("event_id", clock.fmt(clock.from_epoch_ms(ms), clock.STAMP_FORMAT).alias("local"))


@query(
    "wait_seconds",
    "SELECT event_id, round(epoch_us(ts) / 1e6 - epoch(date_trunc('day', ts)), 6) AS wait FROM events",
)
def _(t):
    midnight = F.date_trunc("day", F.col("ts")).cast("timestamp_ntz")
    return t.events.select("event_id", F.round(clock.seconds_between(midnight, F.col("ts")), 6).alias("wait"))


@query("round_n", "SELECT l_orderkey, l_partkey, round(l_extendedprice / 7, 2) AS two, round(l_extendedprice / 7, 3) AS three FROM lineitem")
def _(t):
    seventh = F.col("l_extendedprice") / 7
    return t.lineitem.select("l_orderkey", "l_partkey", text.round_n(seventh, 2).alias("two"), text.round_n(seventh, 3).alias("three"))


@query("agg_bad_rows", "SELECT count(*) AS n, CAST(sum(CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END) AS BIGINT) AS bad, round(sum(CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END) / count(*) * 100, 2) AS pct FROM lineitem")
def _(t):
    return clean.loss_report(t.lineitem.select((F.col("l_linenumber") != 7).alias("ok")))


@query("agg_distinct", "SELECT DISTINCT o_orderpriority FROM orders")
def _(t):
    return clean.distinct_values(t.orders, "o_orderpriority")


@query(
    "agg_distinct_on",
    """SELECT DISTINCT ON (c_nationkey, c_mktsegment) c_nationkey, c_mktsegment, c_custkey, c_name, c_acctbal FROM customer
       ORDER BY c_nationkey, c_mktsegment, c_acctbal, c_custkey""",
)
def _(t):
    return clean.first_per(t.customer, ["c_nationkey", "c_mktsegment"], ["c_acctbal", "c_custkey"])


@query("agg_dedupe_group", "SELECT text, lang, source FROM documents GROUP BY text, lang, source")
def _(t):
    return clean.dedupe(t.documents, ["text", "lang", "source"])


@query("union_layers", "SELECT s_name AS name, 'Supplier' AS type FROM supplier UNION ALL SELECT c_name, 'Customer' FROM customer UNION ALL SELECT p_name, 'Part' FROM part")
def _(t):
    layers = [
        clean.with_label(t.supplier.select(F.col("s_name").alias("name")), "type", "Supplier"),
        clean.with_label(t.customer.select(F.col("c_name").alias("name")), "type", "Customer"),
        clean.with_label(t.part.select(F.col("p_name").alias("name")), "type", "Part"),
    ]
    return clean.union_layers(layers)


@query("union_all", "SELECT oa_id, poi_id, date, time FROM fx_trips WHERE computed = 1 UNION ALL SELECT oa_id, poi_id, date, time FROM fx_trips")
def _(t):
    cols = ["oa_id", "poi_id", "date", "time"]
    return clean.union_layers([t.fx_trips().where("computed = 1").select(*cols), t.fx_trips().select(*cols)])


@query("unpivot_population", "SELECT oa_id, population, count FROM fx_pop")
def _(t):
    return reshape.populations(t.fx_wide(), GROUPS)


@query("unpivot_metrics", "SELECT trip_id, metric, value FROM fx_long")
def _(t):
    return t.fx_long()


@query("unnest_parallel", "SELECT vec_id, unnest(embedding[1:32]) AS a, unnest(embedding[33:64]) AS b FROM embeddings")
def _(t):
    parts = t.embeddings.select("vec_id", F.slice("embedding", 1, 32).alias("a"), F.slice("embedding", 33, 32).alias("b"))
    return reshape.zip_explode(parts, ["a", "b"])
