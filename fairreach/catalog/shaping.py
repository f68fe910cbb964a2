"""Queries over calendars, samples, trip building and trip costing."""

from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairreach.catalog.fixtures import Tables
from fairreach.catalog.registry import query
from fairreach.functions.clock import clock_text
from fairreach.operators import calendar, itinerary, trips
from fairreach.operators.numbering import number_rows
from fairreach.session import scratch_path
from fairreach.sources.trip_table import TripTable

_SPANS_SQL = """(SELECT user_id, CAST(min(ts) AS DATE) AS first_day, CAST(max(ts) AS DATE) AS last_day,
    CAST(epoch(min(CAST(ts AS TIME))) AS INTEGER) // 3600 * 3600 AS first_second,
    CAST(epoch(min(CAST(ts AS TIME))) AS INTEGER) // 3600 * 3600 + 1800 AS last_second FROM events GROUP BY 1)"""
_HOLIDAYS_SQL = "(SELECT CAST(ts AS DATE) AS date FROM events WHERE event_type = 'error' AND value > 25 GROUP BY 1 HAVING count(*) % 2 = 0)"


def _spans(t: Tables):
    second = F.hour("ts") * 3600
    return t.events.groupBy("user_id").agg(
        F.min("ts").cast("date").alias("first_day"),
        F.max("ts").cast("date").alias("last_day"),
        F.min(second).alias("first_second"),
        (F.min(second) + 1800).alias("last_second"),
    )


def _holidays(t: Tables):
    busy = t.events.where("event_type = 'error' AND value > 25").groupBy(F.col("ts").cast("date").alias("date"))
    return busy.agg(F.count("*").alias("n")).where("n % 2 = 0").select("date")


@query(
    "gen_dates",
    f"""SELECT user_id, strftime(d, '%Y-%m-%d') AS date FROM (SELECT user_id, unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS d FROM {_SPANS_SQL})
        WHERE dayname(d) IN ('Tuesday', 'Saturday')""",
)
def _(t: Tables):
    days = calendar.dates_between(_spans(t), "first_day", "last_day", ["Tuesday", "Saturday"])
    return days.select("user_id", F.date_format("date", "yyyy-MM-dd").alias("date"))


@query(
    "minus_holidays",
    f"""SELECT user_id, strftime(d, '%Y-%m-%d') AS date FROM (SELECT user_id, unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS d FROM {_SPANS_SQL})
        WHERE CAST(d AS DATE) NOT IN {_HOLIDAYS_SQL}""",
)
def _(t: Tables):
    days = calendar.dates_between(_spans(t), "first_day", "last_day", None, _holidays(t))
    return days.select("user_id", F.date_format("date", "yyyy-MM-dd").alias("date"))


_TIMES_SQL = f"SELECT user_id, unnest(range(first_second, last_second + 1, 60)) AS s FROM {_SPANS_SQL}"
_CLOCK_SQL = "lpad(CAST(s // 3600 AS VARCHAR), 2, '0') || ':' || lpad(CAST(s // 60 % 60 AS VARCHAR), 2, '0')"


@query("gen_times", f"SELECT user_id, {_CLOCK_SQL} AS time FROM ({_TIMES_SQL})")
def _(t: Tables):
    times = calendar.times_between(_spans(t), F.col("first_second"), F.col("last_second"))
    return times.select("user_id", clock_text(F.col("second")).alias("time"))


@query(
    "gen_datetimes",
    f"""SELECT d.user_id, strftime(d.d, '%Y-%m-%d') AS date, time FROM (SELECT user_id, unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS d FROM {_SPANS_SQL}) d
        JOIN (SELECT user_id, {_CLOCK_SQL} AS time FROM ({_TIMES_SQL})) s ON d.user_id = s.user_id WHERE dayname(d.d) = 'Sunday'""",
)
def _(t: Tables):
    spans = _spans(t)
    days = calendar.dates_between(spans, "first_day", "last_day", ["Sunday"]).select("user_id", F.date_format("date", "yyyy-MM-dd").alias("date"))
    times = calendar.times_between(spans, F.col("first_second"), F.col("last_second"))
    return calendar.datetime_range(days, times.select("user_id", clock_text(F.col("second")).alias("time")), ["user_id"])


@query(
    "sample_strata",
    """WITH c AS (SELECT DISTINCT event_type AS stratum, strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H:%M') AS time FROM events)
       SELECT stratum, date, time FROM (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY md5('999|' || stratum || '|' || date || ' ' || time), date, time) AS n FROM c)
       WHERE n <= 30""",
)
def _(t: Tables):
    stamps = t.events.select(
        F.col("event_type").alias("stratum"), F.date_format("ts", "yyyy-MM-dd").alias("date"), F.date_format("ts", "HH:mm").alias("time")
    ).distinct()
    return calendar.sample_per_stratum(stamps, F.lit(30), 30)


@query(
    "sample_times",
    "SELECT trip_id, CAST(('0x' || md5('999|' || trip_id)[1:8])::BIGINT % 120 AS INTEGER) AS minute FROM fx_trips",
)
def _(t: Tables):
    return t.fx_trips().select("trip_id", calendar.sample_minute(F.col("trip_id").cast("string"), 120).alias("minute"))


_NEAR = """near AS (SELECT o.oa_id, p.poi_id, p.type AS poi_type, o.lat AS oa_lat, o.lon AS oa_lon, p.lat AS poi_lat, p.lon AS poi_lon,
    row_number() OVER (PARTITION BY o.oa_id ORDER BY sqrt((o.lat - p.lat) * (o.lat - p.lat) + (o.lon - p.lon) * (o.lon - p.lon)), p.poi_id) AS rank
    FROM fx_oa o, fx_poi p WHERE p.type = 'School'),
    drawn AS (SELECT near.*, sample_no, TIMESTAMP '2021-04-20 07:30:00' + to_minutes(('0x' || md5('999|' || oa_id || '|' || poi_id || '|' || sample_no)[1:8])::BIGINT % 120) AS stamp
    FROM near, range(1, 4) r(sample_no) WHERE rank <= 3)"""
_START, _END = dt.datetime(2021, 4, 20, 7, 30), dt.datetime(2021, 4, 20, 9, 30)


@query("gen_trips", f"WITH {_NEAR} SELECT oa_id, poi_id, poi_type, CAST(sample_no AS INTEGER) AS sample_no, strftime(stamp, '%Y-%m-%d') AS date, strftime(stamp, '%H:%M') AS time FROM drawn")
def _(t: Tables):
    made = trips.generate_trips(t.fx_oa(), t.fx_poi().where("type = 'School'"), _START, _END, 3)
    return made.select("oa_id", "poi_id", "poi_type", "sample_no", "date", "time")


_PRODUCT = """WITH pairs AS (SELECT *, row_number() OVER (ORDER BY oa_id, poi_type, poi_id) AS pair FROM fx_k_poi),
    stamps AS (SELECT *, row_number() OVER (ORDER BY stratum, date, time) AS ts, count(*) OVER () AS n FROM fx_all_stamps)"""


def _coded(df: DataFrame, column: str, code: str) -> tuple[DataFrame, DataFrame]:
    """``df`` with the number of ``column`` among its values as ``code``, and these values by number: a sum by numbers hashes no texts."""
    codes = number_rows(df.select(column).distinct(), [column], code)
    named = codes.withColumnRenamed(column, "_value")
    return df.join(named, F.col(column).eqNullSafe(F.col("_value"))).drop("_value"), codes


@query(
    "join_cross",
    """SELECT oa_id, poi_id, poi_type, count(*) AS trips, count(DISTINCT stratum) AS strata, sum(CAST(time[1:2] AS INTEGER)) AS hours, 0 AS computed
       FROM fx_k_poi, fx_all_stamps GROUP BY 1, 2, 3""",
)
def _(t: Tables):
    """Every pair at every date and time, summed up by pair."""
    pairs, kinds = _coded(t.fx_k_poi(), "poi_type", "kind")
    stamps, strata = _coded(t.fx_all_stamps().withColumn("hour", F.substring("time", 1, 2).cast("int")), "stratum", "code")
    made = trips.cross_trips(pairs, stamps, carry=["code", "hour"], keep=["kind"])
    # by stratum first: sums are kept in a hash map, where sets of strata would have the whole product sorted
    by_stratum = made.groupBy("oa_id", "poi_id", "kind", "code").agg(
        F.count("*").alias("trips"), F.sum("hour").alias("hours"), F.max("computed").alias("computed")
    )
    summed = by_stratum.join(strata, "code").groupBy("oa_id", "poi_id", "kind").agg(
        F.sum("trips").alias("trips"), F.count("stratum").alias("strata"), F.sum("hours").alias("hours"), F.max("computed").alias("computed")
    )
    return summed.join(kinds, "kind").select("oa_id", "poi_id", "poi_type", "trips", "strata", "hours", "computed")


@query(
    "win_row_id",
    f"""{_PRODUCT} SELECT date, time, stratum, count(*) AS trips, min((pair - 1) * n + ts) AS first, max((pair - 1) * n + ts) AS last, sum((pair - 1) * n + ts) AS ids
        FROM pairs, stamps GROUP BY 1, 2, 3""",
)
def _(t: Tables):
    """The ids of all trips, summed up by date, time and stratum."""
    # the timestamps differ, so their numbers tell them apart
    stamps = number_rows(t.fx_all_stamps(), ["stratum", "date", "time"], "at")
    made = trips.assign_trip_ids(t.fx_k_poi(), stamps, carry=["at"], by_stamp=True)
    summed = made.groupBy("at").agg(
        F.count("*").alias("trips"), F.min("trip_id").alias("first"), F.max("trip_id").alias("last"), F.sum("trip_id").alias("ids")
    )
    return summed.join(stamps, "at").select("date", "time", "stratum", "trips", "first", "last", "ids")


@query(
    "join_cross_all",
    f"""{_PRODUCT} SELECT oa_id, poi_id, stratum, count(*) AS trips, sum((pair - 1) * n + ts) AS ids, min(date || ' ' || time) AS first, max(date || ' ' || time) AS last
    FROM pairs, stamps GROUP BY 1, 2, 3""",
)
def _(t: Tables):
    # least and greatest are taken of the texts' places in their order: those of texts would have the whole product sorted
    stamps, strata = _coded(t.fx_all_stamps().withColumn("text", F.concat_ws(" ", "date", "time")), "stratum", "code")
    texts = number_rows(stamps.select("text").distinct(), ["text"], "at")
    made = trips.cross_trips(t.fx_k_poi(), stamps.join(texts, "text"), carry=["at", "code"])
    summed = made.groupBy("oa_id", "poi_id", "code").agg(
        F.count("*").alias("trips"), F.sum("trip_id").alias("ids"), F.min("at").alias("_first"), F.max("at").alias("_last")
    )
    summed = summed.join(strata, "code").select("oa_id", "poi_id", "stratum", "trips", "ids", "_first", "_last")
    for end in ("first", "last"):
        summed = summed.join(texts.select(F.col("at").alias(f"_{end}"), F.col("text").alias(end)), f"_{end}").drop(f"_{end}")
    return summed


_APPEND = """named AS (SELECT t.*, p.type AS poi_type, s.stratum FROM fx_trips t JOIN fx_poi p ON t.poi_id = p.poi_id JOIN fx_strata s ON t.trip_id = s.trip_id),
    old AS (SELECT trip_id, oa_id, poi_id, date, time, computed, poi_type, stratum FROM named WHERE trip_id % 3 <> 0
    UNION ALL SELECT trip_id + 1000000000000, oa_id, poi_id, date, time, 0, poi_type, 'All times' FROM named WHERE trip_id % 15 = 1),
    new AS (SELECT DISTINCT oa_id, poi_id, date, time, poi_type, stratum FROM named n WHERE trip_id % 3 <> 1
    AND NOT EXISTS (SELECT 1 FROM old o WHERE o.oa_id = n.oa_id AND o.poi_id = n.poi_id AND o.date = n.date AND o.time = n.time)),
    final AS (SELECT trip_id, oa_id, poi_id, date, time, poi_type, stratum, computed FROM old
    UNION ALL SELECT (SELECT max(trip_id) FROM old) + row_number() OVER (ORDER BY oa_id, poi_id, date, time, poi_type, stratum), oa_id, poi_id, date, time, poi_type, stratum, 0 FROM new)"""


def _old_and_new(t: Tables):
    """Stored trips, some of them under two strata, and candidates that partly equal them."""
    poi = t.fx_poi().select("poi_id", F.col("type").alias("poi_type"))
    named = t.fx_trips().join(poi, "poi_id").join(t.fx_strata(), "trip_id")
    twice = named.where("trip_id % 15 = 1").withColumns({"trip_id": F.col("trip_id") + 1_000_000_000_000, "stratum": F.lit("All times"), "computed": F.lit(0)})
    return named.where("trip_id % 3 <> 0").unionByName(twice), named.where("trip_id % 3 <> 1").drop("trip_id", "computed")


def _appended(t: Tables):
    return trips.append_trips(*_old_and_new(t))


@query("upsert_trips", f"WITH {_APPEND} SELECT trip_id, oa_id, poi_id, date, time, poi_type, stratum, computed FROM final")
def _(t: Tables):
    """The stored table: loaded once, then extended."""
    old, new = _old_and_new(t)
    kept = TripTable(t.spark, scratch_path(t.spark, "trips"), buckets=16, types={"oa_id": "bigint"})
    kept.load(old)
    kept.append(new)
    return kept.read()


@query("win_first_value", f"WITH {_APPEND} SELECT oa_id, poi_id, date, time, min(trip_id) AS trip_id FROM final GROUP BY 1, 2, 3, 4")
def _(t: Tables):
    return _appended(t).groupBy("oa_id", "poi_id", "date", "time").agg(F.min("trip_id").alias("trip_id"))


@query("win_max_flag", f"WITH {_APPEND} SELECT oa_id, poi_id, date, time, max(computed) AS computed FROM final GROUP BY 1, 2, 3, 4")
def _(t: Tables):
    return _appended(t).groupBy("oa_id", "poi_id", "date", "time").agg(F.max("computed").alias("computed"))


@query("win_global_max", f"WITH {_APPEND} SELECT trip_id, oa_id, poi_id FROM final WHERE trip_id > (SELECT max(trip_id) FROM old)")
def _(t: Tables):
    old, new = _old_and_new(t)
    last = old.agg(F.max("trip_id")).scalar()
    return trips.new_trips(old, new, last).select("trip_id", "oa_id", "poi_id")


def _text(name: str, c) -> list:
    return [F.lit(f"<{name}>"), c.cast("string"), F.lit(f"</{name}>")]


def _xml(t: Tables):
    """A router reply per order line: mostly one itinerary, some errors."""
    # replies come from as many tasks as there are workers, however few files the trips were in
    lines = t.lineitem.repartition(t.spark.sparkContext.defaultParallelism)
    item = lines.withColumn("asked", F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.lit(8)))
    origin = F.lit("1970-01-01").cast("timestamp_ntz")
    start = (F.timestamp_diff("SECOND", origin, F.col("asked")) - 3600 + F.col("l_quantity").cast("bigint") * 30) * 1000
    duration = F.floor(F.col("l_extendedprice") / 10)
    cents = F.when(F.col("l_linenumber") == 2, F.concat(F.lit("<fare><details><regular><price><cents>"), F.col("l_quantity").cast("int").cast("string"), F.lit("</cents></price></regular></details></fare>"))).otherwise("")
    legs = F.concat(F.lit("<legs><legs><distance>"), (F.col("l_quantity") * 25).cast("string"), F.lit("</distance></legs><legs><distance>"), (F.col("l_quantity") * 400).cast("string"), F.lit("</distance></legs></legs>"))
    itinerary_xml = F.concat(
        F.lit("<itineraries>"),
        *_text("duration", duration),
        *_text("startTime", start),
        *_text("endTime", start + duration * 1000),
        *_text("walkTime", F.col("l_quantity") * 20),
        *_text("transitTime", F.col("l_quantity") * 60),
        *_text("waitingTime", F.col("l_quantity") * 3),
        *_text("walkDistance", F.col("l_quantity") * 25),
        *_text("transfers", F.col("l_linenumber") % 4),
        cents,
        legs,
        F.lit("</itineraries>"),
    )
    error = (
        F.when(F.col("l_linenumber") == 6, F.lit("<error><msg>near</msg><message>TOO_CLOSE</message></error><plan/>"))
        .when(F.col("l_linenumber") == 7, F.lit("<error><msg>none</msg><message>PATH_NOT_FOUND</message></error><plan/>"))
        .otherwise(F.concat(F.lit("<error/><plan><itineraries>"), itinerary_xml, F.lit("</itineraries></plan>")))
    )
    head = F.concat(
        F.lit("<response><requestParameters>"),
        *_text("date", F.date_format("asked", "yyyy-MM-dd")),
        *_text("time", F.date_format("asked", "HH:mm")),
        F.lit("</requestParameters>"),
    )
    return item.select("l_orderkey", "l_partkey", F.concat(head, error, F.lit("</response>")).alias("xml"))


_PARSED = """SELECT l_orderkey, l_partkey, l_linenumber = 6 AS near, l_linenumber <> 7 AS ok, floor(l_extendedprice / 10e0) AS total_time,
    l_quantity AS q, l_linenumber % 4 AS tr, l_linenumber, l_shipdate + INTERVAL 8 HOUR AS asked FROM lineitem"""


@query(
    "xml_itinerary",
    f"""SELECT l_orderkey, l_partkey, CASE WHEN near THEN 0 ELSE total_time END AS total_time, CASE WHEN near THEN 0 ELSE q * 20 END AS walk_time,
        CASE WHEN near THEN 0 ELSE q * 60 END AS transit_time, CASE WHEN near THEN 0 ELSE q * 25 END AS walk_dist,
        CASE WHEN near THEN 0 ELSE q * 400 END AS transit_dist, CASE WHEN near THEN 0 ELSE q * 425 END AS total_dist,
        CASE WHEN near THEN 0 ELSE tr END AS num_transfers, CASE WHEN near THEN 0 ELSE q * 30 END AS initial_wait_time,
        strftime(asked + CASE WHEN near THEN INTERVAL 0 SECOND ELSE to_seconds(q * 30) END, '%Y-%m-%d %H:%M:%S') AS departure_time,
        strftime(asked + CASE WHEN near THEN INTERVAL 0 SECOND ELSE to_seconds(q * 30 + total_time) END, '%Y-%m-%d %H:%M:%S') AS arrival_time
        FROM ({_PARSED}) WHERE ok""",
)
def _(t: Tables):
    fields = [f for f in itinerary.TRIP_FIELDS if f not in ("fare", "transfer_wait_time")]
    return itinerary.trip_results(_xml(t), "xml", ["l_orderkey", "l_partkey"]).select("l_orderkey", "l_partkey", *fields)


@query(
    "parse_rules",
    f"""SELECT l_orderkey, l_partkey, ok, CASE WHEN near THEN 0e0 WHEN NOT ok THEN NULL WHEN l_linenumber = 2 THEN q / 100 WHEN q * 20 = total_time THEN 0e0
        ELSE round(2.4e0 * (tr + 1), 4) END AS fare FROM ({_PARSED})""",
)
def _(t: Tables):
    parsed = itinerary.parse_itineraries(_xml(t), "xml", ["l_orderkey", "l_partkey"])
    return parsed.select("l_orderkey", "l_partkey", "ok", F.round("fare", 4).alias("fare"))


@query("attach_trip_id", f"SELECT l_orderkey AS trip_id, count(*) AS n, sum(CASE WHEN near THEN 0 ELSE total_time END) AS total_time FROM ({_PARSED}) WHERE ok GROUP BY 1")
def _(t: Tables):
    tagged = _xml(t).select(F.col("l_orderkey").alias("trip_id"), "xml")
    results = itinerary.trip_results(tagged, "xml", ["trip_id"])
    return results.groupBy("trip_id").agg(F.count("*").alias("n"), F.sum("total_time").alias("total_time"))


def straight_line_router(batch: pd.DataFrame, endpoint: str | None) -> pd.DataFrame:
    """A stand-in router: minutes from the distance, nothing for every seventh trip."""
    answered = batch[batch["trip_id"] % 7 != 0]
    gap = ((answered["oa_lat"] - answered["poi_lat"]) ** 2 + (answered["oa_lon"] - answered["poi_lon"]) ** 2) ** 0.5
    return pd.DataFrame({"minutes": gap * 600.0}, index=answered.index)


@query(
    "enrich_partitions",
    """SELECT trip_id, trip_id % 7 <> 0 AS ok, CASE WHEN trip_id % 7 <> 0 THEN round(600 * sqrt((o.lat - p.lat) * (o.lat - p.lat) + (o.lon - p.lon) * (o.lon - p.lon)), 6) END AS minutes
       FROM fx_trips t JOIN fx_oa o ON t.oa_id = o.oa_id JOIN fx_poi p ON t.poi_id = p.poi_id WHERE t.computed = 0""",
)
def _(t: Tables):
    from fairreach.operators.combine import otp_trips

    wanted = otp_trips(t.fx_trips(), t.fx_oa(), t.fx_poi())
    costed = itinerary.enrich(wanted, straight_line_router, "minutes double", endpoints=["a", "b"])
    return costed.select("trip_id", "ok", F.round("minutes", 6).alias("minutes"))
