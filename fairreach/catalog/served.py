"""The served queries and the ad-hoc query."""

from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from fairreach.catalog.aggregates import AT_RISK, DEMOGRAPHIC, HIGH_LEVEL, SELECTED, STRATA, TYPES, _ROUNDED_SQL, _rounded
from fairreach.catalog.cleaning import _WORDS
from fairreach.catalog.fixtures import METRIC_COLUMNS, Tables
from fairreach.catalog.registry import query
from fairreach.catalog.shaping import _NEAR
from fairreach.operators.numbering import add_rank
from fairreach.operators.cube import access_metric
from fairreach.plans import serving
from fairreach.plans.adhoc import AccessQuery, access_query
from fairreach.plans.costing import cost_trips
from fairreach.session import scratch_path


def _humanised(col: str) -> str:
    return f"CASE WHEN contains({col}, '_') OR {col}[1] <> upper({col}[1]) THEN array_to_string({_WORDS.format(col)}, ' ') ELSE {col} END"


@query("q_meta_strata", f"SELECT DISTINCT stratum AS key, {_humanised('stratum')} AS value FROM fx_cube")
def _(t: Tables):
    return serving.meta_strata(t.served_cube())


@query("q_meta_poi_type", f"SELECT DISTINCT type AS key, {_humanised('type')} AS value FROM fx_poi")
def _(t: Tables):
    return serving.meta_poi_types(t.fx_poi())


@query("q_meta_demographic", f"SELECT DISTINCT population AS key, {_humanised('population')} AS value FROM fx_pop WHERE population <> 'total'")
def _(t: Tables):
    return serving.meta_demographics(t.fx_pop())


@query(
    "q_population_metrics",
    """SELECT oa_id, CAST(sum(count) AS BIGINT) AS metric, row_number() OVER (ORDER BY sum(count), oa_id) AS rank
       FROM fx_pop WHERE population IN ('not_a') GROUP BY oa_id""",
)
def _(t: Tables):
    return serving.population_metrics(t.served_cube(), t.fx_pop(), demographics=["not_a"])


@query(
    "q_population_metrics_at_risk",
    AT_RISK.format(groups="", where=SELECTED) + " SELECT oa_id, round(metric, 6) AS metric, row_number() OVER (ORDER BY metric, oa_id) AS rank FROM risk",
)
def _(t: Tables):
    ranked = serving.population_metrics(t.served_cube(), t.fx_pop(), "at-risk_score", (), TYPES, STRATA)
    return ranked.withColumn("metric", F.round("metric", 6))


@query("q_accessibility_metrics_high", HIGH_LEVEL.format(m="generalised_cost", where=SELECTED))
def _(t: Tables):
    return serving.high_level(t.served_cube(), "generalised_cost", TYPES, STRATA)


@query(
    "q_accessibility_metrics",
    f"""SELECT oa_id, round(metric, 6) AS metric, row_number() OVER (ORDER BY metric, oa_id) AS rank FROM
        (SELECT oa_id, sum(sum_generalised_cost) / sum(num_trips) AS metric FROM fx_cube {SELECTED} GROUP BY 1)""",
)
def _(t: Tables):
    areas = serving.accessibility_metrics(t.served_cube(), t.fx_pop(), "generalised_cost", TYPES, STRATA)[1]
    return areas.withColumn("metric", F.round("metric", 6))


@query("q_accessibility_metrics_groups", DEMOGRAPHIC.format(m="journey_time", where=SELECTED))
def _(t: Tables):
    return serving.demographic_level(t.served_cube(), t.fx_pop(), "journey_time", TYPES, STRATA)


@query("q_results_summary", f"SELECT oa_id, poi_type, stratum, num_trips, {_ROUNDED_SQL} FROM fx_cube")
def _(t: Tables):
    """The stored cube, built from one half of the results and extended by the other."""
    store = serving.CubeStore(t.spark, scratch_path(t.spark, "summary"))
    rest = (t.fx_trips(), t.fx_poi(), t.fx_strata())
    store.refresh(t.fx_results().where("trip_id % 2 = 0"), *rest)
    for _ in range(2):  # the second time is without effect
        store.add(t.fx_results().where("trip_id % 2 = 1"), *rest, label="odd")
    return _rounded(store.read(), "oa_id", "poi_type", "stratum")


_OVERLAP = """times AS (SELECT DISTINCT date, time, stratum FROM fx_trips JOIN fx_strata USING (trip_id)
    UNION ALL SELECT DISTINCT date, time, 'Morning' FROM fx_trips WHERE time < '12:00'),
    f AS (SELECT l.metric, l.value, m.oa_id, m.poi_id, k.poi_type, s.stratum FROM fx_long l JOIN fx_trips m ON l.trip_id = m.trip_id
    JOIN times s ON m.date = s.date AND m.time = s.time JOIN fx_k_poi k ON m.oa_id = k.oa_id AND m.poi_id = k.poi_id),
    d AS (SELECT oa_id, poi_id, poi_type, stratum, metric, quantile_disc(value, 0.5) AS value FROM f GROUP BY ALL
    UNION ALL SELECT oa_id, poi_id, poi_type, 'All times', metric, quantile_disc(value, 0.5) FROM f GROUP BY oa_id, poi_id, poi_type, metric),
    best AS (SELECT oa_id, poi_type, stratum, metric, CASE WHEN metric = 'walk_dist' THEN min(value) ELSE min(value) / 60 END AS value
    FROM d GROUP BY oa_id, poi_type, stratum, metric)"""


def _overlapping(t: Tables):
    """The times of all trips under their stratum, and those before noon under a second one."""
    trips = t.fx_trips()
    own = trips.join(t.fx_strata(), "trip_id").select("date", "time", "stratum").distinct()
    return own.unionByName(trips.where("time < '12:00'").select("date", "time", F.lit("Morning").alias("stratum")).distinct())


@query("q_vis_map_results", f"WITH {_OVERLAP} SELECT oa_id, poi_type, stratum, metric, value FROM best")
def _(t: Tables):
    return serving.map_from_results(
        t.fx_results(), t.fx_trips(), _overlapping(t), t.fx_k_poi(), METRIC_COLUMNS, ["total_time", "transit_time"]
    )


@query("q_vis_map_centroids", f"WITH {_OVERLAP} SELECT oa_id, poi_type, stratum, metric, value, lat, lon FROM best JOIN fx_oa USING (oa_id)")
def _(t: Tables):
    return serving.map_from_results(
        t.fx_results(), t.fx_trips(), _overlapping(t), t.fx_k_poi(), METRIC_COLUMNS, ["total_time", "transit_time"], t.fx_oa()
    )


@query(
    "json_row",
    """SELECT '{"oa_id":' || oa_id || ',"rank":' || row_number() OVER (ORDER BY metric, oa_id) || '}' AS json FROM
       (SELECT oa_id, sum(sum_walking_distance) / sum(num_trips) AS metric FROM fx_cube GROUP BY 1)""",
)
def _(t: Tables):
    """Ranked areas as JSON text."""
    return serving.as_json(add_rank(access_metric(t.served_cube(), "walking_distance"), "metric", "oa_id"), ["oa_id", "rank"])


def reply_router(batch: pd.DataFrame, endpoint: str | None) -> pd.DataFrame:
    """A stand-in router answering in the router's XML: a ride straight to the destination."""
    gap = ((batch["oa_lat"] - batch["poi_lat"]) ** 2 + (batch["oa_lon"] - batch["poi_lon"]) ** 2) ** 0.5
    s = (gap * 100000).astype(int)
    asked = pd.to_datetime(batch["date"] + " " + batch["time"])
    start = ((asked - pd.Timestamp(0)) // pd.Timedelta(seconds=1) - 3600) * 1000
    fields = {"duration": s, "startTime": start, "endTime": start + s * 1000, "walkTime": 60, "transitTime": s // 2, "waitingTime": 0, "walkDistance": 80, "transfers": 1}
    replies = "<response><requestParameters><date>" + batch["date"] + "</date><time>" + batch["time"] + "</time></requestParameters><error/><plan><itineraries><itineraries>"
    for name, value in fields.items():
        replies += f"<{name}>" + (value.astype(str) if isinstance(value, pd.Series) else str(value)) + f"</{name}>"
    replies += "<legs><legs><distance>80</distance></legs></legs></itineraries></itineraries></plan></response>"
    return pd.DataFrame({"reply": replies}, index=batch.index)


@query(
    "q_access_query",
    f"""WITH {_NEAR}, s AS (SELECT *, CAST(trunc(((oa_lat - poi_lat) ** 2 + (oa_lon - poi_lon) ** 2) ** 0.5 * 100000) AS BIGINT) AS s FROM drawn)
        SELECT oa_id, poi_type, round(sum(cost), 4) AS total_cost, round(avg(cost), 5) AS mean_cost FROM (SELECT *,
        (1.5e0 * s - 0.5e0 * (s // 2) + CASE WHEN s = 60 THEN 0 ELSE 4.8e0 END * 3600 / 6.7e0 + 10) / 60 AS cost FROM s) GROUP BY 1, 2""",
)
def _(t: Tables):
    wanted = AccessQuery(["School"], dt.datetime(2021, 4, 20, 7, 30), dt.datetime(2021, 4, 20, 9, 30), 3)
    scores = access_query(wanted, t.fx_oa(), t.fx_poi(), reply_router)
    return scores.select(
        "oa_id", "poi_type", F.round("total_cost", 4).alias("total_cost"), F.round("mean_cost", 5).alias("mean_cost")
    )


def patchy_router(batch: pd.DataFrame, endpoint: str | None) -> pd.DataFrame:
    """The stand-in router with gaps: no answer for every seventh trip, no path for every eleventh."""
    found = reply_router(batch[batch["trip_id"] % 7 != 0], endpoint)
    none = batch.loc[found.index, "trip_id"] % 11 == 0
    found.loc[none, "reply"] = "<response><error><msg>none</msg><message>PATH_NOT_FOUND</message></error><plan/></response>"
    return found


_COSTED = """asked AS (SELECT t.*, CAST(trunc(((o.lat - p.lat) ** 2 + (o.lon - p.lon) ** 2) ** 0.5 * 100000) AS BIGINT) AS s
    FROM fx_trips t JOIN fx_oa o ON t.oa_id = o.oa_id JOIN fx_poi p ON t.poi_id = p.poi_id WHERE t.computed = 0)"""


def _costed(t: Tables):
    return cost_trips(t.fx_trips(), t.fx_oa(), t.fx_poi(), patchy_router, endpoints=["a", "b"])


@query(
    "cost_trips_results",
    f"""WITH {_COSTED} SELECT trip_id, CAST(s AS DOUBLE) AS total_time, 60e0 AS walk_time, CAST(s // 2 AS DOUBLE) AS transit_time, 80e0 AS walk_dist, 0e0 AS transit_dist,
        date || ' ' || time || ':00' AS departure_time, CASE WHEN s = 60 THEN 0e0 ELSE 4.8e0 END AS fare FROM asked WHERE trip_id % 7 <> 0 AND trip_id % 11 <> 0""",
)
def _(t: Tables):
    return _costed(t).results.select(
        "trip_id", "total_time", "walk_time", "transit_time", "walk_dist", "transit_dist", "departure_time", "fare"
    )


@query(
    "cost_trips_flags",
    f"""WITH {_COSTED} SELECT trip_id, CASE WHEN computed = 1 OR (trip_id % 7 <> 0 AND trip_id % 11 <> 0 AND trip_id IN (SELECT trip_id FROM asked)) THEN 1 ELSE 0 END AS computed
        FROM fx_trips""",
)
def _(t: Tables):
    return _costed(t).trips.select("trip_id", "computed")


@query(
    "cost_trips_failures",
    f"""WITH {_COSTED} SELECT trip_id, CASE WHEN trip_id % 7 = 0 THEN 'no answer' ELSE 'no usable itinerary' END AS reason
        FROM asked WHERE trip_id % 7 = 0 OR trip_id % 11 = 0""",
)
def _(t: Tables):
    return _costed(t).failures


@query(
    "cost_trips_losses",
    f"""WITH {_COSTED}, l AS (SELECT count(*) AS n, count(*) FILTER (WHERE trip_id % 7 = 0 OR trip_id % 11 = 0) AS bad FROM asked)
        SELECT n, bad, round(bad / n * 100e0, 2) AS pct FROM l""",
)
def _(t: Tables):
    return _costed(t).losses
