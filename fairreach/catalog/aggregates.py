"""Queries over the cube, its metrics, medians and ranks."""

from __future__ import annotations

from pyspark.sql import functions as F

from fairreach.catalog.fixtures import Tables
from fairreach.catalog.registry import query
from fairreach.operators import clean, cube, medians, numbering, risk
from fairreach.plans.serving import map_attributes

TYPES = ["School", "Hospital"]
STRATA = ["1-URGENT", "5-LOW"]
SELECTED = "WHERE poi_type IN ('School', 'Hospital') AND stratum IN ('1-URGENT', '5-LOW')"

_SUMS = [c for c in cube.moment_columns()]
_ROUNDED_SQL = ", ".join(f"round({c}, 3) AS {c}" for c in _SUMS)


def _rounded(df, *keys):
    return df.select(*keys, "num_trips", *[F.round(c, 3).alias(c) for c in _SUMS])


@query("agg_summary_cube", f"SELECT oa_id, poi_type, stratum, num_trips, {_ROUNDED_SQL} FROM fx_cube")
def _(t: Tables):
    return _rounded(t.fx_cube(), *cube.DIMENSIONS)


@query(
    "agg_moments_merge",
    "SELECT poi_type, CAST(sum(num_trips) AS BIGINT) AS num_trips, "
    + ", ".join(f"round(sum({c}), 1) AS {c}" for c in _SUMS)
    + " FROM fx_cube GROUP BY 1",
)
def _(t: Tables):
    merged = cube.merge_moments(t.fx_cube(), ["poi_type"])
    return merged.select("poi_type", "num_trips", *[F.round(c, 1).alias(c) for c in _SUMS])


@query("filter_in", f"SELECT oa_id, poi_type, stratum, num_trips FROM fx_cube {SELECTED}")
def _(t: Tables):
    return cube.filter_cube(t.fx_cube(), TYPES, STRATA).select("oa_id", "poi_type", "stratum", "num_trips")


@query(
    "agg_access_metric",
    f"SELECT oa_id, round(sum(sum_walking_distance) / sum(num_trips), 6) AS metric FROM fx_cube {SELECTED} GROUP BY 1",
)
def _(t: Tables):
    areas = cube.access_metric(t.fx_cube(), "walking_distance", TYPES, STRATA)
    return areas.select("oa_id", F.round("metric", 6).alias("metric"))


HIGH_LEVEL = """SELECT round(s / n, 2) AS mean, round(sqrt((q - 2 * (s / n) * s + n * (s / n) * (s / n)) / (n - 1)), 2) AS variance,
    round(s * s / (n * q), 3) AS jains_index FROM (SELECT CAST(sum(num_trips) AS DOUBLE) AS n, sum(sum_{m}) AS s, sum(sum_of_squared_{m}) AS q
    FROM fx_cube {where})"""


@query("agg_high_level", HIGH_LEVEL.format(m="journey_time", where=""))
def _(t: Tables):
    return cube.high_level(t.fx_cube(), "journey_time")


DEMOGRAPHIC = """WITH stats AS (SELECT oa_id, sum(sum_{m}) / sum(num_trips) AS a FROM fx_cube {where} GROUP BY 1),
    w AS (SELECT population, round(sum(a * count) / sum(count), 2) AS wass FROM stats JOIN fx_pop USING (oa_id) GROUP BY 1)
    SELECT population, wass, round(wass - (SELECT wass FROM w WHERE population = 'total'), 2) AS arm FROM w
    WHERE population <> 'total'"""


@query("agg_weighted_demographic", DEMOGRAPHIC.format(m="generalised_cost", where=""))
def _(t: Tables):
    return cube.demographic_level(t.fx_cube(), t.fx_pop())


@query("agg_population", "SELECT oa_id, CAST(sum(count) AS BIGINT) AS metric FROM fx_pop WHERE population IN ('a', 'n') GROUP BY 1")
def _(t: Tables):
    return cube.population_density(t.fx_pop(), ["a", "n"])


AT_RISK = """WITH placed AS (SELECT oa_id, row_number() OVER (ORDER BY count DESC, oa_id) AS place, count(*) OVER () AS size
    FROM fx_pop WHERE population = 'total'),
    heads AS (SELECT oa_id, CAST(sum(count) AS BIGINT) AS heads FROM fx_pop {groups} GROUP BY 1),
    cost AS (SELECT oa_id, sum(sum_generalised_cost) / sum(num_trips) AS cost FROM fx_cube {where} GROUP BY 1),
    risk AS (SELECT oa_id, cost / heads AS metric FROM placed JOIN heads USING (oa_id) JOIN cost USING (oa_id)
    WHERE place <= size // 2 + 1 AND heads > 0)"""


@query("agg_at_risk", AT_RISK.format(groups="WHERE population = 'a'", where="") + " SELECT oa_id, round(metric, 6) AS metric FROM risk")
def _(t: Tables):
    return risk.at_risk(t.fx_cube(), t.fx_pop(), ["a"]).select("oa_id", F.round("metric", 6).alias("metric"))


@query(
    "agg_at_risk_sql",
    """SELECT p.oa_id, round(a.metric / p.heads, 6) AS at_risk_score FROM
       (SELECT oa_id, sum(count) AS heads FROM fx_pop GROUP BY 1 ORDER BY heads DESC, oa_id LIMIT 400) p
       LEFT JOIN fx_access a ON p.oa_id = a.oa_id""",
)
def _(t: Tables):
    top = risk.at_risk_topk(t.fx_cube(), t.fx_pop(), 400)
    return top.select("oa_id", F.round("at_risk_score", 6).alias("at_risk_score"))


@query(
    "topk_population",
    """SELECT oa_id, count, place FROM (SELECT oa_id, count, row_number() OVER (ORDER BY count DESC, oa_id) AS place,
       count(*) OVER () AS size FROM fx_pop WHERE population = 'total') WHERE place <= size // 2 + 1""",
)
def _(t: Tables):
    return numbering.top_half(t.fx_pop()).select("oa_id", "count", "place")


@query(
    "agg_percentile_disc",
    """SELECT oa_id, poi_id, poi_type, stratum, metric, quantile_disc(value, 0.5) AS value FROM fx_full GROUP BY 1, 2, 3, 4, 5""",
)
def _(t: Tables):
    return medians.median_by(t.fx_full(), ["oa_id", "poi_id", "poi_type", "stratum", "metric"], "value")


_WITH_ALL = """SELECT poi_type, stratum, metric, quantile_disc(value, 0.5) AS value FROM fx_full GROUP BY 1, 2, 3
    UNION ALL SELECT poi_type, 'All times', metric, quantile_disc(value, 0.5) FROM fx_full GROUP BY 1, 3"""


@query("agg_rollup_alltimes", _WITH_ALL)
def _(t: Tables):
    out = medians.median_with_all(t.fx_full(), ["poi_type", "stratum", "metric"], "stratum", "value")
    return out.select("poi_type", "stratum", "metric", "value")


_MEDIANS = """m AS (SELECT oa_id, poi_id, poi_type, stratum, metric, quantile_disc(value, 0.5) AS value FROM fx_full GROUP BY 1, 2, 3, 4, 5
    UNION ALL SELECT oa_id, poi_id, poi_type, 'All times', metric, quantile_disc(value, 0.5) FROM fx_full GROUP BY 1, 2, 3, 5)"""


@query("agg_min_over_poi", f"WITH {_MEDIANS} SELECT oa_id, poi_type, stratum, metric, min(value) AS value FROM m WHERE stratum <> 'All times' GROUP BY 1, 2, 3, 4")
def _(t: Tables):
    per_poi = medians.median_by(t.fx_full(), ["oa_id", "poi_id", "poi_type", "stratum", "metric"], "value")
    return medians.best_poi(per_poi)


@query(
    "q_vis_map",
    f"""WITH {_MEDIANS} SELECT oa_id, poi_type, stratum, metric, CASE WHEN metric IN ('total_time', 'transit_time')
        THEN min(value) / 60 ELSE min(value) END AS value FROM m GROUP BY 1, 2, 3, 4""",
)
def _(t: Tables):
    return map_attributes(t.fx_full(), ["total_time", "transit_time"])


@query(
    "agg_access_score",
    """SELECT oa_id, poi_type, round(sum(c), 4) AS total_cost, round(avg(c), 5) AS mean_cost FROM (SELECT oa_id, poi_type,
       (1.5e0 * total_time - 0.5e0 * transit_time + fare * 3600 / 6.7e0 + 10 * num_transfers) / 60 AS c FROM fx_labelled)
       GROUP BY 1, 2""",
)
def _(t: Tables):
    labelled = cube.label_results(t.fx_results(), t.fx_trips(), t.fx_poi(), t.fx_strata())
    return cube.access_score(labelled).select(
        "oa_id", "poi_type", F.round("total_cost", 4).alias("total_cost"), F.round("mean_cost", 5).alias("mean_cost")
    )


@query(
    "win_rank_metric",
    """SELECT oa_id, round(metric, 6) AS metric, row_number() OVER (ORDER BY metric, oa_id) AS rank FROM
       (SELECT oa_id, sum(sum_journey_time) / sum(num_trips) AS metric FROM fx_cube GROUP BY 1)""",
)
def _(t: Tables):
    ranked = numbering.add_rank(cube.access_metric(t.fx_cube(), "journey_time"), "metric", "oa_id")
    return ranked.withColumn("metric", F.round("metric", 6))


@query("sort_by_value", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey")
def _(t: Tables):
    return numbering.sort_by_value(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", reverse=True)


@query("sort_output", "SELECT trip_id, oa_id, poi_id FROM fx_trips ORDER BY trip_id")
def _(t: Tables):
    return numbering.sort_by_value(t.fx_trips().select("trip_id", "oa_id", "poi_id"), "trip_id")


@query("page_scan", "SELECT trip_id, oa_id, poi_id FROM fx_trips ORDER BY trip_id LIMIT 250 OFFSET 500")
def _(t: Tables):
    return numbering.page(t.fx_trips().select("trip_id", "oa_id", "poi_id"), "trip_id", 250, 500)


@query(
    "page_scan_far",
    """SELECT trip_id, oa_id, poi_id FROM (SELECT *, row_number() OVER (ORDER BY trip_id) AS n, count(*) OVER () AS size FROM fx_trips)
       WHERE n > size - 300 AND n <= size - 50""",
)
def _(t: Tables):
    """A page at the end of the stored trips."""
    return t.paged_trips().page(250, t.orders.count() - 300).select("trip_id", "oa_id", "poi_id")
