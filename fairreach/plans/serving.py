"""The served queries, one function each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairreach.functions.text import kv_pairs, strip_common_prefix
from fairreach.operators.clean import distinct_values, groups
from fairreach.operators.combine import full_results
from fairreach.operators.cube import (
    DIMENSIONS,
    access_metric,
    demographic_level,
    high_level,
    merge_moments,
    metric_names,
    population_density,
    summary_cube,
)
from fairreach.operators.medians import best_poi, median_with_all, scale_metrics
from fairreach.operators.numbering import add_rank
from fairreach.operators.reshape import to_long
from fairreach.operators.risk import at_risk
from fairreach.sources.spatial import read_features
from fairreach.sources.versions import VersionedTable


def as_json(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(F.to_json(F.struct(*cols)).alias("json"))


def meta_access_metrics(cube: DataFrame) -> DataFrame:
    """Names of the metrics the cube holds, read off its columns."""
    names = cube.sparkSession.createDataFrame([(n,) for n in metric_names(cube)], "name string")
    return kv_pairs(strip_common_prefix(names, "name"), "name")


def meta_strata(cube: DataFrame) -> DataFrame:
    return kv_pairs(distinct_values(cube, "stratum"), "stratum")


def meta_poi_types(poi: DataFrame) -> DataFrame:
    return kv_pairs(distinct_values(poi, "type"), "type")


def meta_demographics(pop: DataFrame) -> DataFrame:
    return kv_pairs(distinct_values(groups(pop), "population"), "population")


def output_areas(spark: SparkSession, path: str) -> DataFrame:
    return read_features(spark, path)


def population_metrics(
    cube: DataFrame,
    pop: DataFrame,
    metric: str = "population_density",
    demographics: Sequence[str] = (),
    poi_types: Sequence[str] = (),
    strata: Sequence[str] = (),
) -> DataFrame:
    """``(oa_id, metric, rank)`` of head counts or at-risk scores."""
    if metric == "population_density":
        values = population_density(pop, demographics)
    elif metric == "at-risk_score":
        values = at_risk(cube, pop, demographics, poi_types, strata)
    else:
        raise ValueError("Not found")
    return add_rank(values, "metric", "oa_id")


def accessibility_metrics(
    cube: DataFrame,
    pop: DataFrame,
    metric: str = "generalised_cost",
    poi_types: Sequence[str] = (),
    strata: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """High-level figures, ranked areas and population groups over one selection of the cube."""
    areas = add_rank(access_metric(cube, metric, poi_types, strata), "metric", "oa_id")
    return (
        high_level(cube, metric, poi_types, strata),
        areas,
        demographic_level(cube, pop, metric, poi_types, strata),
    )


def results_summary(results: DataFrame, trips: DataFrame, poi: DataFrame, strata: DataFrame) -> DataFrame:
    return summary_cube(results, trips, poi, strata)


class CubeStore:
    """The summary cube stored at ``path``: rebuilt as a whole or extended by new results, and read by the served queries.

    The other functions of this module take the cube that :meth:`read` gives: one small scan a query instead of the joins.
    A version is published when it is complete; what fails before that leaves the old one.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.table = VersionedTable(spark, path)

    def read(self) -> DataFrame:
        return self.table.read()

    def refresh(self, results: DataFrame, trips: DataFrame, poi: DataFrame, strata: DataFrame) -> int:
        """Replace the cube by that of the given tables; returns its number of cells."""
        return self.table.publish(summary_cube(results, trips, poi, strata))

    def add(self, results: DataFrame, trips: DataFrame, poi: DataFrame, strata: DataFrame, label: str) -> int:
        """Add the moments of results that are not in the cube yet; returns its number of cells.

        ``label`` names the increment (the number of a costing run, say). One that has been added since the last refresh is not
        added again, so that a stopped job can be repeated.
        """
        new = summary_cube(results, trips, poi, strata)
        if not self.table.version():
            return self.table.publish(new, label)
        if label in self.table.labels():
            return self.table.read().count()
        return self.table.publish(merge_moments(self.table.read().unionByName(new), DIMENSIONS), label)


def map_from_results(
    results: DataFrame,
    trips: DataFrame,
    timestamps: DataFrame,
    k_poi: DataFrame,
    metrics: Mapping[str, str],
    in_seconds: Sequence[str] = (),
    centroids: DataFrame | None = None,
) -> DataFrame:
    """Map attributes from the wide results on; a time that is in two strata counts in both.

    ``centroids`` (oa_id and further columns) are carried into the result where given.
    """
    # one row a result is stored and shuffled, with all strata of its time; strata and metrics get rows of their own where these are sorted
    times = timestamps.groupBy("date", "time").agg(F.collect_list(F.struct("stratum")).alias("stratum"))
    wide = full_results(results.select("trip_id", *dict.fromkeys(metrics.values())), trips, times, k_poi).drop("trip_id")
    keys = ["oa_id", "poi_id", "poi_type", "stratum"]

    def unfold(rows: DataFrame) -> DataFrame:
        by_stratum = rows.withColumnRenamed("stratum", "_strata").select("*", F.inline("_strata")).drop("_strata")
        return to_long(by_stratum, metrics, keys)

    # what the best destination is chosen from lies together already
    medians = median_with_all(wide, [*keys, "metric"], "stratum", "value", unfold, ["oa_id", "poi_type"])
    best = _map_values(medians, in_seconds)
    # a centroid follows from its area, so it joins the few rows at the end
    return best if centroids is None else best.join(centroids, "oa_id")


def _map_values(medians: DataFrame, in_seconds: Sequence[str], area_cols: Sequence[str] = ("oa_id",)) -> DataFrame:
    return scale_metrics(best_poi(medians, [*area_cols, "poi_type", "stratum", "metric"]), in_seconds)


def map_attributes(full: DataFrame, in_seconds: Sequence[str] = (), area_cols: Sequence[str] = ("oa_id",)) -> DataFrame:
    """Per area, type, stratum and metric the best destination's median, seconds as minutes.

    ``full`` holds one row per trip and metric as given by ``full_results``. Further area columns,
    such as the centroid, can be carried along.
    """
    keys = [*area_cols, "poi_id", "poi_type", "stratum", "metric"]
    return _map_values(median_with_all(full, keys, "stratum", "value"), in_seconds, area_cols)
