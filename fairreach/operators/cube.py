"""The summary cube and the metrics recombined from it.

The cube holds n, sum and sum of squares per (area, destination type, stratum). They add up, so
any filter on type or stratum is answered from the cube alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairreach.functions.cost import cost_minutes

# Metric name -> trip result column
METRICS = {
    "journey_time": "total_time",
    "walking_distance": "walk_dist",
    "fare": "fare",
    "generalised_cost": "generalised_cost",
}
DIMENSIONS = ["oa_id", "poi_type", "stratum"]


def label_results(results: DataFrame, trips: DataFrame, poi: DataFrame, strata: DataFrame) -> DataFrame:
    """Results with area, destination type and stratum; unmatched rows keep NULL dimensions.

    Trips and strata share ``trip_id``, so all three inputs meet on one hash partitioning. Which
    dimension is small enough to broadcast is left to its statistics.
    """
    return (
        results.join(trips.select("trip_id", "oa_id", "poi_id"), "trip_id", "left")
        .join(strata.select("trip_id", "stratum"), "trip_id", "left")
        .join(poi.select("poi_id", F.col("type").alias("poi_type")), "poi_id", "left")
    )


def _moments() -> list[Column]:
    out = [F.count("*").alias("num_trips")]
    for metric, col in METRICS.items():
        x = F.col(col).cast("double")
        out += [F.sum(x).alias(f"sum_{metric}"), F.sum(x * x).alias(f"sum_of_squared_{metric}")]
    return out


def moment_columns() -> list[str]:
    return [f"{kind}_{metric}" for metric in METRICS for kind in ("sum", "sum_of_squared")]


def merge_moments(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add up n, sums and sums of squares of cells that fall together under ``keys``."""
    sums = [F.sum(c).alias(c) for c in ["num_trips", *moment_columns()]]
    return cells.groupBy(*keys).agg(*sums)


def summary_cube(results: DataFrame, trips: DataFrame, poi: DataFrame, strata: DataFrame) -> DataFrame:
    """n, sum and sum of squares per (area, destination type, stratum).

    Moments are first taken per destination, before the join to the destination table: one
    destination receiving a third of all trips then meets that join as a few rows per area.
    """
    fields = ["trip_id", "total_time", "initial_wait_time", "transit_time", "walk_dist", "num_transfers", "fare"]
    costed = results.select(*fields).withColumn("generalised_cost", cost_minutes())
    located = costed.join(trips.select("trip_id", "oa_id", "poi_id"), "trip_id", "left").join(
        strata.select("trip_id", "stratum"), "trip_id", "left"
    )
    per_poi = located.groupBy("oa_id", "poi_id", "stratum").agg(*_moments())
    typed = per_poi.join(poi.select("poi_id", F.col("type").alias("poi_type")), "poi_id", "left")
    return merge_moments(typed, DIMENSIONS)


def filter_cube(df: DataFrame, poi_types: Sequence[str] = (), strata: Sequence[str] = ()) -> DataFrame:
    """Keep the given destination types and strata; an empty list keeps all."""
    if poi_types:
        df = df.where(F.col("poi_type").isin(list(poi_types)))
    if strata:
        df = df.where(F.col("stratum").isin(list(strata)))
    return df


def _known(metric: str) -> str:
    if metric not in METRICS:
        raise ValueError("Not found")
    return metric


def access_metric(
    cube: DataFrame, metric: str = "generalised_cost", poi_types: Sequence[str] = (), strata: Sequence[str] = ()
) -> DataFrame:
    """Trip-weighted mean of ``metric`` per area."""
    total = f"sum_{_known(metric)}"
    mean = F.try_divide(F.sum(total), F.sum("num_trips"))
    return filter_cube(cube, poi_types, strata).groupBy("oa_id").agg(mean.alias("metric"))


def high_level(
    cube: DataFrame, metric: str = "generalised_cost", poi_types: Sequence[str] = (), strata: Sequence[str] = ()
) -> DataFrame:
    """One row: mean, deviation (published under the name variance) and Jain's fairness index."""
    _known(metric)
    sums = filter_cube(cube, poi_types, strata).agg(
        F.sum("num_trips").alias("n"),
        F.sum(f"sum_{metric}").alias("s"),
        F.sum(f"sum_of_squared_{metric}").alias("q"),
    )
    n, s, q = F.col("n"), F.col("s"), F.col("q")
    mean = F.try_divide(s, n)
    spread = F.try_divide(q - 2 * mean * s + n * mean * mean, n - 1)
    return sums.select(
        F.round(mean, 2).alias("mean"),
        F.round(F.sqrt(spread), 2).alias("variance"),
        F.round(F.try_divide(s * s, n * q), 3).alias("jains_index"),
    )


def with_population(stats: DataFrame, pop: DataFrame) -> DataFrame:
    """Area statistics with one row per population group; areas without groups keep NULLs."""
    return stats.join(pop, "oa_id", "left")


def demographic_level(
    cube: DataFrame,
    pop: DataFrame,
    metric: str = "generalised_cost",
    poi_types: Sequence[str] = (),
    strata: Sequence[str] = (),
) -> DataFrame:
    """Head-count weighted mean per group (``wass``) and its distance from the total (``arm``)."""
    stats = access_metric(cube, metric, poi_types, strata)
    weighted = (
        with_population(stats, pop)
        .where(F.col("population").isNotNull())
        .groupBy("population")
        .agg((F.try_divide(F.sum(F.col("metric") * F.col("count")), F.sum("count"))).alias("wass"))
        .withColumn("wass", F.round("wass", 2))
    )
    # one row per group is left, so the window holds a handful of rows, and cube and groups are read once
    overall = F.max(F.when(F.col("population") == "total", F.col("wass"))).over(Window.partitionBy())
    weighted = weighted.withColumn("_total", overall)
    return weighted.where(F.col("population") != "total").select(
        "population", "wass", F.round(F.col("wass") - F.col("_total"), 2).alias("arm")
    )


def population_density(pop: DataFrame, demographics: Sequence[str] = ()) -> DataFrame:
    """Head count per area over the given groups. Without groups all are added, total included."""
    if demographics:
        pop = pop.where(F.col("population").isin(list(demographics)))
    return pop.groupBy("oa_id").agg(F.sum("count").alias("metric"))


def access_score(results: DataFrame) -> DataFrame:
    """Sum and mean of the cost without waiting per (area, destination type)."""
    costed = results.withColumn("generalised_cost", cost_minutes(with_wait=False))
    return costed.groupBy("oa_id", "poi_type").agg(
        F.sum("generalised_cost").alias("total_cost"), F.avg("generalised_cost").alias("mean_cost")
    )


def metric_names(cube: DataFrame) -> list[str]:
    """The ``sum_`` columns of the cube, without the sums of squares."""
    return [c for c in cube.columns if c.startswith("sum_") and not c.startswith("sum_of_squared_")]
