"""At-risk scores: cost per resident in the most populous half of the areas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairreach.operators.cube import access_metric, population_density
from fairreach.operators.numbering import top_half


def at_risk(
    cube: DataFrame,
    pop: DataFrame,
    groups: Sequence[str] = (),
    poi_types: Sequence[str] = (),
    strata: Sequence[str] = (),
) -> DataFrame:
    """``(oa_id, metric)`` for the floor(n/2)+1 areas with most residents.

    Areas whose chosen groups are empty are left out without a replacement.
    """
    busiest = top_half(pop).select("oa_id")
    density = population_density(pop, groups).withColumnRenamed("metric", "heads").where(F.col("heads") > 0)
    cost = access_metric(cube, "generalised_cost", poi_types, strata).withColumnRenamed("metric", "cost")
    return busiest.join(density, "oa_id").join(cost, "oa_id").select("oa_id", (F.col("cost") / F.col("heads")).alias("metric"))


def at_risk_topk(cube: DataFrame, pop: DataFrame, limit: int) -> DataFrame:
    """``(oa_id, at_risk_score)`` for the ``limit`` areas with the largest sum over all groups.

    Areas without trips keep a NULL score.
    """
    heads = population_density(pop).withColumnRenamed("metric", "heads")
    busiest = heads.orderBy(F.col("heads").desc(), "oa_id").limit(limit)
    cost = access_metric(cube).withColumnRenamed("metric", "cost")
    return (
        busiest.join(cost, "oa_id", "left")
        .select("oa_id", F.try_divide("cost", "heads").alias("at_risk_score"))
    )
