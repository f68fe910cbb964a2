"""Trip cost and fare."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Weights of the generalised cost and the flat fare
TIME_WEIGHT = 1.5
TRANSIT_WEIGHT = 0.5
VALUE_OF_TIME = 6.7
TRANSFER_PENALTY = 10
WAIT_OFFSET_SECONDS = 3600
FLAT_FARE = 2.40


def cost_minutes(with_wait: bool = True) -> Column:
    """Generalised cost in minutes from the trip result columns.

    ``with_wait=False`` leaves out the corrected initial wait, as the ad-hoc query does.
    """
    spent = F.col("total_time")
    if with_wait:
        spent = spent + (F.col("initial_wait_time") - F.lit(WAIT_OFFSET_SECONDS))
    fare_time = F.col("fare").cast("double") * F.lit(3600) / F.lit(VALUE_OF_TIME)
    return (
        F.lit(TIME_WEIGHT) * spent
        - F.lit(TRANSIT_WEIGHT) * F.col("transit_time")
        + fare_time
        + F.lit(TRANSFER_PENALTY) * F.col("num_transfers")
    ) / F.lit(60)


def generalised_cost(df: DataFrame, with_wait: bool = True) -> DataFrame:
    return df.withColumn("generalised_cost", cost_minutes(with_wait))


def flat_fare(transfers: Column, walk: Column, total: Column) -> Column:
    """Free when the whole trip is walked, else one flat fare per vehicle boarded."""
    return F.when(walk == total, F.lit(0.0)).otherwise(F.lit(FLAT_FARE) * (transfers + 1))


def fare(transfers: Column, walk: Column, total: Column, cents: Column | None = None) -> Column:
    """The quoted fare when there is one, else the flat rule."""
    rule = flat_fare(transfers, walk, total)
    return rule if cents is None else F.coalesce(cents / F.lit(100), rule)
