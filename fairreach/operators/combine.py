"""Joins. Which side is small enough to broadcast is decided from its statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Coordinates of the ends of a pair or trip.
END_COLUMNS = ["oa_lat", "oa_lon", "poi_lat", "poi_lon"]


def lookup(a: DataFrame, b: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return a.join(b, on, "inner")


def in_scope(df: DataFrame, scope: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in ``scope``; repeats in the scope multiply nothing."""
    return df.join(scope.select(key), key, "left_semi")


def geocode(pois: DataFrame, centroids: DataFrame, key: str) -> DataFrame:
    """Destinations with the coordinates of their postcode, NULL where it is unknown."""
    return pois.join(centroids, key, "left")


def entity(frames: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full join of tables that are each unique on ``keys``, in one shuffle; a key twice in one table raises.

    A chain of full joins shuffles at every step. Stacking the tables and taking the one value per
    key and column gives the same rows. NULL keys match nothing in a join, so rows with one are
    passed through unmerged.
    """
    # one bit a table: a long holds 63
    if len(frames) > 63:
        raise ValueError("more than 63 tables")
    tagged = [df.withColumn("_table", F.lit(1 << number).cast("bigint")) for number, df in enumerate(frames.values())]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    values = [c for c in stacked.columns if c not in (*keys, "_table")]
    # a unique key has as many rows as tables: both are counted in the aggregate that merges
    rows, tables = F.count("*").alias("_rows"), F.bit_count(F.bit_or("_table")).alias("_tables")
    merged = stacked.where(complete).groupBy(*keys).agg(*[F.first(c, ignorenulls=True).alias(c) for c in values], rows, tables)
    message = F.concat(F.lit(f"key {list(keys)} is repeated in one of {list(frames)}: "), F.to_json(F.struct(*keys)))
    unique = F.when(F.col("_rows") > F.col("_tables"), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    merged = merged.where(unique).drop("_rows", "_tables")
    return merged.unionByName(stacked.where(~complete).select(*merged.columns))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; empty when ``keys`` is a primary key."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def require_unique(df: DataFrame, keys: Sequence[str], name: str) -> None:
    """Raise if a key of the table ``name`` occurs more than once, showing some of them."""
    repeated = duplicate_keys(df, keys).select(*keys).take(5)
    if repeated:
        raise ValueError(f"{name} has repeated keys {list(keys)}: {[tuple(r) for r in repeated]}")


def missing_keys(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Distinct child keys without a parent; empty when the reference holds."""
    known = parent.select(F.col(parent_key or key).alias(key))
    return child.select(key).where(F.col(key).isNotNull()).distinct().join(known, key, "left_anti")


def require_known(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> None:
    """Raise if a key of ``child`` is not among those of ``parent``, showing some of them."""
    missing = missing_keys(child, parent, key, parent_key).take(5)
    if missing:
        raise ValueError(f"{key} has values without {parent_key}: {[r[key] for r in missing]}")


def with_ends(df: DataFrame, oa: DataFrame, poi: DataFrame) -> DataFrame:
    """Rows that name an area and a destination, with the coordinates of both; those with an unknown end are left out."""
    start = oa.select("oa_id", F.col("lat").alias("oa_lat"), F.col("lon").alias("oa_lon"))
    end = poi.select("poi_id", F.col("lat").alias("poi_lat"), F.col("lon").alias("poi_lon"))
    return df.join(start, "oa_id").join(end, "poi_id")


def otp_trips(trips: DataFrame, oa: DataFrame, poi: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Trips not costed yet, with the coordinates of both ends; ``carry`` names further columns of ``trips``.

    Trips that bring these coordinates with them, as those made of pairs :func:`with_ends`, are not joined again.
    """
    waiting = trips.where(F.col("computed") == 0)
    located = waiting if set(END_COLUMNS) <= set(trips.columns) else with_ends(waiting, oa, poi)
    return located.select("oa_id", "poi_id", "date", "time", "trip_id", *END_COLUMNS, *carry)


def full_results(long: DataFrame, trips: DataFrame, timestamps: DataFrame, k_poi: DataFrame) -> DataFrame:
    """Long or wide results with area, destination, type and stratum; a time in two strata counts in both."""
    # the trips are joined with their small tables first, so the results are shuffled once
    labelled = (
        trips.select("trip_id", "oa_id", "poi_id", "date", "time")
        .join(timestamps.select("date", "time", "stratum"), ["date", "time"])
        .join(k_poi.select("oa_id", "poi_id", "poi_type"), ["oa_id", "poi_id"])
    )
    return long.join(labelled, "trip_id").select(*long.columns, "oa_id", "poi_id", "poi_type", "stratum")
