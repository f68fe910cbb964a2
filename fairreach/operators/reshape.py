"""Wide to long."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_sum(cols: Sequence[str]) -> Column:
    """Sum of columns, a missing value counting as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in cols])


def populations(oa: DataFrame, groups: Mapping[str, Sequence[str]], key: str = "oa11") -> DataFrame:
    """``(oa_id, population, count)`` with one row per area and configured group."""
    wide = oa.select(F.col(key).alias("oa_id"), *[group_sum(cols).alias(name) for name, cols in groups.items()])
    return wide.unpivot(["oa_id"], list(groups), "population", "count")


def to_long(results: DataFrame, metrics: Mapping[str, str], keys: Sequence[str] = ("trip_id",)) -> DataFrame:
    """``(trip_id, metric, value)`` for each ``{metric: column}``, or with other ``keys`` than the trip; rows stay in their partition."""
    values = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(c).cast("double").alias("value")) for m, c in metrics.items()])
    return results.select(*keys, F.inline(values))


def zip_explode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Unnest parallel arrays side by side; shorter arrays are padded with NULL."""
    kept = [F.col(c) for c in df.columns if c not in cols]
    return df.select(*kept, F.inline(F.arrays_zip(*cols)))


def per_type_k(oa: DataFrame, k_by_type: Mapping[str, int | None], default_k: int = 3) -> DataFrame:
    """Each area once per destination type with its k; an empty or zero k means the default."""
    wanted = F.array(*[F.struct(F.lit(t).alias("poi_type"), F.lit(int(k or default_k)).alias("k")) for t, k in k_by_type.items()])
    return oa.select("*", F.inline(wanted))
