"""Typing, selecting and correcting raw tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# a longer list of ids would bloat the plan as a literal
_LONG_LIST = 1000


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast in place; text that is no number raises, as a typed load would."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def rename_theme(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def keep_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols)


def authorities_in(df: DataFrame, county: str, county_col: str = "cty16nm") -> DataFrame:
    return df.where(F.col(county_col) == F.lit(county))


def require(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNotNull())


def select_areas(df: DataFrame, ids: Iterable = (), key: str = "oa_id") -> DataFrame:
    """The listed areas; an empty list selects all. Long lists become a table to join with."""
    ids = list(ids)
    if len(ids) <= _LONG_LIST:
        return df.where(F.col(key).isin(ids)) if ids else df
    listed = df.sparkSession.createDataFrame([(i,) for i in ids], T.StructType([T.StructField(key, df.schema[key].dataType)]))
    return df.join(listed, key, "left_semi")


def select_pois(df: DataFrame, types: Iterable[str], col: str = "type") -> DataFrame:
    """Destinations of the listed types; an empty list selects none."""
    types = list(types)
    return df.where(F.col(col).isin(types)) if types else df.where(F.lit(False))


def pending(trips: DataFrame) -> DataFrame:
    return trips.where(F.col("computed") == 0)


def groups(pop: DataFrame) -> DataFrame:
    """Population rows other than the total; rows without a group drop out too."""
    return pop.where(F.col("population") != "total")


def with_label(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def apply_overrides(df: DataFrame, overrides: DataFrame, key: str, cols: Sequence[str], seq: str = "seq") -> DataFrame:
    """Replace ``cols`` where ``key`` has a correction; of several corrections the last counts."""
    last = overrides.groupBy(key).agg(*[F.max_by(F.col(c), F.col(seq)).alias(f"_{c}") for c in cols])
    fixed = {c: F.coalesce(F.col(f"_{c}"), F.col(c)) for c in cols}
    return df.join(last, key, "left").withColumns(fixed).drop(*[f"_{c}" for c in cols])


def valid_trips(df: DataFrame) -> DataFrame:
    """Trips with every field filled."""
    return df.dropna("any")


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first by ``order``.

    An aggregate, not a window: each task keeps one candidate per key before the shuffle, so a key
    holding a third of the rows costs no more than the others.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[(F.col(o) if isinstance(o, str) else o).alias(f"_{i}") for i, o in enumerate(order)])
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)


def dedupe(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct values of ``keys``."""
    return df.select(*keys).distinct()


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def union_layers(layers: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), layers)


def loss_report(df: DataFrame, ok: str = "ok") -> DataFrame:
    """One row: trips, failed trips and the percentage lost, rounded to 2 places."""
    bad = F.coalesce(F.sum(F.when(F.col(ok), 0).otherwise(1)), F.lit(0))
    return df.agg(F.count("*").alias("n"), bad.alias("bad")).withColumn(
        "pct", F.round(F.try_divide(F.col("bad"), F.col("n")) * 100, 2)
    )
