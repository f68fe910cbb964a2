"""Discrete medians, exact for groups of any size.

A group of a moderate number of values is sorted in its task and its middle is read off. A group
with more is narrowed down first: a round counts its values by bucket between the least and the greatest, on all
tasks, and keeps the bucket that holds the median. When few values are left between the bounds, or
all are equal, they are sorted like those of other groups. No task has more of a group than its part.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairreach.operators.spread import crowded
from fairreach.session import stored

ALL_TIMES = "All times"
#: Values of a group that one task sorts, unless more than MOST_LARGE groups can have more.
GROUP_VALUES = 100_000
MOST_LARGE = 10_000
#: Rows with the same keys that one task takes where those are fewer than the keys of a group.
PLACE_ROWS = 1_000_000
#: Buckets of a round.
BUCKETS = 1024
#: Hash values of the groups by which rows are counted first: where few rows share one, no group among them is large.
HASHES = 1 << 18


def _in_the_middle(keys: Sequence[str], value: str) -> Column:
    """Whether a row holds the lower middle of its group; place and size come from one sort."""
    ordered = Window.partitionBy(*keys).orderBy(F.col(value).asc_nulls_last())
    known = F.count(value).over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return F.row_number().over(ordered) == F.greatest(F.ceil(known / 2), F.lit(1))


def _lower_middle(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One shuffle by group, one sort by group and value."""
    return df.select(*keys, value, _in_the_middle(keys, value).alias("_hit")).where("_hit").select(*keys, value)


def _both_middles(rows: DataFrame, others: Sequence[str], stratum: str, value: str) -> DataFrame:
    """The lower middles per group and stratum, and those per group as ``All times``: two sorts of rows that have been shuffled by group."""
    own, overall = _in_the_middle([*others, stratum], value), _in_the_middle(others, value)
    placed = rows.select(*others, stratum, value, own.alias("_own"), overall.alias("_overall"))
    label = lambda c: F.struct(c.cast("string").alias(stratum))
    labels = F.array(F.when(F.col("_own"), label(F.col(stratum))), F.when(F.col("_overall"), label(F.lit(ALL_TIMES))))
    hits = placed.where("_own or _overall").select(*others, value, F.inline(F.array_compact(labels)))
    return hits.select(*others, stratum, value)


def _same(keys: Sequence[str], other: str = "_") -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{other}{k}")) for k in keys], F.lit(True))


def _large_groups(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame | None:
    """``_keys.., _lo, _hi, _left, _rank``: bounds and number of the values of each large group, and the place of its median; None without any."""
    # counted by hash, the rows are not shuffled; those of groups that share no full hash value need no count of their own
    hashed = rows.withColumn("_hash", F.pmod(F.xxhash64(*keys), F.lit(HASHES)))
    full = stored(hashed.groupBy("_hash").agg(F.count(value).alias("_n")).where(F.col("_n") > GROUP_VALUES), "full-hashes")
    if full.isEmpty():
        return None
    rows = hashed.join(F.broadcast(full.select("_hash")), "_hash")
    sizes = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.count(value).alias("_left")
    )
    large = stored(sizes.where(F.col("_left") > GROUP_VALUES), "large-groups")
    total = large.agg(F.sum("_left")).first()[0]
    if not total:
        return None
    # fewer than MOST_LARGE groups can each have more than that share, so the list can be broadcast
    large = large.where(F.col("_left") > max(GROUP_VALUES, total // MOST_LARGE))
    return large.withColumn("_rank", F.ceil(F.col("_left") / 2))


def _narrowed(rows: DataFrame, groups: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One round: the bounds of the bucket that holds the value at the rank, the values in it, and the rank among them."""
    names = [f"_{k}" for k in keys]
    lo, hi, v = F.col("_lo").cast("double"), F.col("_hi").cast("double"), F.col(value).cast("double")
    part = F.coalesce(F.try_divide(v / 2 - lo / 2, hi / 2 - lo / 2), F.lit(0.0))
    bucket = F.least(F.floor(part * BUCKETS), F.lit(BUCKETS - 1)).alias("_bucket")
    inside = F.col(value).between(F.col("_lo"), F.col("_hi"))
    counted = (
        rows.join(F.broadcast(groups), _same(keys))
        .where(inside)
        .groupBy(*names, "_rank", bucket)
        .agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.count("*").alias("_left"))
    )
    before = F.coalesce(F.sum("_left").over(Window.partitionBy(*names).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = counted.withColumn("_before", before)
    hit = placed.where((F.col("_before") < F.col("_rank")) & (F.col("_rank") <= F.col("_before") + F.col("_left")))
    return hit.select(*names, "_lo", "_hi", "_left", (F.col("_rank") - F.col("_before")).alias("_rank"))


def _at_rank(rows: DataFrame, groups: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The value at each group's rank, among its few values between the bounds."""
    names = [f"_{k}" for k in keys]
    inside = rows.join(F.broadcast(groups), _same(keys)).where(F.col(value).between(F.col("_lo"), F.col("_hi")))
    counted = inside.groupBy(*names, "_rank", value).agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*names).orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    placed = counted.withColumn("_upto", upto)
    chosen = placed.where((F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_n") < F.col("_rank")))
    return chosen.select(*[F.col(f"_{k}").alias(k) for k in keys], value)


def _medians(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Of a stored table; see :func:`median_by`."""
    groups = _large_groups(rows, keys, value)
    if groups is None:
        return _lower_middle(rows, keys, value)
    small = rows.join(F.broadcast(groups.select(*[f"_{k}" for k in keys])), _same(keys), "left_anti")
    return _lower_middle(small, keys, value).unionByName(_large_medians(rows, groups, keys, value))


def _large_medians(rows: DataFrame, groups: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Of the large ``groups`` alone."""
    out = []
    groups = stored(groups, "bounds")
    while True:
        done = (F.col("_left") <= GROUP_VALUES) | (F.col("_lo") == F.col("_hi"))
        out.append(_at_rank(rows, groups.where(done), keys, value))
        if groups.where(~done).isEmpty():
            return reduce(DataFrame.unionByName, out)
        # the least and the greatest value are in buckets of their own, so every round leaves less
        groups = stored(_narrowed(rows, groups.where(~done), keys, value), "bounds")


def median_by(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The lower of the two middle values per group, NULLs ignored; NULL where a group has no other. Values are finite."""
    return _medians(stored(df.select(*keys, value), "values"), keys, value)


def median_with_all(
    df: DataFrame,
    keys: Sequence[str],
    stratum: str,
    value: str,
    unfold: Callable[[DataFrame], DataFrame] | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Medians per stratum plus the median over all rows, labelled ``All times``.

    With ``unfold``, each row of ``df`` stands for several, which that makes of it where they are sorted: they are neither
    stored nor shuffled, and making them shuffles nothing. ``by``, some of the keys that rows have before, then names what they are
    shuffled by; the medians stay where that puts them, unless more than PLACE_ROWS rows share these keys.
    """
    others = [k for k in keys if k != stratum]
    if unfold is None:
        unfold, by, df = (lambda rows: rows), others, df.select(*others, stratum, value)
    rows = stored(df, "values")
    groups = _large_groups(unfold(rows), others, value)
    many = crowded(rows, by, PLACE_ROWS) if list(by) != others else None
    if groups is None and many is None:
        return _both_middles(unfold(rows.repartition(*by)), others, stratum, value)
    full = [] if groups is None else [groups.select(*[f"_{k}" for k in by])]
    full += [] if many is None else [many.select(*[F.col(k).alias(f"_{k}") for k in by])]
    hot = F.broadcast(reduce(DataFrame.unionByName, full).distinct())
    out = _both_middles(unfold(rows.join(hot, _same(by), "left_anti").repartition(*by)), others, stratum, value)
    # rows of crowded keys, or that stand for one of a large group beside others, are shuffled by their own group
    rows = rest = unfold(rows.join(hot, _same(by), "left_semi"))
    if groups is not None:
        listed = F.broadcast(groups.select(*[f"_{k}" for k in others]))
        rest = rows.join(listed, _same(others), "left_anti")
        # a large group in a stratum is part of one over all strata
        large = rows.join(listed, _same(others), "left_semi")
        out = out.unionByName(_large_medians(rows, groups, others, value).withColumn(stratum, F.lit(ALL_TIMES)))
        out = out.unionByName(_medians(large, [*others, stratum], value))
    return out if list(by) == others else out.unionByName(_both_middles(rest.repartition(*others), others, stratum, value))


def best_poi(medians: DataFrame, keys: Sequence[str] = ("oa_id", "poi_type", "stratum", "metric")) -> DataFrame:
    """The smallest median over the destinations of an area."""
    return medians.groupBy(*keys).agg(F.min("value").alias("value"))


def scale_metrics(df: DataFrame, metrics: Sequence[str], divisor: float = 60) -> DataFrame:
    """Divide ``value`` by ``divisor`` for the named metrics (seconds to minutes)."""
    scaled = F.when(F.col("metric").isin(list(metrics)), F.col("value") / F.lit(divisor)).otherwise(F.col("value"))
    return df.withColumn("value", scaled)
