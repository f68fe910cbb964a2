"""Consecutive numbering in a global order without putting all rows in one task.

``row_number()`` over an unpartitioned window moves the whole table to one task. Here rows are
range-partitioned on the full order (so a value shared by a third of the rows still spreads when
the order ends in a unique key), sorted inside each partition and written to a checkpoint together
with their place in the partition. The only cross-partition step adds up one row count per
partition. The checkpoint fixes the placement: counts and rows are read from the same files, so a
lost executor cannot shift the numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairreach.session import checkpoint_root

# monotonically_increasing_id keeps the partition above bit 33 and the row index below it
_ROW_BITS = 33


def number_rows(df: DataFrame, order: list[str | Column], name: str = "row_no") -> DataFrame:
    """Add ``name`` = 1..N following ``order``, which must end in a unique key."""
    spark = df.sparkSession
    checkpoint_root(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("_part", F.shiftright("_slot", _ROW_BITS))
    )
    # one row per partition, so the unpartitioned window below sees at most `parts` rows
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    in_part = F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + in_part + 1)
        .drop("_part", "_slot", "_before")
    )


def page(df: DataFrame, key: str, limit: int, offset: int) -> DataFrame:
    """Rows ``offset+1 .. offset+limit`` by ``key``.

    A short page near the start is a top-k. A far or long page would make the top-k keep
    ``offset+limit`` rows in one task, so it is cut out of the numbered table instead.
    """
    if limit + offset <= 10_000:
        return df.orderBy(key).offset(offset).limit(limit)
    return number_rows(df, [key], "_at").where(F.col("_at").between(offset + 1, offset + limit)).drop("_at")


def add_rank(df: DataFrame, value: str, key: str) -> DataFrame:
    """``(key, metric, rank)``: rank 1 is the smallest value, equal values ranked by key."""
    rows = df.select(key, F.col(value).alias("metric"))
    return number_rows(rows, ["metric", key], "rank").select(key, "metric", "rank")


def sort_by_value(df: DataFrame, col: str, reverse: bool = False) -> DataFrame:
    """Order by ``col``, then by the remaining columns so that the order is total."""
    first = F.col(col).desc() if reverse else F.col(col).asc()
    return df.orderBy(first, *[c for c in df.columns if c != col])


def top_half(pop: DataFrame, group: str = "total") -> DataFrame:
    """The floor(n/2)+1 areas with the largest ``count`` of ``group``, in that order."""
    areas = pop.where(F.col("population") == group).select("oa_id", "count")
    numbered = number_rows(areas, [F.col("count").desc(), F.col("oa_id")], "place")
    size = numbered.agg(F.count("*")).scalar()
    return numbered.where(F.col("place") <= F.floor(size / 2) + 1)


def mark_computed(trips: DataFrame, limit: int, offset: int) -> DataFrame:
    """Set ``computed`` to 1 on the rows of one page by ``trip_id``; other rows keep theirs."""
    numbered = number_rows(trips, ["trip_id"], "_at")
    in_page = F.col("_at").between(offset + 1, offset + limit)
    flag = F.when(in_page, F.lit(1)).otherwise(F.col("computed"))
    return numbered.withColumn("computed", flag).drop("_at")
