"""Keys that hold too many rows for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairreach.session import stored

#: Keys dealt to several tasks at most: where there would be more, a task takes more rows of a key.
MOST_SPLIT = 10_000


def crowded(rows: DataFrame, keys: Sequence[str], each: int) -> DataFrame | None:
    """``keys, _salts``: the tasks that each key with more than ``each`` rows needs, None if no key has.

    At most MOST_SPLIT rows, so they can be broadcast. Rows with a null key are not counted.
    """
    known = rows.select(*keys).dropna()
    many = stored(known.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > each), "crowded")
    total = many.agg(F.sum("_n")).first()[0]
    if not total:
        return None
    # fewer than MOST_SPLIT keys can each hold more than that share of all
    share = max(each, total // MOST_SPLIT)
    return many.where(F.col("_n") > share).select(*keys, F.ceil(F.col("_n") / share).cast("int").alias("_salts"))
