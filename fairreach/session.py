"""Where checkpoints and intermediate tables live."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Rows of a stored table that a join may broadcast.
BROADCAST_ROWS = 50_000


def checkpoint_root(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only for local sessions without it.

    A cluster names a folder every executor can reach in ``spark.checkpoint.dir``. A machine-local
    folder would be lost with its machine, so on a cluster a missing setting is an error.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="fairreach-checkpoints-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for an intermediate table in the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"


def by_rows(df: DataFrame, rows: int) -> DataFrame:
    """``df`` of so many rows, joined by shuffle where they are many, unless a join broadcasts it by name.

    Spark goes by the size of the files. Repeated values fill next to none, so a small file may hold more rows than the driver can.
    """
    return df.hint("merge") if rows > BROADCAST_ROWS else df


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table that several later steps use to the shared folder and read it back, see :func:`by_rows`."""
    path = scratch_path(df.sparkSession, label)
    counted = Observation()
    df.observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return by_rows(df.sparkSession.read.parquet(path), counted.get["rows"])
