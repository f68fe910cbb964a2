"""Delimited files and tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairreach.sources.versions import VersionedTable


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: str | T.StructType,
    header: bool = True,
    sep: str = ",",
    encoding: str = "ISO-8859-1",
) -> DataFrame:
    """Delimited text under a fixed schema, columns by position; one bad row fails the load."""
    reader = spark.read.schema(schema).option("header", header).option("sep", sep).option("encoding", encoding)
    return reader.option("mode", "FAILFAST").option("enforceSchema", True).option("escape", '"').csv(path)


def load_manifest(
    spark: SparkSession, root: str, files: Mapping[str, str], schemas: Mapping[str, str | T.StructType] | None = None
) -> dict[str, DataFrame]:
    """Read every ``{file: table}`` below ``root`` and register it as a view.

    Tables without a schema take their column names from the header, all as text.
    """
    schemas = schemas or {}
    out = {}
    for file, table in files.items():
        path = f"{root.rstrip('/')}/{file}"
        if table in schemas:
            df = read_delimited(spark, path, schemas[table])
        else:
            df = spark.read.option("header", True).option("encoding", "ISO-8859-1").option("escape", '"').csv(path)
        df.createOrReplaceTempView(table)
        out[table] = df
    return out


def append_files(spark: SparkSession, paths: Sequence[str], schema: str | T.StructType) -> DataFrame:
    """All rows of several files as one table."""
    return read_delimited(spark, list(paths), schema)


def take_in(spark: SparkSession, folder: str, schema: str | T.StructType, table: str, state: str, header: bool = True) -> DataFrame:
    """Add the delimited files of ``folder`` that have not been taken in yet to the table at ``table``, each exactly once.

    A file stream that ends when it has read what there is. ``state`` keeps which files have been read; a run that is stopped is
    finished by the next one, and rows of a half-written batch are not seen by readers. Returns the whole table.
    """
    files = spark.readStream.schema(schema).option("header", header).option("encoding", "ISO-8859-1").option("escape", '"')
    arrived = files.option("mode", "FAILFAST").option("enforceSchema", True).csv(folder)
    batch = arrived.writeStream.format("parquet").option("checkpointLocation", state).option("path", table)
    batch.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(table)


def export_csv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.mode("overwrite").option("header", header).csv(path)


def write_table(df: DataFrame, name: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).saveAsTable(name)


def refresh_summary(df: DataFrame, path: str) -> int:
    """Replace the versioned table at ``path`` and return the number of rows written; until then the old one is read."""
    return VersionedTable(df.sparkSession, path).publish(df)


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    return VersionedTable(spark, path).read()


def count_rows(df: DataFrame) -> DataFrame:
    """One row ``n``; the header of a file is not counted."""
    return df.agg(F.count("*").alias("n"))
