"""A table stored in the order of its key, with a directory of its files, so that a page reads the files it lies in."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fairreach.sources.versions import VersionedTable

#: Rows of a file, about.
FILE_ROWS = 200_000


class PagedTable:
    """Rows at ``path`` by a unique ``key``; the directory holds each file's first key and number of rows.

    Files are never changed: what changes rows writes the files it touches anew and publishes a directory that names them.
    """

    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.directory = VersionedTable(spark, f"{self.path}/directory")

    def _write(self, rows: DataFrame, files: int) -> DataFrame:
        """Store rows in the order of the key; returns the directory of their files."""
        folder = f"{self.path}/rows/{uuid.uuid4().hex}"
        rows.repartitionByRange(files, self.key).sortWithinPartitions(self.key).write.parquet(folder)
        at = F.col("_metadata.file_path").alias("file")
        return self.spark.read.parquet(folder).select(self.key, at).groupBy("file").agg(F.min(self.key).alias("first"), F.count("*").alias("rows"))

    def write(self, rows: DataFrame, file_rows: int = FILE_ROWS) -> None:
        """Replace the whole table."""
        self.directory.publish(self._write(rows, max(1, -(-rows.count() // file_rows))))

    def read(self) -> DataFrame:
        return self._files([r["file"] for r in self.directory.read().select("file").collect()])

    def _files(self, files: list[str]) -> DataFrame:
        if not files:
            raise ValueError("the table has no files")
        return self.spark.read.parquet(*files)

    def _touched(self, limit: int, offset: int) -> tuple[list[str], int]:
        """The files that hold rows ``offset + 1 .. offset + limit``, and the number of rows before them."""
        # one row a file
        before = F.coalesce(F.sum("rows").over(Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        placed = self.directory.read().withColumn("before", before)
        hit = placed.where((F.col("before") < offset + limit) & (F.col("before") + F.col("rows") > offset)).orderBy("before").collect()
        return [r["file"] for r in hit], hit[0]["before"] if hit else 0

    def page(self, limit: int, offset: int) -> DataFrame:
        """Rows ``offset + 1 .. offset + limit`` by the key, read from their own files."""
        files, before = self._touched(limit, offset)
        if not files:
            return self.read().limit(0)
        return self._files(files).orderBy(self.key).offset(offset - before).limit(limit)

    def update_page(self, limit: int, offset: int, **columns) -> None:
        """Set columns of the rows of one page; only the files it lies in are written again."""
        files, _ = self._touched(limit, offset)
        if not files:
            return
        page = self.page(limit, offset)
        low, high = page.agg(F.min(self.key), F.max(self.key)).first()
        rows = self._files(files)
        inside = F.col(self.key).between(low, high)
        changed = rows.withColumns({c: F.when(inside, v).otherwise(F.col(c)) for c, v in columns.items()})
        kept = self.directory.read().where(~F.col("file").isin(files))
        self.directory.publish(kept.unionByName(self._write(changed, len(files))))
