"""Tables that are replaced as a whole without a moment in which they cannot be read."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fairreach.sources import folders


class VersionedTable:
    """A table at ``path`` whose every version is a folder of its own.

    ``publish`` writes a new folder and then makes a marker named after it; readers take the newest marker. A write that fails or is
    stopped leaves no marker, so the version before stays the one that is read, as it does for whoever
    has begun to read it. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _markers(self) -> list[str]:
        return folders.names(self.spark, f"{self.path}/versions")

    def version(self) -> int:
        """Number of the newest version, 0 before the first."""
        markers = self._markers()
        return int(markers[-1].split("-")[0]) if markers else 0

    def read(self) -> DataFrame:
        """The newest version."""
        markers = self._markers()
        if not markers:
            raise ValueError(f"nothing has been published at {self.path}")
        return self.spark.read.parquet(f"{self.path}/data/{markers[-1]}")

    def labels(self) -> list[str]:
        """The labels of the newest version and of those before it, back to the last one that was published without."""
        out = []
        for marker in reversed(self._markers()):
            label = marker.split("-", 2)[2]
            if not label:
                break
            out.append(label)
        return out

    def publish(self, df: DataFrame, label: str = "") -> int:
        """Make the rows of ``df``, which may come from the version before, the newest version; returns their number."""
        if not re.fullmatch(r"[\w.-]*", label):
            raise ValueError(f"{label!r} is no name")
        name = f"{self.version() + 1:012d}-{uuid.uuid4().hex}-{label}"
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{self.path}/data/{name}")
        folders.mark(self.spark, f"{self.path}/versions/{name}")
        return seen.get["rows"]

    def forget(self, keep: int = 2) -> None:
        """Delete the rows of all but the last ``keep`` versions, and what stopped writes have left behind; markers stay."""
        if keep < 1:
            raise ValueError("the newest version stays")
        markers = self._markers()
        for name in folders.names(self.spark, f"{self.path}/data"):
            if name not in markers[-keep:]:
                folders.remove(self.spark, f"{self.path}/data/{name}")
