"""The stored trip table: bucketed by what makes a trip, extended in place, its ids never given twice."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from fairreach.operators.trips import TRIP_COLUMNS, TRIP_KEY, new_trips
from fairreach.sources import folders

_TYPES = {"trip_id": "bigint", "oa_id": "string", "poi_id": "bigint", "date": "string", "time": "string", "poi_type": "string", "stratum": "string", "computed": "int"}


class TripTable:
    """Trips at ``path``, dealt to ``buckets`` by area, destination, date and time.

    Appending reads the stored side bucket by bucket, without a shuffle, and adds files to the buckets that get
    new trips; no stored file is written again. Ids are reserved before the rows that use them are written, by a marker with the
    largest id given so far: a stopped append loses some numbers and gives none twice, and the next one adds
    the trips that are still missing. One writer at a time. ``types`` may change the types of the ids.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, types: dict[str, str] | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        made = folders.names(spark, f"{self.path}/spec")
        wanted = f"buckets-{buckets}"
        if not made:
            folders.mark(spark, f"{self.path}/spec/{wanted}")
        elif made != [wanted]:
            raise ValueError(f"the table at {path} has {made[0]}, not {wanted}")
        self.buckets = buckets
        self.name = f"trips_{hashlib.md5(self.path.encode()).hexdigest()[:16]}"
        kinds = _TYPES | (types or {})
        columns, key = ", ".join(f"{c} {kinds[c]}" for c in TRIP_COLUMNS), ", ".join(TRIP_KEY)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{self.path}/rows'")

    def read(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def last_id(self) -> int:
        """The largest id that has been given."""
        marks = folders.names(self.spark, f"{self.path}/ids")
        return int(marks[-1]) if marks else 0

    def _insert(self, trips: DataFrame) -> None:
        # a task holds a bucket, so each bucket gets one file
        trips.select(TRIP_COLUMNS).repartition(self.buckets, *TRIP_KEY).write.insertInto(self.name)

    def load(self, trips: DataFrame) -> None:
        """Take in trips that have ids already, all rows of them; these must be larger than those given so far."""
        low, high = trips.selectExpr("min(trip_id)", "max(trip_id)").first()
        if low is None:
            return
        if low <= self.last_id():
            raise ValueError(f"ids up to {self.last_id()} have been given")
        folders.mark(self.spark, f"{self.path}/ids/{high:020d}")
        self._insert(trips)

    def append(self, candidates: DataFrame) -> int:
        """Add the candidates that no stored trip equals in area, destination, date and time; returns their number."""
        last = self.last_id()
        added = new_trips(self.read(), candidates, last)
        count = added.count()
        if count:
            folders.mark(self.spark, f"{self.path}/ids/{last + count:020d}")
            self._insert(added)
        return count
