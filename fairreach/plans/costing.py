"""The costing stage: pending trips to a router and back as results, flags and losses."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fairreach.operators.clean import loss_report
from fairreach.operators.combine import otp_trips
from fairreach.operators.itinerary import TRIP_FIELDS, enrich, parse_itineraries
from fairreach.session import scratch_path
from fairreach.sources import folders

# Fixed texts: why a trip without an error of the function has no result
NO_ANSWER = "no answer"
NO_TRIP = "no usable itinerary"
#: Trips that a task asks for: what is asked again if it is lost.
BATCH_TRIPS = 2000
# a task's file is moved to its place when the task commits, not when all tasks have ended
_BY_TASK = ("mapreduce.fileoutputcommitter.algorithm.version", "2")

Router = Callable[[pd.DataFrame, str | None], pd.DataFrame]


@dataclass(frozen=True)
class Report:
    """What one run has asked: trips, those without a result, and the number of the run."""

    run: int
    asked: int
    failed: int


class CostLedger:
    """The answers of all costing runs at ``path``, the one table from which results, flags and failures are read.

    A run deals the trips that are to be costed to tasks of ``BATCH_TRIPS``, and the answers of a task become part of the
    ledger in one move when that task ends, whatever becomes of the others. So a run that is stopped loses the
    batches that were being asked and no others, and the next run asks for what is missing. Trip ids must be unique. One
    run at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _written(self) -> DataFrame | None:
        if not any(n.startswith("part-") for n in folders.names(self.spark, f"{self.path}/answers")):
            return None
        return self.spark.read.parquet(f"{self.path}/answers")

    def answers(self) -> DataFrame | None:
        """Of each trip that was asked for its result, or the last failure without one; None if nothing was asked."""
        written = self._written()
        if written is None:
            return None
        best = F.max_by(F.struct(*written.columns), F.struct(F.col("ok").cast("int"), "run")).alias("best")
        return written.groupBy("trip_id").agg(best).select("best.*")

    def pending(self, trips: DataFrame) -> DataFrame:
        """The trips that are not flagged and have no result in the ledger."""
        written = self._written()
        waiting = trips.where(F.col("computed") == 0)
        return waiting if written is None else waiting.join(written.where("ok").select("trip_id"), "trip_id", "left_anti")

    def flagged(self, trips: DataFrame) -> DataFrame:
        """All trips, those with a result in the ledger flagged as computed."""
        written = self._written()
        if written is None:
            return trips
        back = written.where("ok").select("trip_id").distinct().withColumn("_back", F.lit(1))
        flags = trips.join(back, "trip_id", "left").withColumn("computed", F.greatest("computed", F.coalesce("_back", F.lit(0))))
        return flags.select(trips.columns)

    def run(
        self,
        trips: DataFrame,
        oa: DataFrame,
        poi: DataFrame,
        fn: Router,
        endpoints: Sequence[str] = (),
        shift_hours: float = 1,
        zone: str = "UTC",
        retries: int = 0,
        wait: float = 1.0,
        batch_trips: int = BATCH_TRIPS,
    ) -> Report:
        """Ask ``fn`` for the reply of every pending trip, and keep what comes back with the reason of what does not.

        ``fn(batch, endpoint)`` answers with a column ``reply``; for ``retries`` and ``wait`` see :func:`enrich`. A trip that failed
        is pending again in the next run; one with an end that is not known is not asked for.
        """
        number = 1 + max((int(n) for n in folders.names(self.spark, f"{self.path}/runs")), default=0)
        folders.mark(self.spark, f"{self.path}/runs/{number:09d}")
        wanted = otp_trips(self.pending(trips), oa, poi)
        tasks = max(1, -(-wanted.count() // batch_trips))
        asked = enrich(wanted.repartition(tasks, "trip_id"), fn, "reply string", None, endpoints, retries, wait)
        reason = F.when(F.col("ok"), F.lit(None)).otherwise(F.coalesce("error", F.lit(NO_ANSWER))).alias("reason")
        parsed = parse_itineraries(asked.select("trip_id", "reply", reason), "reply", ["trip_id", "reason"], shift_hours, zone)
        kept = parsed.withColumn("reason", F.when(~F.col("ok"), F.coalesce("reason", F.lit(NO_TRIP)))).withColumn("run", F.lit(number))
        seen = Observation()
        counted = kept.observe(seen, F.count(F.lit(1)).alias("asked"), F.count_if(~F.col("ok")).alias("failed"))
        counted.write.mode("append").option(*_BY_TASK).parquet(f"{self.path}/answers")
        return Report(number, seen.get["asked"], seen.get["failed"])


@dataclass(frozen=True)
class Costed:
    """``results``: trip_id and the trip fields; ``trips``: all trips with their new flags; ``failures``: trip_id and reason of
    those without a result; ``losses``: one row n, bad, pct of what this run has asked."""

    results: DataFrame
    trips: DataFrame
    failures: DataFrame
    losses: DataFrame


def cost_trips(
    trips: DataFrame,
    oa: DataFrame,
    poi: DataFrame,
    fn: Router,
    endpoints: Sequence[str] = (),
    ledger: str | None = None,
    **how,
) -> Costed:
    """Ask ``fn`` for the trips not computed yet, and read results, flags and failures off the ledger.

    ``ledger`` is the folder that all runs share; without one the answers are kept for this run alone. ``how`` goes to
    :meth:`CostLedger.run`.
    """
    book = CostLedger(trips.sparkSession, ledger or scratch_path(trips.sparkSession, "ledger"))
    report = book.run(trips, oa, poi, fn, endpoints, **how)
    answers = book.answers()
    return Costed(
        answers.where("ok").select("trip_id", *TRIP_FIELDS),
        book.flagged(trips),
        answers.where("not ok").select("trip_id", "reason"),
        loss_report(answers.where(F.col("run") == report.run)),
    )
