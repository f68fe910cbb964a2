"""Trip costing: asking a router per trip and flattening its XML replies."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairreach.functions.clock import STAMP_FORMAT, from_epoch_ms, seconds_between
from fairreach.functions.cost import fare

# The reply elements that are read and the error that means an empty trip
_LEG = "struct<legs:array<struct<distance:double>>>"
_FARE = "struct<details:struct<regular:struct<price:struct<cents:double>>>>"
_ITINERARY = (
    "struct<duration:double,startTime:double,endTime:double,walkTime:double,transitTime:double,"
    f"waitingTime:double,walkDistance:double,transfers:int,fare:{_FARE},legs:array<{_LEG}>>"
)
REPLY_SCHEMA = (
    "requestParameters struct<date:string,time:string>, error struct<msg:string,message:string>, "
    f"plan struct<itineraries:array<struct<itineraries:array<{_ITINERARY}>>>>"
)
TOO_CLOSE = "TOO_CLOSE"
TRIP_FIELDS = [
    "departure_time",
    "arrival_time",
    "total_time",
    "walk_time",
    "transfer_wait_time",
    "transit_time",
    "walk_dist",
    "transit_dist",
    "total_dist",
    "num_transfers",
    "initial_wait_time",
    "fare",
]


def _computed_once(df: DataFrame, keep: Sequence[str], **columns: Column) -> DataFrame:
    """``keep`` and the given columns, each evaluated once per row.

    The optimizer copies a projected expression into every later use and into filters moved below
    it, which would parse the same reply dozens of times. It does not look into a generator.
    """
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def parse_itineraries(
    df: DataFrame, xml_col: str, id_cols: Sequence[str], shift_hours: float = 1, zone: str = "UTC"
) -> DataFrame:
    """``id_cols``, the twelve trip fields and ``ok`` per reply.

    An error whose text is part of TOO_CLOSE is a valid empty trip; any other error, an unreadable
    reply or a missing field is a failed one. Of several itineraries the last counts.
    """
    # the fields are elements alone, so attributes are not gathered
    reply = F.from_xml(F.col(xml_col), REPLY_SCHEMA, {"mode": "PERMISSIVE", "excludeAttribute": "true"})
    replies = _computed_once(df.select(*id_cols, xml_col), id_cols, r=reply)
    nested = F.flatten(F.filter(F.transform("r.plan.itineraries", lambda p: p["itineraries"]), lambda a: a.isNotNull()))
    last = F.try_element_at(nested, F.lit(-1))
    leg_groups = F.filter(last["legs"], lambda g: g["legs"].isNotNull())
    legs = F.coalesce(F.flatten(F.transform(leg_groups, lambda g: g["legs"])), F.array().cast("array<struct<distance:double>>"))
    failed = F.col("r.error.msg").isNotNull()
    # functions on arrays end here: beside them no other expression of a step is compiled with the steps around it
    parsed = replies.select(
        *id_cols,
        F.concat_ws(" ", "r.requestParameters.date", "r.requestParameters.time").try_cast("timestamp_ntz").alias("asked"),
        last.alias("it"),
        F.aggregate(legs, F.lit(0.0), lambda acc, leg: acc + leg["distance"]).alias("total_dist"),
        failed.alias("failed"),
        (failed & F.lit(TOO_CLOSE).contains(F.col("r.error.message"))).alias("close"),
    )
    total_dist = F.col("total_dist")
    departure = from_epoch_ms(F.col("it.startTime"), shift_hours, zone)
    arrival = from_epoch_ms(F.col("it.endTime"), shift_hours, zone)
    cents = F.col("it.fare.details.regular.price.cents")
    price = fare(F.col("it.transfers"), F.col("it.walkTime"), F.col("it.duration"), cents)
    read = {
        "departure_time": F.date_format(departure, STAMP_FORMAT),
        "arrival_time": F.date_format(arrival, STAMP_FORMAT),
        "total_time": F.col("it.duration"),
        "walk_time": F.col("it.walkTime"),
        "transfer_wait_time": F.col("it.waitingTime"),
        "transit_time": F.col("it.transitTime"),
        "walk_dist": F.col("it.walkDistance"),
        "transit_dist": total_dist - F.col("it.walkDistance"),
        "total_dist": total_dist,
        "num_transfers": F.col("it.transfers"),
        "initial_wait_time": seconds_between(F.col("asked"), departure),
        "fare": price,
    }
    empty = {name: F.lit(0).cast("int" if name == "num_transfers" else "double") for name in TRIP_FIELDS}
    empty["departure_time"] = empty["arrival_time"] = F.date_format("asked", STAMP_FORMAT)
    fields = {
        name: F.when(F.col("close"), empty[name]).when(~F.col("failed") & F.col("it").isNotNull(), read[name])
        for name in TRIP_FIELDS
    }
    trips = _computed_once(parsed, id_cols, **fields)
    filled = F.lit(True)
    for name in TRIP_FIELDS:
        filled = filled & F.col(name).isNotNull()
    return trips.withColumn("ok", filled)


def trip_results(df: DataFrame, xml_col: str, id_cols: Sequence[str], **zone) -> DataFrame:
    """The valid trips only, under their ids."""
    return parse_itineraries(df, xml_col, id_cols, **zone).where("ok").drop("ok")


def enrich(
    trips: DataFrame,
    fn: Callable[[pd.DataFrame, str | None], pd.DataFrame],
    schema: str | T.StructType,
    workers: int | None = None,
    endpoints: Sequence[str] = (),
    retries: int = 0,
    wait: float = 1.0,
) -> DataFrame:
    """Add the columns of ``schema``, ``ok`` and ``error`` to every trip by a user function over Arrow batches.

    ``fn(batch, endpoint)`` returns a frame indexed like the batch; rows it leaves out are failed
    trips. When it raises, the batch is tried again row by row, so that one bad trip loses only
    itself and keeps the reason in ``error``. A function that raises for each of several rows, or whose answer lacks a
    declared column, is wrong as a whole: that fails the job. Endpoints are shared out by partition. An endpoint that raises
    is asked ``retries`` times more, after ``wait`` seconds, then twice as many, and so on; then the next endpoint has its
    turn, and only after the last one the rows are tried one by one. Lost tasks are run again, so ``fn`` must bear
    being asked twice for the same trip.
    """
    added = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    names = added.fieldNames()
    addresses = list(endpoints)

    def checked(answer: pd.DataFrame) -> pd.DataFrame:
        missing = [n for n in names if n not in answer.columns]
        if missing:
            raise KeyError(f"the function's answer lacks {missing}")
        return answer[names]

    def patient(batch: pd.DataFrame, turns: list[str | None]) -> pd.DataFrame:
        """The answer of the first endpoint that gives one; the last one's error if none does."""
        tries = [(endpoint, attempt) for endpoint in turns for attempt in range(retries + 1)]
        for endpoint, attempt in tries[:-1]:
            try:
                return checked(fn(batch, endpoint))
            except KeyError:
                raise
            except Exception:
                if attempt < retries:
                    time.sleep(wait * 2**attempt)
        return checked(fn(batch, tries[-1][0]))

    def ask(batch: pd.DataFrame, turns: list[str | None]) -> tuple[pd.DataFrame, dict]:
        """The answers, and the error of each row that raised."""
        try:
            return patient(batch, turns), {}
        except KeyError:
            raise
        except Exception as all_rows:
            endpoint, answers, errors = turns[-1], [], {}
            for i in range(len(batch)):
                row = batch.iloc[[i]]
                try:
                    answers.append(checked(fn(row, endpoint)))
                except Exception as one:
                    errors[row.index[0]] = f"{type(one).__name__}: {one}"
            if len(errors) == len(batch) > 1:
                raise RuntimeError("the function fails for every trip of a batch") from all_rows
            return pd.concat(answers) if answers else pd.DataFrame(columns=names, index=batch.index[:0]), errors

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        first = part % len(addresses) if addresses else 0
        turns = [*addresses[first:], *addresses[:first]] or [None]
        for batch in batches:
            answers, errors = ask(batch, turns)
            out = batch.join(answers)
            out["ok"] = batch.index.isin(answers.index)
            out["error"] = [errors.get(k) for k in batch.index]
            yield out

    out_schema = T.StructType([*trips.schema.fields, *added.fields, T.StructField("ok", T.BooleanType()), T.StructField("error", T.StringType())])
    spread = trips.repartition(workers) if workers else trips
    return spread.mapInPandas(run, out_schema)
