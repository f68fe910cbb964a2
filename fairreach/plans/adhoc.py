"""The ad-hoc access query: chosen areas and types, random times, costed by a user function."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame

from fairreach.operators.clean import select_areas, select_pois
from fairreach.operators.cube import access_score
from fairreach.operators.itinerary import enrich, trip_results
from fairreach.operators.trips import generate_trips


@dataclass(frozen=True)
class AccessQuery:
    poi_types: Sequence[str]
    start: dt.datetime
    end: dt.datetime
    num_trips: int
    areas: Sequence = field(default_factory=tuple)
    k: int = 3
    seed: int = 999
    workers: int | None = None
    endpoints: Sequence[str] = ()


def query_trips(query: AccessQuery, oa: DataFrame, poi: DataFrame) -> DataFrame:
    areas, pois = select_areas(oa, query.areas), select_pois(poi, query.poi_types)
    return generate_trips(areas, pois, query.start, query.end, query.num_trips, query.k, query.seed)


def access_query(
    query: AccessQuery, oa: DataFrame, poi: DataFrame, fn: Callable[[pd.DataFrame, str | None], pd.DataFrame]
) -> DataFrame:
    """Sum and mean cost per (area, type); ``fn`` answers each batch of trips with a column ``reply``."""
    trips = query_trips(query, oa, poi)
    replies = enrich(trips, fn, "reply string", query.workers, query.endpoints).where("ok")
    return access_score(trip_results(replies, "reply", ["oa_id", "poi_type", "poi_id"]))
