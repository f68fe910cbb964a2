"""The load stage: files under a folder to the raw tables of the batch run."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fairreach import settings
from fairreach.plans.etl import Config, run_etl
from fairreach.sources.spatial import read_boundaries, read_ways
from fairreach.sources.tables import load_manifest


def raw_schemas() -> dict[str, T.StructType]:
    """Layout of each raw text table, all columns as text."""
    census = {t: f"{settings.CENSUS_KEYS} {own}" for t, own in settings.CENSUS_COLUMNS.items()}
    return {
        t: T.StructType([T.StructField(c, T.StringType()) for c in listed.split()])
        for t, listed in (settings.RAW_COLUMNS | census).items()
    }


def load_raw(
    spark: SparkSession, root: str, boundaries: str, ways: str, boundary_srid: int = 27700, files: Mapping[str, str] = settings.TEXT_FILES
) -> dict[str, DataFrame]:
    """The raw tables of a run: delimited ``files`` under ``root``, GeoJSON ``boundaries`` and OSM ``ways``.

    Columns are taken by position under the fixed layouts, whatever the header says; a row with too few or too many fields
    fails the load. Nothing is read before the tables are used, and only the columns that are.
    """
    raw = load_manifest(spark, root, files, raw_schemas())
    areas = read_boundaries(spark, boundaries, boundary_srid, "oa11cd string")
    raw["boundaries"] = areas.select("properties.oa11cd", "geometry")
    raw["roads"] = read_ways(spark, ways).withColumnRenamed("osm_id", "line_id").select("line_id", "way")
    return raw


def run_from_files(
    spark: SparkSession, root: str, boundaries: str, ways: str, config: Config = Config(), existing_trips: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Every layer of the batch run from files; see :func:`load_raw` and :func:`fairreach.plans.etl.run_etl`."""
    return run_etl(load_raw(spark, root, boundaries, ways, config.boundary_srid), config, existing_trips)
