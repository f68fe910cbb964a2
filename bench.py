"""Time the headline queries: prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from fairreach import catalog

HEADLINE = [
    "agg_summary_cube",
    "q_accessibility_metrics",
    "q_accessibility_metrics_high",
    "q_accessibility_metrics_groups",
    "q_population_metrics",
    "agg_at_risk",
    "agg_access_metric",
    "gc_cost",
    "unpivot_population",
    "agg_percentile_disc",
    "q_vis_map",
    "join_left_chain",
    "join_using_multi",
    "join_full_using",
    "knn_poi",
    "knn_poi_planar",
    "knn_nearest_road",
    "join_within",
    "upsert_trips",
    "mark_computed",
    "page_scan",
    "sample_strata",
    "xml_itinerary",
    "enrich_partitions",
    "str_squeeze",
    "agg_dedupe_group",
    "q_etl",
    "q_access_query",
    "agg_rollup_alltimes",
    "gen_trips",
    "cost_trips_results",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = catalog.queries()
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    seconds = {}
    for name in names:
        started = time.time()
        registered[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - started, 3)
    total = round(sum(seconds.values()), 3)
    scale = folder.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": float(scale)}))


if __name__ == "__main__":
    main()
