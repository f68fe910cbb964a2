"""Tables that are kept and extended: trips, costing answers, the summary cube."""

import os
import subprocess
import sys
import textwrap
from collections import Counter
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from fairreach.catalog.served import reply_router
from fairreach.operators import cube, itinerary, trips
from fairreach.plans.costing import CostLedger
from fairreach.plans.serving import CubeStore
from fairreach.session import BROADCAST_ROWS, by_rows, stored
from fairreach.sources.trip_table import TripTable
from fairreach.sources.versions import VersionedTable

ROOT = Path(__file__).resolve().parents[1]


def times(spark, n, *strata):
    return spark.createDataFrame([(s, "2021-01-05", f"07:{i:02d}") for s in strata for i in range(n)], "stratum string, date string, time string")


def pairs(spark, n):
    return spark.range(n).select(F.format_string("E%03d", "id").alias("oa_id"), (F.col("id") % 7).alias("poi_id"), F.lit("School").alias("poi_type"))


def candidates(spark, n, m, *strata):
    return trips.cross_trips(pairs(spark, n), times(spark, m, *strata)).drop("trip_id", "computed")


def rows_of(df):
    return sorted(tuple(r[c] for c in trips.TRIP_COLUMNS) for r in df.collect())


# --- intermediate tables
def test_many_repeated_rows_in_a_small_file_are_not_broadcast(spark):
    """Runs of one value fill next to nothing in a file; a broadcast would hold every row in the driver."""
    other = spark.range(3_000_000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    plans = []
    for n in (BROADCAST_ROWS + 1, 1_000):
        same = stored(spark.range(n).select(F.lit(1).cast("bigint").alias("k"), F.lit("x").alias("name")), "same")
        joined = other.join(same.where("name is not null"), "k")
        plans.append(joined._jdf.queryExecution().executedPlan().toString())
        assert joined.count() == n
    assert "Broadcast" not in plans[0] and "BroadcastHashJoin" in plans[1]
    # what is broadcast by name stays so
    named = by_rows(other, 3_000_000).join(F.broadcast(spark.range(3).select(F.col("id").alias("k"))), "k")
    assert "BroadcastHashJoin" in named._jdf.queryExecution().executedPlan().toString()


# --- trips


def test_trip_table_keeps_ids_and_adds_files_only(spark, tmp_path):
    path = str(tmp_path / "trips")
    table = TripTable(spark, path, buckets=8)
    old = trips.cross_trips(pairs(spark, 20), times(spark, 2, "AM", "All day")).withColumn("computed", F.lit(1))
    table.load(old)
    before = {f: f.stat().st_mtime_ns for f in Path(path, "rows").glob("*.parquet")}
    assert table.append(candidates(spark, 20, 2, "AM", "PM")) == 0
    assert table.append(candidates(spark, 21, 2, "AM", "All day")) == 4
    # another session's view of the same folder
    again = TripTable(spark, path, buckets=8)
    assert rows_of(again.read())[:80] == rows_of(old) and again.last_id() == 84
    assert again.append(candidates(spark, 21, 3, "AM")) == 21
    assert sorted(r["trip_id"] for r in again.read().collect()) == list(range(1, 106))
    after = {f: f.stat().st_mtime_ns for f in Path(path, "rows").glob("*.parquet")}
    assert before.items() <= after.items()
    with pytest.raises(ValueError, match="buckets-8"):
        TripTable(spark, path, buckets=4)
    with pytest.raises(ValueError, match="have been given"):
        table.load(old)


def test_trip_table_never_gives_an_id_twice(spark, tmp_path, monkeypatch):
    table = TripTable(spark, str(tmp_path / "trips"), buckets=2)
    table.load(trips.cross_trips(pairs(spark, 2), times(spark, 1, "AM")))

    def stopped(self, rows):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(TripTable, "_insert", stopped)
        with pytest.raises(RuntimeError):
            table.append(candidates(spark, 4, 1, "AM"))
    assert table.append(candidates(spark, 4, 1, "AM")) == 2
    assert sorted(r["trip_id"] for r in table.read().collect()) == [1, 2, 5, 6]


def test_appending_does_not_shuffle_the_stored_trips(spark, tmp_path):
    table = TripTable(spark, str(tmp_path / "trips"), buckets=8)
    table.load(trips.cross_trips(pairs(spark, 20), times(spark, 2, "AM")))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        fresh = candidates(spark, 30, 2, "AM")
        join = fresh.join(table.read().select(trips.TRIP_KEY), trips.TRIP_KEY, "left_anti").distinct()
        plan = join._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    stored_side = plan[plan.index("SortMergeJoin") :].split("FileScan")[-2:]
    assert "Bucketed: true" in plan
    # above the scan of the stored trips stands no exchange: the last one of the plan is that of the candidates
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    depth = lines[scan].index("FileScan")
    above, at = [], depth
    for line in reversed(lines[:scan]):
        indent = len(line) - len(line.lstrip(" :+-"))
        if indent < at:
            above.append(line)
            at = indent
        if "SortMergeJoin" in line:
            break
    assert stored_side and not any("Exchange" in line for line in above)


# --- costing


def pending(spark, n):
    made = spark.range(1, n + 1).select(F.col("id").alias("trip_id"), F.lit(1).alias("oa_id"), F.lit(1).alias("poi_id"), F.lit("2021-01-05").alias("date"), F.lit("07:00").alias("time"), F.lit(0).alias("computed"))
    return made, spark.createDataFrame([(1, 52.5, -1.9)], "oa_id int, lat double, lon double"), spark.createDataFrame([(1, 52.51, -1.9)], "poi_id int, lat double, lon double")


def logging_router(log, pause=0.0):
    import time

    def router(batch, endpoint):
        with open(log, "a") as out:  # one short write, so lines of several workers do not mix
            out.write("".join(f"{t}\n" for t in batch["trip_id"]))
        time.sleep(pause)
        return reply_router(batch, endpoint)

    return router


KILLED = """
    import os, sys, threading, time
    sys.path[:0] = [{root!r}, {tests!r}]
    from pathlib import Path
    from pyspark.sql import SparkSession
    from fairreach.plans.costing import CostLedger
    import test_stored

    spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()

    def watch():
        while len(list(Path({ledger!r}, "answers").glob("part-*"))) < 3:
            time.sleep(0.01)
        os._exit(9)

    threading.Thread(target=watch, daemon=True).start()
    made = test_stored.pending(spark, 400)
    CostLedger(spark, {ledger!r}).run(*made, test_stored.logging_router({log!r}, 0.5), batch_trips=20)
    os._exit(0)
"""


def test_costing_goes_on_where_it_was_killed(spark, tmp_path):
    ledger, log, second = str(tmp_path / "ledger"), str(tmp_path / "asked"), str(tmp_path / "asked-again")
    script = textwrap.dedent(KILLED.format(root=str(ROOT), tests=str(ROOT / "tests"), ledger=ledger, log=log))
    ended = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, timeout=120, env=os.environ | {"PYTHONPATH": f"{ROOT}:{ROOT / 'tests'}"})
    assert ended.returncode == 9, ended.stderr[-2000:]
    book = CostLedger(spark, ledger)
    kept = {r["trip_id"] for r in book.answers().collect()}
    assert 40 <= len(kept) < 400
    report = book.run(*pending(spark, 400), logging_router(second), batch_trips=50)
    assert (report.run, report.asked, report.failed) == (2, 400 - len(kept), 0)
    asked = [int(x) for x in Path(second).read_text().split()]
    assert sorted([*kept, *asked]) == list(range(1, 401))
    results = Counter(r["trip_id"] for r in book.answers().where("ok").collect())
    assert results == Counter(range(1, 401))
    assert {r["computed"] for r in book.flagged(pending(spark, 400)[0]).collect()} == {1}


def test_a_task_that_wrote_twice_counts_once(spark, tmp_path):
    book = CostLedger(spark, str(tmp_path / "ledger"))
    book.run(*pending(spark, 5), reply_router)
    spark.read.parquet(f"{book.path}/answers").write.mode("append").parquet(f"{book.path}/answers")
    assert book.answers().count() == 5


def test_endpoints_are_asked_again_after_a_wait(spark, tmp_path):
    log = str(tmp_path / "calls")

    def router(batch, endpoint):
        import time

        with open(log, "a") as out:
            out.write(f"{endpoint} {time.time()}\n")
        calls = [line.split()[0] for line in open(log)]
        if endpoint == "a" or calls.count("b") < 3:
            raise ConnectionError("away")
        return pd.DataFrame({"cost": 1.0}, index=batch.index)

    df = spark.range(3).coalesce(1)
    out = itinerary.enrich(df, router, "cost double", endpoints=["a", "b"], retries=2, wait=0.1).collect()
    assert all(r["ok"] for r in out)
    calls = [line.split() for line in open(log)]
    assert [c[0] for c in calls] == ["a", "a", "a", "b", "b", "b"]
    gaps = [float(b[1]) - float(a[1]) for a, b in zip(calls, calls[1:])]
    assert gaps[0] >= 0.1 and gaps[1] >= 0.2 and gaps[3] >= 0.1 and gaps[4] >= 0.2


# --- versions and the cube


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError):
        table.read()
    assert table.publish(spark.range(5)) == 5
    broken = spark.range(100).select(F.raise_error(F.lit("no")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="no"):
        table.publish(broken)
    assert table.version() == 1 and table.read().count() == 5
    open_before = table.read()
    assert table.publish(table.read().where("id > 1")) == 3
    assert open_before.count() == 5 and table.read().count() == 3
    table.publish(table.read().where("id > 3"))
    table.forget(keep=1)
    assert table.version() == 3 and [r["id"] for r in table.read().collect()] == [4]
    assert len(list((tmp_path / "t" / "data").iterdir())) == 1


def test_cube_grows_by_increments(spark, tables, tmp_path):
    rest = (tables.fx_trips(), tables.fx_poi(), tables.fx_strata())
    results = tables.fx_results()
    store = CubeStore(spark, str(tmp_path / "cube"))
    for k in (0, 1, 1, 2, 0):  # an increment that is repeated is added once
        store.add(results.where(f"trip_id % 3 = {k}"), *rest, label=f"run-{k}")
    got = {tuple(r[d] for d in cube.DIMENSIONS): r for r in store.read().collect()}
    want = {tuple(r[d] for d in cube.DIMENSIONS): r for r in cube.summary_cube(results, *rest).collect()}
    assert got.keys() == want.keys() and store.table.version() == 3
    for key, row in want.items():
        assert [got[key][c] for c in ["num_trips", *cube.moment_columns()]] == pytest.approx([row[c] for c in ["num_trips", *cube.moment_columns()]])
    store.refresh(results.limit(0), *rest)
    assert store.read().count() == 0 and store.table.labels() == []


def test_served_queries_read_the_stored_cube(spark, tables):
    from fairreach.plans import serving

    plan = serving.high_level(tables.served_cube())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "served-cube" in plan and "Join" not in plan
