import datetime as dt
import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from fairreach import settings
from fairreach.operators import calendar, clean, combine, itinerary, reshape, trips
from fairreach.operators.combine import END_COLUMNS, otp_trips, with_ends

HEAD = "<response><requestParameters><date>2020-07-28</date><time>07:07</time></requestParameters>"
RIDE = (
    "<itineraries><duration>1200</duration><startTime>1595917620000</startTime><endTime>1595918820000</endTime>"
    "<walkTime>300</walkTime><transitTime>800</transitTime><waitingTime>100</waitingTime><walkDistance>350.5</walkDistance>"
    "<transfers>1</transfers>{fare}<legs><legs><distance>350.5</distance></legs><legs><distance>4000</distance></legs></legs></itineraries>"
)
FARE = "<fare><details><regular><price><cents>250</cents></price></regular></details></fare>"


def reply(body):
    return f"{HEAD}{body}</response>"


def ride(fare="", tail=""):
    return reply(f"<error/><plan><itineraries>{RIDE.format(fare=fare)}{tail}</itineraries></plan>")


def parsed(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "trip_id int, xml string")
    return {r["trip_id"]: r for r in itinerary.parse_itineraries(df, "xml", ["trip_id"]).collect()}


def test_itinerary_fields(spark):
    rows = parsed(spark, ride(), ride(FARE), ride(tail=RIDE.format(fare=FARE).replace("1200", "900")))
    first = rows[0].asDict()
    assert first == {
        "trip_id": 0, "departure_time": "2020-07-28 07:27:00", "arrival_time": "2020-07-28 07:47:00", "total_time": 1200.0,
        "walk_time": 300.0, "transfer_wait_time": 100.0, "transit_time": 800.0, "walk_dist": 350.5, "transit_dist": 4000.0,
        "total_dist": 4350.5, "num_transfers": 1, "initial_wait_time": 1200.0, "fare": 4.8, "ok": True,
    }
    assert rows[1]["fare"] == 2.5
    # of several itineraries the last one counts
    assert (rows[2]["total_time"], rows[2]["fare"]) == (900.0, 2.5)


def test_failed_and_empty_trips(spark):
    rows = parsed(
        spark,
        reply("<error><msg>m</msg><message>TOO_CLOSE</message></error><plan/>"),
        reply("<error><msg>m</msg><message>CLOSE</message></error><plan/>"),
        reply("<error><msg>m</msg><message>PATH_NOT_FOUND</message></error><plan/>"),
        reply("<error/><plan><itineraries/></plan>"),
        ride().replace("<walkTime>300</walkTime>", ""),
        "not xml",
        ride().replace("<error/>", ""),
    )
    assert [rows[i]["ok"] for i in range(7)] == [True, True, False, False, False, False, True]
    assert rows[0]["departure_time"] == rows[0]["arrival_time"] == "2020-07-28 07:07:00"
    assert rows[0]["total_time"] == rows[0]["fare"] == 0


def test_enrich_loses_only_bad_rows(spark):
    def router(batch, endpoint):
        if (batch["trip_id"] == 13).any():
            raise RuntimeError("router down")
        kept = batch[batch["trip_id"] != 5]
        return pd.DataFrame({"cost": kept["trip_id"] * 2.0, "host": endpoint}, index=kept.index)

    df = spark.range(20).withColumnRenamed("id", "trip_id")
    out = itinerary.enrich(df, router, "cost double, host string", workers=3, endpoints=["a", "b"])
    rows = {r["trip_id"]: r for r in out.collect()}
    assert {i for i, r in rows.items() if not r["ok"]} == {5, 13}
    assert all(r["cost"] == 2.0 * i for i, r in rows.items() if r["ok"])
    report = clean.loss_report(out).first()
    assert (report["n"], report["bad"], report["pct"]) == (20, 2, 10.0)


def test_dates(spark):
    days = calendar.date_range(spark, "2021-01-01", dt.date(2021, 1, 28), ["Tuesday"])
    assert [str(r["date"]) for r in days.orderBy("date").collect()] == ["2021-01-05", "2021-01-12", "2021-01-19", "2021-01-26"]
    holidays = calendar.holiday_table(spark, 2021, 2021)
    april = calendar.date_range(spark, "2021-04-01", "2021-04-06", None, holidays)
    assert sorted(str(r["date"]) for r in april.collect()) == ["2021-04-01", "2021-04-03", "2021-04-04", "2021-04-06"]
    assert calendar.date_range(spark, "2021-02-02", "2021-02-01").count() == 0
    assert {dt.date(2021, 12, 27), dt.date(2021, 12, 28), dt.date(2021, 8, 30)} <= calendar.uk_bank_holidays(2021)


def test_times(spark):
    minutes = sorted(r["time"] for r in calendar.time_range(spark, "6:30", "8:30").collect())
    assert (len(minutes), minutes[0], minutes[-1]) == (121, "06:30:00", "08:30:00")
    assert calendar.time_range(spark, "6:30", "8:30", "h").count() == 3
    assert calendar.time_range(spark, "6:30", "6:31", "s").count() == 61
    both = calendar.datetime_range(calendar.date_range(spark, "2021-01-01", "2021-01-03"), calendar.time_range(spark, "6:30", "6:31"))
    assert both.count() == 6


def test_sampled_timestamps(spark):
    def draw(n=30, strata=settings.TIME_STRATA):
        return calendar.sample_timestamps(spark, settings.TIME_DEFS, strata, n)

    rows = [tuple(r) for r in draw().collect()]
    assert len(set(rows)) == 180
    assert {s for s, _, _ in rows} == set(settings.TIME_STRATA)
    days = {"Saturday": 5, "Sunday": 6}
    assert all(dt.date.fromisoformat(d).weekday() == days.get(s, 1) for s, d, _ in rows)
    assert all("06:30" <= t <= "08:30" for s, _, t in rows if "AM" in s)
    assert sorted(rows) == sorted(tuple(r) for r in draw().collect())
    own = {"Sunday": {"time_of_day": "all", "day_of_week": "sunday", "n_sample": 4}}
    assert draw(strata=own).count() == 4
    with pytest.raises(Exception, match="sample larger"):
        draw(n=5000).collect()


def stamps(spark, n):
    return spark.createDataFrame([("s", "2021-01-05", f"07:{i:02d}") for i in range(n)], "stratum string, date string, time string")


def pairs(spark, n):
    return spark.range(n).select(F.format_string("E%03d", "id").alias("oa_id"), (F.col("id") % 7).alias("poi_id"), F.lit("School").alias("poi_type"))


def test_trip_ids_and_appending(spark):
    old = trips.cross_trips(pairs(spark, 20), stamps(spark, 3))
    assert sorted(r["trip_id"] for r in old.collect()) == list(range(1, 61))
    done = old.withColumn("computed", F.when(F.col("trip_id") <= 10, 1).otherwise(0))
    new = trips.cross_trips(pairs(spark, 25), stamps(spark, 4)).drop("trip_id", "computed")
    both = trips.append_trips(done, new)
    rows = both.collect()
    assert sorted(r["trip_id"] for r in rows) == list(range(1, 101))
    kept = {r["trip_id"]: (r["oa_id"], r["time"], r["computed"]) for r in rows if r["trip_id"] <= 60}
    assert kept == {r["trip_id"]: (r["oa_id"], r["time"], r["computed"]) for r in done.collect()}
    first = trips.append_trips(done.limit(0), new)
    assert sorted(r["trip_id"] for r in first.collect()) == list(range(1, 101))
    assert trips.cross_trips(pairs(spark, 3), stamps(spark, 0)).count() == 0


def test_trips_by_pair_are_the_same_trips(spark):
    placed = pairs(spark, 20).withColumn("oa_lat", F.col("poi_id") * 0.5)
    made = trips.cross_trips(placed, stamps(spark, 3), keep=["oa_lat"], by_pair=True)
    plain = trips.cross_trips(pairs(spark, 20), stamps(spark, 3))
    assert sorted(made.drop("oa_lat").collect()) == sorted(plain.collect()) and made.where("oa_lat <> poi_id * 0.5").count() == 0
    assert trips.cross_trips(placed.limit(0), stamps(spark, 3), by_pair=True).count() == 0
    at = trips.TRIP_COLUMNS
    ends = [spark.createDataFrame([(k, 1.0, 2.0) for k in keys], f"{name}, lat double, lon double") for name, keys in (("oa_id string", ["E001", "E002"]), ("poi_id bigint", [1, 5]))]
    located = trips.cross_trips(with_ends(pairs(spark, 20), *ends), stamps(spark, 3), keep=END_COLUMNS, by_pair=True)
    later = otp_trips(located.select(at), *ends, carry=["stratum"])
    assert sorted(otp_trips(located, *ends, carry=["stratum"]).collect()) == sorted(later.collect()) and later.count() == 3


def test_no_product_join_in_the_trip_plan(spark):
    plan = trips.cross_trips(pairs(spark, 20), stamps(spark, 3))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("most", [64, 2])
def test_many_timestamps_meet_the_pairs_by_cells(spark, monkeypatch, most):
    wide = stamps(spark, 25).withColumn("place", F.col("time").substr(4, 2).cast("int"))
    whole = sorted(tuple(r) for r in trips.cross_trips(pairs(spark, 33), wide, carry=["place"]).collect())
    for name, value in {"_BROADCAST_STAMPS": 5, "_SLICE_STAMPS": 4, "_CHUNK_PAIRS": 10, "_MOST_SLICES": most}.items():
        monkeypatch.setattr(trips, name, value)
    made = trips.cross_trips(pairs(spark, 33), wide, carry=["place"])
    assert sorted(tuple(r) for r in made.collect()) == whole and len(whole) == 33 * 25
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_ts" not in plan and "hashpartitioning(_pair" not in plan and "CartesianProduct" not in plan
    assert trips.cross_trips(pairs(spark, 0), wide).count() == 0


def test_by_stamp_the_trips_of_a_time_follow_each_other(spark, monkeypatch):
    for name, value in {"_BROADCAST_STAMPS": 5, "_SLICE_STAMPS": 4, "_CHUNK_PAIRS": 10}.items():
        monkeypatch.setattr(trips, name, value)
    whole = sorted(tuple(r) for r in trips.assign_trip_ids(pairs(spark, 33), stamps(spark, 25)).collect())
    made = trips.assign_trip_ids(pairs(spark, 33), stamps(spark, 25), by_stamp=True)
    assert sorted(tuple(r) for r in made.collect()) == whole

    def changes(rows):
        listed = list(rows)
        return [sum(a != b for a, b in zip(listed, listed[1:])) + bool(listed)]

    assert made.select("stratum", "date", "time").rdd.mapPartitions(changes).sum() <= 25 * 4


@pytest.mark.parametrize("name", ["join_cross", "win_row_id", "join_cross_all"])
def test_the_product_is_summed_up_by_numbers(spark, name):
    from fairreach import catalog

    plan = catalog.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    keys = [line.split("keys=[")[1].split("]")[0] for line in plan.splitlines() if "HashAggregate" in line and "partial_count(1)" in line]
    assert keys and not any(f"{text}#" in k for k in keys for text in ("stratum", "poi_type", "date", "time"))


@pytest.mark.parametrize("name", ["join_cross", "win_row_id", "join_cross_all"])
def test_the_product_is_summed_up_without_sorting_it(spark, name):
    from fairreach import catalog

    plan = catalog.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    # the first aggregates above the product keep numbers alone, which stay in a hash map
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_entity_equals_chained_full_joins(spark):
    a = spark.createDataFrame([(1, "g", 10), (2, "g", 20), (None, "g", 30)], "oa int, geo string, a int")
    b = spark.createDataFrame([(2, "g", 5), (3, "g", 6), (None, "g", 7)], "oa int, geo string, b int")
    c = spark.createDataFrame([(3, "h", 1), (2, "g", None)], "oa int, geo string, c int")
    got = combine.entity({"a": a, "b": b, "c": c}, ["oa", "geo"])
    want = a.join(b, ["oa", "geo"], "full").join(c, ["oa", "geo"], "full")
    rows = [sorted(map(tuple, df.select("oa", "geo", "a", "b", "c").collect()), key=str) for df in (got, want)]
    assert rows[0] == rows[1]
    assert combine.duplicate_keys(got.where("oa is not null"), ["oa", "geo"]).count() == 0


def test_overrides_last_wins(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, lat double")
    fixes = spark.createDataFrame([("a", 5.0, 0), ("a", 6.0, 1), ("z", 9.0, 2)], "k string, lat double, seq int")
    assert sorted(tuple(r) for r in clean.apply_overrides(df, fixes, "k", ["lat"]).collect()) == [("a", 6.0), ("b", 2.0)]


def test_reshape(spark):
    df = spark.createDataFrame([([1, 2, 3], ["a", "b"])], "n array<int>, s array<string>")
    assert [tuple(r) for r in reshape.zip_explode(df, ["n", "s"]).collect()] == [(1, "a"), (2, "b"), (3, None)]
    oa = spark.createDataFrame([("E1",)], "oa_id string")
    got = {(r["poi_type"], r["k"]) for r in reshape.per_type_k(oa, {"x": 2, "y": None, "z": 0}, 3).collect()}
    assert got == {("x", 2), ("y", 3), ("z", 3)}


def test_cast_raises_on_bad_numbers(spark):
    with pytest.raises(Exception):
        clean.cast_columns(spark.createDataFrame([("x1",)], "v string"), {"v": "int"}).collect()


def test_json_rows(spark):
    from fairreach.plans.serving import as_json

    rows = as_json(spark.createDataFrame([("E1", 1.5, 1)], "oa_id string, metric double, rank int"), ["oa_id", "metric", "rank"])
    assert json.loads(rows.first()["json"]) == {"oa_id": "E1", "metric": 1.5, "rank": 1}


def test_long_id_lists(spark):
    df = spark.range(5000).withColumnRenamed("id", "oa_id")
    assert clean.select_areas(df, range(0, 6000, 2)).count() == 2500
    assert clean.select_areas(df, [1, 2]).count() == 2
    assert clean.select_areas(df).count() == 5000
    assert clean.select_pois(df.withColumn("type", F.lit("t")), []).count() == 0


def test_appending_keeps_every_trip(spark):
    """Strata that share times give trips that differ in stratum alone."""
    times = spark.createDataFrame([(s, "2021-01-05", "07:00") for s in ("AM", "All day")], "stratum string, date string, time string")
    old = trips.cross_trips(pairs(spark, 2), times).withColumn("computed", (F.col("stratum") == "AM").cast("int"))
    new = trips.cross_trips(pairs(spark, 3), times).drop("trip_id", "computed")
    nowhere = new.limit(1).withColumn("oa_id", F.lit(None).cast("string"))
    rows = trips.append_trips(old, new.unionByName(new).unionByName(nowhere)).orderBy("trip_id").collect()
    assert [(r["trip_id"], r["oa_id"], r["stratum"], r["computed"]) for r in rows] == [
        (1, "E000", "AM", 1), (2, "E000", "All day", 0), (3, "E001", "AM", 1), (4, "E001", "All day", 0), (5, "E002", "AM", 0), (6, "E002", "All day", 0),
    ]


def costable(spark, n=6):
    made = spark.createDataFrame(
        [(i, 1, 1, "2021-01-05", "07:00", int(i == 5)) for i in range(1, n + 1)], "trip_id long, oa_id long, poi_id long, date string, time string, computed int"
    )
    oa = spark.createDataFrame([(1, 52.5, -1.9)], "oa_id long, lat double, lon double")
    return made, oa, spark.createDataFrame([(1, 52.51, -1.9)], "poi_id long, lat double, lon double")


def test_costing_flags_what_came_back(spark, tmp_path):
    from fairreach.catalog.served import reply_router
    from fairreach.plans.costing import cost_trips

    def router(batch, endpoint):
        if (batch["trip_id"] == 3).any():
            raise ValueError("trip three")
        return reply_router(batch[batch["trip_id"] != 4], endpoint)

    made, oa, poi = costable(spark)
    ledger = str(tmp_path / "ledger")
    done = cost_trips(made, oa, poi, router, ledger=ledger)
    assert sorted(r["trip_id"] for r in done.results.collect()) == [1, 2, 6]
    assert {r["trip_id"]: r["computed"] for r in done.trips.collect()} == {1: 1, 2: 1, 3: 0, 4: 0, 5: 1, 6: 1}
    assert {r["trip_id"]: r["reason"] for r in done.failures.collect()} == {3: "ValueError: trip three", 4: "no answer"}
    assert tuple(done.losses.first()) == (5, 2, 40.0)
    # the flags of the first run need not be kept: the ledger knows
    again = cost_trips(made, oa, poi, reply_router, ledger=ledger)
    assert tuple(again.losses.first()) == (2, 0, 0.0)
    assert sorted(r["trip_id"] for r in again.results.collect()) == [1, 2, 3, 4, 6] and again.failures.count() == 0
    empty = cost_trips(made, oa, poi, reply_router, ledger=ledger)
    assert empty.losses.first()["n"] == 0 and sorted(r["trip_id"] for r in empty.results.collect()) == [1, 2, 3, 4, 6]


def test_all_stamps_reach_the_product(spark, tables):
    from fairreach import catalog

    stamps = tables.orders.selectExpr("o_orderpriority", "o_orderdate", "o_orderkey * 37 % 1440").distinct().count()
    out = catalog.queries()["join_cross_all"](spark, "/root/testdata/sf0.001")
    made, ids = out.agg({"trips": "sum", "ids": "sum"}).select("sum(trips)", "sum(ids)").first()
    assert made == tables.fx_k_poi().count() * stamps
    assert ids == made * (made + 1) // 2


def test_keys_without_a_parent_raise(spark):
    child = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    combine.require_known(child, "k", spark.createDataFrame([("a",), ("b",), ("c",)], "p string"), "p")
    with pytest.raises(ValueError, match="b"):
        combine.require_known(child, "k", spark.createDataFrame([("a",)], "p string"), "p")


def test_replies_are_read_by_compiled_steps(spark):
    """Functions on arrays are kept out of the generators, which run uncompiled beside them; attributes change nothing."""
    ride = "<duration u='s'>{d}</duration><startTime>3600000</startTime><endTime>7200000</endTime><walkTime>60</walkTime>" \
        "<transitTime>120</transitTime><waitingTime>5</waitingTime><walkDistance>10</walkDistance><transfers>1</transfers>"
    legs = "<legs id='x'><legs><distance u='m'>30</distance></legs><legs><distance>12.5</distance></legs></legs>"
    one = lambda d: f"<itineraries k='v'>{ride.format(d=d)}{legs}</itineraries>"
    head = "<response v='1'><requestParameters><date>1970-01-01</date><time>01:30</time></requestParameters><error/>"
    xml = f"{head}<plan><itineraries>{one(7)}{one(200)}</itineraries></plan></response>"
    parsed = itinerary.parse_itineraries(spark.createDataFrame([(1, xml), (2, "<broken"), (3, None)], "id int, xml string"), "xml", ["id"])
    rows = {r["id"]: r for r in parsed.collect()}
    assert rows[1]["ok"] and rows[1]["total_time"] == 200 and rows[1]["total_dist"] == 42.5 and rows[1]["transit_dist"] == 32.5
    assert rows[1]["departure_time"] == "1970-01-01 02:00:00" and rows[1]["initial_wait_time"] == 1800
    assert not rows[2]["ok"] and not rows[3]["ok"]
    plan = parsed._jdf.queryExecution().executedPlan().toString().splitlines()
    generators = [line for line in plan if "Generate " in line]
    assert generators and not [line for line in generators if "lambdafunction" in line]
