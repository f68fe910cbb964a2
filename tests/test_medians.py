import random

import pytest
from pyspark.sql import functions as F

from fairreach.operators import medians
from fairreach.operators.reshape import to_long
from fairreach.plans.serving import map_from_results
from fairreach.session import stored


def plain(rows):
    groups = {}
    for k, s, v in rows:
        groups.setdefault((k, s), []).append(v)
    out = {}
    for key, values in groups.items():
        known = sorted(v for v in values if v is not None)
        out[key] = known[(len(known) + 1) // 2 - 1] if known else None
    return out


def sample():
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "a", "a", "b", None]), rnd.choice("xyz"), rnd.choice([None, 1.0, 2.0, rnd.random()])) for _ in range(800)]
    return [*rows, ("nulls", "x", None), ("nulls", "x", None), ("one", "x", 4.0)]


def test_medians_equal_sorted_lists(spark):
    rows = sample()
    df = spark.createDataFrame(rows, "k string, s string, v double")
    got = {(r["k"], r["s"]): r["v"] for r in medians.median_by(df, ["k", "s"], "v").collect()}
    assert got == plain(rows)


def test_a_value_most_rows_share_ends_the_rounds(spark, monkeypatch):
    monkeypatch.setattr(medians, "GROUP_VALUES", 1000)
    df = spark.range(200_000, numPartitions=8).select(F.lit("a").alias("k"), F.when(F.col("id") % 10 > 0, 2.4).otherwise(F.col("id") % 1000 / 10).alias("v"))
    assert medians.median_by(df, ["k"], "v").first()["v"] == 2.4


def test_all_times_is_a_median_of_values(spark):
    rows = sample()
    df = spark.createDataFrame(rows, "k string, s string, v double")
    want = plain(rows) | {(k, medians.ALL_TIMES): v for (k, _), v in plain([(k, None, v) for k, _, v in rows]).items()}
    got = {(r["k"], r["s"]): r["v"] for r in medians.median_with_all(df, ["k", "s"], "s", "v").collect()}
    assert got == want


def test_scale(spark):
    df = spark.createDataFrame([("t", 120.0), ("d", 120.0)], "metric string, value double")
    assert sorted(tuple(r) for r in medians.scale_metrics(df, ["t"]).collect()) == [("d", 120.0), ("t", 2.0)]
    assert medians.best_poi(df.select(F.lit(1).alias("oa_id"), "metric", "value"), ["oa_id"]).first()["value"] == 120.0


def test_large_groups_are_narrowed_down(spark, monkeypatch):
    """A million different values: no aggregate over a group takes more than its share, and the median is exact."""

    monkeypatch.setattr(medians, "GROUP_VALUES", 1000)
    taken = []
    at_rank = medians._at_rank

    def counting(rows, groups, keys, value):
        taken.append([r["_left"] for r in groups.where("_lo < _hi").collect()])
        return at_rank(rows, groups, keys, value)

    monkeypatch.setattr(medians, "_at_rank", counting)
    n = 1_000_001
    even = spark.range(n).select(F.lit("even").alias("k"), (F.col("id") * 7919 % n).cast("double").alias("v"))
    steep = spark.range(50_000).select(F.lit("steep").alias("k"), F.pow(F.lit(10.0), F.col("id") / 50_000 * 30 - 15).alias("v"))
    alike = spark.range(50_000).select(F.lit(None).cast("string").alias("k"), F.when(F.col("id") % 3 == 0, F.col("id").cast("double")).otherwise(2.5).alias("v"))
    few = spark.createDataFrame([("few", 1.0), ("few", None), ("few", 3.0), ("none", None)], "k string, v double")
    df = even.union(steep).union(alike).union(few)
    got = {r["k"]: r["v"] for r in medians.median_by(df, ["k"], "v").collect()}
    steeps = sorted(10.0 ** (i / 50_000 * 30 - 15) for i in range(50_000))
    assert got["even"] == (n - 1) // 2 and got["few"] == 1.0 and got["none"] is None
    assert abs(got["steep"] / steeps[24_999] - 1) < 1e-12
    values = sorted(float(i) if i % 3 == 0 else 2.5 for i in range(50_000))
    assert got[None] == values[24_999] == 2.5
    assert max(x for left in taken for x in left) <= 1000


def test_strata_and_all_times_share_a_shuffle(spark):
    df = spark.createDataFrame(sample(), "k string, s string, v double")
    plan = medians.median_with_all(df, ["k", "s"], "s", "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_large_groups_beside_small_ones_by_stratum(spark, monkeypatch):
    """Groups that are large over all strata only, in one stratum too, or not at all."""
    monkeypatch.setattr(medians, "GROUP_VALUES", 100)
    rows = sample() + [(None, "y", float(i % 7)) for i in range(150)] + [("few", s, float(i)) for i in range(30) for s in "xy"]
    df = spark.createDataFrame(rows, "k string, s string, v double")
    want = plain(rows) | {(k, medians.ALL_TIMES): v for (k, _), v in plain([(k, None, v) for k, _, v in rows]).items()}
    got = medians.median_with_all(df, ["k", "s"], "s", "v").collect()
    assert len(got) == len(want) and {(r["k"], r["s"]): r["v"] for r in got} == want


def folded_sample(spark):
    """Rows that each stand for their strata and both metrics, and the long rows they stand for."""
    rows = [(k, [(s,), ("w",)] if i % 3 else [(s,)], v, None if i % 5 == 0 else float(i % 11)) for i, (k, s, v) in enumerate(sample())]
    long = [((k, m), s, v) for k, strata, *values in rows for (s,) in strata for m, v in zip("vu", values)]
    return spark.createDataFrame(rows, "k string, s array<struct<s: string>>, v double, u double"), long


def unfold(rows):
    return to_long(rows.withColumnRenamed("s", "_s").select("k", F.inline("_s"), "v", "u"), {"v": "v", "u": "u"}, ["k", "s"])


@pytest.mark.parametrize("large, place", [(100_000, 100_000), (100, 100_000), (100_000, 100), (100, 200)])
def test_rows_that_stand_for_several_are_folded_until_they_are_sorted(spark, monkeypatch, large, place):
    monkeypatch.setattr(medians, "GROUP_VALUES", large)
    monkeypatch.setattr(medians, "PLACE_ROWS", place)
    df, long = folded_sample(spark)
    want = plain(long) | {(k, medians.ALL_TIMES): v for (k, _), v in plain([(k, None, v) for k, _, v in long]).items()}
    found = medians.median_with_all(df, ["k", "s", "metric"], "s", "value", unfold, ["k"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    got = found.collect()
    assert len(got) == len(want) and {((r["k"], r["metric"]), r["s"]): r["value"] for r in got} == want
    if min(large, place) > len(long):
        # the rows are shuffled once, before they are made long
        assert plan.count("Exchange") == 1 and plan.index("Exchange") > plan.rindex("Generate")


def test_results_of_the_map_are_stored_once_each(spark, monkeypatch):
    """Neither strata that share a time nor metrics multiply what is stored and shuffled."""
    kept = []

    def counting(df, label):
        out = stored(df, label)
        kept.append((label, out.count()))
        return out

    monkeypatch.setattr(medians, "stored", counting)
    results = spark.createDataFrame([(i, float(i), i * 2.0) for i in range(60)], "trip_id long, a double, b double")
    trips = spark.range(60).select(F.col("id").alias("trip_id"), (F.col("id") % 2).alias("oa_id"), F.lit(7).alias("poi_id"), F.lit("d").alias("date"), F.lit("t").alias("time"))
    times = spark.createDataFrame([("d", "t", s) for s in ("x", "y", "y", None)], "date string, time string, stratum string")
    kinds = spark.createDataFrame([(0, 7, "School"), (1, 7, "School")], "oa_id long, poi_id int, poi_type string")
    got = map_from_results(results, trips, times, kinds, {"a": "a", "b": "b"}).collect()
    assert [n for label, n in kept if label == "values"] == [60]
    want = {(oa, s, m): float((28 + oa) * f) for oa in (0, 1) for s in ("x", "y", None, "All times") for m, f in (("a", 1), ("b", 2))}
    assert {(r["oa_id"], r["stratum"], r["metric"]): r["value"] for r in got} == want and len(got) == len(want)
