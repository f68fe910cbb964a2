"""Relations that must hold between the cube, its filters and the metrics."""

import pytest
from pyspark.sql import functions as F

from fairreach.operators import cube, risk
from fairreach.plans import serving

TYPES = ["Hospital", "School", "Childcare"]
STRATA = ["1-URGENT", "2-HIGH", "5-LOW"]


@pytest.fixture(scope="module")
def cells(tables):
    return tables.fx_cube().cache()


@pytest.fixture(scope="module")
def pop(tables):
    return tables.fx_pop().cache()


def test_cube_adds_up_to_the_rows(tables, cells):
    rows = tables.fx_results().agg(F.count("*"), F.sum("total_time"), F.sum(F.col("fare") ** 2)).first()
    cube_sums = cells.agg(F.sum("num_trips"), F.sum("sum_journey_time"), F.sum("sum_of_squared_fare")).first()
    assert rows[0] == cube_sums[0]
    assert list(rows)[1:] == pytest.approx(list(cube_sums)[1:])


def test_unmatched_results_keep_null_dimensions(tables):
    results = tables.fx_results().withColumn("trip_id", F.col("trip_id") + 10**9)
    rows = cube.summary_cube(results, tables.fx_trips(), tables.fx_poi(), tables.fx_strata()).collect()
    assert [(r["oa_id"], r["poi_type"], r["stratum"]) for r in rows] == [(None, None, None)]
    assert rows[0]["num_trips"] == results.count()


@pytest.mark.parametrize("metric", list(cube.METRICS))
def test_prefix_subsets_of_filters(cells, pop, metric):
    seen = 0
    for n in range(1, 4):
        part = cube.filter_cube(cells, TYPES[:n], STRATA[:n])
        areas = cube.access_metric(cells, metric, TYPES[:n], STRATA[:n])
        assert areas.count() == part.select("oa_id").distinct().count() >= seen
        seen = areas.count()
        high = cube.high_level(cells, metric, TYPES[:n], STRATA[:n]).first()
        assert 0 <= high["jains_index"] <= 1
        lo, hi = areas.agg(F.min("metric"), F.max("metric")).first()
        assert lo - 0.01 <= high["mean"] <= hi + 0.01
        groups = cube.demographic_level(cells, pop, metric, TYPES[:n], STRATA[:n]).collect()
        assert {g["population"] for g in groups} <= {"a", "n", "not_a"}
        assert all(lo - 0.01 <= g["wass"] <= hi + 0.01 for g in groups)


def test_ranks_are_a_permutation(cells, pop):
    high, areas, groups = serving.accessibility_metrics(cells, pop)
    rows = areas.orderBy("rank").collect()
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
    assert [r["metric"] for r in rows] == sorted(r["metric"] for r in rows)
    assert high.count() == 1 and groups.count() == 3


def test_unknown_metrics(cells, pop):
    with pytest.raises(ValueError, match="Not found"):
        cube.access_metric(cells, "speed")
    with pytest.raises(ValueError, match="Not found"):
        serving.population_metrics(cells, pop, "happiness")


def test_single_trip_has_no_deviation(spark):
    one = {c: 4.0 for c in cube.moment_columns()} | {"num_trips": 1, "oa_id": "E", "poi_type": "t", "stratum": "s"}
    row = cube.high_level(spark.createDataFrame([one]), "fare").first()
    assert row["variance"] is None and row["mean"] == 4.0


def test_at_risk_skips_empty_groups(spark):
    zeros = {c: 0.0 for c in cube.moment_columns()}
    cells = spark.createDataFrame([zeros | {"num_trips": 2, "sum_generalised_cost": 20.0, "oa_id": a, "poi_type": "t", "stratum": "s"} for a in "wxyz"])
    rows = [(a, "total", n) for a, n in zip("wxyz", [40, 30, 20, 10])] + [("w", "elderly", 0), ("x", "elderly", 5), ("y", "elderly", 2)]
    pop = spark.createDataFrame(rows, "oa_id string, population string, count int")
    got = {r["oa_id"]: r["metric"] for r in risk.at_risk(cells, pop, ["elderly"]).collect()}
    # three of four areas count; the first has nobody in the group and is not replaced
    assert got == {"x": 2.0, "y": 5.0}
    top = {r["oa_id"]: r["at_risk_score"] for r in risk.at_risk_topk(cells.where("oa_id <> 'x'"), pop, 2).collect()}
    assert top == {"w": 0.25, "x": None}


def test_metric_names_come_from_the_columns(spark):
    from fairreach.operators.cube import metric_names
    from fairreach.plans.serving import meta_access_metrics

    cube = spark.createDataFrame([(1, 2.0, 4.0, 3.0)], "num_trips long, sum_journey_time double, sum_of_squared_journey_time double, sum_fare double")
    assert metric_names(cube) == ["sum_journey_time", "sum_fare"]
    assert meta_access_metrics(cube).count() == 2


def test_entity_refuses_repeated_keys(spark):
    import pytest

    from fairreach.operators.combine import entity

    a = spark.createDataFrame([(1, 2), (1, 3)], "k long, a long")
    b = spark.createDataFrame([(1, 5), (2, 6)], "k long, b long")
    with pytest.raises(Exception, match="is repeated in one of"):
        entity({"a": a, "b": b}, ["k"]).collect()
    assert sorted(map(tuple, entity({"a": a.where("a = 2"), "b": b}, ["k"]).collect()), key=str) == [(1, 2, 5), (2, None, 6)]


def test_order_lines_are_counted_after_the_join_with_their_area(tables):
    wide = tables.fx_wide()
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [o_custkey" in plan and "Aggregate [l_orderkey" not in plan
    counted = wide.agg(*[F.sum(f"flag_{f}") for f in "anr"]).first()
    lines = tables.lineitem.join(tables.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    assert list(counted) == [lines.where(F.col("l_returnflag") == f).count() for f in "ANR"]
