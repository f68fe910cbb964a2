import pytest
from pyspark.sql import functions as F

from fairreach.operators import numbering


def test_numbers_follow_the_order_even_when_a_value_dominates(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 50).alias("v"))
    rows = numbering.number_rows(df, [F.col("v").desc(), "id"], "n").collect()
    want = sorted(((-r["v"], r["id"]) for r in rows))
    got = [(-r["v"], r["id"]) for r in sorted(rows, key=lambda r: r["n"])]
    assert got == want
    assert sorted(r["n"] for r in rows) == list(range(1, 3001))


def test_no_single_task_over_the_data(spark):
    df = spark.range(100).withColumn("v", F.col("id") % 5)
    plan = numbering.number_rows(df, ["v", "id"])._jdf.queryExecution().executedPlan().toString()
    # the one SinglePartition exchange is over the row counts per partition
    assert plan.count("SinglePartition") <= 1


def test_rank(spark):
    df = spark.createDataFrame([("E001", 0), ("E003", 10), ("E002", 5)], "oa_id string, v int")
    rows = {r["oa_id"]: (r["metric"], r["rank"]) for r in numbering.add_rank(df, "v", "oa_id").collect()}
    assert rows == {"E001": (0, 1), "E002": (5, 2), "E003": (10, 3)}
    assert numbering.add_rank(df.limit(0), "v", "oa_id").count() == 0
    assert numbering.add_rank(df.limit(1), "v", "oa_id").first()["rank"] == 1


def test_sort_by_value(spark):
    df = spark.createDataFrame([("E001", 0), ("E003", 10), ("E002", 5)], "oa_id string, v int")
    assert [r["oa_id"] for r in numbering.sort_by_value(df, "v").collect()] == ["E001", "E002", "E003"]
    assert [r["oa_id"] for r in numbering.sort_by_value(df, "v", reverse=True).collect()] == ["E003", "E002", "E001"]


@pytest.mark.parametrize(("limit", "offset"), [(10, 5), (20, 9990), (0, 0), (15000, 100)])
def test_page(spark, limit, offset):
    df = spark.range(12000).select((F.lit(12000) - F.col("id")).alias("k"))
    got = sorted(r["k"] for r in numbering.page(df, "k", limit, offset).collect())
    assert got == list(range(1, 12001))[offset : offset + limit]


def test_a_far_page_reads_its_own_files(spark, tmp_path):
    from fairreach.sources.paged_table import PagedTable

    table = PagedTable(spark, str(tmp_path / "t"), "k")
    table.write(spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"), F.lit(0).alias("computed")), file_rows=50)
    assert table.directory.read().count() == 20
    for limit, offset in [(30, 960), (120, 400), (10, 0), (50, 990), (5, 2000)]:
        page = table.page(limit, offset)
        assert [r["k"] for r in page.collect()] == list(range(1000))[offset : offset + limit]
        if offset < 1000:
            assert len(page.inputFiles()) <= limit / 50 + 3
    before = {r["file"] for r in table.directory.read().collect()}
    table.update_page(60, 500, computed=F.lit(1))
    after = {r["file"] for r in table.directory.read().collect()}
    assert len(before - after) <= 3 and len(before & after) >= 17
    rows = sorted(tuple(r) for r in table.read().collect())
    assert rows == [(k, int(500 <= k < 560)) for k in range(1000)]
