"""Exact nearest binary codes by incremental multi-index hashing.

Codes of 64 bits are cut into four segments of 16, each with an index from segment value to rows. For a query the
segments are looked up at radius 0, then 1, 2, ...: once the first j segments are done at radius r and the
others at r - 1, every code within 4 r + j - 1 bits has been seen (if it differed by more in every segment, the
differences would add up to more). A query ends when its kth verified distance is within that bound.

Rows are dealt to shards, queries to blocks, and each (block, shard) cell answers its queries from its rows; the best
k of a query's cells are its answer. Cells hold a bounded share of both sides whatever the sizes, and no
query or row is collected to the driver.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairreach.llm.common import table
from fairreach.llm.registry import query
from fairreach.session import stored

#: Rows that a cell holds, about; queries that it holds at most, and those it is worth a task for.
SHARD_ROWS, BLOCK_QUERIES, LEAST_QUERIES = 1 << 16, 1 << 14, 128
SEGMENTS, WIDTH = 4, 16


def sign_codes(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id, code``: bit i of the code is 1 where component i is above 0.

    A null vector, null component or one that a shorter vector lacks gives bit 0; a vector with more than 64 components raises.
    """
    value = F.col(vector)
    message = F.concat(F.lit("a code has 64 bits, the vector has "), F.size(value).cast("string"))
    wide = F.when(F.size(value) > 64, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    rows = rows.where(wide)
    bits = [F.when(F.get(F.col(vector), F.lit(i)) > 0, F.lit(-(1 << 63) if i == 63 else 1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for i in range(64)]
    return rows.select("vec_id", functools.reduce(lambda a, b: a.bitwiseOR(b), bits).alias("code"))


@functools.lru_cache(maxsize=1)
def _masks() -> list[np.ndarray]:
    """The segment values with r bits set, for each r."""
    values = np.arange(1 << WIDTH)
    weight = np.bitwise_count(values)
    return [values[weight == r] for r in range(WIDTH + 1)]


class Index:
    """The four segment indexes over some codes."""

    def __init__(self, codes: np.ndarray, ids: np.ndarray):
        self.codes, self.ids = codes, ids
        self.parts = []
        for s in range(SEGMENTS):
            part = ((codes >> np.uint64(WIDTH * s)) & np.uint64((1 << WIDTH) - 1)).astype(np.int64)
            counts = np.bincount(part, minlength=1 << WIDTH)
            self.parts.append((np.argsort(part, kind="stable"), np.cumsum(counts) - counts, counts))

    def nearest(self, code: np.uint64, own: int, k: int, most: int = 64) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the k nearest by (distance, id), without the row ``own`` and those beyond ``most``."""
        seen = np.zeros(len(self.codes), bool)
        ids = dist = np.zeros(0, np.int64)
        for r, masks in enumerate(_masks()):
            for s, (rows, first, counts) in enumerate(self.parts):
                value = (int(code) >> (WIDTH * s)) & ((1 << WIDTH) - 1)
                at = value ^ masks
                at = at[counts[at] > 0]
                sizes = counts[at]
                if len(at):
                    before = np.cumsum(sizes) - sizes
                    found = rows[np.repeat(first[at] - before, sizes) + np.arange(sizes.sum())]
                    found = found[~seen[found]]
                    seen[found] = True
                    found = found[self.ids[found] != own]
                    ids = np.concatenate([ids, self.ids[found]])
                    dist = np.concatenate([dist, np.bitwise_count(self.codes[found] ^ code).astype(np.int64)])
                    if len(ids) > 4 * k:
                        best = np.lexsort((ids, dist))[:k]
                        ids, dist = ids[best], dist[best]
                # all codes within this many bits have been seen; equal distances are needed too, for the order by id
                kth = np.partition(dist, k - 1)[k - 1] if len(ids) >= k else most
                if min(kth, most) <= SEGMENTS * r + s:
                    ids, dist = ids[dist <= most], dist[dist <= most]
                    best = np.lexsort((ids, dist))[:k]
                    return ids[best], dist[best]
        best = np.lexsort((ids, dist))[:k]
        return ids[best], dist[best]


def top_k(rows: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``query_id, neighbor_id, distance, rank`` of the k rows nearest to each query, ties by id.

    Both tables have ``vec_id, code``. A query's own id is no neighbour of it. Rows and queries with a null id or code are left
    out; of rows with the same id and code one counts. With fewer than k other rows all of them are returned; empty tables give no rows.
    """
    for df in (rows, queries):
        if not isinstance(df.schema["vec_id"].dataType, T.IntegralType):
            raise ValueError("ids are whole numbers")
    spark = rows.sparkSession
    rows = stored(rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), "code").dropna().distinct(), "codes")
    queries = stored(queries.select(F.col("vec_id").cast("bigint").alias("vec_id"), "code").dropna().distinct(), "queries")
    n, asked = rows.count(), queries.count()
    # by the rows alone: each further shard adds k candidates a query
    shards = max(1, -(-n // SHARD_ROWS))
    # as many blocks as give every task a cell, if that leaves a cell some queries
    wanted = -(-2 * spark.sparkContext.defaultParallelism // shards)
    blocks = max(1, -(-asked // BLOCK_QUERIES), min(wanted, -(-asked // LEAST_QUERIES)))
    placed = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shards)).cast("int"))
    blocked = queries.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(blocks)).cast("int")).withColumn("most", F.lit(64))
    found = _search(placed.where("shard = 0"), blocked, [0], blocks, k)
    if shards > 1:
        # the kth distance in the first shard bounds how far the others have to look
        found = stored(found, "first")
        bounds = found.groupBy(F.col("query_id").alias("vec_id"), F.col("query_code").alias("code")).agg(F.max("distance").alias("kth"), F.count("*").alias("n"))
        bounded = blocked.drop("most").join(bounds, ["vec_id", "code"], "left").withColumn("most", F.when(F.col("n") >= k, F.col("kth")).otherwise(64))
        found = found.unionByName(_search(placed.where("shard > 0"), bounded.drop("kth", "n"), list(range(1, shards)), blocks, k))
    order = Window.partitionBy("query_id").orderBy("distance", "neighbor_id")
    return found.drop("query_code").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search(rows: DataFrame, queries: DataFrame, shards: list[int], blocks: int, k: int) -> DataFrame:
    """The nearest rows of each query (with its ``block`` and bound ``most``) in each of the shards."""

    def answer(own: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(own) and len(wanted):
            index = Index(own["code"].to_numpy(np.int64).view(np.uint64), own["vec_id"].to_numpy(np.int64))
            codes = wanted["code"].to_numpy(np.int64)
            for q, code, most in zip(wanted["vec_id"].tolist(), codes, wanted["most"].tolist(), strict=True):
                ids, dist = index.nearest(code.view(np.uint64), q, k, most)
                out.append(pd.DataFrame({"query_id": q, "query_code": code, "neighbor_id": ids, "distance": dist.astype(np.int32)}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "query_code": [], "neighbor_id": [], "distance": []}).astype("int64")

    cells = len(shards) * blocks
    data = rows.select("vec_id", "code", "shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    asked = queries.select("vec_id", "code", "most", "block", F.explode(F.lit(shards)).alias("shard"))
    # small cells would be put together into one task
    tasks = min(cells, 4096)
    met = [df.repartition(tasks, "block", "shard").groupBy("block", "shard") for df in (data, asked)]
    return met[0].cogroup(met[1]).applyInPandas(answer, "query_id bigint, query_code bigint, neighbor_id bigint, distance int")


ORACLE = """
WITH coded AS (
    SELECT DISTINCT vec_id, list_transform(range(1, 65), lambda i: CAST(coalesce(embedding[i], 0) > 0 AS INTEGER)) AS bits
    FROM embeddings WHERE vec_id IS NOT NULL),
pair AS (
    SELECT q.vec_id AS query_id, d.vec_id AS neighbor_id,
        CAST(list_sum(list_transform(list_zip(q.bits, d.bits), lambda z: abs(z[1] - z[2]))) AS INTEGER) AS distance
    FROM coded q JOIN coded d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id)
SELECT query_id, neighbor_id, distance, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank FROM pair) WHERE rank <= 10
"""


@query("op6_exact_top_k", ORACLE)
def op6(spark, sf_dir):
    codes = sign_codes(table(spark, sf_dir, "embeddings"))
    return top_k(codes, codes.where("vec_id % 50 = 0"), k=10)
