"""Near-duplicates by SimHash fingerprints, found with vantage-point trees.

Fingerprints within ``r`` bits of each other agree to within ``r // 3`` bits on one of three segments.
For each segment a vantage-point tree is grown over a bounded sample: a node parts the values by their
Hamming distance to a vantage value, inner half up to the median, outer half beyond it. Its leaves are
the shards. Every distinct fingerprint has one home leaf and also visits each later leaf that its ball
overlaps by the triangle bound, so every close pair meets in exactly one shard a segment. Inside a shard the same
split goes on while many homes are left, and what remains is compared in full (all 64 bits). A shard far fuller than
the others (near copies share segments, hence leaves) is dealt into blocks, and each two blocks meet in a task of their own.

Shards send on a spanning forest of their links, not all pairs, so a group of thousands of near copies
gives one edge a member. Exact copies are one fingerprint from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairreach.llm.common import LOWER, append_columns, fresh, table
from fairreach.llm.graph import components
from fairreach.llm.registry import query
from fairreach.session import scratch_path, stored

#: Segments of a fingerprint: lowest bit and width.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Leaves of a tree at most, and fingerprints that it is grown from (a leaf, and in all at least): with MOST_LEAVES a million.
MOST_LEAVES = 1 << 16
SAMPLE_A_LEAF, SAMPLE = 16, 32_768
#: Distinct fingerprints that a leaf should hold, and homes that a shard compares without another split.
LEAF = 1_024
FLAT = 2_048
#: Rows of a shard: four times the mean, but within these bounds; fuller ones are dealt into blocks of half as many.
#: The lower bound is what a task compares in full in about ten seconds; the copies of a row grow with its shard's blocks.
TASK_ROWS = (1 << 16, 1 << 22)
#: Hashes whose bits are counted at once, and sides of a block of comparisons.
_CHUNK = 1 << 16
_ROWS, _COLS = 512, 4_096


def simhash(texts: list, shingle: int) -> np.ndarray:
    """Fingerprints (uint64) of texts given as bytes; None and texts without words give 0."""
    counts = np.zeros((len(texts), 64), np.int64)
    totals = np.zeros(len(texts), np.int64)
    hashes: list[int] = []
    owners: list[tuple[int, int]] = []
    digest = xxhash.xxh64_intdigest

    def count() -> None:
        if not hashes:
            return
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sizes = [n for _, n in owners]
        sums = np.add.reduceat(bits, np.cumsum([0, *sizes[:-1]]), axis=0, dtype=np.int64)
        np.add.at(counts, [k for k, _ in owners], sums)
        hashes.clear()
        owners.clear()

    for k, text in enumerate(texts):
        words = text.translate(LOWER).split() if text else []
        if not words:
            continue
        joined = b" ".join(words)
        if len(words) <= shingle:
            spans = [(0, len(joined))]
        else:
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate([[0], ends[: -shingle] + 1])
            spans = list(zip(starts.tolist(), ends[shingle - 1 :].tolist(), strict=True))
        totals[k] = len(spans)
        for at in range(0, len(spans), _CHUNK):
            part = spans[at : at + _CHUNK]
            hashes.extend([digest(joined[a:b], 42) for a, b in part])
            owners.append((k, len(part)))
            if len(hashes) >= _CHUNK:
                count()
    count()
    set_bits = (2 * counts > totals[:, None]).astype(np.uint8)
    return np.packbits(set_bits, axis=1, bitorder="little").view("<u8").ravel()


def with_fingerprint(docs: DataFrame, shingle: int = 4, name: str = "fingerprint") -> DataFrame:
    """All rows and columns of ``docs`` with the fingerprint of ``text`` as a signed long.

    Where ``docs`` has a column of that name, the new one gets underscores before its name.
    """
    return append_columns(docs, {name: "bigint"}, lambda texts: [pa.array(simhash(texts, shingle).view(np.int64))])


class Tree:
    """A vantage-point tree over one segment; ``leaf`` is -1 at inner nodes."""

    def __init__(self, sample: np.ndarray, low: int, width: int, leaves: int):
        self.low, self.mask = low, (1 << width) - 1
        self.vantage, self.radius, self.inner, self.outer, self.leaf = [], [], [], [], []
        self.leaves = 0
        values = self.part(sample)
        least = max(8, -(-len(values) // max(1, leaves)))
        todo = [(values, self._node())]
        while todo:
            values, at = todo.pop()
            split = self._split(values) if len(values) > least and self.leaves + len(todo) < leaves else None
            if split is None:
                self.leaf[at] = self.leaves
                self.leaves += 1
                continue
            self.vantage[at], self.radius[at], near = split
            self.inner[at], self.outer[at] = self._node(), self._node()
            todo += [(values[~near], self.outer[at]), (values[near], self.inner[at])]
        for k in ("vantage", "radius", "inner", "outer", "leaf"):
            setattr(self, k, np.array(getattr(self, k), np.int64))

    def part(self, fingerprints: np.ndarray) -> np.ndarray:
        return ((fingerprints.view(np.uint64) >> np.uint64(self.low)) & np.uint64(self.mask)).astype(np.int64)

    def _node(self) -> int:
        for k, x in (("vantage", 0), ("radius", 0), ("inner", -1), ("outer", -1), ("leaf", -1)):
            getattr(self, k).append(x)
        return len(self.leaf) - 1

    @staticmethod
    def _split(values: np.ndarray) -> tuple[int, int, np.ndarray] | None:
        """Of a few vantage values the one that parts best: few values near its median distance, halves of one size."""
        best = None
        for v in values[:: max(1, len(values) // 5)][:5].tolist():
            d = np.bitwise_count(values ^ v)
            radius = int(np.median(d))
            near = d <= radius
            if near.all():
                radius -= 1
                near = d <= radius
            if not near.any() or near.all():
                continue
            cost = abs(2 * near.sum() - len(values)) + ((d == radius) | (d == radius + 1)).sum()
            if best is None or cost < best[0]:
                best = (cost, v, radius, near)
        return best and best[1:]

    def route(self, fingerprints: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, leaf and whether it is the row's home, for the home and every later leaf within reach."""
        values = self.part(fingerprints)
        row, node, home = np.arange(len(values)), np.zeros(len(values), np.int64), np.ones(len(values), bool)
        out = []
        while len(row):
            done = self.leaf[node] >= 0
            out.append((row[done], self.leaf[node[done]], home[done]))
            row, node, home = row[~done], node[~done], home[~done]
            d = np.bitwise_count(values[row] ^ self.vantage[node]).astype(np.int64)
            radius = self.radius[node]
            # leaves are numbered from the inner side: a visit is kept where it is later than the home
            own = d <= radius
            go_in = np.where(home, own, d - reach <= radius)
            go_out = d + reach > radius
            row, home = np.concatenate([row[go_in], row[go_out]]), np.concatenate([home[go_in], (home & ~own)[go_out]])
            node = np.concatenate([self.inner[node[go_in]], self.outer[node[go_out]]])
        rows, leaves, homes = (np.concatenate(x) for x in zip(*out, strict=True))
        return rows, leaves, homes


def _hook(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the sets of each pair (i, j)."""
    while len(i):
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up
        i, j = parent[i], parent[j]
        apart = i != j
        i, j = i[apart], j[apart]
        np.minimum.at(parent, np.maximum(i, j), np.minimum(i, j))


def shard_links(fingerprints: np.ndarray, home: np.ndarray, low: int, width: int, most: int, within: bool = True) -> np.ndarray:
    """Root of each row of a shard when rows within ``most`` bits are joined, home to home and home to visitor.

    Without ``within`` homes are not compared with one another: the two kinds are blocks that have met themselves elsewhere.
    """
    parent = np.arange(len(fingerprints))
    mask = np.uint64((1 << width) - 1)
    values = (fingerprints >> np.uint64(low)) & mask
    todo = [(np.flatnonzero(home), np.flatnonzero(~home))]
    reach = most // len(SEGMENTS)
    while todo:
        homes, visitors = todo.pop()
        d = np.bitwise_count(values[homes] ^ values[homes[0]]).astype(int) if len(homes) > FLAT else np.zeros(1, int)
        radius = int(np.median(d))
        near = d <= radius
        if near.all():
            radius = int(d.max()) - 1
            near = d <= radius
        if len(homes) > FLAT and near.any():
            dv = np.bitwise_count(values[visitors] ^ values[homes[0]]).astype(int)
            todo.append((homes[near], visitors[dv - reach <= radius]))
            crossing = homes[near & (d + reach > radius) & within]
            todo.append((homes[~near], np.concatenate([visitors[dv + reach > radius], crossing])))
            continue
        others = np.concatenate([homes, visitors]) if within else visitors
        for a in range(0, len(homes), _ROWS):
            left = homes[a : a + _ROWS]
            for b in range(a // _COLS * _COLS if within else 0, len(others), _COLS):
                right = others[b : b + _COLS]
                close = np.bitwise_count(fingerprints[left][:, None] ^ fingerprints[right][None, :]) <= most
                i, j = np.nonzero(close)
                i, j = left[i], right[j]
                apart = parent[i] != parent[j]
                _hook(parent, i[apart], j[apart])
    while (parent != parent[parent]).any():
        parent = parent[parent]
    return parent


def _block(values: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Block of each fingerprint among ``many``, by a mix of all its bits."""
    mixed = values.view(np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % many.astype(np.uint64)).astype(np.int32)


def links(fingerprints: DataFrame, most: int = 4) -> DataFrame:
    """Edges ``(a, b)`` that join all distinct ``fingerprint`` values within ``most`` bits, a forest in each task."""
    spark = fingerprints.sparkSession
    distinct = stored(fingerprints.select("fingerprint").where(F.col("fingerprint").isNotNull()).distinct(), "fingerprints")
    n = distinct.count()
    leaves = min(MOST_LEAVES, -(-n // LEAF))
    wanted = max(SAMPLE, leaves * SAMPLE_A_LEAF)
    # the lowest hashes, about as many as wanted: a filter, so that nothing is sorted
    below = min((1 << 63) - 1, (1 << 64) * wanted // max(n, 1) - (1 << 63))
    sample = distinct.where(F.xxhash64("fingerprint") <= F.lit(below).cast("bigint")).toArrow()
    sample = np.sort(sample.column(0).to_numpy().astype(np.int64))[_order(sample.num_rows)]
    reach = most // len(SEGMENTS)
    trees = spark.sparkContext.broadcast([Tree(sample, low, width, leaves) for low, width in SEGMENTS])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, tree in enumerate(trees.value):
                shard, many = np.unique(k * MOST_LEAVES + tree.route(batch.column(0).to_numpy(), reach)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array(many, pa.int64())], names=["shard", "n"])

    # one row for each shard, so its number is bounded by MOST_LEAVES
    sizes = distinct.mapInArrow(count, "shard int, n bigint").groupBy("shard").agg(F.sum("n").cast("bigint").alias("n")).toArrow()
    rows = sizes.column("n").to_numpy().astype(np.int64)
    room = min(TASK_ROWS[1], max(TASK_ROWS[0], 4 * int(rows.mean()) if len(rows) else 0))
    many = np.ones(len(SEGMENTS) * MOST_LEAVES, np.int32)
    many[sizes.column("shard").to_numpy()] = np.where(rows > room, -(-2 * rows // room), 1)
    blocks = spark.sparkContext.broadcast(many)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy()
            for k, tree in enumerate(trees.value):
                at, leaf, home = tree.route(values, reach)
                shard = k * MOST_LEAVES + leaf
                times = blocks.value[shard]
                own = _block(values[at], times)
                # a row goes to its block paired with each block of its shard
                copy = np.repeat(np.arange(len(at)), times)
                other = (np.arange(len(copy)) - np.repeat(np.cumsum(times) - times, times)).astype(np.int32)
                own = own[copy]
                columns = [shard[copy].astype(np.int32), np.minimum(own, other), np.maximum(own, other), values[at[copy]]]
                flags = [home[copy], own < other]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns + flags], names=["shard", "one", "two", "fingerprint", "home", "first"])

    def join(group: pa.Table) -> pa.Table:
        values = group.column("fingerprint").to_numpy().astype(np.int64)
        shard, one, two = (group.column(c)[0].as_py() for c in ("shard", "one", "two"))
        side = group.column("home" if one == two else "first").to_numpy(zero_copy_only=False)
        root = shard_links(values.view(np.uint64), side, *SEGMENTS[shard // MOST_LEAVES], most, one == two)
        joined = np.flatnonzero(root != np.arange(len(root)))
        return pa.table({"a": values[joined], "b": values[root[joined]]})

    dealt = distinct.mapInArrow(deal, "shard int, one int, two int, fingerprint bigint, home boolean, first boolean")
    return dealt.groupBy("shard", "one", "two").applyInArrow(join, "a bigint, b bigint")


def _order(n: int) -> np.ndarray:
    """A fixed shuffle, as the trees take their vantage values by place."""
    return np.random.default_rng(7).permutation(n)


def near_duplicates(docs: DataFrame, shingle: int = 4, most: int = 4) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row: components of fingerprints within ``most`` bits.

    Nulls and empty texts have fingerprint zero and link like any other; a text with fewer words than a
    shingle is one shingle. component_id is the smallest doc_id that is reachable (null ids are passed over,
    so null only where all are null). Repeated rows are kept. An empty table gives no rows.
    """
    path = scratch_path(docs.sparkSession, "simhash")
    with_fingerprint(docs.select("doc_id", "text"), shingle).select("doc_id", "fingerprint").write.parquet(path)
    rows = docs.sparkSession.read.parquet(path)
    return rows.join(classes(rows, most), "fingerprint").select("doc_id", "fingerprint", "component_id")


def classes(rows: DataFrame, most: int, least: str = "doc_id") -> DataFrame:
    """``fingerprint, component_id`` for each distinct fingerprint; component_id is the component's smallest ``least``."""
    roots = components(links(rows, most)).withColumnRenamed("node", "fingerprint")
    firsts = rows.groupBy("fingerprint").agg(F.min(least).alias("first"))
    rooted = firsts.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(ids, "root").select("fingerprint", "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, most: int = 4) -> DataFrame:
    """One row of each component, with the columns of ``docs``: that of the smallest doc_id.

    Rows with the same doc_id in a component are told apart by a hash of the whole row, and of rows that are the same in
    every column one stays. Null ids come last.
    """
    names = docs.columns
    spark = docs.sparkSession
    docs = docs.select([F.col(f"`{c}`") for c in names])
    hashed = [F.col(f"`{c}`").cast("string") if "map" in t else F.col(f"`{c}`") for c, t in docs.dtypes]
    key, code, finger = (fresh(docs, c) for c in ("llm_id", "llm_row", "fingerprint"))
    keyed = docs.withColumns({key: F.col("doc_id"), code: F.xxhash64(*hashed)})
    path = scratch_path(spark, "simhash-rows")
    marked = with_fingerprint(keyed.select(key, code, "text"), shingle, finger)
    place = F.struct(F.col(key).isNull().alias("no_id"), F.col(key).alias("id"), F.col(code).alias("row"))
    marked.select(place.alias("place"), F.col(finger).alias("fingerprint")).write.parquet(path)
    rows = spark.read.parquet(path)
    firsts = classes(rows, most, "place").select("component_id").distinct()
    # rows that share the place are the same in every column: only those, if there are any, need a distinct
    counted = rows.groupBy("place").count().join(firsts, F.col("place") == F.col("component_id"), "left_semi")
    path = scratch_path(spark, "simhash-kept")
    counted.select(F.col("place.id").alias("id"), F.col("place.row").alias("row"), "count").write.parquet(path)
    kept = spark.read.parquet(path)
    same = F.col(key).eqNullSafe(F.col("id")) & (F.col(code) == F.col("row"))
    out = keyed.join(kept.where("count = 1"), same, "left_semi")
    if not kept.where("count > 1").isEmpty():
        out = out.unionByName(keyed.join(kept.where("count > 1"), same, "left_semi").dropDuplicates([key, code]))
    return out.select([F.col(f"`{c}`") for c in names])


@query("op2_simhash_near_dedup")
def op2(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=4, most=4)
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))

