"""Benchmark passages in training texts, found with an FM-index over each shard of texts.

A shard is a few megabytes of texts of one task. Words that no benchmark item has are equal to a
separator for this search, and a run of words between separators that is shorter than the shortest
window holds no match, so the index covers the other runs only. All windows are searched backwards at
once: the ranks come from a wavelet matrix over the Burrows-Wheeler transform, positions from sampled suffix positions
by walking back to the nearest sample. Nothing is shuffled; a lost task is done again on its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairreach.llm.common import ALNUM, fresh, ranges, slices, table
from fairreach.llm.registry import query
from fairreach.session import checkpoint_root

WINDOW = 10
#: Bytes of benchmark text that one pass over the texts searches for; a larger benchmark takes more passes.
BLOCK_BYTES = 16 << 20
#: Every such position of a suffix is stored; the others are reached in fewer steps than this.
STEP = 16


class Wavelet:
    """Ranks of symbols in an array: bits of the symbols by level, zeros first."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.levels = []
        for bit in reversed(range(max(1, int(largest).bit_length()))):
            ones = (symbols >> bit) & 1 == 1
            zeros = np.concatenate([[0], np.cumsum(~ones)]).astype(np.int32)
            self.levels.append((bit, zeros))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        self.first = self._down(np.arange(largest + 1), np.zeros(largest + 1, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, zeros in self.levels:
            below = zeros[at]
            at = np.where((symbol >> bit) & 1 == 1, zeros[-1] + at - below, below)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        return self._down(symbol, at) - self.first[symbol]


class FMIndex:
    """Full-text index of runs of symbols >= 1, each run followed by a 0."""

    def __init__(self, symbols: np.ndarray, largest: int):
        ends = symbols == 0
        order = np.where(ends, np.cumsum(ends) - 1, symbols + ends.sum())  # each end is a symbol of its own
        suffixes = self._suffixes(np.unique(order, return_inverse=True)[1])
        before = symbols[suffixes - 1]
        self.before = before
        self.counts = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=largest + 1))])
        self.wavelet = Wavelet(before, largest)
        self.sampled = (suffixes % STEP == 0) | (before == 0)  # a run's start is a sample, so no walk leaves its run
        self.sample_no = np.cumsum(self.sampled) - 1
        self.samples = suffixes[self.sampled]

    @staticmethod
    def _suffixes(rank: np.ndarray) -> np.ndarray:
        n, width = len(rank), 1
        while True:
            later = np.zeros(n, np.int64)
            later[: n - width] = rank[width:] + 1
            key = rank.astype(np.int64) * (n + 1) + later
            order = np.argsort(key)
            sorted_key = key[order]
            new = np.empty(n, np.int64)
            new[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
            rank, width = new, width * 2
            if width >= n or rank.max() == n - 1:
                return order

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end row of each phrase (rows of a matrix, all of one length), last word first."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), len(self.before), np.int64)
        live = np.arange(len(phrases))
        for column in reversed(range(phrases.shape[1])):
            c = phrases[live, column]
            low[live] = self.counts[c] + self.wavelet.rank(c, low[live])
            high[live] = self.counts[c] + self.wavelet.rank(c, high[live])
            live = live[low[live] < high[live]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of rows."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        walk = np.flatnonzero(~self.sampled[rows])
        while len(walk):
            c = self.before[rows[walk]]
            rows[walk] = self.counts[c] + self.wavelet.rank(c, rows[walk])
            steps[walk] += 1
            walk = walk[~self.sampled[rows[walk]]]
        return self.samples[self.sample_no[rows]] + steps


def text_words(text: bytes | None) -> list[bytes]:
    return text.translate(ALNUM).split() if text else []


class Phrases:
    """The distinct windows of some items and the items that have each."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.words: dict[bytes, int] = {}
        found: dict[tuple, set[str]] = {}
        for item, text in items:
            codes = tuple(self.words.setdefault(w, len(self.words) + 1) for w in text_words(text))
            for at in range(max(1, len(codes) - window + 1)) if codes else ():
                found.setdefault(codes[at : at + window], set()).add(item)
        self.by_size = {}
        for size in sorted({len(w) for w in found}):
            own = [(w, sorted(x)) for w, x in found.items() if len(w) == size]
            sizes = np.array([len(x) for _, x in own])
            names = [x for _, xs in own for x in xs]
            self.by_size[size] = (np.array([w for w, _ in own]), np.cumsum(sizes) - sizes, sizes, names)

    def find(self, lists: list[list[bytes]]) -> tuple[list, list]:
        """For each list of words: merged spans (first word, word after the last), and the items, sorted."""
        spans: list[list] = [[] for _ in lists]
        items: list[set] = [set() for _ in lists]
        if not self.by_size:
            return spans, items
        sizes = np.array([len(x) + 1 for x in lists])
        starts = np.cumsum(sizes) - sizes
        flat = np.zeros(int(sizes.sum()), np.int64)
        for words, at in zip(lists, starts.tolist(), strict=True):
            flat[at : at + len(words)] = np.fromiter(map(self.words.get, words, repeat(0)), np.int64, len(words))
        edge = np.diff(np.concatenate([[0], flat != 0, [0]]).astype(np.int8))
        run, size = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - np.flatnonzero(edge == 1)
        run, size = run[size >= min(self.by_size)], size[size >= min(self.by_size)]
        if not len(run):
            return spans, items
        place = ranges(run, size + 1)  # the place after a run holds a zero
        index = FMIndex(flat[place], len(self.words))
        change = np.zeros(len(flat) + 1, np.int64)
        for length, (phrases, first, many, names) in self.by_size.items():
            low, high = index.search(phrases)
            hits = place[index.locate(ranges(low, high - low))]
            if not len(hits):
                continue
            np.add.at(change, hits, 1)
            np.add.at(change, hits + length, -1)
            which = np.repeat(np.arange(len(phrases)), high - low)
            owner = np.searchsorted(starts, hits, "right") - 1
            for doc, phrase in np.unique(np.stack([owner, which], 1), axis=0).tolist():
                items[doc].update(names[first[phrase] : first[phrase] + many[phrase]])
        covered = np.diff(np.concatenate([[0], np.cumsum(change)[:-1] > 0, [0]]).astype(np.int8))
        begin, finish = np.flatnonzero(covered == 1), np.flatnonzero(covered == -1)
        owner = np.searchsorted(starts, begin, "right") - 1
        for doc, a, b in zip(owner.tolist(), (begin - starts[owner]).tolist(), (finish - starts[owner]).tolist(), strict=True):
            spans[doc].append((a, b))
        return spans, items


def _merged(old: list, new: list) -> list:
    out: list = []
    for a, b in sorted([*((x["begin"], x["finish"]) for x in old), *new]):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[str, bytes]]]:
    """The items in blocks of a bounded size, one at a time on the driver."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text"))
    items = items.where("item is not null and text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-total // BLOCK_BYTES))
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        rows = part.toArrow()
        yield sorted(zip(rows.column("item").to_pylist(), rows.column("text").to_pylist(), strict=True))


def find_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, names: tuple = ("n_words", "spans", "items")) -> DataFrame:
    """All rows and columns of ``docs`` with their word count, the merged spans of words to remove, and the items.

    A window is ``window`` consecutive words of an item, or the whole item where it has fewer (but not
    none). Null and empty texts have no words; items without an id, text or word are left out; items of one id count
    once. Windows that several items share are searched once and name all of them. Where ``docs`` has a column of one of
    the names, the new one gets underscores before its name.
    """
    checkpoint_root(docs.sparkSession)
    count, spans, items = names = tuple(fresh(docs, n) for n in names)
    empty = {count: "0L", spans: "cast(array() as array<struct<begin:bigint,finish:bigint>>)", items: "cast(array() as array<string>)"}
    out = docs.withColumns({n: F.expr(x) for n, x in empty.items()})
    found_type = pa.list_(pa.struct([("begin", pa.int64()), ("finish", pa.int64())]))
    for k, block in enumerate(_blocks(benchmark)):
        sent = docs.sparkSession.sparkContext.broadcast(Phrases(block, window))

        def run(batches: Iterator[pa.RecordBatch], sent=sent, first=not k) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, texts in slices(batch):
                    lists = [text_words(x) for x in texts]
                    new_spans, new_items = sent.value.find(lists)
                    at = {n: part.schema.names.index(n) for n in names}
                    if not first:
                        new_spans = [_merged(a, b) for a, b in zip(part.column(at[spans]).to_pylist(), new_spans, strict=True)]
                        new_items = [{*a, *b} for a, b in zip(part.column(at[items]).to_pylist(), new_items, strict=True)]
                    columns = list(part.columns)
                    columns[at[count]] = pa.array([len(x) for x in lists], pa.int64())
                    columns[at[spans]] = pa.array([[{"begin": a, "finish": b} for a, b in x] for x in new_spans], found_type)
                    columns[at[items]] = pa.array([sorted(x) for x in new_items], pa.list_(pa.string()))
                    yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

        if k:
            out = out.checkpoint()
        out = out.mapInArrow(run, out.schema)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which no window of the benchmark occurs, with their columns."""
    names = tuple(fresh(docs, n) for n in ("llm_words", "llm_spans", "llm_items"))
    found = find_passages(docs, benchmark, window, names)
    return found.where(F.size(names[1]) == 0).select([F.col(f"`{c}`") for c in docs.columns])


ORACLE = r"""
WITH doc AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents),
item AS (
    SELECT CAST(item_id AS VARCHAR) AS item_id,
        regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
win AS (
    SELECT DISTINCT item_id, size, array_to_string(list_slice(w, pos, pos + size - 1), ' ') AS phrase
    FROM (SELECT item_id, w, least(len(w), 10) AS size, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS pos FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM win),
gram AS (
    SELECT r, pos, size, array_to_string(list_slice(w, pos, pos + size - 1), ' ') AS phrase
    FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS pos FROM doc, sizes WHERE len(w) >= size)),
hit AS (SELECT r, pos, g.size, item_id FROM gram g JOIN win USING (size, phrase)),
word AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(pos, pos + size)) AS p FROM hit) GROUP BY r),
named AS (
    SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (r) LEFT JOIN named USING (r)
"""


@query("op9_benchmark_decontamination", ORACLE)
def op9(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_passages(docs, table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, x: n + x["finish"] - x["begin"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )
