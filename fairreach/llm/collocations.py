"""Collocations: phrases whose words come together more often than their parts do.

Phrases are counted size by size, and a phrase is looked at only where its shorter parts may be frequent (a part is never
rarer than the whole, so nothing is lost): first words, then pairs, then all longer sizes over runs of frequent pairs. What
may be frequent is read from a bitmap of fixed size that is broadcast; where it says yes by mistake, a phrase is counted that
the minimum then removes, so its size changes the work and no result.

A task counts in a HAT-trie over word ids: the first word leads to a container, a hash table of the words that follow;
one that has grown past BURST entries bursts into up to 256 containers by the next byte of the ids. When the trie
has too many entries its largest subtrees are spilled, each as a sorted run, and so is everything at the end. Runs are dealt by
their prefix (all words of a pair but the last, two words of a longer phrase) to partitions, where the runs of a partition
are merged. A prefix with more than a 65,536th of all words is dealt by whole phrases, so no partition has to hold a common
word's phrases; there are fewer than 65,536 such prefixes whatever the size of the corpus, and this list is broadcast.

A word's id is its XXH64. If two words of the corpus share one, another salt is taken, so ids are exact.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fairreach.llm.common import SLICE_BYTES, slices, table
from fairreach.llm.registry import query
from fairreach.session import stored

#: Entries after which a container bursts, and those a task's tries hold at most before subtrees are spilled.
BURST, MOST_ENTRIES = 1 << 13, 1_000_000
#: Different words a task counts before it sends them on.
MOST_WORDS = 500_000
#: Words of the corpus for each partition that runs are merged in.
PARTITION_WORDS = 1 << 20
#: Size of the bitmap: a power of two, BITS_PER_PHRASE bits a phrase or more, at most MOST_BITS (32 MB).
BITS_PER_PHRASE, MOST_BITS, BLOCK_BITS = 32, 1 << 28, 1 << 16
#: A prefix with more than this part of all words is dealt by whole phrases.
HEAVY_PART = 1 << 16

#: What ends a piece becomes a dot; A-Z in lower case; a tab is a space.
_PIECES = bytes(b + 32 if 65 <= b <= 90 else 46 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256))
_DOT = b"."
_M1, _M2, _M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def word_ids(words: list[bytes], salt: bytes = b"") -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh64_intdigest(w + salt, 42) for w in words), np.uint64, len(words))


def phrase_hashes(lang: str, *ids: np.ndarray) -> np.ndarray:
    """A number for each phrase, whose words' ids are given word by word; it is used to prune and to deal, never as the phrase."""
    h = word_ids([lang.encode()])
    for column in ids:
        h = _mix(h * _M3 + column)
    return h


def _blocks(batch: pa.RecordBatch, most: int = SLICE_BYTES) -> Iterator[tuple[str, bytes]]:
    """The texts of a batch by language, with pieces apart by dots, in blocks of about ``most`` bytes that end where a piece does."""
    for part, texts in slices(batch, most=most):
        by_lang = defaultdict(list)
        for lang, text in zip(part.column(part.schema.names.index("lang")).to_pylist(), texts, strict=True):
            if text:
                by_lang[lang].append(text)
        for lang, own in by_lang.items():
            whole = _DOT.join(own).translate(_PIECES)
            at = 0
            while at < len(whole):
                end = whole.find(_DOT, at + most)
                end = len(whole) if end < 0 else end
                yield lang, whole[at:end]
                at = end


def coded(block: bytes) -> tuple[list[bytes], np.ndarray]:
    """The distinct words of a block, the dot first, and the code of every word, 0 between pieces."""
    text = b". " + block.replace(_DOT, b" . ").strip(b" ")
    words = pc.ascii_split_whitespace(pa.array([text], pa.large_binary()).view(pa.large_string())).flatten().dictionary_encode()
    return words.dictionary.view(pa.large_binary()).to_pylist(), words.indices.to_numpy()


class HatTrie:
    """Counts of phrases. A node is a hash container, ``{rest of the phrase: count}``, or a list of up to 256 nodes by its next byte."""

    def __init__(self, burst: int = BURST):
        self.burst, self.size = burst, 0
        self.first: dict[int, dict | list] = {}
        self.sizes: Counter = Counter()

    def add(self, first: int, items: list[tuple[bytes, int]]) -> None:
        """Add counts to phrases: ``first`` is the first word's id, an item the big-endian ids of the others."""
        node, new = self._put(self.first.get(first) or {}, 0, items)
        self.first[first] = node
        self.sizes[first] += new
        self.size += new

    def _put(self, node: dict | list, depth: int, items: list) -> tuple[dict | list, int]:
        if isinstance(node, dict):
            before = len(node)
            for key, n in items:
                node[key] = node.get(key, 0) + n
            new = len(node) - before
            if len(node) > self.burst and all(len(key) > depth for key in node):
                branch: list = [None] * 256
                self._deal(branch, depth, list(node.items()))
                return branch, new
            return node, new
        return node, self._deal(node, depth, items)

    def _deal(self, branch: list, depth: int, items: list) -> int:
        parts, new = defaultdict(list), 0
        for item in items:
            parts[item[0][depth]].append(item)
        for byte, own in parts.items():
            branch[byte], more = self._put(branch[byte] or {}, depth + 1, own)
            new += more
        return new

    def _run(self, node: dict | list | None) -> Iterator[tuple[bytes, int]]:
        if isinstance(node, dict):
            yield from sorted(node.items())
        else:
            for child in node or ():
                yield from self._run(child)

    def spill(self, keep: int = 0) -> Iterator[tuple[int, Iterator[tuple[bytes, int]]]]:
        """Take out subtrees, the largest first, until ``keep`` entries or fewer are left: first words by id, each with its sorted run."""
        taken = []
        for first, size in self.sizes.most_common():
            if self.size <= keep:
                break
            self.size -= size
            taken.append(first)
        for first in sorted(taken):
            del self.sizes[first]
            yield first, self._run(self.first.pop(first))


class Bitmap:
    """Phrases that may be frequent."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def has(self, hashes: np.ndarray) -> np.ndarray:
        place = (hashes & np.uint64(len(self.bits) * 8 - 1)).view(np.int64)
        return (self.bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def _columns(keys: list[bytes], size: int) -> np.ndarray:
    return np.frombuffer(b"".join(keys), ">u8").reshape(-1, size).T.astype(np.uint64)


def _hashed(phrases: DataFrame) -> DataFrame:
    """``h``: the hash of each ``lang, key``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = defaultdict(list)
            for lang, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                groups[lang, len(key) // 8].append(key)
            for (lang, size), keys in groups.items():
                yield pa.RecordBatch.from_arrays([pa.array(phrase_hashes(lang, *_columns(keys, size)).view(np.int64))], names=["h"])

    return phrases.select("lang", "key").mapInArrow(run, "h bigint")


def _bitmap(phrases: DataFrame, most_bits: int) -> Bitmap:
    """The bitmap of the phrases, its blocks made on the workers."""
    bits = BLOCK_BITS
    wanted = min(phrases.count() * BITS_PER_PHRASE, most_bits)
    while bits < wanted:
        bits *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            place = batch.column(0).to_numpy()
            for block in np.unique(place // BLOCK_BITS).tolist():
                own = np.unique(place[place // BLOCK_BITS == block] % BLOCK_BITS)
                row = blocks.setdefault(block, np.zeros(BLOCK_BITS // 8, np.uint8))
                np.bitwise_or.at(row, own >> 3, np.left_shift(1, own & 7).astype(np.uint8))
        for block, row in blocks.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([row.tobytes()], pa.binary())], names=["block", "bits"])

    place = F.col("h").bitwiseAND(F.lit(bits - 1))
    rows = _hashed(phrases).select(place.alias("place")).repartition(F.shiftright("place", 16)).mapInArrow(run, "block int, bits binary").toArrow()
    out = np.zeros(bits // 8, np.uint8)
    for block, own in zip(rows.column("block").to_pylist(), rows.column("bits").to_pylist(), strict=True):
        out[block * BLOCK_BITS // 8 : (block + 1) * BLOCK_BITS // 8] |= np.frombuffer(own, np.uint8)
    return Bitmap(out)


def count_words(docs: DataFrame) -> DataFrame:
    """``lang, word, n`` of all words of ``lang, text``."""

    def send(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, own in counts.items():
            columns = [pa.array([lang] * len(own), pa.string()), pa.array(list(own), pa.binary()), pa.array(list(own.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for lang, block in _blocks(batch):
                words, codes = coded(block)
                own, n = counts[lang], np.bincount(codes, minlength=len(words)).tolist()
                for word, k in zip(words[1:], n[1:], strict=True):
                    own[word] += k
                if sum(map(len, counts.values())) > MOST_WORDS:
                    yield from send(counts)
                    counts.clear()
        yield from send(counts)

    return docs.mapInArrow(run, "lang string, word binary, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _salt(words: DataFrame) -> bytes:
    """A salt under which no two words share an id."""
    for salt in (b"", *(str(k).encode() for k in range(1, 16))):
        ids = words.select("word").distinct().groupBy(_id(F.col("word"), salt).alias("id")).count()
        if ids.where("count > 1").isEmpty():
            return salt
    raise ValueError("the corpus has too many different words for 64-bit ids")


def _id(word, salt: bytes):
    return F.xxhash64(F.concat(word, F.lit(salt)) if salt else word)


def _frequent(codes: np.ndarray, words: list[bytes], lang: str, salt: bytes, known: list[Bitmap]) -> tuple[np.ndarray, np.ndarray]:
    """The words' ids, and for each bitmap, of sizes 1, 2, ..., where a phrase of that size begins that may be frequent (the last one's)."""
    ids = word_ids(words, salt)
    one = known[0].has(phrase_hashes(lang, ids))
    one[0] = False
    begins = one[codes]
    for size, bitmap in enumerate(known[1:], 2):
        begins = begins[:-1] & begins[1:]
        at = np.flatnonzero(begins)
        begins[at] = bitmap.has(phrase_hashes(lang, *(ids[codes[at + k]] for k in range(size))))
    return ids, begins


def phrases_of(codes: np.ndarray, begins: np.ndarray, have: int, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size from ``have + 1`` to ``longest``: the phrases, as rows of word codes ordered by the first, and their counts.

    ``begins`` tells where a phrase of ``have`` words begins that may be frequent; a longer one is made of such alone.
    """
    at = np.flatnonzero(begins)
    name = np.zeros(len(codes), np.int64)
    key = codes[at].astype(np.int64)
    for k in range(1, have):
        key = np.unique(key, return_inverse=True)[1] * np.int64(codes.max(initial=0) + 1) + codes[at + k]
    kinds, name[at] = np.unique(key, return_inverse=True)
    n = len(kinds)
    for size in range(have + 1, longest + 1):
        begins = begins[:-1] & begins[1:]
        at = np.flatnonzero(begins)
        if not len(at):
            return
        _, index, own, counts = np.unique(name[at] * n + name[at + 1], return_index=True, return_inverse=True, return_counts=True)
        yield codes[at[index][:, None] + np.arange(size)], counts
        name[at] = own
        n = len(counts)


def _runs(docs: DataFrame, salt: bytes, known: list[Bitmap], longest: int, heavy: np.ndarray, parts: int) -> DataFrame:
    """``part, lang, size, ids, counts``: sorted runs of the phrases of more words than ``known`` has bitmaps, up to ``longest``.

    ``ids`` are the first words' ids, then the second words', ...; ``heavy`` holds the hashes of the heavy prefixes.
    """
    have = len(known)
    sent = docs.sparkSession.sparkContext.broadcast((known, heavy))

    def send(lang: str, trie: HatTrie, keep: int) -> Iterator[pa.RecordBatch]:
        spilled = defaultdict(lambda: ([], [], []))
        for first, run in trie.spill(keep):
            head = first.to_bytes(8, "big")
            for rest, n in run:
                keys, counts = spilled[1 + len(rest) // 8][:2]
                keys.append(head + rest)
                counts.append(n)
        prefixes = sent.value[1]
        for size, (keys, counts, _) in spilled.items():
            ids, counts = _columns(keys, size), np.array(counts, np.int64)
            prefix = phrase_hashes(lang, *ids[:have])
            if len(prefixes):
                at = np.minimum(np.searchsorted(prefixes, prefix), len(prefixes) - 1)
                prefix = np.where(prefixes[at] == prefix, phrase_hashes(lang, *ids), prefix)
            part = (_mix(prefix) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")  # the trie's order stays within a part
            own, begin = np.unique(part[order], return_index=True)
            for p, a, b in zip(own.tolist(), begin.tolist(), [*begin[1:].tolist(), len(order)], strict=True):
                rows = order[a:b]
                columns = [pa.array([p], pa.int32()), pa.array([lang]), pa.array([size], pa.int32())]
                columns += [pa.array([np.ascontiguousarray(ids[:, rows]).tobytes()], pa.binary()), pa.array([counts[rows].tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "lang", "size", "ids", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries: dict[str, HatTrie] = defaultdict(HatTrie)
        for batch in batches:
            for lang, block in _blocks(batch):
                words, codes = coded(block)
                ids, begins = _frequent(codes, words, lang, salt, sent.value[0])
                trie = tries[lang]
                for rows, counts in phrases_of(codes, begins, have, longest):
                    rest = np.ascontiguousarray(ids[rows[:, 1:]].astype(">u8")).view(f"V{8 * rows.shape[1] - 8}").ravel().tolist()
                    first, begin = np.unique(rows[:, 0], return_index=True)
                    items = list(zip(rest, counts.tolist(), strict=True))
                    for word, a, b in zip(ids[first].tolist(), begin.tolist(), [*begin[1:].tolist(), len(items)], strict=True):
                        trie.add(word, items[a:b])
                while sum(t.size for t in tries.values()) > MOST_ENTRIES:
                    largest = max(tries, key=lambda x: tries[x].size)
                    yield from send(largest, tries[largest], tries[largest].size // 2)
        for lang, trie in tries.items():
            yield from send(lang, trie, 0)

    return docs.mapInArrow(run, "part int, lang string, size int, ids binary, counts binary")


def _merged(runs: DataFrame, least: int) -> DataFrame:
    """``lang, key, n``: the phrases with ``least`` occurrences or more, each partition's runs merged."""

    def merge(own: pa.Table) -> pa.Table:
        lang, size = own.column("lang")[0].as_py(), own.column("size")[0].as_py()
        ids = np.concatenate([np.frombuffer(x, np.uint64).reshape(size, -1) for x in own.column("ids").to_pylist()], 1)
        counts = np.concatenate([np.frombuffer(x, np.int64) for x in own.column("counts").to_pylist()])
        order = np.lexsort(ids[::-1])
        ids, counts = ids[:, order], counts[order]
        new = np.concatenate([[True], (ids[:, 1:] != ids[:, :-1]).any(0)])
        counts = np.add.reduceat(counts, np.flatnonzero(new))
        ids = ids[:, new][:, counts >= least]
        counts = counts[counts >= least]
        keys = np.ascontiguousarray(ids.T.astype(">u8")).view(f"V{8 * size}").ravel().tolist()
        return pa.table([pa.array([lang] * len(keys), pa.string()), pa.array(keys, pa.binary()), pa.array(counts)], names=["lang", "key", "n"])

    return runs.groupBy("part", "lang", "size").applyInArrow(merge, "lang string, key binary, n bigint")


def _heavy(phrases: DataFrame, total: int) -> np.ndarray:
    """Sorted hashes of the phrases that have more than their part of all words; as counts add up to at most ``total``, they are few."""
    rows = _hashed(phrases.where(F.col("n") > total // HEAVY_PART)).toArrow() if total else None
    return np.sort(rows.column("h").to_numpy().view(np.uint64)) if rows is not None and rows.num_rows else np.zeros(0, np.uint64)


def count_phrases(docs: DataFrame, longest: int = 4, least: int = 30, most_bits: int = MOST_BITS) -> tuple[DataFrame, DataFrame]:
    """``lang, word, key, n`` of all words, and ``lang, key, n`` of the phrases (words too) with ``least`` occurrences or more.

    ``docs`` has ``lang`` (null: ``und``) and ``text`` (null: empty); other columns are ignored. Words are what stands between
    spaces and tabs of a piece, pieces what stands between ``.,;:!?`` and line ends, A-Z in lower case. A key
    is the phrase's word ids, 8 bytes each. Repeated rows count each; an empty table gives no rows.
    """
    if longest < 2 or least < 1:
        raise ValueError("phrases have two words or more, and occur")
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    words = stored(count_words(texts), "words")
    total = words.agg(F.sum("n")).first()[0] or 0
    parts = min(max(1, -(-total // PARTITION_WORDS)), HEAVY_PART)
    salt = _salt(words)
    words = words.withColumn("key", F.unhex(F.lpad(F.hex(_id(F.col("word"), salt)), 16, "0")))
    single = words.where(F.col("n") >= least).select("lang", "key", "n")
    known = [_bitmap(single, most_bits)]
    pairs = stored(_merged(_runs(texts, salt, known, 2, _heavy(single, total), parts), least), "pairs")
    out = single.unionByName(pairs)
    if longest > 2:
        known = [*known, _bitmap(pairs, most_bits)]
        out = out.unionByName(stored(_merged(_runs(texts, salt, known, longest, _heavy(pairs, total), parts), least), "phrases"))
    return words, out


def _part(begin, size):
    return F.substring("key", 8 * begin + 1, 8 * size)


def collocations(docs: DataFrame, longest: int = 4, least: int = 30, absorbed: int = 80, scale: int = 2_000_000, top: int | None = None) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the phrases of 2 to ``longest`` words with a >= ``least`` occurrences.

    The score is the least of floor(scale a / (l + r)) over the cuts into a first part with l occurrences and a rest with r; of equal
    cuts the earliest counts. A phrase is left out if a longer one that contains it has ``absorbed`` percent of its
    occurrences or more. ``n`` is the number of all words of the language; ``top`` keeps the best of each language, ranked by score, then
    a, both falling, then phrase in byte order; without it there is no rank. For texts see :func:`count_phrases`.
    """
    words, phrases = count_phrases(docs, longest, least)
    candidates = phrases.select("lang", "key", F.col("n").alias("a"), F.expr("cast(octet_length(key) div 8 as int)").alias("size")).where("size > 1")

    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumns({"left": _part(F.lit(0), F.col("k")), "right": _part(F.col("k"), F.col("size") - F.col("k"))})
    left = phrases.select("lang", F.col("key").alias("left"), F.col("n").alias("l"))
    right = phrases.select("lang", F.col("key").alias("right"), F.col("n").alias("r"))
    score = F.expr(f"(cast(a as decimal(20,0)) * cast({scale} as decimal(12,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    scored = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).withColumn("score", score)
    lowest = scored.groupBy("lang", "key", "a", "size").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inner = candidates.where("size > 2").withColumn("k", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    inner = inner.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("size") - F.col("k"))))
    longer = inner.select("lang", _part(F.col("at"), F.col("k")).alias("key"), F.col("a").alias("longer")).groupBy("lang", "key").agg(F.max("longer").alias("longer"))
    covered = F.expr(f"100 * cast(longer as decimal(20,0)) >= {absorbed} * cast(a as decimal(20,0))")
    left_over = lowest.join(longer, ["lang", "key"], "left").where(F.col("longer").isNull() | ~covered)

    word = left_over.select("lang", F.col("key").alias("whole"), "a", "cut", F.posexplode(F.sequence(F.lit(0), F.col("size") - 1)).alias("at", "_at"), "key")
    word = word.select("lang", "whole", "a", "cut", "at", _part(F.col("at"), F.lit(1)).alias("key"))
    named = word.join(words.select("lang", "key", F.col("word").cast("string").alias("word")), ["lang", "key"])
    named = named.groupBy("lang", "whole", "a", "cut").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("parts"))
    phrase = F.array_join(F.transform("parts", lambda x: x["word"]), " ").alias("phrase")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    out = named.select("lang", phrase, "a", "cut.l", "cut.r", "cut.score")
    columns = ["phrase", "a", "l", "r", "n", "score"]
    if top is None:
        return out.join(totals, "lang").select("lang", *columns)
    # first the best of each of some shares of a language, so that the last step reads few rows however many tasks there are
    deal = max(1, math.isqrt(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    out = out.withColumn("deal", F.pmod(F.xxhash64("phrase"), F.lit(deal)))
    for by in (["lang", "deal"], ["lang"]):
        order = Window.partitionBy(*by).orderBy(F.desc("score"), F.desc("a"), "phrase")
        out = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return out.join(totals, "lang").select("lang", "rank", *columns)


ORACLE = r"""
WITH piece AS (
    SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece
    FROM (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM split GROUP BY lang),
gram AS (
    SELECT lang, size, list_slice(w, pos, pos + size - 1) AS p
    FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS pos FROM split, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(w) >= size)),
f AS (SELECT lang, size, p, count(*) AS a FROM gram GROUP BY 1, 2, 3 HAVING count(*) >= 30),
cut AS (
    SELECT c.lang, c.p, c.size, c.a, k, l.a AS l, r.a AS r, CAST((CAST(c.a AS HUGEINT) * 2000000) // (CAST(l.a AS HUGEINT) + r.a) AS BIGINT) AS score
    FROM (SELECT *, unnest(range(1, size)) AS k FROM f WHERE size > 1) c
    JOIN f l ON l.lang = c.lang AND l.p = list_slice(c.p, 1, k) JOIN f r ON r.lang = c.lang AND r.p = list_slice(c.p, k + 1, c.size)),
lowest AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inside AS (
    SELECT lang, list_slice(p, pos, pos + k - 1) AS p, max(a) AS longer
    FROM (SELECT lang, p, a, k, unnest(range(1, size - k + 2)) AS pos FROM (SELECT *, unnest(range(2, size)) AS k FROM f WHERE size > 2)) GROUP BY 1, 2),
kept AS (
    SELECT c.lang, array_to_string(c.p, ' ') AS phrase, a, l, r, score FROM lowest c LEFT JOIN inside i ON i.lang = c.lang AND i.p = c.p
    WHERE longer IS NULL OR 100 * CAST(longer AS HUGEINT) < 80 * CAST(a AS HUGEINT))
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept JOIN total USING (lang)) WHERE rank <= 2000
"""


@query("op12_phrase_collocations", ORACLE)
def op12(spark, sf_dir):
    found = collocations(table(spark, sf_dir, "documents"), longest=4, least=30, absorbed=80, top=2000)
    return found.withColumn("rank", F.col("rank").cast("bigint"))
