"""Secrets: credential patterns, and values in a credential context that are hard to guess.

A value that follows a credential word and a separator is cut into the segments that an attacker would guess most cheaply: words of a
list, dates, repeats of a unit, walks over the keyboard and brute-force stretches. Every segment costs the logarithm of its guesses, the
least total over all ways to cut is found by dynamic programming over the value's positions, and a value of at least
``hard`` is reported. So placeholders and words are left alone, however long, and random strings are found, however short they are
for the patterns.

The attacker's words are counted over all texts and ranked; the most frequent, at most WORDS (beside a fixed list of password words),
are broadcast, a documented bound. Cost grows with the length of a value, not its square: a word has at most LONGEST_WORD letters, and
repeats and walks are extended as far as they go from each place once.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairreach.llm.common import fresh, slices, split_coded, table
from fairreach.llm.registry import query
from fairreach.session import stored

#: Words of the corpus that an attacker tries, most frequent first, and the lengths of those.
WORDS, SHORTEST_WORD, LONGEST_WORD = 1 << 16, 3, 24
#: log10 of the guesses from which on a value is a secret.
HARD = 10.0
#: Different words a task counts before it sends them on.
MOST_WORDS = 400_000
#: Units of a repeat have at most this many characters.
LONGEST_UNIT = 8

# fixed values: words of passwords and placeholders, the rows of a keyboard
PASSWORDS = "password pass passwd admin root user guest test demo example sample default changeme change please letmein welcome login master dragon monkey qwerty abc iloveyou sunshine princess football baseball shadow superman batman hello freedom whatever trustno secret token key apikey value your here none null true false undefined placeholder redacted hidden dummy fake todo string insert enter replace xxx yyy zzz".split()
KEYBOARD = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")

KINDS = ("assign", "access", "hex", "guess")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
#: A credential word, perhaps the begin of a longer name, a separator, and what stands up to a quote, space, bracket, comma or semicolon.
_CONTEXT = re.compile(
    r"""(?:password|passphrase|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credentials?|authorization|bearer)(?:[_-][a-z0-9_-]*|[0-9]+)?["']?[\x20\t]*(?:=>|:=|[:=])[\x20\t]*["'`]?([^\s"'`,;<>(){}\[\]]+)""",
    re.ASCII | re.IGNORECASE,
)
_HINTS = ("pass", "pwd", "secret", "token", "key", "credential", "authorization", "bearer")

# (one key, the next): the direction of the step; keys of a row are half a key right of those above
_STEPS = {(row[i], row[i + d]): (d, 0) for row in KEYBOARD for i in range(len(row)) for d in (-1, 1) if 0 <= i + d < len(row)}
for above, below in zip(KEYBOARD, KEYBOARD[1:], strict=False):
    for i, key in enumerate(above):
        for j in (i - 1, i):
            if 0 <= j < len(below):
                _STEPS[key, below[j]], _STEPS[below[j], key] = (j - i, 1), (i - j, -1)
_KEYS = sum(map(len, KEYBOARD))
_DATES = [
    re.compile(x)
    for x in (
        r"(?:19|20)\d\d([-/._]?)(?:0?[1-9]|1[0-2])\1(?:[12]\d|3[01]|0?[1-9])",
        r"(?:[12]\d|3[01]|0?[1-9])([-/._]?)(?:0?[1-9]|1[0-2])\1(?:19|20)\d\d",
        r"(?:19|20)\d\d",
    )
]
#: What each of these dates costs: days of two centuries (and five separators), years.
_DATE_COST = [math.log10(200 * 366 * 5)] * 2 + [math.log10(200)]


def brute_cost(char: str) -> float:
    """log10 of the characters of one kind: digits, letters of one case, signs, others."""
    return math.log10(10 if "0" <= char <= "9" else 26 if "a" <= char <= "z" or "A" <= char <= "Z" else 33 if char < "\x80" else 100)


class Guesser:
    """Costs of values, with the ranks of an attacker's words."""

    def __init__(self, words: list[str]):
        ranked = dict.fromkeys([*PASSWORDS, *words])
        self.rank = {w: k for k, w in enumerate(ranked, 1)}

    def word_cost(self, word: str) -> float:
        """Of a word as it stands: its rank, twice that if written in upper case or with a capital, else a choice for each letter."""
        low = word.lower()
        rank = self.rank.get(low)
        if rank is None:
            return math.inf
        style = 0.0 if word == low else math.log10(2) if word in (low.upper(), low.capitalize()) else len(word) * math.log10(2)
        return math.log10(rank) + style

    def _pieces(self, value: str, at: int) -> Iterator[tuple[int, float]]:
        """End and cost of the characters, words and dates that begin at a place."""
        yield at + 1, brute_cost(value[at])
        for end in range(at + SHORTEST_WORD, min(len(value), at + LONGEST_WORD) + 1):
            if (cost := self.word_cost(value[at:end])) < math.inf:
                yield end, cost
        if "0" <= value[at] <= "9":
            for pattern, cost in zip(_DATES, _DATE_COST, strict=True):
                for end in range(at + 4, min(len(value), at + 10) + 1):
                    if pattern.fullmatch(value, at, end):
                        yield end, cost

    def cost(self, value: str) -> float:
        """log10 of the guesses of the cheapest way to cut the value; 0 for an empty one.

        A walk or a repeat goes on as far as it can from the place where it begins.
        """
        n, low = len(value), [c.lower() for c in value]
        best = [0.0] + [math.inf] * n
        steps = [_STEPS.get((a, b)) for a, b in zip(low, low[1:], strict=False)] + [None]
        walk, turns = [0] * (n + 1), [0] * (n + 1)
        same = [[0] * (n + 1) for _ in range(LONGEST_UNIT)]  # for each unit length, equal characters that far apart from a place on
        for i in range(n - 1, -1, -1):
            if steps[i]:
                walk[i] = walk[i + 1] + 1
                turns[i] = turns[i + 1] + (walk[i + 1] > 0 and steps[i] != steps[i + 1])
            for unit, own in enumerate(same, 1):
                if i + unit < n and value[i] == value[i + unit]:
                    own[i] = own[i + 1] + 1
        for i in range(n):
            here = best[i]
            for end, cost in self._pieces(value, i):
                best[end] = min(best[end], here + cost)
            if walk[i] > 1:
                end = i + walk[i] + 1
                best[end] = min(best[end], here + math.log10(_KEYS * (end - i)) + turns[i] * math.log10(4))
            for unit, own in enumerate(same, 1):
                times = own[i] // unit + 1
                if times > 1 and unit * times > 2:
                    once = value[i : i + unit]
                    cost = min(self.word_cost(once), sum(map(brute_cost, once))) + math.log10(times)
                    best[i + unit * times] = min(best[i + unit * times], here + cost)
        return best[n]

    def spans(self, text: str, hard: float = HARD) -> list[tuple[int, int, int]]:
        """Begin, number of the kind and end of all secrets of a text, in that order."""
        out = [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
        if "AKIA" in text:
            out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
        low = text.lower()
        if any(hint in low for hint in _HINTS):
            out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
            for m in _CONTEXT.finditer(text):
                value = m.group(1).rstrip(".:!?")
                if self.cost(value) >= hard:
                    out.append((m.start(1), 3, m.start(1) + len(value)))
        return sorted(out)


_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def frequent_words(docs: DataFrame, most: int = WORDS) -> list[str]:
    """The frequent words of all texts, of SHORTEST_WORD to LONGEST_WORD letters, A-Z in lower case; by falling count, then word.

    Frequent are words that occur 2**k times or more, with the least k that leaves ``most`` words or fewer.
    """

    def send(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for _, texts in slices(batch):
                words, codes, _ = split_coded(texts, _LETTERS)
                for word, n in zip(words, np.bincount(codes, minlength=len(words)).tolist(), strict=True):
                    if SHORTEST_WORD <= len(word) <= 4 * LONGEST_WORD:
                        counts[word] += n
                if len(counts) > MOST_WORDS:
                    yield send(counts)
                    counts.clear()
        yield send(counts)

    rows = docs.select("text").mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    word = F.col("word").cast("string").alias("word")
    rows = stored(rows.select(word, "n").where(F.length("word").between(SHORTEST_WORD, LONGEST_WORD)), "words")
    # the least power of two that at most so many words reach, from one row for each power
    sizes = dict(rows.groupBy(F.expr("cast(floor(log2(n)) as int)").alias("k")).count().collect())
    above, k = 0, max(sizes, default=0) + 1
    while k and above + sizes.get(k - 1, 0) <= most:
        k -= 1
        above += sizes.get(k, 0)
    found = rows.where(F.col("n") >= 2**k).collect()
    return [r["word"] for r in sorted(found, key=lambda r: (-r["n"], r["word"]))]


def find_secrets(docs: DataFrame, guesser: Guesser, hard: float = HARD, name: str = "secrets") -> DataFrame:
    """All rows and columns of ``docs`` with the secrets of their ``text`` (null: empty) as an array of kind, begin and end in code points.

    In order of begin, then kind: ``assign``, ``access``, ``hex`` (patterns) and ``guess`` (values that take 10**``hard`` guesses or
    more). A column of that name gets underscores before it in the result's new one. Texts are searched whole, however long; repeated
    rows each; an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(guesser)
    name = fresh(docs, name)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("finish", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                found = [[{"kind": KINDS[k], "begin": a, "finish": b} for a, k, b in sent.value.spans(t.decode(), hard)] if t else [] for t in texts]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, kind)], names=[*part.schema.names, name])

    return docs.mapInArrow(run, docs.withColumn(name, F.expr("cast(array() as array<struct<kind:string,begin:bigint,finish:bigint>>)")).schema)


def listed(secrets: Column) -> Column:
    """``kind:begin:end`` of each, with commas between."""
    return F.array_join(F.transform(secrets, lambda x: F.concat_ws(":", x["kind"], x["begin"].cast("string"), x["finish"].cast("string"))), ",")


@query("op13_secret_scans")
def op13(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_secrets(docs, Guesser(frequent_words(docs)))
    count = lambda kind: F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = listed(F.filter("secrets", lambda x: x["kind"] != "guess"))
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(base, 256).alias("base_sha256"), listed(F.col("secrets")).alias("spans"))
