"""Languages of mixed texts: scripts narrow the candidates, Viterbi labels the words.

A language is a table of character-trigram counts over its whole training texts. A word (a run of letters)
scores the sum of its trigrams' log probabilities; languages that hardly use the word's script are no candidates.
Over a text's words the best path of labels pays a penalty at each switch, so a stray word does not break a span.

A text is identified if its best language holds the majority of its letters and explains them better than no language
does, that is, better than a table in which all buckets are alike: the trigrams of junk, and of languages and scripts that were
not learnt, mostly fall into buckets that a learnt language hardly uses.
"""

from __future__ import annotations

import bisect
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairreach.llm.common import append_columns, encode_words, fresh, id_remainder, slices, split_coded, table
from fairreach.llm.registry import query

BUCKETS = 1 << 15
SMOOTHING = 0.5
SWITCH = 8.0
#: A language is a candidate for a script in which it has this share of its letters.
SCRIPT_SHARE = 0.002
UNKNOWN = "und"
#: Log probability of a trigram in a table in which all buckets are alike.
NO_LANGUAGE = -float(np.log(BUCKETS))
#: Ranges of the scripts (fixed values: Unicode blocks), first and last code point.
SCRIPTS = (
    (0x0041, 0x024F, "Latin"),
    (0x0370, 0x03FF, "Greek"),
    (0x0400, 0x052F, "Cyrillic"),
    (0x0530, 0x058F, "Armenian"),
    (0x0590, 0x05FF, "Hebrew"),
    (0x0600, 0x077F, "Arabic"),
    (0x0900, 0x097F, "Devanagari"),
    (0x0980, 0x09FF, "Bengali"),
    (0x0E00, 0x0E7F, "Thai"),
    (0x10A0, 0x10FF, "Georgian"),
    (0x1100, 0x11FF, "Hangul"),
    (0x1E00, 0x1EFF, "Latin"),
    (0x1F00, 0x1FFF, "Greek"),
    (0x3040, 0x30FF, "Kana"),
    (0x3400, 0x9FFF, "Han"),
    (0xAC00, 0xD7AF, "Hangul"),
)
_NAMES = ["other", *dict.fromkeys(name for *_, name in SCRIPTS)]
_FIRST = [a for a, *_ in SCRIPTS]
_LETTERS = regex.compile(r"\p{L}+")


def script_of(word: str) -> int:
    """Number of the script of a word's first letter; an empty word has that of "other"."""
    if "a" <= word[:1] <= "z":
        return 1
    point = ord(word[0]) if word else 0
    at = bisect.bisect_right(_FIRST, point) - 1
    return _NAMES.index(SCRIPTS[at][2]) if at >= 0 and point <= SCRIPTS[at][1] else 0


# lower-cases A-Z and turns all other ASCII bytes into spaces; bytes of longer characters stay
_ASCII = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def coded_words(texts: list) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words, the code of every word of every text in a row, and where each text starts (one end more).

    A word is what stands between ASCII characters other than letters; of a word with longer characters, the letters count
    (some, or none).
    """
    words, flat, starts = split_coded(texts, _ASCII)
    return ["".join(_LETTERS.findall(w.decode().lower())) if not w.isascii() else w.decode() for w in words], flat, starts


def _trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the trigram around each letter of all words in a row, and how many each word has."""
    points = np.frombuffer(("\0" + "\0".join(words) + "\0").encode("utf-32-le"), np.uint32).astype(np.uint64)
    mixed = (points[:-2] * np.uint64(0x9E3779B1) + points[1:-1] * np.uint64(0x85EBCA77) + points[2:] * np.uint64(0xC2B2AE3D)) & np.uint64(0xFFFFFFFF)
    mixed = (mixed ^ (mixed >> np.uint64(15))) % np.uint64(BUCKETS)
    letter = points[1:-1] != 0
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    return mixed[letter].astype(np.int64), sizes


class Model:
    """Log probabilities of the trigram buckets for each language, and the candidates of each script."""

    def __init__(self, counts: dict[str, dict[int, int]]):
        self.languages = sorted(counts)
        table_ = np.zeros((BUCKETS + len(_NAMES), len(self.languages)))
        for j, name in enumerate(self.languages):
            for bucket, n in counts[name].items():
                table_[bucket, j] = n
        grams, scripts = table_[:BUCKETS], table_[BUCKETS:]
        self.log = np.log((grams + SMOOTHING) / (grams.sum(0) + SMOOTHING * BUCKETS)).astype(np.float32)
        used = scripts >= SCRIPT_SHARE * np.maximum(1, scripts.sum(0))
        used[~used.any(1)] = True  # a script that no language uses rules none out
        self.barred = np.where(used, 0, -1e4).astype(np.float32)

    def scores(self, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language; 0 for a word without letters."""
        grams, sizes = _trigrams(words)
        out = np.zeros((len(words), len(self.languages)), np.float32)
        some = np.flatnonzero(sizes)
        if len(some):
            ends = np.cumsum(sizes)
            out[some] = np.add.reduceat(self.log[grams], (ends - sizes)[some], axis=0)
            out[some] += self.barred[[script_of(words[k]) for k in some.tolist()]]
        return out

    def label(self, words: list[str], flat: np.ndarray, starts: np.ndarray, scores: np.ndarray | None = None) -> np.ndarray:
        """Language number of every word of every text: the path with the highest score less SWITCH for each switch.

        ``scores`` are those of ``words``, if they are at hand.
        """
        labels = np.zeros(len(flat), np.int32)
        if not len(flat):
            return labels
        scores = self.scores(words) if scores is None else scores
        sizes = np.diff(starts)
        some = np.flatnonzero(sizes)
        whole = np.zeros((len(sizes), len(self.languages)))
        whole[some] = np.add.reduceat(scores[flat], starts[:-1][some], axis=0, dtype=np.float64)
        one = whole.argmax(1)
        labels[:] = np.repeat(one, sizes)
        mixed = np.flatnonzero(self._may_switch(scores, flat, starts, one))
        if len(mixed):
            self._label_mixed(scores, flat, starts, mixed, labels)
        return labels

    def _label_mixed(self, scores: np.ndarray, flat: np.ndarray, starts: np.ndarray, mixed: np.ndarray, labels: np.ndarray) -> None:
        """Best paths of the texts ``mixed``, cut at words that can have one label only.

        A word that a language leads by more than two switches has that label in every best path, so the stretches
        between such words are independent.
        """
        two = np.sort(np.partition(scores, -2, axis=1)[:, -2:], axis=1) if scores.shape[1] > 1 else np.zeros((len(scores), 2))
        sure = (two[:, 1] - two[:, 0] > 2 * SWITCH)[flat]
        is_start = np.zeros(len(flat) + 1, bool)
        is_start[starts[:-1][mixed]] = True
        is_end = np.zeros(len(flat) + 1, bool)
        is_end[starts[1:][mixed]] = True
        inside = np.cumsum(is_start[:-1].astype(int) - is_end[:-1]) > 0
        begins = np.flatnonzero(inside & (is_start[:-1] | sure))
        finish = np.append(begins[1:], len(flat))
        owner_end = starts[np.searchsorted(starts, begins, "right")]
        sizes = np.minimum(finish, owner_end) - begins
        best_one = scores.argmax(1)
        first = np.where(sure[begins], best_one[flat[begins]], -1)
        follows = begins + sizes
        after = np.where(follows < owner_end, best_one[flat[np.minimum(follows, len(flat) - 1)]], -1)
        self._viterbi(scores, flat, begins, sizes, first, after, labels)

    def _may_switch(self, scores: np.ndarray, flat: np.ndarray, starts: np.ndarray, one: np.ndarray) -> np.ndarray:
        """Texts in which some stretch gains more than SWITCH in some other language than ``one``.

        In all others the path that stays in one language is the best: every path is that one with stretches of other
        languages put in, and each of these costs a switch at least and gains less.
        """
        sizes = np.diff(starts)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        own = scores[flat, one[owner]].astype(np.float64)
        out = np.zeros(len(sizes), bool)
        for k in range(len(self.languages)):
            gain = scores[flat, k] - own
            total = np.cumsum(gain)
            # stretches do not cross texts: each text's sums are set below all earlier ones before the running minimum
            low = total - gain - owner * (np.abs(total).max() * 2 + 1)
            rise = total - (np.minimum.accumulate(low) + owner * (np.abs(total).max() * 2 + 1))
            out[owner[rise > SWITCH * 0.999]] = True
        return out

    def _viterbi(self, scores: np.ndarray, flat: np.ndarray, begins: np.ndarray, sizes: np.ndarray, first: np.ndarray, after: np.ndarray, labels: np.ndarray) -> None:
        """Best paths of stretches of words, all a word further at each step, written into ``labels``.

        first: label that a stretch begins with, after: label of the word that follows it (-1: any or none).
        """
        order = np.argsort(-sizes, kind="stable")
        begins, sizes, first, after = begins[order], sizes[order], first[order], after[order]
        live = np.searchsorted(-sizes, -np.arange(sizes[0]), "left")  # stretches longer than each step
        own = np.arange(len(self.languages), dtype=np.int32)
        at = np.concatenate([[0], np.cumsum(live)])  # where each step's rows begin in ``came``
        came = np.empty((at[-1], len(own)), np.int32)
        best = np.where((first[:, None] >= 0) & (first[:, None] != own), np.float32(-1e9), np.float32(0)) + scores[flat[begins]]
        leave = np.where((after[:, None] >= 0) & (after[:, None] != own), np.float32(-SWITCH), np.float32(0))
        last = np.zeros(len(begins), np.int32)
        for step, n in enumerate(live.tolist()):
            if not step:
                continue
            last[n : len(best)] = (best[n:] + leave[n : len(best)]).argmax(1)
            best = best[:n]
            top = best.argmax(1)
            switched = best[np.arange(n), top] - SWITCH
            moved = switched[:, None] > best
            came[at[step] : at[step + 1]] = np.where(moved, top[:, None], own)
            best = np.maximum(best, switched[:, None]) + scores[flat[begins[:n] + step]]
        last[: len(best)] = (best + leave[: len(best)]).argmax(1)
        for step in range(len(live) - 1, -1, -1):
            n = live[step]
            labels[begins[:n] + step] = last[:n]
            if step:
                last[:n] = came[at[step] : at[step + 1]][np.arange(n), last[:n]]

    def predict(self, texts: list) -> tuple[list[str], np.ndarray]:
        """Language with most letters of each text, and its share of them; ``und`` and 0 without letters or languages."""
        return self.judge(texts)[:2]

    def judge(self, texts: list) -> tuple[list[str], np.ndarray, np.ndarray]:
        """As :meth:`predict`, and the mean log probability of the trigrams of the words with that language, in it (0 without any)."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        words, flat, starts = coded_words(texts)
        scores = self.scores(words)
        labels = self.label(words, flat, starts, scores)
        letters = np.fromiter(map(len, words), np.int64, len(words))[flat]
        owner = np.repeat(np.arange(len(texts)), np.diff(starts))
        width = len(self.languages)
        sums = np.bincount(owner * width + labels, letters, len(texts) * width).reshape(-1, width)
        total, best = sums.sum(1), sums.argmax(1)
        names = [self.languages[k] if n else UNKNOWN for k, n in zip(best.tolist(), total.tolist(), strict=True)]
        logs = np.bincount(owner, np.where(labels == best[owner], scores[flat, labels], 0), len(texts))
        return names, sums.max(1) / np.maximum(total, 1), logs / np.maximum(sums.max(1), 1)

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """``(language, begin, end)`` of the stretches of one language in a text, as character offsets."""
        found = [(m.start(), m.end()) for m in _LETTERS.finditer(text)]
        if not found or not self.languages:
            return []
        words, flat, starts = encode_words([[text[a:b].lower() for a, b in found]])
        labels = self.label(words, flat, starts).tolist()
        out: list[tuple[str, int, int]] = []
        for (a, b), k in zip(found, labels, strict=True):
            if out and out[-1][0] == self.languages[k]:
                out[-1] = (out[-1][0], out[-1][1], b)
            else:
                out.append((self.languages[k], a, b))
        return out


def train(docs: DataFrame) -> Model:
    """Count the trigrams of each ``lang`` over all whole texts; rows without a text or lang teach nothing.

    What reaches the driver is one row for each language and bucket, whatever the size of the input.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(BUCKETS + len(_NAMES), np.int64))
        for batch in batches:
            for part, texts in slices(batch):
                words, flat, starts = coded_words(texts)
                if not words:
                    continue
                grams, sizes = _trigrams(words)
                script = np.array([script_of(w) for w in words])
                langs = part.column(0).to_pylist()
                names = sorted(set(langs))
                of = np.repeat([names.index(x) for x in langs], np.diff(starts))
                for k, lang in enumerate(names):
                    many = np.bincount(flat[of == k], minlength=len(words))
                    sums[lang][:BUCKETS] += np.bincount(grams, np.repeat(many, sizes), BUCKETS).astype(np.int64)
                    sums[lang][BUCKETS:] += np.bincount(script, many * sizes, len(_NAMES)).astype(np.int64)
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(total[at])], names=["lang", "bucket", "n"])

    counted = docs.where("lang is not null and text is not null").select("lang", "text").mapInArrow(count, "lang string, bucket int, n bigint")
    counts: dict[str, dict[int, int]] = defaultdict(dict)
    for row in counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow().to_pylist():
        counts[row["lang"]][row["bucket"]] = row["n"]
    return Model(counts)


def identify(docs: DataFrame, model: Model, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """All rows and columns of ``docs`` with the predicted language and its share of the text's letters (0 to 1).

    Texts that are null or have no letter are ``und`` with score 0, as is every text if nothing was learnt; of
    equal shares the language that comes first by name wins. Where ``docs`` has a column of one of the names, the new one gets
    underscores before its name.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: list) -> list[pa.Array]:
        languages, shares = sent.value.predict(texts)
        return [pa.array(languages, pa.string()), pa.array(shares, pa.float64())]

    return append_columns(docs, {names[0]: "string", names[1]: "double"}, run)


def label_spans(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang, char_begin, char_end`` for every stretch of one language in every text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("lang", pa.string()), ("char_begin", pa.int64()), ("char_end", pa.int64())]))

    def run(texts: list) -> list[pa.Array]:
        names = ("lang", "char_begin", "char_end")
        return [pa.array([[dict(zip(names, s, strict=True)) for s in sent.value.spans(t.decode())] if t else [] for t in texts], kind)]

    found = append_columns(docs.select("doc_id", "text"), {"spans": "array<struct<lang:string,char_begin:bigint,char_end:bigint>>"}, run)
    return found.select("doc_id", F.inline("spans"))


def split_learned(docs: DataFrame) -> DataFrame:
    """The rows that may be learnt from: crc32 of the id, modulo 4, is not 2."""
    return docs.where(id_remainder("doc_id", 4) != 2)


def drop_unidentified(docs: DataFrame, model: Model, least: float = 1 / 2) -> DataFrame:
    """The rows of ``docs`` with a language that holds at least ``least`` of their letters and explains them better than none, with their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    name = fresh(docs, "llm_identified")

    def run(texts: list) -> list[pa.Array]:
        languages, shares, logs = sent.value.judge(texts)
        return [pa.array((np.array(languages) != UNKNOWN) & (shares >= least) & (logs > NO_LANGUAGE), pa.bool_())]

    return append_columns(docs, {name: "boolean"}, run).where(F.col(name)).select([F.col(f"`{c}`") for c in docs.columns])


@query("op4_language_id")
def op4(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = train(split_learned(docs))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (id_remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
