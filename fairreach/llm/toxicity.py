"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A text is cut into overlapping windows of 32 words, 16 apart; its score is that of its highest window. A word
enters as two vectors: its own, and that of its characters, the mean and the highest of the runs of five that it is made of. Both
begin as the sample's evidence (how much more often the word, or the run, stands in toxic than in other texts) and are
trained with the network; characters carry the evidence over to forms of a word that the sample lacks. Two gated recurrent layers
read each window in both directions, attention pools their states, and a logistic unit scores the pool. Training sees whole
texts: the highest window of each sampled text takes the text's label; it is picked anew from time to time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairreach.llm.common import ALNUM, append_columns, fresh, id_remainder, ranges, split_coded, table
from fairreach.llm.registry import query

#: Labelled texts that the network is fitted on at most, of each label; those with the lowest hash of their id.
SAMPLE_TOXIC, SAMPLE_OTHER = 700, 2_700
WINDOW, STRIDE = 32, 16
HIDDEN, WIDTH = 12, 2
VOCABULARY, CHAR_BUCKETS = 8_192, 1 << 17
PICKS, STEPS, BATCH, RATE = 4, 200, 64, 0.01
INPUT_RATE = 0.01
#: What a text says more often counts so often in the evidence.
TIMES = 3
THRESHOLD = 0.3
#: Windows scored at once.
_AT_ONCE = 1_024


def _chars(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the five bytes around each byte of all words in a row, and how many each word has."""
    codes = np.frombuffer(b"  " + b"  ".join(words) + b"  ", np.uint8).astype(np.uint64)
    mixed = np.zeros(len(codes) - 4, np.uint64)
    for k in range(5):
        mixed = mixed * np.uint64(0x100000001B3) + codes[k : k + len(mixed)]
    mixed = (mixed * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(CHAR_BUCKETS)
    return mixed[codes[2:-2] != 32].astype(np.int64), np.fromiter(map(len, words), np.int64, len(words))


def _windows(starts: np.ndarray, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word and length of every window; a text without words has one of length 0."""
    sizes = np.diff(starts)
    many = np.maximum(1, -(-(sizes - WINDOW) // stride) + 1)
    text = np.repeat(np.arange(len(sizes)), many)
    offset = stride * (np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many))
    return text, starts[:-1][text] + offset, np.minimum(WINDOW, sizes[text] - offset)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Weights of the network; ``words`` numbers the known words from 1."""

    def __init__(self, words: list[bytes], rng: np.random.Generator):
        self.words = {w: k + 1 for k, w in enumerate(words)}
        draw = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
        self.w = {
            "att": draw(2 * HIDDEN, HIDDEN),
            "att_b": np.zeros(HIDDEN, np.float32),
            "att_v": draw(HIDDEN),
            "out": draw(2 * HIDDEN),
            "out_b": np.full(1, -1, np.float32),
        }
        for d in "fb":
            self.w |= {f"in_{d}": draw(2 * WIDTH, 3 * HIDDEN), f"bias_{d}": np.zeros(3 * HIDDEN, np.float32), f"rec_{d}": draw(HIDDEN, 3 * HIDDEN)}
        self.word = np.zeros((len(words) + 1, WIDTH), np.float32)  # evidence, and whether the word is known
        self.word[1:, 1] = 1
        self.char = np.zeros(CHAR_BUCKETS, np.float32)

    def inputs(self, words: list[bytes]) -> np.ndarray:
        """Input vector of each word: its own, and the mean and the highest evidence of its characters."""
        if not words:
            return np.zeros((0, 2 * WIDTH), np.float32)
        known = np.fromiter((self.words.get(w, 0) for w in words), np.int64, len(words))
        grams, sizes = _chars(words)
        found, first = self.char[grams], np.cumsum(sizes) - sizes
        mean = np.add.reduceat(found, first) / sizes.astype(np.float32)
        return np.column_stack([self.word[known], mean, np.maximum.reduceat(found, first)]).astype(np.float32)

    def _read(self, x: tuple, mask: np.ndarray | None, d: str, keep: list | None) -> np.ndarray:
        """States (step, window, unit) of one direction for projected inputs (step, window, units)."""
        steps, n = mask.shape if mask is not None else x[0].shape[:2]
        rec, h = self.w[f"rec_{d}"], np.zeros((n, HIDDEN), np.float32)
        gates, new = np.ascontiguousarray(rec[:, : 2 * HIDDEN]) * np.float32(0.5), np.ascontiguousarray(rec[:, 2 * HIDDEN :])
        states = np.empty((steps, n, HIDDEN), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            zr = h @ gates
            zr += x[0][t]
            np.tanh(zr, out=zr)  # sigmoid(2 a) is (1 + tanh a) / 2
            zr += 1
            zr *= np.float32(0.5)
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            hn = h @ new
            c = r * hn
            c += x[1][t]
            np.tanh(c, out=c)
            nxt = h - c
            nxt *= z
            nxt += c
            if mask is not None:
                nxt = np.where(mask[t, :, None], nxt, h)
            if keep is not None:
                keep.append((t, h, z, r, hn, c))
            h = states[t] = nxt
        return states

    def project(self, x: np.ndarray, d: str) -> tuple[np.ndarray, np.ndarray]:
        """What words add to the gates (halved) and to the new state of one direction; a row of zeros at the end."""
        p = np.concatenate([x @ self.w[f"in_{d}"] + self.w[f"bias_{d}"], np.zeros((1, 3 * HIDDEN), np.float32)])
        return p[:, : 2 * HIDDEN] * np.float32(0.5), np.ascontiguousarray(p[:, 2 * HIDDEN :])

    def forward(self, projected: dict[str, tuple], mask: np.ndarray | None, keep: dict | None = None) -> np.ndarray:
        """Logit of each window."""
        kept = {d: [] if keep is not None else None for d in "fb"}
        states = np.concatenate([self._read(projected[d], mask, d, kept[d]) for d in "fb"], 2)
        seen = np.tanh(states @ self.w["att"] + self.w["att_b"])
        weight = seen @ self.w["att_v"]
        if mask is not None:
            weight = np.where(mask, weight, -1e9)
        weight = np.exp(weight - weight.max(0))
        if mask is not None:
            weight = weight * mask
        weight = weight / np.maximum(weight.sum(0), 1e-9)
        pooled = (weight[:, :, None] * states).sum(0)
        if keep is not None:
            keep.update(states=states, seen=seen, weight=weight, pooled=pooled, kept=kept)
        return pooled @ self.w["out"] + self.w["out_b"][0]

    def logits(self, coded: tuple, stride: int | None = None) -> tuple[np.ndarray, tuple]:
        """Logit of every window of coded texts, and (text, first word, length) of the windows."""
        words, flat, starts = coded
        x = self.inputs(words)
        project = {d: self.project(x, d) for d in "fb"}
        text, first, size = _windows(starts, stride or STRIDE)
        codes = np.append(flat, len(words))
        out = np.empty(len(text), np.float32)
        full = size == WINDOW
        for which, whole in ((np.flatnonzero(full), True), (np.flatnonzero(~full), False)):
            for a in range(0, len(which), _AT_ONCE):
                own = which[a : a + _AT_ONCE]
                at, mask = self._at(codes, first[own], size[own], len(words))
                out[own] = self.forward({d: tuple(p[at] for p in project[d]) for d in "fb"}, None if whole else mask)
        return out, (text, first, size)

    @staticmethod
    def _at(codes: np.ndarray, first: np.ndarray, size: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
        """Word codes (step, window), ``pad`` beyond a window's end, and where there is a word."""
        step = np.arange(WINDOW)[:, None]
        mask = step < size[None, :]
        return np.where(mask, codes[np.minimum(first[None, :] + step, len(codes) - 1)], pad), mask

    def scores(self, texts: list) -> np.ndarray:
        """Highest window of each text, 0 to 1."""
        if not texts:
            return np.zeros(0)
        logits, (text, *_) = self.logits(split_coded(texts, ALNUM))
        top = np.full(len(texts), -np.inf)
        np.maximum.at(top, text, logits)
        return 1 / (1 + np.exp(-np.clip(top, -60, 60)))

    def gradients(self, words: list[bytes], at: np.ndarray, mask: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross entropy of windows given as codes (step, window); the pad is len(words)."""
        w = self.w
        used, codes = np.unique(at, return_inverse=True)
        codes = codes.reshape(at.shape)
        if used[-1] == len(words):
            used = used[:-1]
        x = self.inputs([words[k] for k in used])
        codes = np.where(mask, codes, len(used))
        keep: dict = {}
        logit = self.forward({d: tuple(p[codes] for p in self.project(x, d)) for d in "fb"}, mask, keep)
        x = np.concatenate([x, np.zeros((1, 2 * WIDTH), np.float32)])
        n = len(label)
        d_logit = (_sigmoid(logit) - label).astype(np.float32) / n
        states, seen, weight, pooled = (keep[k] for k in ("states", "seen", "weight", "pooled"))
        g = {"out": pooled.T @ d_logit, "out_b": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * w["out"]
        d_weight = (states * d_pooled).sum(2)
        d_raw = weight * (d_weight - (weight * d_weight).sum(0))
        g["att_v"] = np.tensordot(d_raw, seen, ((0, 1), (0, 1)))
        d_seen = d_raw[:, :, None] * w["att_v"] * (1 - seen * seen)
        g["att"] = np.tensordot(states, d_seen, ((0, 1), (0, 1)))
        g["att_b"] = d_seen.sum((0, 1))
        d_states = weight[:, :, None] * d_pooled + d_seen @ w["att"].T
        d_x = np.zeros_like(x)
        for k, d in enumerate("fb"):
            d_state = d_states[:, :, k * HIDDEN : (k + 1) * HIDDEN]
            rec = w[f"rec_{d}"]
            d_rec, d_proj = np.zeros_like(rec), np.zeros((WINDOW, n, 3 * HIDDEN), np.float32)
            d_h = np.zeros((n, HIDDEN), np.float32)
            for t, h, z, r, hn, c in reversed(keep["kept"][d]):
                total = d_h + d_state[t]
                m = mask[t, :, None]
                d_new = np.where(m, total, 0)
                d_c = d_new * (1 - z) * (1 - c * c)
                d_z = d_new * (h - c) * z * (1 - z)
                d_r = d_c * hn * r * (1 - r)
                d_gate = np.concatenate([d_z, d_r, d_c * r], 1)
                d_rec += h.T @ d_gate
                d_proj[t] = np.concatenate([d_z, d_r, d_c], 1)
                d_h = np.where(m, d_new * z, total) + d_gate @ rec.T
            g[f"rec_{d}"], g[f"bias_{d}"] = d_rec, d_proj.sum((0, 1))
            g[f"in_{d}"] = np.tensordot(x[codes], d_proj, ((0, 1), (0, 1)))
            for k in range(2 * WIDTH):
                d_x[:, k] += np.bincount(codes.ravel(), (d_proj @ w[f"in_{d}"][k]).ravel(), len(x))
        g["word"], g["char"] = self._input_gradients([words[k] for k in used], d_x[:-1])
        return g

    def _input_gradients(self, words: list[bytes], d_x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of the word vectors and of the characters' evidence from those of the words' inputs."""
        d_word, d_char = np.zeros_like(self.word), np.zeros_like(self.char)
        if words:
            known = np.fromiter((self.words.get(v, 0) for v in words), np.int64, len(words))
            np.add.at(d_word, known, d_x[:, :WIDTH])
            d_word[0] = 0  # words that are not known have no vector
            grams, sizes = _chars(words)
            owner, first = np.repeat(np.arange(len(words)), sizes), np.cumsum(sizes) - sizes
            found = self.char[grams]
            top = found == np.maximum.reduceat(found, first)[owner]
            at = np.flatnonzero(top)
            at = at[np.unique(owner[at], return_index=True)[1]]  # the first of equal ones
            d_char += np.bincount(grams, (d_x[:, WIDTH] / sizes)[owner], len(d_char)) + np.bincount(grams[at], d_x[owner[at], WIDTH + 1], len(d_char))
        return d_word, d_char


def _evidence(own: np.ndarray, other: np.ndarray, n_own: int, n_other: int) -> np.ndarray:
    """Log of how much more often something occurs among the words of toxic than of other texts, less what chance may add; from -4 to 4.

    As it is a ratio of rates, neither the length of texts nor the number of texts in a language moves it, so a
    language with few texts passes its words too; two standard errors are taken off.
    """
    ratio = np.log((own + 0.5) / max(n_own, 1)) - np.log((other + 0.5) / max(n_other, 1))
    error = np.sqrt(1 / (own + 0.5) + 1 / (other + 0.5))
    return np.clip(np.sign(ratio) * np.maximum(np.abs(ratio) - 2 * error, 0), -4, 4).astype(np.float32)


def fit(texts: list, labels: list[int], seed: int = 7) -> Network | None:
    """A network for the labelled texts; None unless both labels occur."""
    label = np.array(labels, np.float32)
    if not len(label) or label.min() == label.max():
        return None
    rng = np.random.default_rng(seed)
    words, flat, starts = coded = split_coded(texts, ALNUM)
    width = max(1, len(words))
    # a text that is there twice counts once, and so does what a text says more often than TIMES
    first_of: dict[bytes, int] = {}
    alone = np.array([first_of.setdefault(t or b"", k) == k for k, t in enumerate(texts)])
    grams, sizes = _chars(words)
    first_gram = np.cumsum(sizes) - sizes
    seen, chars = [], []
    for k in (0, 1):
        own = np.repeat((label == k) & alone, np.diff(starts))
        pairs, times = np.unique(np.repeat(np.arange(len(texts)), np.diff(starts))[own] * np.int64(width) + flat[own], return_counts=True)
        times = np.minimum(times, TIMES)
        seen.append(np.bincount(pairs % width, times, width))
        held = grams[ranges(first_gram[pairs % width], sizes[pairs % width])] if len(pairs) else grams[:0]
        chars.append(np.bincount(held, np.repeat(times, sizes[pairs % width]), CHAR_BUCKETS))
    other, toxic = (float(x.sum()) for x in seen)
    often = np.flatnonzero(seen[0] + seen[1] >= 3)
    often = often[np.lexsort((often, -(seen[0] + seen[1])[often]))][:VOCABULARY] if words else often[:0]
    net = Network([words[k] for k in often], rng)
    net.word[1:, 0] = _evidence(seen[1][often], seen[0][often], toxic, other)
    net.char[:] = _evidence(chars[1], chars[0], toxic, other)
    first_moment = {k: np.zeros_like(v) for k, v in net.w.items()}
    second_moment = {k: np.zeros_like(v) for k, v in net.w.items()}
    inputs, squares = {"word": net.word, "char": net.char}, {"word": np.zeros_like(net.word), "char": np.zeros_like(net.char)}
    step = 0
    for _ in range(PICKS):
        logits, (text, first, size) = net.logits(coded, WINDOW)  # side by side: the more windows, the more often a clean text's highest one is chance
        order = np.lexsort((logits, text))
        top = order[np.append(text[order][1:] != text[order][:-1], True)]  # highest window of each text
        codes = np.append(flat, len(words))
        for _ in range(STEPS):  # a text is drawn once a step at most
            own = rng.choice(top, min(BATCH, len(top)), replace=False)
            at, mask = net._at(codes, first[own], size[own], len(words))
            step += 1
            for k, grad in net.gradients(words, at, mask, label[text[own]]).items():
                if k in inputs:  # few of their entries have a gradient in a step
                    squares[k] += grad * grad
                    inputs[k] -= (INPUT_RATE * grad / (np.sqrt(squares[k]) + 1e-7)).astype(np.float32)
                    continue
                first_moment[k] = 0.9 * first_moment[k] + 0.1 * grad
                second_moment[k] = 0.999 * second_moment[k] + 0.001 * grad * grad
                rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                net.w[k] -= (rate * first_moment[k] / (np.sqrt(second_moment[k]) + 1e-7)).astype(np.float32)
    return net


def train(docs: DataFrame, labels: DataFrame) -> Network | None:
    """Fit on a bounded sample of the labelled texts (SAMPLE_TOXIC and SAMPLE_OTHER rows at most, whole texts).

    Only rows whose id's crc32, modulo 4, is not 2 are learnt from. A document labelled twice takes the higher
    label; labels other than 0 and 1 and rows without an id or text are left out.
    """
    known = labels.where("toxic in (0, 1) and doc_id is not null").where(id_remainder("doc_id", 4) != 2)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    draw = lambda toxic, n: known.where(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    sample = draw(1, SAMPLE_TOXIC).union(draw(0, SAMPLE_OTHER)).toArrow()
    ids = dict(zip(sample.column("doc_id").to_pylist(), sample.column("toxic").to_pylist(), strict=True))
    kind = labels.schema["doc_id"].dataType.simpleString()
    chosen = docs.sparkSession.createDataFrame(sorted(ids.items()), f"sample_id {kind}, toxic int")
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text")).where("text is not null")
    rows = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("sample_id")).groupBy("doc_id").agg(F.min("text").alias("text"))
    chosen = rows.toArrow()
    found = sorted(zip(chosen.column("doc_id").to_pylist(), chosen.column("text").to_pylist(), strict=True))
    return fit([t for _, t in found], [int(ids[i]) for i, _ in found])


def score(docs: DataFrame, network: Network | None, name: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` with the score of ``text``, 0 to 1.

    Null and empty texts, and those without a word, are one window without words; without a network all scores are 0.
    Where ``docs`` has a column of that name, the score's gets underscores before its name.
    """
    if network is None:
        return docs.withColumn(fresh(docs, name), F.lit(0.0))
    sent = docs.sparkSession.sparkContext.broadcast(network)
    return append_columns(docs, {name: "double"}, lambda texts: [pa.array(sent.value.scores(texts), pa.float64())])


def drop_toxic(docs: DataFrame, network: Network | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with their columns."""
    name = fresh(docs, "llm_toxic")
    return score(docs, network, name).where(F.col(name) < threshold).select([F.col(f"`{c}`") for c in docs.columns])


@query("op5_toxicity")
def op5(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    network = train(docs, table(spark, sf_dir, "labels"))
    held_out = (id_remainder("doc_id", 4) == 2).alias("held_out")
    found = score(docs.select("doc_id", "text"), network)
    return found.select("doc_id", held_out, "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
