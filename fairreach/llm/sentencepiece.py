"""Encoding and decoding with the pieces of a SentencePiece model, by Viterbi over shared prefixes.

A text is marked (a space before it; spaces stand for U+2581) and cut where no piece can cross: before each run of
spaces and around line feeds. Of a few megabytes of texts the distinct marked words are sorted, which lists
them as a depth-first walk of their trie; the forward scores of a prefix stay on the stack and are used again by all
words below it. A word's best segmentation is the highest sum of piece scores. Models whose scores are merge ranks
(pair-merging models) are read with the log probability that Zipf's law gives each rank, as sums of ranks mean nothing.
"""

from __future__ import annotations

import functools
import gc
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairreach.llm.common import append_columns, encode_words, fresh, ranges, table
from fairreach.llm.registry import query

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Encoded words in each of the two generations that a worker remembers, at most. Longer words are not remembered.
REMEMBERED, LONGEST = 250_000, 64
_WORDS = re.compile(b" *[^ \n]+|\n| +")
_CUTS = (b"\x1f", b"\x1e", b"\x1d", b"\x1c", b"\x01", b"\x02", b"\x03", b"\x04")


class Model:
    """Pieces, scores and the trie walk of one model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces: dict[str, tuple[float, int]] = {}
        self.byte_ids: dict[int, int] = {}
        out: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                out.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                out.append(b"")
            else:
                pieces[piece.replace(MARK, " ")] = (model.get_score(i), i)
                out.append(piece.replace(MARK, " ").encode())
        if all(float(score).is_integer() for score, _ in pieces.values()):
            # merge ranks, not log probabilities: the ranks' probabilities by Zipf's law take their place
            total = np.log((1 / np.arange(1, len(pieces) + 1)).sum())
            pieces = {p: (float(-np.log(k + 1) - total), i) for k, (p, (_, i)) in enumerate(pieces.items())}
        if any(re.search("[^ ] |.\n|\n.", p, re.S) for p in pieces) or len(self.byte_ids) < 256:
            raise ValueError("the pieces of the model must not cross words or lines, and must hold all bytes")
        self.unknown = min(s for s, _ in pieces.values()) - 10
        # trie of the pieces: a node is [nodes by next character, score, id], the latter of the piece that ends there
        self.root: dict[str, list] = {}
        for p, (score, i) in pieces.items():
            at, node = self.root, None
            for c in p:
                node = at.setdefault(c, [{}, None, -1])
                at = node[0]
            node[1:] = score, i
        self.bytes = np.frombuffer(b"".join(out), np.uint8)
        self.sizes = np.array([len(x) for x in out])
        self.first = np.cumsum(self.sizes) - self.sizes
        self.young: dict[bytes, tuple[int, ...]] = {}
        self.old: dict[bytes, tuple[int, ...]] = {}

    def segment(self, words: list[bytes]) -> dict[bytes, tuple[int, ...]]:
        """Ids of each word: one depth-first walk over the sorted words.

        The stack holds, for each character of the current prefix, the best score up to it, the last piece of
        that segmentation, and the pieces that are under way there as (score before, begin, nodes that may follow).
        """
        done: dict[bytes, tuple[int, ...]] = {}
        root, unknown, byte_ids = self.root.get, self.unknown, self.byte_ids
        before = ""
        best: list[float] = [0.0]
        back: list[tuple[int, int]] = [(0, -1)]
        under_way: list[list[tuple[float, int, dict]]] = [[]]
        for word in sorted(words):  # the order of bytes in UTF-8 is that of the characters
            chars = word.decode()
            n = len(chars)
            same = 0
            if chars[:2] == before[:2]:
                for a, b in zip(before, chars):
                    if a != b:
                        break
                    same += 1
            elif chars[:1] == before[:1] and chars:
                same = 1
            del best[same + 1 :], back[same + 1 :], under_way[same + 1 :]
            for at in range(same, n):
                c = chars[at]
                top, link, live = -1e300, None, []
                for score, begin, nodes in under_way[at]:
                    node = nodes.get(c)
                    if node is not None:
                        nodes, end, i = node
                        if nodes:
                            live.append((score, begin, nodes))
                        if end is not None and score + end > top:
                            top, link = score + end, (begin, i)
                score, node = best[at], root(c)
                end = unknown
                i = -1
                if node is not None:
                    if node[0]:
                        live.append((score, at, node[0]))
                    if node[1] is not None:
                        end, i = node[1], node[2]
                if score + end > top:
                    top, link = score + end, (at, i)
                best.append(top)
                back.append(link)
                under_way.append(live)
            before = chars
            ids, at = [], n
            while at:
                begin, i = back[at]
                if i >= 0:
                    ids.append(i)
                else:
                    ids.extend([byte_ids[b] for b in reversed(chars[begin].encode())])
                at = begin
            ids.reverse()
            done[word] = tuple(ids)
        return done

    def marked_words(self, texts: list) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Distinct marked words, the code of every word of every text in a row, and where each text starts (one end more)."""
        cut = next((c for c in _CUTS if not any(c in t for t in texts if t)), None)
        if cut is None:
            return encode_words([_WORDS.findall(b" " + t) if t else [] for t in texts])

        def prepared(text: bytes | None) -> bytes:
            if not text:
                return b""
            text = (b" " + text).replace(b" ", cut + b" ")
            while b" " + cut + b" " in text:
                text = text.replace(b" " + cut + b" ", b"  ")
            return text.replace(b"\n", cut + b"\n" + cut)

        lists = pc.split_pattern(pa.array([prepared(t) for t in texts], pa.large_binary()), cut)
        sizes, words = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64), lists.flatten()
        some = pc.greater(pc.binary_length(words), 0)
        kept = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))])
        starts = kept[np.concatenate([[0], np.cumsum(sizes)])]
        coded = words.filter(some).dictionary_encode()
        return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False), starts

    def encode(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (bytes or None) in a row, and where each text's begin (one end more)."""
        words, flat, starts = self.marked_words(texts)
        young, old = self.young, self.old
        gc.disable()  # the walk makes many small objects and no cycles
        try:
            new = self.segment([w for w in words if w not in young and w not in old])
        finally:
            gc.enable()
        parts = [young.get(w) or old.get(w) or new[w] for w in words]
        for w, ids in zip(words, parts, strict=True):
            if len(w) <= LONGEST:
                young[w] = ids
                if len(young) >= REMEMBERED:
                    self.old, self.young = young, (young := {})
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        store = np.fromiter((i for ids in parts for i in ids), np.int32, int(sizes.sum()))
        first = np.cumsum(sizes) - sizes
        each = sizes[flat]
        ids = store[ranges(first[flat], each)] if len(flat) else store
        offsets = np.concatenate([[0], np.cumsum(each)])[starts]
        return ids, offsets

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """The text of each stretch of ids: its pieces, with marks as spaces and without the first, which encoding has added."""
        sizes = self.sizes[ids]
        joined = self.bytes[ranges(self.first[ids], sizes)].tobytes() if len(ids) else b""
        cuts = np.concatenate([[0], np.cumsum(sizes)])[offsets].tolist()
        texts = [joined[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return [t[1:] if t[:1] == b" " else t for t in texts]


@functools.lru_cache(maxsize=2)
def _model(path: str, _stamp: float) -> Model:
    return Model(path)


def load(path: str = MODEL) -> Model:
    return _model(path, os.path.getmtime(path))


def encode(docs: DataFrame, name: str = "ids", model: str = MODEL) -> DataFrame:
    """All rows and columns of ``docs`` with the ids of ``text``.

    Null and empty texts have no ids. Characters that no piece has become byte pieces, as does a U+2581 of the
    text itself, so decoding gives back every text exactly. Of segmentations with equal scores the one whose last pieces are longer wins.
    Where ``docs`` has a column of that name, the new one gets underscores before its name.
    """

    def run(texts: list) -> list[pa.Array]:
        ids, offsets = load(model).encode(texts)
        return [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))]

    return append_columns(docs, {name: "array<int>"}, run)


def decode(rows: DataFrame, ids: str = "ids", name: str = "decoded", model: str = MODEL) -> DataFrame:
    """All rows and columns of ``rows`` with the text of the array column ``ids``; null ids give null.

    Where ``rows`` has a column of that name, the new one gets underscores before its name.
    """
    at, name = rows.columns.index(ids), fresh(rows, name)

    def run(batches):
        for batch in batches:
            lists = [x or [] for x in batch.column(at).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
            texts = load(model).decode(np.array([i for x in lists for i in x], np.int64), offsets)
            known = batch.column(at).is_valid().to_pylist()
            made = pa.array([t.decode("utf-8", "replace") if k else None for t, k in zip(texts, known, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, name])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(name, T.StringType())]))


def round_trip(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """``doc_id, ids, n_tokens, exact`` for every row: exact says that decoding the ids gives back the text (empty for null)."""

    def run(texts: list) -> list[pa.Array]:
        coder = load(model)
        ids, offsets = coder.encode(texts)
        exact = [a == (b or b"") for a, b in zip(coder.decode(ids, offsets), texts, strict=True)]
        return [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids)), pa.array(exact, pa.bool_())]

    docs = docs.select("doc_id", "text")
    made = append_columns(docs, {"ids": "array<int>", "exact": "boolean"}, run)
    return made.select("doc_id", "ids", F.size("ids").cast("bigint").alias("n_tokens"), "exact")


@query("op8_sentencepiece")
def op8(spark, sf_dir):
    return round_trip(table(spark, sf_dir, "documents"))
