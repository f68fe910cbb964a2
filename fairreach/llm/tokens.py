"""Token counts of the sections of a text, from one encoding of the whole text.

The whole text is encoded once. The byte lengths of its tokens give their offsets, the sections theirs, and a sorted
search over both is the interval join: no token is encoded twice and none is lost at a boundary.
"""

from __future__ import annotations

import base64
import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairreach.llm.common import append_columns, table
from fairreach.llm.registry import query

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Splits a text before the merges of the rank file (fixed value of the vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RULES = ("first", "last", "most")


@functools.lru_cache(maxsize=2)
def _encoder(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), sizes


def line_starts(text: bytes) -> np.ndarray:
    """Byte offsets of the lines; a line holds its line feed, and there is no empty line at the end."""
    after = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    return np.concatenate([[0], after[after < len(text)]])


def attribute(ids_sizes: np.ndarray, chars: np.ndarray, starts: np.ndarray, rule: str) -> np.ndarray:
    """Tokens of each section.

    ids_sizes: bytes of each token; chars: for each byte the character that it belongs to; starts: first byte of each section.
    A token's characters are those of its bytes. It counts for the section of its first character (``first``), of its
    last (``last``), or with the most of its characters, the first of equals (``most``).
    """
    counts = np.zeros(len(starts), np.int64)
    if not len(ids_sizes):
        return counts
    ends = np.cumsum(ids_sizes)
    first = np.searchsorted(starts, ends - ids_sizes, "right") - 1
    last = np.searchsorted(starts, ends - 1, "right") - 1
    owner = last if rule == "last" else first
    if rule == "most":
        edge = np.append(chars[starts], chars[-1] + 1)
        owner = first.copy()
        for k in np.flatnonzero(first != last):
            a, b = chars[ends[k] - ids_sizes[k]], chars[ends[k] - 1] + 1
            of = np.arange(first[k], last[k] + 1)
            owner[k] = of[np.argmax(np.minimum(edge[of + 1], b) - np.maximum(edge[of], a))]
    np.add.at(counts, owner, 1)
    return counts


def section_tokens(docs: DataFrame, rule: str = "first", vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, section, char_begin, char_end, n_tokens`` for every line of every text.

    Null and empty texts have one section 0 without characters or tokens. Strings of special tokens in a
    text are ordinary text. Repeated rows give their sections again; an empty table gives none.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    def count(texts: list) -> list[pa.Array]:
        encoder, sizes = _encoder(vocabulary)
        begins, ends, numbers, offsets = [], [], [], [0]
        for text in texts:
            if not text:
                begins.append(np.zeros(1, np.int64))
                ends.append(np.zeros(1, np.int64))
                numbers.append(np.zeros(1, np.int64))
            else:
                ids = encoder.encode_to_numpy(text.decode(), disallowed_special=())
                chars = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80) - 1
                starts = line_starts(text)
                edge = np.append(chars[starts], chars[-1] + 1)
                begins.append(edge[:-1])
                ends.append(edge[1:])
                numbers.append(attribute(sizes[ids], chars, starts, rule))
            offsets.append(offsets[-1] + len(begins[-1]))
        parts = [pa.array(np.concatenate(x)) if x else pa.array([], pa.int64()) for x in (begins, ends, numbers)]
        rows = pa.StructArray.from_arrays(parts, ["char_begin", "char_end", "n_tokens"])
        return [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)]

    kind = "array<struct<char_begin:bigint,char_end:bigint,n_tokens:bigint>>"
    counted = append_columns(docs.select("doc_id", "text"), {"sections": kind}, count).select("doc_id", F.posexplode("sections").alias("section", "s"))
    return counted.select("doc_id", "section", "s.char_begin", "s.char_end", "s.n_tokens")


@query("op3_token_counts")
def op3(spark, sf_dir):
    return section_tokens(table(spark, sf_dir, "documents"))
