"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Text bytes that one step inside a task works on at a time; a longer single text is a step of its own.
SLICE_BYTES = 6 << 20

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
LOWER = bytes.maketrans(_UPPER, _UPPER.lower())
# lower-cases A-Z and turns every ASCII byte but digits and letters into a space; bytes of longer characters stay
ALNUM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id has remainder -1."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % n, F.lit(-1))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it (names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Parts of a batch with at most ``most`` bytes of text (one row at least) and their texts as bytes or None."""
    texts = batch.column(batch.schema.names.index(column)).cast(pa.large_binary())
    sizes = np.cumsum([0 if x is None else x for x in pc.binary_length(texts).to_pylist()])
    at = 0
    while at < batch.num_rows:
        before = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, before + most, "right")))
        yield batch.slice(at, end - at), texts.slice(at, end - at).to_pylist()
        at = end


def append_columns(df: DataFrame, new: dict[str, str], fn: Callable[[list], list[pa.Array]]) -> DataFrame:
    """All rows and columns of ``df`` with the columns ``new`` (name: type) that ``fn`` makes of the texts.

    Where ``df`` has a column of that name, the new one gets underscores before its name, see :func:`fresh`.
    """
    names = [fresh(df, n) for n in new]
    schema = T.StructType([*df.schema.fields, *(T.StructField(n, T.DataType.fromDDL(t)) for n, t in zip(names, new.values(), strict=True))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                yield pa.RecordBatch.from_arrays([*part.columns, *fn(texts)], names=[*part.schema.names, *names])

    return df.mapInArrow(run, schema)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


class Codes(dict):
    """Numbers each new word on first use."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def encode_words(lists: list[list]) -> tuple[list, np.ndarray, np.ndarray]:
    """Distinct words, the code of every word of every list in a row, and where each list starts (one end more)."""
    codes = Codes()
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    flat = np.empty(starts[-1], np.int32)
    for words, a, b in zip(lists, starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        flat[a:b] = np.fromiter(map(codes.__getitem__, words), np.int32, b - a)
    return list(codes), flat, starts


def split_coded(texts: list, table: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """As :func:`encode_words` for the words between white space of each text after ``table`` has changed its bytes."""
    lists = pc.ascii_split_whitespace(pa.array([t.translate(table).strip() if t else b"" for t in texts], pa.large_binary()).view(pa.large_string()))
    sizes, words = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64), lists.flatten()
    blank = pc.equal(words, "")  # a text without words is split into one empty word
    if pc.any(blank).as_py():
        empty = blank.to_numpy(zero_copy_only=False)
        first = np.cumsum(sizes) - sizes
        sizes = sizes - empty[first]
        words = words.filter(pc.invert(blank))
    coded = words.dictionary_encode()
    distinct = coded.dictionary.view(pa.large_binary()).to_pylist()
    return distinct, coded.indices.to_numpy(zero_copy_only=False).astype(np.int32), np.concatenate([[0], np.cumsum(sizes)])


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... for sizes[0] numbers, then the same for the others."""
    total = int(sizes.sum())
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(total)
