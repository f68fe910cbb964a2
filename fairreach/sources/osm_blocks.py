"""Extracts of the road map in their binary form: a data source whose partitions are runs of blocks.

A file is a row of blocks, each with its length before it and packed on its own. The lengths are read on the driver, the blocks by the
tasks: their messages are unpacked field by field, and lists of numbers (ids, coordinates, references) as whole arrays.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from fairreach.sources.shapefile import files_of, open_folder, read_range
from fairreach.sources.spatial import located_ways

#: Packed bytes that a task reads, about.
TASK_BYTES = 16 << 20
_UNSEEN = ".unseen"
# fixed values of the format: wire types, and the numbers of the fields that are read
_VARINT, _LONG, _BYTES, _INT = 0, 1, 2, 5
_BLOB_TYPE, _BLOB_SIZE, _BLOB_RAW, _BLOB_RAW_SIZE, _BLOB_ZLIB = 1, 3, 1, 2, 3
_STRINGS, _GROUP, _GRANULARITY, _LAT_OFFSET, _LON_OFFSET = 1, 2, 17, 19, 20
_NODES, _DENSE, _WAYS = 1, 2, 3
_ID, _KEYS, _VALUES, _LAT, _LON, _REFS = 1, 2, 3, 8, 9, 8
_NANO = 1e-9

NODE_SCHEMA = "id bigint, lat double, lon double"
WAY_SCHEMA = "id bigint, tags map<string,string>, refs array<bigint>"


def varints(packed: bytes) -> np.ndarray:
    """Unsigned numbers of a packed list."""
    data = np.frombuffer(packed, np.uint8)
    last = np.flatnonzero(data < 128)
    first = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
    out = np.zeros(len(last), np.uint64)
    for k in range(int((last - first).max(initial=-1)) + 1):
        own = first + k <= last
        out[own] |= (data[first[own] + k] & np.uint8(127)).astype(np.uint64) << np.uint64(7 * k)
    return out


def signed(numbers: np.ndarray) -> np.ndarray:
    """Zigzag numbers with their sign."""
    return (numbers >> np.uint64(1)).astype(np.int64) ^ -(numbers & np.uint64(1)).astype(np.int64)


def _one(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        if byte < 128:
            return value, at
        shift += 7


def _few(packed: bytes) -> list[int]:
    """Unsigned numbers of a short packed list."""
    out, at = [], 0
    while at < len(packed):
        value, at = _one(packed, at)
        out.append(value)
    return out


def _running(lists: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Packed lists of signed steps as running sums, one list after the other, and where each begins and ends."""
    data = b"".join(lists)
    # a number ends with a byte below 128
    upto = np.concatenate([[0], np.cumsum(np.frombuffer(data, np.uint8) < 128)])
    ends = upto[np.concatenate([[0], np.cumsum([len(v) for v in lists], dtype=np.int64)])]
    sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(signed(varints(data)))])
    return sums[1:] - np.repeat(sums[ends[:-1]], np.diff(ends)), ends


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a message."""
    at = 0
    while at < len(data):
        tag, at = _one(data, at)
        kind = tag & 7
        if kind == _VARINT:
            value, at = _one(data, at)
        elif kind == _BYTES:
            size, at = _one(data, at)
            value, at = data[at : at + size], at + size
        elif kind in (_LONG, _INT):
            size = 8 if kind == _LONG else 4
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"wire type {kind}")
        yield tag >> 3, value


def _unpacked(blob: bytes) -> bytes:
    found = dict(fields(blob))
    if _BLOB_RAW in found:
        return found[_BLOB_RAW]
    if _BLOB_ZLIB not in found:
        raise ValueError("blocks are packed by an unknown method")
    return zlib.decompress(found[_BLOB_ZLIB])


def _sint(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


class Block:
    """Strings, scale and groups of one block."""

    def __init__(self, data: bytes):
        self.strings, self.groups = [], []
        scale = {_GRANULARITY: 100, _LAT_OFFSET: 0, _LON_OFFSET: 0}
        for number, value in fields(data):
            if number == _STRINGS:
                self.strings = [s.decode("utf-8", "replace") for _, s in fields(value)]
            elif number == _GROUP:
                self.groups.append(value)
            elif number in scale:
                scale[number] = _sint(value)
        self.step, self.lat, self.lon = scale[_GRANULARITY], scale[_LAT_OFFSET], scale[_LON_OFFSET]

    def nodes(self) -> Iterator[pa.RecordBatch]:
        for group in self.groups:
            single = []
            for number, value in fields(group):
                if number == _DENSE:
                    found = dict(fields(value))
                    columns = [np.cumsum(signed(varints(found.get(n, b"")))) for n in (_ID, _LAT, _LON)]
                    yield self._placed(*columns)
                elif number == _NODES:
                    found = dict(fields(value))
                    single.append([int(signed(np.array([found[n]], np.uint64))[0]) for n in (_ID, _LAT, _LON)])
            if single:
                yield self._placed(*np.array(single, np.int64).T)

    def _placed(self, ids: np.ndarray, lat: np.ndarray, lon: np.ndarray) -> pa.RecordBatch:
        degrees = [(offset + self.step * v) * _NANO for offset, v in ((self.lat, lat), (self.lon, lon))]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *map(pa.array, degrees)], names=["id", "lat", "lon"])

    def ways(self) -> Iterator[pa.RecordBatch]:
        ids, tags, packed_refs = [], [], []
        for group in self.groups:
            for number, value in fields(group):
                if number == _WAYS:
                    found = dict(fields(value))
                    ids.append(_sint(found[_ID]))
                    pairs = zip(_few(found.get(_KEYS, b"")), _few(found.get(_VALUES, b"")), strict=True)
                    tags.append([(self.strings[k], self.strings[v]) for k, v in pairs])
                    packed_refs.append(found.get(_REFS, b""))
        # the references of all ways are unpacked together
        refs, ends = _running(packed_refs)
        listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(refs, pa.int64()))
        columns = [pa.array(ids, pa.int64()), pa.array(tags, pa.map_(pa.string(), pa.string())), listed]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "tags", "refs"])


class _Blocks(InputPartition):
    """``blocks``: place and size of each."""

    def __init__(self, file: str, blocks: list[tuple[int, int]]):
        self.file, self.blocks = file, blocks


class BlockReader(DataSourceReader):
    def __init__(self, path: str, element: str, task_bytes: int):
        self.path, self.element, self.task_bytes = path, element, task_bytes

    def partitions(self) -> list[_Blocks]:
        system, out = open_folder(self.path)[0], []
        for at in files_of(self.path, ".pbf"):
            own, total = [], system.get_file_info(at).size
            with system.open_input_file(at) as file:
                place = 0
                while place < total:
                    (head,) = struct.unpack(">I", file.read_at(4, place))
                    found = dict(fields(file.read_at(head, place + 4)))
                    place += 4 + head
                    if found[_BLOB_TYPE] == b"OSMData":
                        own.append((place, found[_BLOB_SIZE]))
                    place += found[_BLOB_SIZE]
            while own:
                many, size = 0, 0
                while many < len(own) and (not many or size + own[many][1] <= self.task_bytes):
                    size += own[many][1]
                    many += 1
                out.append(_Blocks(at, own[:many]))
                own = own[many:]
        return out

    def read(self, part: _Blocks | None) -> Iterator[pa.RecordBatch]:
        # an extract without blocks has no partition
        for place, size in part.blocks if part else ():
            yield from getattr(Block(_unpacked(read_range(self.path, part.file, place, size))), self.element)()


class OsmBlocks(DataSource):
    """Option ``element``: nodes (:data:`NODE_SCHEMA`) or ways (:data:`WAY_SCHEMA`); ``task_bytes``: what a task reads."""

    @classmethod
    def name(cls) -> str:
        return "osm_blocks"

    def schema(self) -> str:
        return {"nodes": NODE_SCHEMA, "ways": WAY_SCHEMA}[self.options["element"]]

    def reader(self, schema: T.StructType) -> BlockReader:
        return BlockReader(self.options["path"], self.options["element"], int(self.options.get("task_bytes", TASK_BYTES)))

    def writer(self, schema: T.StructType, overwrite: bool) -> BlockWriter:
        return BlockWriter(self.options["path"], schema, int(self.options.get("block_rows", 8000)))


def read_way_blocks(spark: SparkSession, path: str, task_bytes: int = TASK_BYTES) -> DataFrame:
    """``(osm_id, amenity, area, tags, way)`` per way of binary extracts, as :func:`read_ways` gives those of XML files."""
    spark.dataSource.register(OsmBlocks)
    read = lambda element: spark.read.format("osm_blocks").option("element", element).option("task_bytes", task_bytes).load(path)
    ways = read("ways").select(F.col("id").alias("osm_id"), "tags", F.col("refs").alias("nodes"))
    nodes = read("nodes").select(F.col("id").alias("node"), F.col("lat").alias("_lat"), F.col("lon").alias("_lon"))
    return located_ways(ways, nodes)


# --- writing


def _sizes(numbers: np.ndarray) -> np.ndarray:
    """Bytes that each unsigned number takes."""
    size = np.ones(len(numbers), np.int64)
    for k in range(1, 10):
        size += numbers >= np.uint64(1) << np.uint64(7 * k)
    return size


def packed(numbers: np.ndarray) -> bytes:
    """Unsigned numbers as a packed list."""
    rest = numbers.astype(np.uint64)
    size = _sizes(rest)
    out = np.zeros(int(size.sum()), np.uint8)
    first = np.cumsum(size) - size
    for k in range(int(size.max(initial=0))):
        own = size > k
        byte = (rest[own] >> np.uint64(7 * k)) & np.uint64(127)
        out[first[own] + k] = byte.astype(np.uint8) | np.where(size[own] > k + 1, 128, 0).astype(np.uint8)
    return out.tobytes()


def _zigzag(steps: np.ndarray) -> np.ndarray:
    return ((steps << 1) ^ (steps >> 63)).view(np.uint64)


def _deltas(numbers: list[int] | np.ndarray) -> bytes:
    return packed(_zigzag(np.diff(np.array(numbers, np.int64), prepend=np.int64(0))))


def _each_deltas(lists: list[list[int]]) -> list[bytes]:
    """:func:`_deltas` of each list, packed together."""
    lengths = np.array([len(v) for v in lists], np.int64)
    numbers = np.array([n for v in lists for n in v], np.int64)
    steps = np.diff(numbers, prepend=np.int64(0))
    first = (np.cumsum(lengths) - lengths)[lengths > 0]
    steps[first] = numbers[first]
    whole = _zigzag(steps)
    ends = np.concatenate([[0], np.cumsum(_sizes(whole))])[np.concatenate([[0], np.cumsum(lengths)])].tolist()
    data = packed(whole)
    return [data[a:b] for a, b in zip(ends, ends[1:])]


def _varint(value: int) -> bytes:
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    out.append(value)
    return bytes(out)


def _field(number: int, value: int | bytes) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | _BYTES) + _varint(len(value)) + value
    return _varint(number << 3 | _VARINT) + _varint(value & (1 << 64) - 1)


def _blob(kind: bytes, data: bytes) -> bytes:
    blob = _field(_BLOB_RAW_SIZE, len(data)) + _field(_BLOB_ZLIB, zlib.compress(data))
    head = _field(_BLOB_TYPE, kind) + _field(_BLOB_SIZE, len(blob))
    return struct.pack(">I", len(head)) + head + blob


def _known(rows: pa.Table, name: str) -> np.ndarray:
    column = rows.column(name)
    if column.null_count:
        raise ValueError(f"nodes without {name}")
    return column.to_numpy()


def node_block(rows: pa.Table) -> bytes:
    """A block of nodes (id, lat, lon), to the ten millionth of a degree."""

    def whole(name: str) -> np.ndarray:
        units = np.rint(_known(rows, name) * 1e7)
        if not (np.abs(units) < 2.0**63).all():
            raise ValueError(f"{name} is no number of degrees")
        return units.astype(np.int64)

    dense = _field(_ID, _deltas(_known(rows, "id"))) + _field(_LAT, _deltas(whole("lat"))) + _field(_LON, _deltas(whole("lon")))
    return _field(_STRINGS, _field(1, b"")) + _field(_GROUP, _field(_DENSE, dense))


def way_block(rows: pa.Table) -> bytes:
    """A block of ways (id, tags, refs)."""
    rows = rows.to_pylist()
    strings: dict[str, int] = {"": 0}
    ways = []
    for r, refs in zip(rows, _each_deltas([r["refs"] or [] for r in rows])):
        tags = dict(r["tags"] or ())
        keys, values = (b"".join(_varint(strings.setdefault(s, len(strings))) for s in own) for own in (tags.keys(), tags.values()))
        ways.append(_field(_WAYS, _field(_ID, r["id"]) + _field(_KEYS, keys) + _field(_VALUES, values) + _field(_REFS, refs)))
    return _field(_STRINGS, b"".join(_field(1, s.encode()) for s in strings)) + _field(_GROUP, b"".join(ways))


class Written(WriterCommitMessage):
    def __init__(self, file: str):
        self.file = file


def _runs(batches: Iterator[pa.RecordBatch], names: list[str], size: int) -> Iterator[pa.Table]:
    """The rows in tables of ``size``, the last one of what is left."""
    held, many = [], 0
    for batch in batches:
        batch = batch.rename_columns(names)
        while many + batch.num_rows >= size:
            yield pa.Table.from_batches([*held, batch.slice(0, size - many)])
            batch, held, many = batch.slice(size - many), [], 0
        if batch.num_rows:
            held.append(batch)
            many += batch.num_rows
    if held:
        yield pa.Table.from_batches(held)


class BlockWriter(DataSourceArrowWriter):
    """One file of blocks a task. What a lost task has written is not seen: files get their name when all tasks have ended."""

    def __init__(self, path: str, schema: T.StructType, block_rows: int):
        self.path, self.block_rows, self.names = path, block_rows, schema.fieldNames()
        self.block = way_block if "refs" in self.names else node_block

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, folder = open_folder(self.path)
        system.create_dir(folder, recursive=True)
        at = f"{folder}/part-{uuid.uuid4().hex}.pbf"
        with system.open_output_stream(at + _UNSEEN) as out:
            out.write(_blob(b"OSMHeader", _field(4, b"OsmSchema-V0.6") + _field(4, b"DenseNodes")))
            for rows in _runs(batches, self.names, self.block_rows):
                out.write(_blob(b"OSMData", self.block(rows)))
        return Written(at)

    def commit(self, messages: list) -> None:
        for message in messages:
            open_folder(self.path)[0].move(message.file + _UNSEEN, message.file)

    def abort(self, messages: list) -> None:
        for message in messages:
            if message:
                open_folder(self.path)[0].delete_file(message.file + _UNSEEN)


def write_blocks(df: DataFrame, path: str, block_rows: int = 8000) -> None:
    """Add nodes or ways, told apart by the columns of :data:`NODE_SCHEMA` and :data:`WAY_SCHEMA`, to the extract at ``path``."""
    df.sparkSession.dataSource.register(OsmBlocks)
    df.write.format("osm_blocks").mode("append").option("block_rows", block_rows).save(path)
