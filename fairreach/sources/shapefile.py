"""Polygon layers as shapefiles: a data source whose partitions are ranges of records.

The index file (.shx) tells where records begin, and rows of the attribute file (.dbf) have one length, so a task reads the bytes of its
records and no others. Paths are opened through Arrow's file systems. A layer is a ``.shp`` file or a folder of them, each with its
two companions; writing gives one of them a task.
"""

from __future__ import annotations

import posixpath
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from fairreach.functions.geo import MULTIPOLYGON

#: Records that a task reads.
RECORDS = 5_000
# fixed values of the format: code and version of the header, shape types, end of the field list, marks of rows
_CODE, _VERSION, _HEADER = 9994, 1000, 100
_NULL, _POLYGON_TYPES = 0, {5, 15, 25}
_FIELDS_END, _DELETED = 0x0D, ord("*")
#: Encoding and width of attributes that are written: the format's greatest.
_ENCODING, _WIDTH = "utf-8", 254
_UNSEEN = ".unseen"
_POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path in it."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = f"file://{path[5:]}"
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), posixpath.abspath(path))


def files_of(path: str, suffix: str) -> list[str]:
    """The file at a path, or those of a folder that end in ``suffix``."""
    system, at = open_folder(path)
    if system.get_file_info(at).type == fs.FileType.File:
        return [at]
    return sorted(f.path for f in system.get_file_info(fs.FileSelector(at)) if f.path.endswith(suffix))


def read_range(path: str, at: str, begin: int, size: int) -> bytes:
    with open_folder(path)[0].open_input_file(at) as file:
        return file.read_at(size, begin)


class _Records(InputPartition):
    def __init__(self, file: str, first: int, count: int):
        self.file, self.first, self.count = file, first, count


class ShapefileReader(DataSourceReader):
    def __init__(self, path: str, records: int):
        self.path, self.records = path, records

    def partitions(self) -> list[_Records]:
        system, _ = open_folder(self.path)
        out = []
        for file in files_of(self.path, ".shp"):
            many = (system.get_file_info(f"{file[:-4]}.shx").size - _HEADER) // 8
            out += [_Records(file, a, min(self.records, many - a)) for a in range(0, many, self.records)]
        return out

    def read(self, part: _Records | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # a layer without records has no partition
            return
        index = np.frombuffer(read_range(self.path, f"{part.file[:-4]}.shx", _HEADER + 8 * part.first, 8 * part.count), ">i4").reshape(-1, 2) * 2
        begin, end = int(index[0, 0]), int(index[-1].sum()) + 8
        data = read_range(self.path, part.file, begin, end - begin)
        shapes = [_rings(data[at - begin + 8 : at - begin + 8 + size]) for at, size in index.tolist()]
        names, rows = _attributes(self.path, f"{part.file[:-4]}.dbf", part.first, part.count)
        kept = [k for k, row in enumerate(rows) if row is not None]
        properties = pa.array([list(zip(names, rows[k], strict=True)) for k in kept], pa.map_(pa.string(), pa.string()))
        yield pa.RecordBatch.from_arrays([properties, _nested([shapes[k] for k in kept])], names=["properties", "geometry"])


def _rings(content: bytes) -> list[list[np.ndarray]] | None:
    """The polygons of a record, each an outer ring and its holes; None for a record without a shape."""
    (kind,) = struct.unpack_from("<i", content)
    if kind == _NULL:
        return None
    if kind not in _POLYGON_TYPES:
        raise ValueError(f"shape type {kind} is no polygon")
    parts, points = struct.unpack_from("<2i", content, 36)
    starts = np.frombuffer(content, "<i4", parts, 44).tolist()
    xy = np.frombuffer(content, "<f8", 2 * points, 44 + 4 * parts).reshape(-1, 2)
    rings = [xy[a:b] for a, b in zip(starts, [*starts[1:], points], strict=True)]
    # outer rings run clockwise, holes the other way
    outer = [[r] for r in rings if _area(r) <= 0]
    for hole in (r for r in rings if _area(r) > 0):
        around = [p for p in outer if _holds(p[0], *hole[0])]
        if around:
            min(around, key=lambda p: abs(_area(p[0]))).append(hole)
        else:
            outer.append([hole])  # wound the wrong way
    return outer


def _area(ring: np.ndarray) -> float:
    """Positive for a ring that runs anticlockwise."""
    x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
    return float((x[:-1] * y[1:] - x[1:] * y[:-1]).sum()) / 2


def _holds(ring: np.ndarray, x: float, y: float) -> bool:
    a, b = ring[:-1], ring[1:]
    over = (a[:, 1] > y) != (b[:, 1] > y)
    a, b = a[over], b[over]
    return bool((a[:, 0] + (y - a[:, 1]) * (b[:, 0] - a[:, 0]) / (b[:, 1] - a[:, 1]) > x).sum() % 2)


def _nested(shapes: list) -> pa.Array:
    """Multipolygons from the points of their rings, by offsets."""
    rings = [ring for shape in shapes for poly in shape or () for ring in poly]
    xy = np.concatenate(rings) if rings else np.zeros((0, 2))
    points = pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], fields=list(_POINT))
    cuts = lambda sizes: pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    ring_list = pa.ListArray.from_arrays(cuts([len(r) for r in rings]), points)
    polys = pa.ListArray.from_arrays(cuts([len(poly) for shape in shapes for poly in shape or ()]), ring_list)
    missing = pa.array([shape is None for shape in shapes], pa.bool_())
    return pa.ListArray.from_arrays(cuts([len(shape or ()) for shape in shapes]), polys, mask=missing)


def _attributes(path: str, at: str, first: int, count: int) -> tuple[list[str], list[list | None]]:
    """Names of the attributes and their texts in some rows; None for a deleted row."""
    _, head, width = struct.unpack("<IHH", read_range(path, at, 4, 8))
    fields, names, sizes = read_range(path, at, 32, head - 32), [], []
    while fields and fields[0] != _FIELDS_END:
        names.append(fields[:11].split(b"\0")[0].decode(_ENCODING))
        sizes.append(fields[16])
        fields = fields[32:]
    cuts = np.concatenate([[1], 1 + np.cumsum(sizes)]).tolist()
    data, rows = read_range(path, at, head + width * first, width * count), []
    for k in range(count):
        row = data[k * width : (k + 1) * width]
        texts = [row[a:b].decode(_ENCODING, "replace").strip() or None for a, b in zip(cuts, cuts[1:], strict=False)]
        rows.append(None if row[0] == _DELETED else texts)
    return names, rows


class ShapefileWriter(DataSourceWriter):
    """One layer file a task. What a lost task has written is not seen: files get their name when all tasks have ended."""

    def __init__(self, path: str, schema: T.StructType):
        self.path, self.names = path, [f.name for f in schema.fields if f.name != "geometry"]
        if len({n[:10] for n in self.names}) < len(self.names):
            raise ValueError("names of attributes have ten letters, and these are then alike")

    def write(self, rows: Iterator) -> WriterCommitMessage:
        records, index, table, words = [], [], [], _HEADER // 2
        for row in rows:
            content = _content(row["geometry"])
            index.append(struct.pack(">2i", words, len(content) // 2))
            records.append(struct.pack(">2i", len(records) + 1, len(content) // 2) + content)
            words += 4 + len(content) // 2
            texts = ["" if row[n] is None else str(row[n]) for n in self.names]
            if any(len(t.encode(_ENCODING)) > _WIDTH for t in texts):
                raise ValueError(f"an attribute has at most {_WIDTH} bytes")
            table.append(b" " + b"".join(t.encode(_ENCODING).ljust(_WIDTH) for t in texts))
        fields = b"".join(n.encode(_ENCODING)[:10].ljust(11, b"\0") + b"C" + bytes(4) + bytes([_WIDTH]) + bytes(15) for n in self.names)
        head = struct.pack("<4BIHH20x", 3, 0, 1, 1, len(table), 33 + len(fields), 1 + _WIDTH * len(self.names))
        system, folder = open_folder(self.path)
        system.create_dir(folder, recursive=True)
        base = f"{folder}/part-{uuid.uuid4().hex}"
        top = lambda size: struct.pack(">i20xi", _CODE, size) + struct.pack("<2i8d", _VERSION, 5, *[0.0] * 8)
        made = {".shx": top(50 + 4 * len(index)) + b"".join(index), ".dbf": head + fields + bytes([_FIELDS_END]) + b"".join(table), ".shp": top(words) + b"".join(records)}
        for suffix, content in made.items():
            with system.open_output_stream(base + suffix + (_UNSEEN if suffix == ".shp" else "")) as out:
                out.write(content)
        return Written(base)

    def commit(self, messages: list) -> None:
        system, _ = open_folder(self.path)
        for message in messages:
            system.move(f"{message.base}.shp{_UNSEEN}", f"{message.base}.shp")

    def abort(self, messages: list) -> None:
        system, _ = open_folder(self.path)
        for message in messages:
            for suffix in (f".shp{_UNSEEN}", ".shx", ".dbf") if message else ():
                system.delete_file(message.base + suffix)


class Written(WriterCommitMessage):
    def __init__(self, base: str):
        self.base = base


def _content(geometry: list | None) -> bytes:
    """A polygon record: rings closed, outer ones clockwise and holes the other way."""
    if geometry is None:
        return struct.pack("<i", _NULL)
    rings = []
    for poly in geometry:
        for k, ring in enumerate(poly):
            xy = np.array([(p["x"], p["y"]) for p in ring], float).reshape(-1, 2)
            if len(xy) and (xy[0] != xy[-1]).any():
                xy = np.concatenate([xy, xy[:1]])
            rings.append(xy[::-1] if len(xy) and (_area(xy) > 0) == (k == 0) else xy)
    xy = np.concatenate(rings) if rings else np.zeros((0, 2))
    starts = np.cumsum([0, *map(len, rings)])[: len(rings)]
    box = [*xy.min(0), *xy.max(0)] if len(xy) else [0.0] * 4
    return struct.pack("<i4d2i", 5, *box, len(rings), len(xy)) + starts.astype("<i4").tobytes() + xy.astype("<f8").tobytes()


class Shapefile(DataSource):
    """``properties map<string,string>, geometry``; option ``records`` is the number of records a task reads."""

    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def schema(self) -> str:
        return f"properties map<string,string>, geometry {MULTIPOLYGON}"

    def reader(self, schema: T.StructType) -> ShapefileReader:
        return ShapefileReader(self.options["path"], int(self.options.get("records", RECORDS)))

    def writer(self, schema: T.StructType, overwrite: bool) -> ShapefileWriter:
        return ShapefileWriter(self.options["path"], schema)


def read_shapefile(spark: SparkSession, path: str, srid: int = 4326, properties: str | None = None, records: int = RECORDS) -> DataFrame:
    """Records as ``properties`` and ``geometry`` (multipolygon of points, null without a shape), as :func:`read_boundaries` gives features.

    ``properties`` names attributes and their types; without it they are a map of texts. The reference system is kept in the
    metadata of the geometry column.
    """
    spark.dataSource.register(Shapefile)
    rows = spark.read.format("shapefile").option("records", records).load(path)
    if properties:
        fields = T.StructType.fromDDL(properties).fields
        rows = rows.withColumn("properties", F.struct(*[F.col("properties")[f.name].cast(f.dataType).alias(f.name) for f in fields]))
    return rows.withMetadata("geometry", {"srid": srid})


def write_shapefile(df: DataFrame, path: str) -> None:
    """Add ``geometry`` (multipolygons) and the other columns as attributes to the layer at ``path``, one file a task."""
    df.sparkSession.dataSource.register(Shapefile)
    df.write.format("shapefile").mode("append").save(path)
