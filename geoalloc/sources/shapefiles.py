"""Polygon shapefiles read by ranges of records.

The index file of a set tells where every record lies, at a place of its own that follows
from the record's number; so does the attribute table. A set is planned as ranges of
records of bounded size, and each task reads its ranges of the three files by offset. No file
is read as a whole and no raw bytes are shuffled.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from geoalloc.functions.geometry import GEOM_TYPE, with_box

POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])
RANGE_BYTES, BATCH = 32 << 20, 2000
#: Record kinds of the public layout that hold areas (plain, with height, with measure), and the empty one.
AREAS, EMPTY = (5, 15, 25), 0


def open_files(folder: str):
    """The file system of a folder and its path there."""
    from pyarrow import fs

    if not re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*:/", folder):
        return fs.LocalFileSystem(), folder
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder))


def holds(ring: np.ndarray, q: np.ndarray) -> bool:
    a, b = ring[:-1], ring[1:]
    with np.errstate(divide="ignore", invalid="ignore"):
        x = a[:, 0] + (q[1] - a[:, 1]) * (b[:, 0] - a[:, 0]) / (b[:, 1] - a[:, 1])
    return bool((((a[:, 1] > q[1]) != (b[:, 1] > q[1])) & (x > q[0])).sum() % 2)


def polygons(rings: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Clockwise rings are shells, in the order given; each other one is a hole of the smallest shell around it.

    Only shells whose box holds a hole are looked at, and a lone shell has all holes in its box.
    A hole without a shell is a polygon of its own.
    """
    turns = [float(np.sum(r[:-1, 0] * r[1:, 1] - r[1:, 0] * r[:-1, 1])) for r in rings]
    shells = [i for i, t in enumerate(turns) if t <= 0]
    out = {i: [rings[i]] for i in shells}
    lost = []
    if shells:
        low, high = (np.array([f(rings[i], axis=0) for i in shells]) for f in (np.min, np.max))
        size = np.array([-turns[i] for i in shells])
    for i, t in enumerate(turns):
        if t <= 0:
            continue
        spot, found = (rings[i][0] + rings[i][1]) / 2, None
        if shells:
            near = np.flatnonzero(((low <= spot) & (spot <= high)).all(1))
            near = near[np.argsort(size[near], kind="stable")]
            found = next((shells[k] for k in near if len(shells) == 1 or holds(rings[shells[k]], spot)), None)
        (out[found] if found is not None else lost).append(rings[i] if found is not None else [rings[i]])
    return [*out.values(), *lost]


def record_rings(record: bytes, where: str) -> list[np.ndarray]:
    """Rings of the content of one record."""
    kind = struct.unpack_from("<i", record)[0] if len(record) >= 4 else EMPTY
    if kind == EMPTY:
        return []
    if kind not in AREAS:
        raise ValueError(f"{where}: a shape of kind {kind} is no area")
    parts, points = struct.unpack_from("<2i", record, 36)
    starts = np.frombuffer(record, "<i4", parts, 44).tolist() + [points]
    xy = np.frombuffer(record, "<f8", 2 * points, 44 + 4 * parts).reshape(-1, 2)
    return [xy[a:b] for a, b in zip(starts, starts[1:]) if b - a > 1]


def nested(rows: list[list[list[np.ndarray]]]) -> pa.Array:
    """Polygons of many rows as one nested column."""
    polys = [p for row in rows for p in row]
    rings = [r for p in polys for r in p]
    xy = np.concatenate(rings) if rings else np.empty((0, 2))

    def bounds(items):
        return pa.array(np.concatenate([[0], np.cumsum([len(x) for x in items])]).astype(np.int32))

    points = pa.StructArray.from_arrays([pa.array(xy[:, 0].copy()), pa.array(xy[:, 1].copy())], fields=list(POINT))
    return pa.ListArray.from_arrays(bounds(rows), pa.ListArray.from_arrays(bounds(polys), pa.ListArray.from_arrays(bounds(rings), points)))


class ShapefileReader(DataSourceReader):
    def __init__(self, options):
        self.folder, self.columns = options["path"], [c for c in options.get("columns", "").split("\n") if c]
        self.range_bytes = int(options.get("range_bytes", RANGE_BYTES))

    def sets(self) -> dict[str, dict[str, tuple[str, int]]]:
        """Paths and sizes of the files of each set, by the common name and the ending."""
        from pyarrow import fs

        store, folder = open_files(self.folder)
        out: dict[str, dict[str, tuple[str, int]]] = {}
        for info in store.get_file_info(fs.FileSelector(folder)):
            stem, dot, kind = info.path.rpartition(".")
            if info.is_file and dot and kind.lower() in ("shp", "dbf", "shx"):
                out.setdefault(stem, {})[kind.lower()] = (info.path, info.size)
        return out

    def partitions(self) -> list[InputPartition]:
        store, _ = open_files(self.folder)
        out = []
        for stem, files in sorted(self.sets().items()):
            for kind in ("shp", "dbf"):
                if kind not in files:
                    raise ValueError(f"{stem} has no .{kind} file")
            with store.open_input_file(files["dbf"][0]) as f:
                rows = struct.unpack("<I", f.read(8)[4:])[0]
            offsets = None
            if "shx" in files:
                records = (files["shx"][1] - 100) // 8
            else:  # hop from record to record: eight bytes of each are read
                offsets, at = [], 100
                with store.open_input_file(files["shp"][0]) as f:
                    while at + 12 <= files["shp"][1]:
                        f.seek(at)
                        size = struct.unpack(">2i", f.read(8))[1] * 2
                        offsets.append((at, size))
                        at += 8 + size
                records = len(offsets)
            if records != rows:
                raise ValueError(f"{stem}: the files have different numbers of records")
            step = max(1, records * self.range_bytes // max(1, files["shp"][1]))
            for first in range(0, records, step):
                last = min(records, first + step)
                out.append(InputPartition((stem, {k: p for k, (p, _) in files.items()}, first, last, offsets and offsets[first:last])))
        return out or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value is None:
            return
        stem, paths, first, last, offsets = partition.value
        store, _ = open_files(self.folder)
        if offsets is None:
            with store.open_input_file(paths["shx"]) as f:
                f.seek(100 + 8 * first)
                offsets = [(2 * a, 2 * n) for a, n in np.frombuffer(f.read(8 * (last - first)), ">i4").reshape(-1, 2).tolist()]
        with store.open_input_file(paths["dbf"]) as f:
            head, width = struct.unpack("<2H", f.read(12)[8:])
            f.seek(32)
            layout, at, fields = f.read(head - 32), 1, {}
            for k in range(0, len(layout) - 31, 32):
                if layout[k] == 0x0D:
                    break
                fields[layout[k : k + 11].split(b"\0")[0].decode("latin-1")] = (at, at + layout[k + 16])
                at += layout[k + 16]
            f.seek(head + first * width)
            table = f.read((last - first) * width)
        with store.open_input_file(paths["shp"]) as f:
            for a in range(0, last - first, BATCH):
                ids, shapes, texts = [], [], {c: [] for c in self.columns}
                for k in range(a, min(a + BATCH, last - first)):
                    row = table[k * width : (k + 1) * width]
                    if row[:1] == b"*":  # marked as deleted
                        continue
                    f.seek(offsets[k][0] + 8)
                    ids.append(first + k + 1)
                    shapes.append(polygons(record_rings(f.read(offsets[k][1]), f"{stem}, record {first + k + 1}")))
                    for c, xs in texts.items():
                        xs.append(row[slice(*fields[c])].decode("latin-1").strip() if c in fields else None)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([stem] * len(ids), pa.string()), *(pa.array(x, pa.string()) for x in texts.values()), nested(shapes)],
                                                 ["id", "file", *texts, "polys"])


class Shapefiles(DataSource):
    """Format ``polygon_shapefiles``: options ``path`` (a folder), ``columns`` (one per line) and ``range_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "polygon_shapefiles"

    def schema(self) -> str:
        columns = "".join(f"`{c}` string, " for c in self.options.get("columns", "").split("\n") if c)
        return f"id bigint, file string, {columns}polys array<array<array<struct<x:double,y:double>>>>"

    def reader(self, schema) -> DataSourceReader:
        return ShapefileReader(self.options)


def read_shapefile_shapes(spark: SparkSession, folder: str, columns: Sequence[str], srid: int = 4326,
                          id: str = "id_0", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Polygon shapefiles of a folder: one row per record with the named text columns.

    Records are numbered from 1 in each file. A set is read by ranges of about ``range_bytes`` of its
    shapes, each in a task of its own; without an index file the driver lists the records first.
    A file without its partner, or with another number of records, and shapes that are
    no areas are errors; empty shapes have no polygons, rows marked as deleted are left out.
    The folder is a path that all executors see, or one in a store that Arrow reads.
    """
    spark.dataSource.register(Shapefiles)
    read = spark.read.format("polygon_shapefiles").option("columns", "\n".join(columns)).option("range_bytes", str(range_bytes)).load(folder)
    rows = read.withColumn("geom", F.struct(F.lit(srid).alias("srid"), "polys").cast(GEOM_TYPE)).drop("polys")
    return with_box(rows.withColumnRenamed("id", id))
