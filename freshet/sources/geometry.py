"""Geometry columns: well-known binary polygons and multipolygons as rings, a bounded batch at a time.

The headers of all geometries of a batch are read side by side: one NumPy state vector holds where each geometry is
and how many polygons and rings it has to come; a step reads a polygon's or a ring's header of every geometry that is
not done. The coordinates of all rings are then gathered at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows and bytes decoded at once, whatever the size of the batches that come.
BATCH_ROWS, BATCH_BYTES = 20_000, 16 << 20
RINGS = "array<struct<hole:boolean,points:array<struct<x:double,y:double>>>>"
# Type codes, and the flags of the extended form for a height, a measure and a reference number.
POLYGON, MULTIPOLYGON, HAS_Z, HAS_M, HAS_SRID = 3, 6, 0x80000000, 0x40000000, 0x20000000


def bounded(batches: Iterator[pa.RecordBatch], column: int, rows: int = BATCH_ROWS, size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut to at most ``rows`` rows and ``size`` bytes of a binary column, or one row."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        begin = 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            end = min(begin + rows, max(begin + 1, int(np.searchsorted(ends, before + size, side="right"))))
            yield batch.slice(begin, end - begin)
            begin = end


class _Reader:
    """Numbers of either byte order at any offset of one buffer, for many offsets at once."""

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        self.data, self.ends = data, ends

    def whole(self, at: np.ndarray, of: np.ndarray, little: np.ndarray) -> np.ndarray:
        if (at + 4 > self.ends[of]).any():
            raise ValueError("a geometry ends before it is whole")
        raw = self.data[at[:, None] + np.arange(4)]
        return np.where(little, raw.view("<u4").ravel(), raw.view(">u4").ravel()).astype(np.int64)


def decoded(column: pa.Array, srid: int | None = None) -> pa.Array:
    """Rings of a binary column of polygons and multipolygons: null stays null, an empty geometry has no rings. The first
    ring of a polygon is its outline, others are holes; the point that closes a ring is left out, heights and measures
    too. Any other type, a geometry that is cut off, or one that names another reference system than ``srid``, is an
    error."""
    column = column.cast(pa.large_binary())
    buffers, n = column.buffers(), len(column)
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    read = _Reader(data, offsets[1:])
    live = np.flatnonzero(valid)
    at, polygons, rings, stride, little, first = offsets[:-1].copy(), *(np.zeros(n, np.int64) for _ in range(3)), np.zeros(n, bool), np.ones(n, bool)

    def header(of: np.ndarray) -> np.ndarray:
        """Byte order and type of the geometries ``of``; gives the plain type."""
        if (at[of] + 5 > read.ends[of]).any():
            raise ValueError("a geometry ends before it is whole")
        little[of] = data[at[of]] == 1
        code = read.whole(at[of] + 1, of, little[of])
        named = of[(code & HAS_SRID) > 0]
        if srid is not None and len(named):
            other = read.whole(at[named] + 5, named, little[named])
            if (other != srid).any():
                raise ValueError(f"reference system {int(other[other != srid][0])} in place of {srid}")
        at[of] += 5 + 4 * ((code & HAS_SRID) > 0)
        plain = code & 0x0FFFFFFF
        stride[of] = 2 + (((code & HAS_Z) > 0) | np.isin(plain // 1000, (1, 3))) + (((code & HAS_M) > 0) | np.isin(plain // 1000, (2, 3)))
        return plain % 1000

    kind = header(live)
    if not np.isin(kind, (POLYGON, MULTIPOLYGON)).all():
        raise ValueError(f"not a polygon: geometry type {int(kind[~np.isin(kind, (POLYGON, MULTIPOLYGON))][0])}")
    many, one = live[kind == MULTIPOLYGON], live[kind == POLYGON]
    polygons[many] = read.whole(at[many], many, little[many])
    at[many] += 4
    rings[one] = read.whole(at[one], one, little[one])
    at[one] += 4
    found = []
    while True:
        todo = np.flatnonzero((polygons > 0) | (rings > 0))
        if not len(todo):
            break
        ring = todo[rings[todo] > 0]
        count = read.whole(at[ring], ring, little[ring])
        size = 8 * stride[ring] * count
        if (at[ring] + 4 + size > read.ends[ring]).any():
            raise ValueError("a geometry ends before it is whole")
        found.append((ring, at[ring] + 4, count, ~first[ring], little[ring], stride[ring]))
        at[ring] += 4 + size
        rings[ring] -= 1
        first[ring] = False
        fresh = np.setdiff1d(todo, ring)
        if len(fresh):
            if (header(fresh) != POLYGON).any():
                raise ValueError("a multipolygon holds something else")
            rings[fresh] = read.whole(at[fresh], fresh, little[fresh])
            at[fresh] += 4
            polygons[fresh] -= 1
            first[fresh] = True
    of, start, count, hole, order, width = (np.concatenate([f[k] for f in found]) if found else np.empty(0, np.int64) for k in range(6))
    by = np.argsort(of, kind="stable")  # rings of a geometry in their order
    of, start, count, hole, order, width = of[by], start[by], count[by], hole[by].astype(bool), order[by].astype(bool), width[by]
    total = int(count.sum())
    step = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
    place = np.repeat(start, count) + 8 * np.repeat(width, count) * step
    raw = data[place[:, None] + np.arange(16)] if total else np.empty((0, 16), np.uint8)
    xy = np.where(np.repeat(order, count)[:, None], raw.view("<f8"), raw.view(">f8")).reshape(-1, 2)
    ends = np.cumsum(count)
    some = count > 1
    closed = np.zeros(len(count), bool)
    closed[some] = (xy[ends[some] - 1] == xy[(ends - count)[some]]).all(1)
    keep = np.ones(total, bool)
    keep[ends[closed] - 1] = False
    points = pa.StructArray.from_arrays([pa.array(xy[keep, k]) for k in range(2)], names=["x", "y"])
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(count - closed))), pa.int32()), points)
    struct = pa.StructArray.from_arrays([pa.array(hole), lists], names=["hole", "points"])
    bounds = np.searchsorted(of, np.arange(n + 1))
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32(), mask=np.append(~valid, False)), struct)


def with_rings(df: DataFrame, column: str, to: str = "rings", rows: int = BATCH_ROWS, size: int = BATCH_BYTES, srid: int | None = None) -> DataFrame:
    """``df`` with the rings of a binary geometry column in its place; with ``srid``, geometries that name another
    reference system are an error."""
    others = [c for c in df.columns if c != column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, len(others), rows, size):
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], decoded(batch.column(len(others)), srid)], names=[*others, to])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != column] + [f"`{to}` {RINGS}"])
    return df.select(*others, column).mapInArrow(run, schema)


def with_binary(df: DataFrame, column: str = "rings", to: str = "geometry") -> DataFrame:
    """``df`` with rings as well-known binary (little-endian): each outline begins a polygon that its holes follow; one
    polygon is written as such, any other number as a multipolygon. Rings are closed."""
    others = [c for c in df.columns if c != column]

    def number(x: int) -> bytes:
        return int(x).to_bytes(4, "little")

    def ring(points: list[dict]) -> bytes:
        xy = [(p["x"], p["y"]) for p in points]
        xy += xy[:1] if len(xy) > 1 and xy[0] != xy[-1] or len(xy) == 1 else []
        return number(len(xy)) + np.array(xy, "<f8").tobytes()

    def geometry(rings: list[dict] | None) -> bytes | None:
        if rings is None:
            return None
        polygons: list[list[bytes]] = []
        for r in rings:
            if not r["hole"] or not polygons:
                polygons.append([])
            polygons[-1].append(ring(r["points"]))
        bodies = [b"\x01" + number(POLYGON) + number(len(p)) + b"".join(p) for p in polygons]
        return bodies[0] if len(bodies) == 1 else b"\x01" + number(MULTIPOLYGON) + number(len(bodies)) + b"".join(bodies)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = pa.array([geometry(r) for r in batch.column(len(others)).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], packed], names=[*others, to])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != column] + [f"`{to}` binary"])
    return df.select(*others, F.col(column)).mapInArrow(run, schema)
