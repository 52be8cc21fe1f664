"""Chunked array stores (Zarr format 3: JSON metadata, one file a chunk) as a data source.

A store is a folder of arrays that share named dimensions; a one-dimensional array named like a dimension holds its
coordinates. ``register(spark)`` makes the format known; then

    spark.read.format("array_store").option("path", path).option("variables", "q").load()

gives a row for every element: the coordinate of each dimension, the year where a coordinate has units of time "... since ...",
and the variables, which must have equal dimensions and chunks; fill values are NULL. Comparisons of coordinates and
the year with constants reach the reader, which then opens only chunks that can hold wanted elements; no task is made
for the others. Any file system that Arrow opens by URI will do. Compressed chunks may be gzip or zstd.

Other chunk formats: give a subclass of ``ChunkReader`` to ``array_source`` and override ``decoded``.
"""

from __future__ import annotations

import gzip
import itertools
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

# Names of element types in the metadata, and of their columns.
TYPES = {"float32": "float", "float64": "double", "int8": "byte", "int16": "short", "int32": "int", "int64": "long", "uint8": "short", "bool": "boolean"}
UNITS = {"seconds": "s", "minutes": "m", "hours": "h", "days": "D"}
#: Bytes of elements, before compression, that a task reads; neighbouring chunks share one.
TASK_BYTES = 32 << 20


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


@dataclass
class Array:
    """The metadata of one array."""

    name: str
    shape: tuple[int, ...]
    chunks: tuple[int, ...]
    kind: str
    dims: tuple[str, ...]
    fill: float
    codec: str | None
    separator: str
    attributes: dict

    @classmethod
    def load(cls, fs: pafs.FileSystem, root: str, name: str) -> Array:
        with fs.open_input_stream(f"{root}/{name}/zarr.json") as f:
            spec = json.loads(f.read())
        if spec["zarr_format"] != 3 or spec["node_type"] != "array" or spec["chunk_grid"]["name"] != "regular" or spec["data_type"] not in TYPES:
            raise ValueError(f"not an array that can be read: {name}")
        codecs = [c["name"] for c in spec["codecs"]]
        if codecs[0] != "bytes" or spec["codecs"][0].get("configuration", {}).get("endian", "little") != "little" or len(codecs) > 2 or codecs[1:] not in ([], ["gzip"], ["zstd"]):
            raise ValueError(f"codecs {codecs} of {name} are not known")
        grid = spec["chunk_grid"]["configuration"]["chunk_shape"]
        dims = spec.get("dimension_names") or [f"dim{k}" for k in range(len(grid))]
        separator = spec["chunk_key_encoding"].get("configuration", {}).get("separator", "/")
        return cls(name, tuple(spec["shape"]), tuple(grid), spec["data_type"], tuple(dims), float(spec["fill_value"]), (codecs[1:] or [None])[0], separator, spec.get("attributes", {}))

    def spec(self) -> dict:
        codecs = [{"name": "bytes", "configuration": {"endian": "little"}}]
        if self.codec:
            codecs.append({"name": self.codec, "configuration": {"level": 5} | ({"checksum": False} if self.codec == "zstd" else {})})
        fill = self.fill if self.kind.startswith("float") and self.fill == self.fill else "NaN" if self.kind.startswith("float") else int(self.fill)
        return {
            "zarr_format": 3, "node_type": "array", "shape": list(self.shape), "data_type": self.kind, "chunk_grid": {"name": "regular", "configuration": {"chunk_shape": list(self.chunks)}},
            "chunk_key_encoding": {"name": "default", "configuration": {"separator": self.separator}}, "fill_value": fill, "codecs": codecs, "dimension_names": list(self.dims), "attributes": self.attributes,
        }

    def key(self, index: tuple[int, ...]) -> str:
        return self.separator.join(["c", *map(str, index)])

    def grid(self) -> list[int]:
        return [-(-n // c) for n, c in zip(self.shape, self.chunks)]


def encoded(block: np.ndarray, codec: str | None) -> bytes:
    raw = np.ascontiguousarray(block).astype(block.dtype.newbyteorder("<")).tobytes()
    if codec == "zstd":
        import zstandard

        return zstandard.ZstdCompressor(level=5).compress(raw)
    return gzip.compress(raw, 5, mtime=0) if codec == "gzip" else raw


class ChunkReader:
    """How a chunk becomes an array. Subclasses override ``decoded`` for stores of another chunk format."""

    def decoded(self, data: bytes, array: Array) -> np.ndarray:
        if array.codec == "zstd":
            import zstandard

            data = zstandard.ZstdDecompressor().decompress(data, max_output_size=int(np.prod(array.chunks)) * 8)
        elif array.codec == "gzip":
            data = gzip.decompress(data)
        return np.frombuffer(data, np.dtype(array.kind).newbyteorder("<")).reshape(array.chunks)

    def chunk(self, fs: pafs.FileSystem, root: str, array: Array, index: tuple[int, ...]) -> np.ndarray:
        """The elements of a chunk that lie within the shape; a chunk without a file is all fill values."""
        within = tuple(slice(0, min(c, n - i * c)) for i, c, n in zip(index, array.chunks, array.shape))
        path = f"{root}/{array.name}/{array.key(index)}"
        if fs.get_file_info(path).type == pafs.FileType.NotFound:
            fill = array.fill if array.kind.startswith("float") else int(array.fill)
            return np.full(array.chunks, fill, array.kind)[within]
        with fs.open_input_stream(path) as f:
            return self.decoded(f.read(), array)[within]

    def whole(self, fs: pafs.FileSystem, root: str, array: Array) -> np.ndarray:
        """A one-dimensional array."""
        return np.concatenate([self.chunk(fs, root, array, (i,)) for i in range(array.grid()[0])] or [np.empty(0, array.kind)])


def dated(units: str | None) -> bool:
    return re.match(rf"({'|'.join(UNITS)}) since ", str(units)) is not None


def years(values: np.ndarray, units: str) -> np.ndarray:
    """The calendar year of numbers in ``units`` ("hours since 1940-01-01")."""
    unit, start = re.fullmatch(r"(\w+) since (.+)", units).groups()
    start = np.datetime64(re.sub(r"^(\d{4}-\d\d-\d\d)[ T]?(.*?)(?:Z|\+00:00)?$", lambda m: m[1] + ("T" + m[2] if m[2] else ""), start.strip()), "s")
    return (start + values.astype(f"timedelta64[{UNITS[unit]}]").astype("timedelta64[s]")).astype("datetime64[Y]").astype(np.int64) + 1970


class Chunks(InputPartition):
    def __init__(self, indices: list[tuple[int, ...]]):
        super().__init__(indices)


class ArrayReader(DataSourceReader):
    def __init__(self, options: dict, chunks: ChunkReader):
        self.path, self.chunks, self.filters = options["path"], chunks, []
        fs, root = _opened(self.path)
        self.arrays = [Array.load(fs, root, v.strip()) for v in options["variables"].split(",")]
        first = self.arrays[0]
        if any((a.dims, a.shape, a.chunks) != (first.dims, first.shape, first.chunks) for a in self.arrays):
            raise ValueError("variables differ in dimensions or chunks")
        self.axes = {}
        for name, n in zip(first.dims, first.shape):
            axis = None
            if fs.get_file_info(f"{root}/{name}/zarr.json").type != pafs.FileType.NotFound:
                axis = Array.load(fs, root, name)
                if axis.shape != (n,):
                    raise ValueError(f"the coordinates of {name} have another length")
            self.axes[name] = axis
        self.task_bytes = int(options.get("taskbytes", TASK_BYTES))

    def columns(self) -> str:
        out = [f"`{n}` {TYPES[a.kind] if a else 'long'}" for n, a in self.axes.items()]
        if any(a and dated(a.attributes.get("units")) for a in self.axes.values()):
            out.append("`year` int")
        return ", ".join(out + [f"`{a.name}` {TYPES[a.kind]}" for a in self.arrays])

    def _coordinates(self, fs, root) -> dict[str, tuple[str, np.ndarray]]:
        """Of each column that depends on one dimension: the dimension and the values along it."""
        out = {}
        for (name, axis), n in zip(self.axes.items(), self.arrays[0].shape):
            out[name] = name, self.chunks.whole(fs, root, axis) if axis else np.arange(n)
            units = str(axis.attributes.get("units")) if axis else ""
            if dated(units) and "year" not in out:
                out["year"] = name, years(out[name][1], units)
        return out

    def pushFilters(self, filters):
        """Comparisons of coordinates leave chunks out; Spark applies all filters again to the rows."""
        known = (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, In)
        self.filters = [f for f in filters if isinstance(f, known) and len(f.attribute) == 1 and (f.attribute[0] in self.axes or f.attribute[0] == "year")]
        yield from filters

    @staticmethod
    def _true(f, x: np.ndarray) -> np.ndarray:
        if isinstance(f, In):
            return np.isin(x, [v for v in f.value if v is not None])
        return {EqualTo: np.equal, GreaterThan: np.greater, GreaterThanOrEqual: np.greater_equal, LessThan: np.less, LessThanOrEqual: np.less_equal}[type(f)](x, f.value)

    def partitions(self) -> list[Chunks]:
        fs, root = _opened(self.path)
        first = self.arrays[0]
        coordinates = self._coordinates(fs, root) if self.filters else {}
        wanted = {name: np.ones(n, bool) for name, n in zip(first.dims, first.shape)}
        for f in self.filters:
            if f.attribute[0] in coordinates:
                dim, values = coordinates[f.attribute[0]]
                wanted[dim] &= self._true(f, values)
        slots = [[i for i in range(g) if wanted[d][i * c : (i + 1) * c].any()] for d, g, c in zip(first.dims, first.grid(), first.chunks)]
        size = int(np.prod(first.chunks)) * sum(np.dtype(a.kind).itemsize for a in self.arrays)
        every = list(itertools.product(*slots))
        together = max(1, self.task_bytes // size)
        return [Chunks(every[i : i + together]) for i in range(0, len(every), together)] or [Chunks([])]

    def read(self, partition: Chunks) -> Iterator[pa.RecordBatch]:
        fs, root = _opened(self.path)
        coordinates = self._coordinates(fs, root) if partition.value else {}
        first = self.arrays[0]
        for index in partition.value:
            blocks = [self.chunks.chunk(fs, root, a, index) for a in self.arrays]
            shape = blocks[0].shape
            columns = {}
            for name, (dim, values) in coordinates.items():
                k = first.dims.index(dim)
                part = values[index[k] * first.chunks[k] :][: shape[k]]
                columns[name] = pa.array(np.broadcast_to(part.reshape([-1 if j == k else 1 for j in range(len(shape))]), shape).ravel())
            year = columns.pop("year", None)
            if year is not None:
                columns["year"] = year.cast(pa.int32())
            for a, block in zip(self.arrays, blocks):
                flat = block.ravel()
                gone = np.isnan(flat) if a.kind.startswith("float") else None
                if gone is not None and a.fill == a.fill:
                    gone |= flat == a.fill
                columns[a.name] = pa.array(flat, mask=gone).cast(pa.int16()) if a.kind == "uint8" else pa.array(flat, mask=gone)
            yield pa.RecordBatch.from_pydict(columns)


@dataclass
class Written(WriterCommitMessage):
    names: list[tuple[str, str]]


class ChunkWriter(DataSourceWriter):
    """Rows (key, data): each becomes a file. Tasks write drafts; on commit they get their names, metadata last."""

    def __init__(self, options: dict):
        self.path, self.meta = options["path"], options["metadata"]

    def write(self, iterator) -> Written:
        fs, root = _opened(self.path)
        names = []
        for row in iterator:
            draft = f"{root}/.drafts/{uuid.uuid4().hex}"
            fs.create_dir(f"{root}/.drafts")
            with fs.open_output_stream(draft) as f:
                f.write(bytes(row["data"]))
            names.append((draft, f"{root}/{row['key']}"))
        return Written(names)

    def commit(self, messages) -> None:
        fs, root = _opened(self.path)
        for draft, name in itertools.chain.from_iterable(m.names for m in messages if m):
            fs.create_dir(name.rpartition("/")[0])
            fs.move(draft, name)
        for name, spec in json.loads(self.meta).items():
            fs.create_dir(f"{root}/{name}" if name else root)
            with fs.open_output_stream(f"{root}/{name}/zarr.json") as f:
                f.write(json.dumps(spec).encode())

    def abort(self, messages) -> None:
        fs, _ = _opened(self.path)
        for draft, _ in itertools.chain.from_iterable(m.names for m in messages if m):
            fs.delete_file(draft)


def array_source(name: str = "array_store", chunks: type[ChunkReader] = ChunkReader) -> type[DataSource]:
    """A data source class of this name that reads chunks as ``chunks`` does."""
    format_name = name

    class ArraySource(DataSource):
        @classmethod
        def name(cls) -> str:
            return format_name

        def schema(self) -> str:
            return ArrayReader(self.options, chunks()).columns()

        def reader(self, schema) -> ArrayReader:
            return ArrayReader(self.options, chunks())

        def writer(self, schema, overwrite: bool) -> ChunkWriter:
            return ChunkWriter(self.options)

    return ArraySource


def register(spark: SparkSession, name: str = "array_store", chunks: type[ChunkReader] = ChunkReader) -> None:
    """Makes the format known, and lets filters reach it."""
    spark.dataSource.register(array_source(name, chunks))
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def write_array(df: DataFrame, path: str, name: str, dims: tuple[str, ...], shape: tuple[int, ...], chunks: tuple[int, ...], kind: str = "float32", codec: str | None = "zstd", attributes: dict | None = None) -> None:
    """Adds an array to the store at ``path``. ``df`` has the places along ``dims`` (whole numbers from 0) and ``value``.

    Each chunk is packed by one task, so a task holds one chunk's rows; elements without a row are fill values (NaN, or 0
    for whole numbers). The array's metadata appears last, so a failed write leaves no array. ``register`` comes first.
    """
    array = Array(name, tuple(shape), tuple(chunks), kind, tuple(dims), float("nan") if kind.startswith("float") else 0, codec, "/", attributes or {})
    ids = [F.floor(F.col(d) / c).cast("long").alias(f"_{d}") for d, c in zip(dims, chunks)]

    def pack(key, rows):
        block = np.full(array.chunks, array.fill if kind.startswith("float") else 0, kind)
        places = tuple(rows.column(d).to_numpy() - k.as_py() * c for d, k, c in zip(dims, key, array.chunks))
        block[places] = rows.column("value").to_numpy()
        return pa.table({"key": pa.array([f"{name}/{array.key(tuple(k.as_py() for k in key))}"]), "data": pa.array([encoded(block, codec)], pa.binary())})

    packed = df.select(*[F.col(d).cast("long").alias(d) for d in dims], "value").where("value is not null").groupBy(*ids).applyInArrow(pack, "key string, data binary")
    root = {"zarr_format": 3, "node_type": "group", "attributes": {}}
    packed.write.format("array_store").option("path", path).option("metadata", json.dumps({"": root, name: array.spec()})).mode("append").save()


def read_arrays(spark: SparkSession, path: str, *variables: str, format: str = "array_store", **where) -> DataFrame:
    """The variables of a store; keyword arguments name columns and give a least and greatest value, or a list of values."""
    df = spark.read.format(format).option("path", path).option("variables", ",".join(variables)).load()
    tests = [F.col(c).isin(v) if isinstance(v, list) else F.col(c).between(*v) for c, v in where.items()]
    return df.where(reduce(lambda a, b: a & b, tests)) if tests else df
