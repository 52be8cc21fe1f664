"""Writers: resumable partitioned tables, global tables, map codes, alerts."""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions.numerics import KEEP_BITS, NO_DATA, STYLE_PERIODS, THICKNESS_EDGES


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a committed table is there (its _SUCCESS mark)."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def write_once(df: DataFrame, path: str, *partitions: str) -> bool:
    """Writes unless a complete table is there; an incomplete one is replaced. The committer makes it whole."""
    if exists(df.sparkSession, path):
        return False
    df.write.mode("overwrite").partitionBy(*partitions).parquet(path)
    return True


def write_partitions(df: DataFrame, path: str, *partitions: str, tasks: int = 1) -> None:
    """Replaces only the partitions in ``df``: history stays, the tail is written anew. Each partition's rows are written
    by ``tasks`` tasks, each with a file; the rows of a year of all rivers want many."""
    others = [c for c in df.columns if c not in partitions]
    spread = [F.pmod(F.xxhash64(*others), F.lit(tasks))] if tasks > 1 and others else []
    df.repartition(*partitions, *spread).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def unfinished(wanted: DataFrame, done: DataFrame, *keys: str) -> DataFrame:
    """The keys still to do after an interruption."""
    return wanted.join(done.select(*keys).distinct(), list(keys), "left_anti")


def write_rivers(df: DataFrame, path: str, blocks: int, key: str = "riverIndex") -> None:
    """Files of consecutive rivers, so that a range of rivers reads few row groups."""
    df.repartitionByRange(blocks, key).sortWithinPartitions(key).write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_by_step(rows: DataFrame, path: str) -> None:
    """The second layout: all rivers of one step together."""
    rows.repartition("step").sortWithinPartitions("riverIndex").write.mode("overwrite").partitionBy("step").parquet(path)


def write_browser_weights(weights: DataFrame, path: str) -> None:
    """Five columns, snappy, no dictionaries, one file."""
    columns = [F.col(c).cast(t) for c, t in (("river_id", "int"), ("x_index", "int"), ("y_index", "int"), ("area_sqm", "float"), ("proportion", "float"))]
    weights.select(*columns).coalesce(1).write.mode("overwrite").option("compression", "snappy").option("parquet.enable.dictionary", "false").parquet(path)


def write_global(parts: DataFrame, regions: DataFrame, path: str) -> bool:
    """All regions' rows in river order, once every region is there."""
    lacking = regions.select("region").distinct().join(parts.select("region").distinct(), "region", "left_anti")
    if not lacking.isEmpty():
        return False
    return write_once(parts.orderBy("riverIndex"), path)


def write_alerts(alerts: DataFrame, path: str) -> None:
    alerts.orderBy("riverIndex").coalesce(1).write.mode("overwrite").option("header", True).csv(path)


# Names of the header's entries, the stylesets there are, the encoding that readers expect.
STYLESETS = ("timeseries", "max-flow", "time-to-peak", "below-q95")
ENCODING = "uint8 (n_reaches, n_steps) C order, delta along steps modulo 256, zlib"
#: Rivers that a task packs, and the factor and modulus by which checksums of packed parts are put together.
RIVERS_A_PART, ADLER = 100_000, 65521


def _packed_parts(steps: int):
    """Deflates the delta bytes of a partition, ending on a byte so that parts can follow one another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, check, rivers, out, first = zlib.compressobj(6, zlib.DEFLATED, -15), 1, 0, [], None
        for batch in batches:
            lists = batch.column(1)
            if any(n != steps for n in lists.value_lengths().to_pylist()):
                raise ValueError(f"a river has other than {steps} steps")
            raw = lists.flatten().to_numpy().astype(np.uint8).tobytes()
            first = batch.column(0)[0].as_py() if first is None and batch.num_rows else first
            check, rivers = zlib.adler32(raw, check), rivers + batch.num_rows
            out.append(packer.compress(raw))
        if rivers:
            out.append(packer.flush(zlib.Z_FULL_FLUSH))
            yield pa.RecordBatch.from_pydict({"first": pa.array([first], pa.int64()), "rivers": pa.array([rivers], pa.int64()), "adler": pa.array([check], pa.int64()), "packed": pa.array([b"".join(out)], pa.binary())})

    return run


def _joined_check(one: int, other: int, length: int) -> int:
    """The Adler-32 checksum of two runs of bytes from theirs; ``length`` is that of the second."""
    low = ((one & 0xFFFF) + (other & 0xFFFF) - 1) % ADLER
    high = ((one >> 16) + (other >> 16) + length % ADLER * ((one & 0xFFFF) - 1)) % ADLER
    return high << 16 | low


class _Commit:
    """A file of any Hadoop file system that appears under its name only when it is whole."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, jvm = spark, spark._jvm.org.apache.hadoop.fs
        self.path, self.draft = jvm.Path(path), jvm.Path(f"{path}.{uuid.uuid4().hex}")
        self.fs = self.path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def __enter__(self):
        self.out = self.fs.create(self.draft, True)
        return self.out

    def __exit__(self, failure, *_) -> None:
        self.out.close()
        if failure is None:  # one step: who reads finds the old file or the new one
            jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
            over = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
            context.rename(self.draft, self.path, over)
        else:
            self.fs.delete(self.draft, False)


def write_styles(deltas: DataFrame, directory: str, styleset: str, start: str, timestamps: list[str], step_hours: int = 3, description: str = "", by_part: int = RIVERS_A_PART) -> None:
    """One styleset in a folder of any file system: delta bytes by river as one zlib stream, and a JSON header.

    ``deltas`` is (river, deltas array<int>), as ``thresholds.stylesets`` makes it. Tasks deflate ranges of rivers; the
    driver only strings packed parts together, one at a time. A styleset that does not exist, or a river with
    another number of steps, is an error, and nothing appears.
    """
    if styleset not in STYLESETS:
        raise ValueError(f"no such styleset: {styleset}")
    spark, count = deltas.sparkSession, len(timestamps)
    held = deltas.select("river", "deltas").persist(StorageLevel.DISK_ONLY)  # counted, cut into ranges and packed
    ranges = max(1, -(-held.count() // by_part))
    rows = held.select(F.col("river").cast("long"), F.col("deltas").cast("array<int>")).repartitionByRange(ranges, "river").sortWithinPartitions("river")
    parts = rows.mapInArrow(_packed_parts(count), "first long, rivers long, adler long, packed binary").orderBy("first")
    rivers, check = 0, 1
    with _Commit(spark, f"{directory}/styles.bin") as out:
        out.write(bytearray(b"\x78\x9c"))
        for part in parts.toLocalIterator():
            out.write(bytearray(part["packed"]))
            check, rivers = _joined_check(check, part["adler"], part["rivers"] * count), rivers + part["rivers"]
        out.write(bytearray(b"\x03\x00" + check.to_bytes(4, "big")))
    held.unpersist()
    about = {"styleset": styleset, "description": description, "initialization_time": start, "n_reaches": rivers, "n_steps": count}
    classes = {"ret_per_values": [0, *map(int, STYLE_PERIODS)], "thickness_edges": list(THICKNESS_EDGES), "no_data": NO_DATA}
    header = about | {"step_hours": step_hours, "timestamps": timestamps} | classes | {"encoding": ENCODING}
    with _Commit(spark, f"{directory}/styles.json") as out:
        out.write(bytearray(json.dumps(header, indent=1).encode()))


# Fixed value: the record before this day is history, which an append never writes again.
SPLIT_DATE = "2025-01-01"


def _pointer(spark: SparkSession, path: str) -> list[str]:
    """Names of the tail that counts and of the one before it."""
    jvm = spark._jvm.org.apache.hadoop.fs
    target = jvm.Path(f"{path}/_notes/tail.json")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return json.loads("".join(r[0] for r in spark.read.text(str(target)).collect())) if fs.exists(target) else []


def write_record(df: DataFrame, path: str, ts: str = "ts", split: str = SPLIT_DATE) -> None:
    """A record in two parts, history and tail. History is written once; later calls replace only the tail.

    A new tail is written whole beside the old one, under a name of its own; then the pointer to it is replaced in one
    step. Whoever reads meanwhile sees the old tail, and a write that fails changes nothing. The tail before stays until
    the next write, for readers that have begun with it; older ones, and what failed writes left, go.
    """
    spark = df.sparkSession
    own = df.withColumn("era", F.when(F.col(ts) < F.lit(split).cast("timestamp"), "history").otherwise("tail"))
    write_once(own.where("era = 'history'").drop("era").sortWithinPartitions("river", ts), f"{path}/history")
    before = _pointer(spark, path)
    fresh = f"tail-{uuid.uuid4().hex}"
    own.where("era = 'tail'").drop("era").sortWithinPartitions("river", ts).write.parquet(f"{path}/{fresh}")
    with _Commit(spark, f"{path}/_notes/tail.json") as out:
        out.write(bytearray(json.dumps([fresh, *before[:1]]).encode()))
    jvm = spark._jvm.org.apache.hadoop.fs
    fs = jvm.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(jvm.Path(path)):
        name = status.getPath().getName()
        if name.startswith("tail-") and name not in (fresh, *before[:1]):
            fs.delete(status.getPath(), True)


def read_record(spark: SparkSession, path: str) -> DataFrame:
    """History and the tail that counts, with the column era."""
    parts = [("history", f"{path}/history")] * exists(spark, f"{path}/history") + [("tail", f"{path}/{name}") for name in _pointer(spark, path)[:1]]
    frames = [spark.read.parquet(p).withColumn("era", F.lit(era)) for era, p in parts]
    if not frames:
        raise FileNotFoundError(f"no record in {path}")
    return frames[0].unionByName(frames[1]) if len(frames) > 1 else frames[0]


def described(df: DataFrame, notes: dict[str, dict]) -> DataFrame:
    """``df`` with notes on its columns (units, provenance); Parquet keeps them in the schema."""
    return df.select(*[F.col(c).alias(c, metadata=notes[c]) if c in notes else F.col(c) for c in df.columns])


def create_store(spark: SparkSession, table: str, columns: str, partitions: tuple[str, ...] = (), attributes: dict[str, str] | None = None, location: str | None = None) -> None:
    """An empty table with its columns, partitions and attributes; one that exists is an error."""
    quoted = lambda x: "'" + str(x).replace("\\", "\\\\").replace("'", "\\'") + "'"
    ddl = f"CREATE TABLE {table} ({columns}) USING parquet"
    if partitions:
        ddl += f" PARTITIONED BY ({', '.join(partitions)})"
    if location:
        ddl += f" LOCATION {quoted(location)}"
    if attributes:
        ddl += f" TBLPROPERTIES ({', '.join(f'{quoted(k)} = {quoted(v)}' for k, v in attributes.items())})"
    spark.sql(ddl)


# Columns of the published stores, and what their partitions are.
STORES = {
    "retrospective": ("riverId INT COMMENT 'river', time INT COMMENT 'hours since the first', Q FLOAT COMMENT 'm3 s-1', year INT", ("year",)),
    "forecast": ("riverId INT, member INT, time INT, Q FLOAT COMMENT 'm3 s-1', year INT, month INT, day INT", ("year", "month", "day")),
    "return_periods": ("riverId INT, distribution STRING, series STRING, recurrence_interval FLOAT COMMENT 'years', flow FLOAT COMMENT 'm3 s-1'", ("distribution", "series")),
}


def create_named_store(spark: SparkSession, kind: str, table: str, title: str, location: str | None = None) -> None:
    """One of the published stores, empty, with its title and rounding among its properties."""
    columns, partitions = STORES[kind]
    create_store(spark, table, columns, partitions, {"title": title, "keepbits": str(KEEP_BITS), "dimension": "riverId"}, location)
