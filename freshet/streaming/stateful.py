"""State that a stream carries from batch to batch: increments and running totals, and writes that survive a restart."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from freshet.sinks.writers import _Commit

STATE = "hours bigint, ro double, total double, n bigint"
FLOWING = "cell bigint, hours bigint, ro double, step_ro double, total double, n bigint, what string"


class Increments(StatefulProcessor):
    """Of each cell: the last accumulation, the running total of increments and the number of steps.

    Accumulations at hours that are not after the last one are late: they are given back as such and change nothing.
    With ``quiet`` hours of event time (column ts and a watermark), a cell without rows for so long gives its state
    back as a closing row and is forgotten.
    """

    def __init__(self, quiet: float | None = None):
        self.quiet = quiet

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.last = handle, handle.getValueState("last", STATE)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        row = initialState.sort_values("hours").iloc[-1]
        self.last.update((int(row["hours"]), float(row["ro"]), float(row["total"]), int(row["n"])))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        hours, ro, total, n = self.last.get() if self.last.exists() else (None, 0.0, 0.0, 0)
        batch = pd.concat(list(rows)).sort_values("hours", kind="stable")  # one cell's rows of one micro-batch
        out = []
        for at, value in zip(batch["hours"].tolist(), batch["ro"].tolist()):
            if hours is not None and at <= hours:
                out.append((key[0], at, value, None, None, None, "late"))
                continue
            total, n = total + (value - ro), n + 1
            out.append((key[0], at, value, value - ro, total, n, "step"))
            hours, ro = at, value
        self.last.update((hours, ro, total, n))
        if self.quiet is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            latest = int(batch["ts"].max().timestamp() * 1000)
            self.handle.registerTimer(max(latest, timerValues.getCurrentWatermarkInMs()) + int(self.quiet * 3_600_000))
        yield _rows(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        hours, ro, total, n = self.last.get()
        self.last.clear()
        yield _rows([(key[0], hours, ro, None, total, n, "closed")])

    def close(self) -> None:
        pass


def _rows(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in FLOWING.split(", ")])
    return frame.astype({"step_ro": "float64", "total": "float64", "n": "Int64"})


def with_state_store(spark: SparkSession) -> None:
    """State of many cells lies in RocksDB, on the executors' disks, with changelogs in the checkpoint."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def flowing_increments(stream: DataFrame, start: DataFrame | None = None, quiet: float | None = None) -> DataFrame:
    """(cell, hours, ro, step_ro, total, n, what) of a stream (cell, hours, ro): what fell since the step before, the running
    total and the number of steps, across micro-batches and restarts.

    ``start`` (cell, hours, ro, total, n) is the state to begin with, such as the end of a batch job; it counts only when
    the query first starts. ``quiet``: see ``Increments``; ``stream`` then has ts. Rows whose cell, hours or ro is null
    are left out. The rows of one cell in one micro-batch are ordered by hours; ``maxFilesPerTrigger`` bounds a batch.
    """
    usable = stream.where("cell is not null and hours is not null and ro is not null")
    columns = [F.col("cell").cast("long").alias("cell"), F.col("hours").cast("long").alias("hours"), F.col("ro").cast("double").alias("ro")]
    usable = usable.select(*columns, *(["ts"] if quiet is not None else []))
    if quiet is not None:
        usable = usable.withWatermark("ts", "0 seconds")
    first = None if start is None else start.select(*columns, F.col("total").cast("double").alias("total"), F.col("n").cast("long").alias("n")).groupBy("cell")
    return usable.groupBy("cell").transformWithStateInPandas(Increments(quiet), outputStructType=FLOWING, outputMode="Append", timeMode="None" if quiet is None else "EventTime", initialState=first)


def last_states(rows: DataFrame) -> DataFrame:
    """The state after the rows that ``flowing_increments`` gave: what another query may start with."""
    last = F.max_by(F.struct("hours", "ro", "total", "n"), "hours").alias("s")
    return rows.where("what = 'step'").groupBy("cell").agg(last).select("cell", "s.hours", "s.ro", "s.total", "s.n")


class Layout(ValueError):
    """A table that is there has other columns or partitions than what is to be added."""


class Resumable:
    """A sink for ``foreachBatch`` that gets every batch once, whatever fails in between.

    The rows of a batch are a partition ``batch=<id>`` of the table, written by overwriting that partition: a batch that
    is repeated after a failure takes its own place. When the rows are there, a progress file gets the batch's number
    and rows; readers count only batches that progress knows. The first batch notes the table's layout, and a restart
    whose columns, types or partitions differ is refused before anything is written.
    """

    def __init__(self, path: str, partitions: tuple[str, ...] = (), after_data: Callable[[int], None] | None = None):
        self.path, self.partitions, self.after_data = path.rstrip("/"), partitions, after_data

    def _load(self, spark: SparkSession, name: str):
        jvm = spark._jvm.org.apache.hadoop.fs
        target = jvm.Path(f"{self.path}/_notes/{name}")
        fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return json.loads("\n".join(r[0] for r in spark.read.text(str(target)).collect())) if fs.exists(target) else None

    def _save(self, spark: SparkSession, name: str, value) -> None:
        with _Commit(spark, f"{self.path}/_notes/{name}") as out:
            out.write(bytearray(json.dumps(value).encode()))

    def layout(self, df: DataFrame) -> dict:
        return {"columns": [[c, t] for c, t in df.dtypes], "partitions": list(self.partitions)}

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        held = self._load(spark, "layout.json")
        if held is None:
            self._save(spark, "layout.json", self.layout(batch))
        elif held != self.layout(batch):
            raise Layout(f"{self.path} has {held}, the batch {self.layout(batch)}")
        done = self.progress(spark)
        if number <= done["batch"]:  # known in full already: the stream's own checkpoint is older than its data
            return
        rows = batch.withColumn("batch", F.lit(number).cast("long"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", *self.partitions).parquet(f"{self.path}/rows")
        if self.after_data:
            self.after_data(number)
        self._save(spark, "progress.json", {"batch": number})

    def progress(self, spark: SparkSession) -> dict:
        """{"batch": number of the last batch that is there in full, -1 before the first}."""
        return self._load(spark, "progress.json") or {"batch": -1}

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows of all batches that progress knows."""
        held = self._load(spark, "layout.json")
        schema = ", ".join(f"`{c}` {t}" for c, t in held["columns"])
        rows = spark.read.schema(f"{schema}, batch long").parquet(f"{self.path}/rows")
        return rows.where(F.col("batch") <= self.progress(spark)["batch"]).drop("batch")


def resume(stream: DataFrame, sink: Resumable, checkpoint: str) -> None:
    """Handles what is there and ends; a later call goes on from the checkpoint and repeats what was not finished."""
    stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
