"""Functions of blocks of rivers: each block is computed by one task, committed by itself and done once."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def done_blocks(spark: SparkSession, path: str) -> DataFrame:
    """(block, rows) of the blocks whose file is there."""
    fs, root = pafs.FileSystem.from_uri(path)
    found = []
    for info in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
        match = re.fullmatch(r"block-(\d+)-(\d+)\.parquet", info.base_name)
        if match:
            found.append((int(match[1]), int(match[2])))
    return spark.createDataFrame(found, "block long, rows long")  # two numbers a block


def run_blocks(df: DataFrame, path: str, function: Callable[[int, pa.Table], pa.Table], size: int, key: str = "riverIndex") -> int:
    """Applies ``function(block, rows)`` to blocks of ``size`` consecutive rivers; gives how many blocks were computed.

    Blocks are aligned (block = key div size). A task gets the rows of one block, as one Arrow table; the table that
    the function gives is written beside and moved to block-<number>-<rows>.parquet, so a block is there in full or not at
    all, a task that is repeated does no harm, and a run after an interruption computes only the blocks that are not
    there. Blocks without rows are not computed; an empty result is a file without rows. ``path`` is a URI that all
    executors share.
    """
    spark = df.sparkSession
    names = df.columns
    block = F.floor(F.col(key) / size).cast("long")
    left = df.withColumn("_block", block).join(F.broadcast(done_blocks(spark, path).select(F.col("block").alias("_block"))), "_block", "left_anti")

    def one(key, rows):
        number = key[0].as_py()
        result = function(number, rows.select(names))
        fs, root = pafs.FileSystem.from_uri(path)
        fs.create_dir(root)
        draft = f"{root}/.draft-{number}-{uuid.uuid4().hex}"
        pq.write_table(result, draft, filesystem=fs)
        fs.move(draft, f"{root}/block-{number:08d}-{result.num_rows}.parquet")
        return pa.table({"block": pa.array([number], pa.int64()), "rows": pa.array([result.num_rows], pa.int64())})

    return left.groupBy("_block").applyInArrow(one, "block long, rows long").count()


def read_blocks(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """The rows of all blocks, or of those from ``first`` to ``last``."""
    if first is None and last is None:
        return spark.read.parquet(path)
    wanted = [r["block"] for r in done_blocks(spark, path).collect() if (first is None or r["block"] >= first) and (last is None or r["block"] <= last)]
    return spark.read.parquet(*[f"{path}/block-{b:08d}-*.parquet" for b in wanted])
