"""Partitions of equal cost for stages that spend CPU, not bytes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hash buckets whose costs are summed, and most partitions that they are cut into.
BUCKETS, MOST_PARTS = 1 << 18, 1 << 14


def cuts(held: np.ndarray, costs: np.ndarray, parts: int, buckets: int) -> list[tuple[int, int, int]]:
    """(part, first bucket, last bucket) by prefix sums: a bucket goes where the middle of its cost lies. ``held`` are
    the buckets with rows, ascending. The spans cover all buckets, so no row is without a part."""
    total = costs.sum()
    part = np.minimum(parts - 1, ((costs.cumsum() - costs / 2) * parts / total).astype(int)) if total else np.zeros(len(costs), int)
    starts = np.flatnonzero(part[1:] != part[:-1]) + 1
    first = [0, *held[starts].tolist()]
    return list(zip(part[[0, *starts]].tolist() if len(part) else [0], first, [*(f - 1 for f in first[1:]), buckets - 1], strict=True))


def balanced(df: DataFrame, cost: Column, task_cost: float, *by: str, buckets: int = BUCKETS, least: int | None = None) -> DataFrame:
    """``df`` in partitions whose sums of ``cost`` are about equal and at most about ``task_cost``.

    Adaptive execution merges and splits partitions by their bytes, which says nothing about the work that rows make.
    Rows are hashed by ``by`` to buckets, the buckets' costs are summed (with partial sums; at most ``buckets`` numbers
    reach the driver, as arrays) and cut by prefix sums; the driver gives out a span of buckets for each partition. A
    single row of more than the share of a task stays whole. ``least`` is the smallest number of partitions while there
    are rows, by default what the cluster runs at once. Null costs count as 0. The plan of ``df`` runs once more for the
    sums, so give what makes rows, not what spends CPU on them.
    """
    spark = df.sparkSession
    bucket = F.pmod(F.xxhash64(*by), F.lit(buckets)).cast("int").alias("bucket")
    sums = df.groupBy(bucket).agg(F.sum(F.coalesce(cost.cast("double"), F.lit(0.0))).alias("cost")).toArrow()
    held, costs = (sums[c].to_numpy() for c in ("bucket", "cost"))
    order = held.argsort()
    held, costs = held[order], costs[order]
    least = spark.sparkContext.defaultParallelism if least is None else least
    parts = max(1, min(MOST_PARTS, len(costs), max(least, int(-(-costs.sum() // task_cost)))))
    spans = spark.createDataFrame(cuts(held, costs, parts, buckets), "_part int, first int, last int")
    of = spans.select(F.explode(F.sequence("first", "last")).alias("_bucket"), "_part")
    placed = df.withColumn("_bucket", bucket).join(F.broadcast(of), "_bucket")
    return placed.repartitionById(parts, F.col("_part")).drop("_bucket", "_part")
