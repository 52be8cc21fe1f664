"""Ensemble summaries, peaks and low flows of (river, member, step, q)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.functions.numerics import NO_DATA, keepbits

PERCENTILES = tuple(range(0, 101, 10))


def deciles(members: DataFrame) -> DataFrame:
    """(river, step, percentile, q): exact, linear between ranks."""
    marks = F.array(*[F.lit(p / 100) for p in PERCENTILES])
    grouped = members.groupBy("river", "step").agg(F.percentile(F.col("q").cast("double"), marks).alias("values"))
    rows = grouped.select("river", "step", F.posexplode("values").alias("i", "v"))
    return rows.select("river", "step", (F.col("i") * 10).cast("int").alias("percentile"), keepbits(F.col("v")).alias("q"))


def mean(members: DataFrame) -> DataFrame:
    return members.groupBy("river", "step").agg(keepbits(F.avg(F.col("q").cast("double"))).alias("q"))


def peaks(series: DataFrame) -> DataFrame:
    """Of (river, step, q): peak, its first step and the step's map code (NO_DATA without flow)."""
    first = F.max_by("step", F.struct(F.col("q"), -F.col("step")))
    grouped = series.where("q is not null").groupBy("river").agg(F.max("q").alias("peak"), first.alias("peak_step"))
    flows = (F.col("peak") > 0) & (F.col("peak") < float("inf"))
    return grouped.select("river", "peak", "peak_step", F.when(flows, F.col("peak_step")).otherwise(NO_DATA).cast("int").alias("time_to_peak"))


def below_low_flow(series: DataFrame, low: DataFrame) -> DataFrame:
    """Whether the lowest flow of the horizon is under the river's low flow (river, q95): 1, 0 or NO_DATA."""
    lowest = series.groupBy("river").agg(F.min("q").alias("lowest"))
    joined = lowest.join(low, "river", "left")
    known = F.col("lowest").isNotNull() & F.col("q95").isNotNull()
    return joined.select("river", "lowest", "q95", F.when(known, (F.col("lowest") < F.col("q95")).cast("int")).otherwise(NO_DATA).alias("below"))
