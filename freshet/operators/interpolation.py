"""Accumulated forcings: rates between steps, and values at every whole hour between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def increments(series: DataFrame) -> DataFrame:
    """(cell, hours, ro) accumulated to what fell since the step before; the first keeps its value."""
    before = F.lag("ro").over(Window.partitionBy("cell").orderBy("hours"))
    return series.select("cell", "hours", "ro", (F.col("ro") - F.coalesce(before, F.lit(0))).alias("step_ro"))


def at_every_hour(series: DataFrame) -> DataFrame:
    """(cell, hours int, ro float) at irregular steps to every hour from the first step to the last.

    Each pair of neighbouring steps yields the hours it brackets, so no series is joined with itself. Hour 0
    holds no accumulation and is dropped. Arithmetic is in single precision: (after - before) * share + before.
    """
    kept = series.where((F.col("hours") != 0) & F.col("hours").isNotNull())
    w = Window.partitionBy("cell").orderBy("hours")
    pairs = kept.withColumns({"h0": F.lag("hours").over(w), "q0": F.lag("ro").over(w)})
    begin = F.when(F.col("h0").isNull(), F.col("hours")).otherwise(F.col("h0") + 1)
    rows = pairs.where(F.col("h0").isNull() | (F.col("hours") > F.col("h0"))).select("cell", "hours", "ro", "h0", "q0", F.explode(F.sequence(begin, "hours")).alias("hour"))
    share = ((F.col("hour") - F.col("h0")).cast("double") / (F.col("hours") - F.col("h0"))).cast("float")
    value = F.when(F.col("h0").isNull(), F.col("ro")).otherwise(((F.col("ro") - F.col("q0")) * share + F.col("q0")).cast("float"))
    return rows.select("cell", "hour", value.alias("ro"))


def whole_hours(series: DataFrame) -> DataFrame:
    """Rows that break the rule: accumulations are at positive, increasing hours."""
    before = F.lag("hours").over(Window.partitionBy("cell").orderBy("hours"))
    kept = series.where("hours <> 0").withColumn("before", before)
    return kept.where((F.col("hours") <= 0) | (F.col("hours") <= F.col("before"))).select("cell", "hours", "before")
