"""Incremental jobs: windowed means with a watermark, and channel state carried from year to year."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.functions.numerics import keepbits
from freshet.operators.network import final_state, route


def windowed_means(stream: DataFrame, hours: int = 3, late: str = "6 hours") -> DataFrame:
    """(river, ts, q) to (river, ts, q, n): left-labelled means; rows later than ``late`` are let go."""
    window = F.window("ts", f"{hours} hours")
    grouped = stream.withWatermark("ts", late).where("q is not null").groupBy("river", window.alias("w")).agg(F.avg(F.col("q").cast("double")).alias("q"), F.count("q").alias("n"))
    return grouped.select("river", F.col("w.start").alias("ts"), keepbits(F.col("q")).alias("q"), "n")


def run_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Handles what is there, then ends; a restart goes on from the checkpoint."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()


def route_years(years: list[int], inflow_of: Callable[[int], DataFrame], rivers: DataFrame, save: Callable[[int, str, DataFrame], DataFrame], warm_up: int = 0, state: DataFrame | None = None) -> DataFrame | None:
    """Routes year after year, each from the state in which the year before ended.

    The first ``warm_up`` years only make the state; their flows are not saved. ``save(year, what, frame)``
    writes a frame and returns it read again; the flows of a year come before its state, so a year whose state
    is there is complete, and a restart may begin after it with that state.
    """
    for i, year in enumerate(years):
        routed = route(inflow_of(year), rivers, state=state)
        if i >= warm_up:
            routed = save(year, "discharge", routed)
        state = save(year, "state", final_state(routed))
    return state
