"""The published stores as chunked arrays with their coordinates: forecasts with percentiles and mean, return periods
with the largest maxima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.functions.numerics import KEEP_BITS
from freshet.operators import ensemble, frequency, network
from freshet.sources.array_store import register, write_array

#: Rivers of a chunk; the other dimensions, which are short, are whole in every chunk.
CHUNK_RIVERS, AXIS_CHUNK = 256, 1 << 16
FLOW = {"units": "m3 s-1", "keepbits": KEEP_BITS}


class _Store:
    """Arrays over named axes; an axis holds each distinct value at its place in ascending order."""

    def __init__(self, rows: DataFrame, path: str, kinds: dict[str, str], chunk_rivers: int, attributes: dict[str, dict]):
        register(rows.sparkSession)
        self.path, self.chunk_rivers, self.places, self.sizes = path, chunk_rivers, {}, {}
        for name, kind in kinds.items():
            placed = network.places(rows.select(F.col(name)).where(F.col(name).isNotNull()).distinct(), name, 64 if name == "river" else 1).persist()
            self.places[name], self.sizes[name] = placed, placed.count()
            write_array(placed.select(F.col("place").alias(name), F.col(name).alias("value")), path, name, (name,), (self.sizes[name],), (AXIS_CHUNK,), kind, attributes=attributes.get(name))

    def close(self) -> None:
        for placed in self.places.values():
            placed.unpersist()

    def add(self, rows: DataFrame, name: str, dims: tuple[str, ...], value: str = "q") -> None:
        placed = rows.select(*dims, F.col(value).alias("value"))
        for d in dims:
            axis = self.places[d]
            placed = placed.join(axis if d == "river" else F.broadcast(axis), d).drop(d).withColumnRenamed("place", d)
        shape = tuple(self.sizes[d] for d in dims)
        chunks = tuple(min(self.chunk_rivers, n) if d == "river" else n for d, n in zip(dims, shape))
        write_array(placed, self.path, name, dims, shape, tuple(max(1, c) for c in chunks), attributes=FLOW)


def write_forecast_store(members: DataFrame, path: str, units: str, chunk_rivers: int = CHUNK_RIVERS) -> None:
    """(river, member, step, q) as q (river, member, step), percentiles (river, percentile, step) and mean (river, step), with
    the coordinates of all dimensions; ``units`` says what steps are ("hours since ..."). Members, percentiles and steps
    are short axes, which are broadcast; rivers are joined. A chunk is packed by one task."""
    deciles = ensemble.deciles(members)
    marks = members.sparkSession.createDataFrame([(p,) for p in ensemble.PERCENTILES], "percentile int")
    axes = members.select("river", F.col("member").cast("int").alias("member"), F.col("step").cast("int").alias("step"), F.lit(None).cast("int").alias("percentile"))
    axes = axes.union(marks.select(F.lit(None), F.lit(None), F.lit(None), "percentile"))
    store = _Store(axes, path, {"river": "int64", "member": "int32", "percentile": "int32", "step": "int32"}, chunk_rivers, {"step": {"units": units}, "river": {"description": "river"}})
    store.add(members, "q", ("river", "member", "step"))
    store.add(deciles, "percentiles", ("river", "percentile", "step"))
    store.add(ensemble.mean(members), "mean", ("river", "step"))
    store.close()


def write_return_period_store(annual: DataFrame, path: str, chunk_rivers: int = CHUNK_RIVERS) -> None:
    """(river, year, hourly, daily) as an array of flows (river, recurrence_interval) for each distribution and series, and
    the largest maximum of each series (river); exceedance probabilities stand beside the intervals."""
    curves = frequency.return_periods(frequency.both_series(annual), keys=("river", "series")).persist()
    try:
        intervals = curves.select("river", F.col("recurrence_interval").cast("float").alias("recurrence_interval"))
        store = _Store(intervals.union(annual.select("river", F.lit(None).cast("float"))), path, {"river": "int64", "recurrence_interval": "float32"}, chunk_rivers, {"recurrence_interval": {"units": "years"}})
        for row in curves.select("distribution", "series").distinct().orderBy("distribution", "series").collect():  # eight at most
            own = curves.where((F.col("distribution") == row["distribution"]) & (F.col("series") == row["series"]))
            store.add(own.select("river", F.col("recurrence_interval").cast("float").alias("recurrence_interval"), "flow"), f"{row['distribution']}_{row['series']}", ("river", "recurrence_interval"), "flow")
        for series in ("hourly", "daily"):
            largest = frequency.largest(annual.select("river", F.col(series).alias("q")))
            store.add(largest, f"max_simulated_{series}", ("river",), "max_simulated")
        store.close()
    finally:
        curves.unpersist()
