"""Grids and catchments: cell edges, overlapping boxes, area weights, lateral inflow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions.numerics import wrap_longitude


def cell_edges(centers: DataFrame) -> DataFrame:
    """(axis, i, center) ascending to (axis, i, low, high): midpoints, and half a spacing past each end."""
    w = Window.partitionBy("axis").orderBy("center")
    before, after = F.lag("center").over(w), F.lead("center").over(w)
    c = F.col("center")
    low = F.coalesce((before + c) / 2, c - (after - c) / 2, c)
    high = F.coalesce((c + after) / 2, c + (c - before) / 2, c)
    return centers.select("axis", "i", "center", low.alias("low"), high.alias("high"))


def touching(boxes: DataFrame, cells: DataFrame, size: float) -> DataFrame:
    """Pairs of boxes and cells that overlap with an inner area, their columns named b_ and c_.

    Both sides are (id, west, south, east, north). Each is dealt to the squares of ``size`` that it touches and
    joined on the square; a pair that meets in several is counted in the one of its intersection's corner.
    """

    def dealt(df: DataFrame, p: str) -> DataFrame:
        named = df.select(*[F.col(x).alias(p + x) for x in ("id", "west", "south", "east", "north")])
        span = lambda a, b: F.sequence(F.floor(F.col(p + a) / size), F.floor(F.col(p + b) / size))
        return named.withColumn("gx", F.explode(span("west", "east"))).withColumn("gy", F.explode(span("south", "north")))

    met = dealt(boxes, "b_").join(dealt(cells, "c_"), ["gx", "gy"])
    here = (F.floor(F.greatest("b_west", "c_west") / size) == F.col("gx")) & (F.floor(F.greatest("b_south", "c_south") / size) == F.col("gy"))
    return met.where((F.col("b_east") > F.col("c_west")) & (F.col("b_west") < F.col("c_east")) & (F.col("b_north") > F.col("c_south")) & (F.col("b_south") < F.col("c_north")) & here)


def overlaps(boxes: DataFrame, cells: DataFrame, size: float) -> DataFrame:
    """(box, cell, area) of the pairs that overlap."""
    width = F.least("b_east", "c_east") - F.greatest("b_west", "c_west")
    height = F.least("b_north", "c_north") - F.greatest("b_south", "c_south")
    return touching(boxes, cells, size).select(F.col("b_id").alias("box"), F.col("c_id").alias("cell"), (width * height).alias("area"))


def interval_overlaps(segments: DataFrame, blocks: DataFrame, size: int) -> DataFrame:
    """(segment, block, first, end): the common part of half-open intervals (id, first, end) that overlap.

    Both sides are dealt to bins of ``size`` and joined on the bin in which the common part begins.
    """

    def dealt(df: DataFrame, p: str) -> DataFrame:
        named = df.where("end > first").select(*[F.col(x).alias(p + x) for x in ("id", "first", "end")])
        return named.withColumn("bin", F.explode(F.sequence(F.floor(F.col(p + "first") / size), F.floor((F.col(p + "end") - 1) / size))))

    first, end = F.greatest("s_first", "b_first"), F.least("s_end", "b_end")
    met = dealt(segments, "s_").join(dealt(blocks, "b_"), "bin").where((first < end) & (F.floor(first / size) == F.col("bin")))
    return met.select(F.col("s_id").alias("segment"), F.col("b_id").alias("block"), first.alias("first"), end.alias("end"))


def repeated_coordinates(centers: DataFrame) -> DataFrame:
    """(axis, center, n) of the coordinates that an axis has more than once; a grid with any is refused."""
    return centers.groupBy("axis", "center").agg(F.count("*").alias("n")).where("n > 1")


def ordered_axis(longitudes: DataFrame) -> DataFrame:
    """(axis, i, center) to (axis, i, shifted, place): longitudes on -180..180 and their place in ascending order."""
    shifted = longitudes.select("axis", "i", wrap_longitude(F.col("center")).alias("shifted"))
    return shifted.withColumn("place", F.row_number().over(Window.partitionBy("axis").orderBy("shifted", "i")) - 1)


def run_starts(rows: DataFrame, by: str, order: tuple[str, ...], key: str) -> DataFrame:
    """The rows at which ``key`` differs from the row before, within each ``by``."""
    w = Window.partitionBy(by).orderBy(*order)
    starts = (F.row_number().over(w) == 1) | ~F.col(key).eqNullSafe(F.lag(key).over(w))
    return rows.withColumn("_starts", starts).where("_starts").drop("_starts")


def proportions(pieces: DataFrame) -> DataFrame:
    """(river, cell, area) with the piece's share of its river, divided in double, cast last."""
    whole = F.sum("area").over(Window.partitionBy("river"))
    return pieces.where("area > 0").select("river", "cell", "area", (F.col("area") / whole).cast("float").alias("proportion"))


def ranked(pieces: DataFrame) -> DataFrame:
    """A river's pieces by area, largest first; equal areas by cell."""
    w = Window.partitionBy("river").orderBy(F.desc("area"), "cell")
    return pieces.select("river", "cell", "area", F.row_number().over(w).alias("place"))


def ranked_proportions(pieces: DataFrame) -> DataFrame:
    """(river, cell, area, proportion, place) from one pass over the pieces: share of the river, and place by area."""
    river = Window.partitionBy("river")
    share, place = (F.col("area") / F.sum("area").over(river)).cast("float"), F.row_number().over(river.orderBy(F.desc("area"), "cell"))
    return pieces.where("area > 0").select("river", "cell", "area", share.alias("proportion"), place.alias("place"))


def lateral_inflow(pieces: DataFrame, runoff: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Depth on cells times area of pieces, summed over each river (and step)."""
    joined = pieces.join(runoff, "cell")
    return joined.groupBy("river", *by).agg(F.sum(F.col("ro").cast("double") * F.col("area")).alias("inflow"), F.count("cell").alias("pieces"))


def unmatched(rivers: DataFrame, pieces: DataFrame) -> DataFrame:
    """Rivers without weights and weights without rivers."""
    lacking = rivers.select("river").distinct().join(pieces, "river", "left_anti").withColumn("side", F.lit("no weights"))
    extra = pieces.select("river").distinct().join(rivers, "river", "left_anti").withColumn("side", F.lit("no river"))
    return lacking.unionByName(extra)


def octahedral(rows: Column) -> Column:
    """Whether row lengths (north pole first) are those of an octahedral grid: 20, 24, 28 ... and back."""
    half = F.slice(rows, 1, (F.size(rows) / 2).cast("int"))
    rising = F.forall(F.arrays_zip(half.alias("n"), F.sequence(F.lit(0), F.size(half) - 1).alias("i")), lambda x: x["n"] == 20 + 4 * x["i"])
    return (F.size(rows) % 2 == 0) & rising & (F.reverse(rows) == rows)


def areas(pieces: DataFrame) -> DataFrame:
    """(river, area, n_pieces, least, most) of a river's pieces."""
    return pieces.groupBy("river").agg(F.sum("area").alias("area"), F.count("cell").alias("n_pieces"), F.min("area").alias("least"), F.max("area").alias("most"))


def counts(pieces: DataFrame) -> DataFrame:
    """(n_rivers, n_cells, n_pairs, n_missing): one row; areas that are null or NaN are missing."""
    missing = F.count_if(F.col("area").isNull() | F.isnan(F.col("area").cast("double")))
    return pieces.agg(F.countDistinct("river").alias("n_rivers"), F.countDistinct("cell").alias("n_cells"), F.count("*").alias("n_pairs"), missing.alias("n_missing"))
