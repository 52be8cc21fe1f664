"""Catchment polygons cut by grid cells: exact areas of pieces on the ellipsoid.

A catchment is (river, rings), rings an array of struct<hole boolean, points array<struct<x double, y double>>>
in web Mercator; rings close themselves. Bounds meet cells by an equi-join on grid squares; only the pairs that
meet carry their rings on, in partitions of equal numbers of corners, and only catchments that reach beyond one cell
are clipped, once for each pair. All of it is column expressions, so rows stay in the JVM.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions.numerics import AUTHALIC_E2, MERCATOR_RADIUS
from freshet.operators.weights import touching
from freshet.plans.balance import balanced

#: Corners that a task projects; one that is clipped first counts as CLIP_COST.
TASK_CORNERS, CLIP_COST = 100_000, 5


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def bounds(catchments: DataFrame) -> DataFrame:
    """(river, west, south, east, north) of all rings; a catchment without points has none."""
    points = F.flatten(F.transform("rings", lambda r: r["points"]))
    side = lambda f, axis: f(F.transform("points", lambda p: p[axis]))
    edges = catchments.select("river", points.alias("points")).where(F.size("points") > 0)
    return edges.select("river", side(F.array_min, "x").alias("west"), side(F.array_min, "y").alias("south"), side(F.array_max, "x").alias("east"), side(F.array_max, "y").alias("north"))


def total_bounds(boxes: DataFrame) -> DataFrame:
    """One row: the box around all boxes."""
    return boxes.agg(F.min("west").alias("west"), F.min("south").alias("south"), F.max("east").alias("east"), F.max("north").alias("north"))


def half_plane(points: Column, axis: str, bound: Column, sign: int) -> Column:
    """The ring's part with sign * (coordinate - bound) >= 0; crossings become points on the bound."""
    other = "y" if axis == "x" else "x"

    def cut(p: Column, q: Column) -> Column:
        share = F.try_divide(bound - p[axis], q[axis] - p[axis])
        across = p[other] + share * (q[other] - p[other])
        return F.struct((bound if axis == "x" else across).alias("x"), (across if axis == "x" else bound).alias("y"))

    def edge(p: Column, q: Column) -> Column:
        p_in, q_in = (p[axis] - bound) * sign >= 0, (q[axis] - bound) * sign >= 0
        return F.when(p_in & q_in, F.array(p)).when(p_in, F.array(p, cut(p, q))).when(q_in, F.array(cut(p, q))).otherwise(F.slice(F.array(p), 1, 0))

    def ring(ps: Column) -> Column:
        return F.when(F.size(ps) > 0, F.flatten(F.zip_with(ps, F.concat(F.slice(ps, 2, F.size(ps) - 1), F.slice(ps, 1, 1)), edge))).otherwise(ps)

    return _let(points, ring)


def clipped(points: Column, west: Column, south: Column, east: Column, north: Column) -> Column:
    """The ring within a box. Parts of a concave ring that the box sets apart stay joined along its sides, which
    adds no area."""
    for axis, bound, sign in (("x", west, 1), ("x", east, -1), ("y", south, 1), ("y", north, -1)):
        points = half_plane(points, axis, bound, sign)
    return points


def equal_area(p: Column) -> Column:
    """A web Mercator point in the cylindrical equal-area projection of the ellipsoid (authalic form)."""
    e = math.sqrt(AUTHALIC_E2)
    s = F.tanh(p["y"] / MERCATOR_RADIUS)  # sine of the latitude
    q = (1 - AUTHALIC_E2) * (s / (1 - AUTHALIC_E2 * s * s) - F.log((1 - e * s) / (1 + e * s)) / (2 * e))
    return F.struct(p["x"].alias("x"), (MERCATOR_RADIUS / 2 * q).alias("y"))


def plane(p: Column) -> Column:
    return p


def ring_area(points: Column, project=equal_area) -> Column:
    """Area within a ring whose corners are projected; 0 for fewer than three corners."""

    def shoelace(ps: Column) -> Column:
        turns = F.zip_with(ps, F.concat(F.slice(ps, 2, F.size(ps) - 1), F.slice(ps, 1, 1)), lambda p, q: p["x"] * q["y"] - q["x"] * p["y"])
        return F.abs(F.aggregate(turns, F.lit(0.0), lambda a, b: a + b)) / 2

    return _let(points, lambda ps: F.when(F.size(ps) > 2, _let(F.transform(ps, project), shoelace)).otherwise(F.lit(0.0)))


def pieces(catchments: DataFrame, cells: DataFrame, size: float, project=equal_area) -> DataFrame:
    """(river, cell, area) of every catchment in every cell that it overlaps with an inner area.

    ``cells`` is (cell, west, south, east, north), ``size`` the side of the squares that both sides are dealt to.
    Holes are taken off. Pieces without area are left out, as are catchments without points.
    """
    boxes = bounds(catchments).withColumnRenamed("river", "id")
    # Planners take sizes from files: an array counts as one element and a row that is dealt to squares as one row.
    # What they broadcast by that can be far more than the driver holds, so both joins are sorted.
    met = touching(boxes, cells.withColumnRenamed("cell", "id").hint("merge"), size)
    met = met.select(F.col("b_id").alias("river"), F.col("c_id").alias("cell"), *[f"{s}_{x}" for s in "bc" for x in ("west", "south", "east", "north")])
    whole = (F.col("b_west") >= F.col("c_west")) & (F.col("b_east") <= F.col("c_east")) & (F.col("b_south") >= F.col("c_south")) & (F.col("b_north") <= F.col("c_north"))
    box = [F.col(f"c_{x}") for x in ("west", "south", "east", "north")]

    def part(r: Column) -> Column:
        inside = F.when(F.col("whole"), r["points"]).otherwise(clipped(r["points"], *box))
        return F.when(r["hole"], -1.0).otherwise(1.0) * ring_area(inside, project)

    joined = met.withColumn("whole", whole).join(catchments.select("river", "rings").hint("merge"), "river")
    corners = F.aggregate("rings", F.lit(0), lambda n, r: n + F.coalesce(F.size(r["points"]), F.lit(0)))
    dealt = balanced(joined, corners * F.when(F.col("whole"), 1).otherwise(CLIP_COST), TASK_CORNERS, "river", "cell")
    area = F.aggregate(F.transform("rings", part), F.lit(0.0), lambda a, b: a + b)
    # A filter on a column is pushed into what makes it, which would clip again; one on what explode gives is not.
    return dealt.select("river", "cell", F.explode(F.array(area)).alias("area")).where("area > 0")


def catchment_faults(catchments: DataFrame, rivers: DataFrame, grid: DataFrame) -> DataFrame:
    """(river, fault): rivers with several catchments, catchments of no river, and those that reach beyond the grid."""
    repeated = catchments.groupBy("river").count().where("count > 1").select("river", F.lit("repeated").alias("fault"))
    unknown = catchments.select("river").distinct().join(rivers.select("river"), "river", "left_anti").withColumn("fault", F.lit("no river"))
    edge = total_bounds(grid).first()
    beyond = (F.col("west") < edge.west) | (F.col("south") < edge.south) | (F.col("east") > edge.east) | (F.col("north") > edge.north)
    outside = bounds(catchments).where(beyond if edge.west is not None else F.lit(True))
    return repeated.unionByName(unknown).unionByName(outside.select("river", F.lit("outside").alias("fault")).distinct())
