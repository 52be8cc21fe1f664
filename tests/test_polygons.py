"""Catchment polygons: areas against boxes, whole polygons and sampling."""

import math
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from freshet.functions import calendar, numerics
from freshet.operators import network, polygons, weights
from freshet.plans import balance

RINGS = "river int, rings array<struct<hole:boolean,points:array<struct<x:double,y:double>>>>"
GRID = [(10 * i + j, float(i), float(j), i + 1.0, j + 1.0) for i in range(-5, 6) for j in range(-5, 6)]


def grid(spark):
    return spark.createDataFrame(GRID, "cell int, west double, south double, east double, north double")


def star(rng, n):
    """A simple polygon around a point, concave in places."""
    angle, reach = np.sort(rng.uniform(0, 2 * math.pi, n)), rng.uniform(0.2, 3.5, n)
    return [(float(0.3 + r * math.cos(a)), float(-0.2 + r * math.sin(a))) for a, r in zip(angle, reach)]


def inside(p, x, y):
    odd = np.zeros(len(x), bool)
    for (ax, ay), (bx, by) in zip(p, p[1:] + p[:1]):
        odd ^= ((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / (by - ay + (ay == by)) + ax)
    return odd


def area(p):
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(p, p[1:] + p[:1]))) / 2


def test_pieces_of_polygons(spark):
    rng = np.random.default_rng(1)
    shapes = {i: star(rng, 5 + 4 * i) for i in range(5)}
    hole = [(0.2, -0.3), (0.4, -0.3), (0.3, -0.1)]
    rows = [(i, [(False, p)]) for i, p in shapes.items()] + [(9, [(False, shapes[0]), (True, hole)]), (10, []), (11, [(False, [(0.25, 0.25), (0.5, 0.25)])]), (12, [(False, [])])]
    got = polygons.pieces(spark.createDataFrame(rows, RINGS), grid(spark), 1.0, polygons.plane).collect()
    assert {r.river for r in got} == {0, 1, 2, 3, 4, 9} and all(r.area > 0 for r in got)
    cells = {c[0]: c[1:] for c in GRID}
    x, y = rng.uniform(-5, 6, 400_000), rng.uniform(-5, 6, 400_000)
    for i, p in shapes.items():
        own = {r.cell: r.area for r in got if r.river == i}
        assert sum(own.values()) == pytest.approx(area(p), rel=1e-9)
        held = inside(p, x, y)
        for cell, (w, s, e, n) in cells.items():
            share = (held & (x > w) & (x < e) & (y > s) & (y < n)).mean() * 121
            assert own.get(cell, 0.0) == pytest.approx(share, abs=0.08)
    assert sum(r.area for r in got if r.river == 9) == pytest.approx(area(shapes[0]) - area(hole))


def test_boxes_on_the_ellipsoid(spark):
    """A box between meridians and parallels has the area of the closed form."""
    lon, lat = (10.0, 11.0), (-3.0, 40.0)
    m = lambda v: numerics.MERCATOR_RADIUS * math.log(math.tan(math.pi / 4 + math.radians(v) / 2))
    x, y = [numerics.MERCATOR_RADIUS * math.radians(v) for v in lon], [m(v) for v in lat]
    ring = [(False, [(x[0], y[0]), (x[1], y[0]), (x[1], y[1]), (x[0], y[1])])]
    cells = spark.createDataFrame([(1, x[0], y[0] - 1, (x[0] + x[1]) / 2, y[1] + 1), (2, (x[0] + x[1]) / 2, y[0] - 1, x[1] + 1, y[1] + 1)], "cell int, west double, south double, east double, north double")
    got = polygons.pieces(spark.createDataFrame([(1, ring)], RINGS), cells, 1e6).collect()
    want = spark.range(1).select(numerics.box_area(F.lit(lon[0]), F.lit(lat[0]), F.lit(lon[1]), F.lit(lat[1])).alias("a")).first().a
    assert [r.area for r in got] == pytest.approx([want / 2, want / 2], rel=1e-9)


def test_catchment_faults(spark):
    box = lambda x: [(False, [(x, 0.0), (x + 0.5, 0.0), (x, 0.5)])]
    found = polygons.catchment_faults(spark.createDataFrame([(1, box(0.0)), (1, box(1.0)), (2, box(5.8)), (3, box(0.0))], RINGS), spark.createDataFrame([(1,), (2,)], "river int"), grid(spark))
    assert sorted(map(tuple, found.collect())) == [(1, "repeated"), (2, "outside"), (3, "no river")]


def test_axes_and_segments(spark):
    centers = spark.createDataFrame([("x", 0, 0.0), ("x", 1, 190.0), ("x", 2, 90.0), ("x", 3, 90.0)], "axis string, i int, center double")
    assert [tuple(r) for r in weights.repeated_coordinates(centers).collect()] == [("x", 90.0, 2)]
    assert [r.i for r in weights.ordered_axis(centers).orderBy("place").collect()] == [1, 0, 2, 3]
    spans = spark.createDataFrame([(1, 0, 10), (2, 10, 10), (3, 95, 205)], "id int, first int, end int")
    blocks = spark.createDataFrame([(7, 5, 100), (8, 100, 300)], "id int, first int, end int")
    assert sorted(map(tuple, weights.interval_overlaps(spans, blocks, 20).collect())) == [(1, 7, 5, 10), (3, 7, 95, 100), (3, 8, 100, 205)]
    runs = spark.createDataFrame([("r", i, k) for i, k in enumerate("aabba")] + [("r", 5, None), ("r", 6, None)], "by string, i int, k string")
    assert sorted(r.i for r in weights.run_starts(runs, "by", ("i",), "k").collect()) == [0, 2, 4, 5]


def test_resume_and_records(spark):
    years = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 1), ("b", 3), ("c", 5)], "region string, year int")
    states = spark.createDataFrame([("a", 1), ("a", 3), ("b", 1), ("b", 3), ("c", 5), ("c", 9)], "region string, year int")
    assert {tuple(r) for r in network.resume_after(years, states).collect()} == {("a", 1, 2), ("b", 1, 2), ("c", 1, 6)}
    rows = spark.sql("select * from values (1, timestamp'1940-01-01 07:00:00'), (1, timestamp'1941-01-01 00:10:00'), (1, timestamp'1942-01-01 02:00:00') t(river, ts)")
    assert [(r.year, r.late, r.allowed) for r in network.record_starts(rows, "river", "ts").orderBy("year").collect()] == [(1940, True, True), (1941, False, True), (1942, True, False)]
    assert [tuple(r) for r in network.uneven(spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("b", 2)], "r string, v int"), "r", "v").collect()] == [("b", 2, [1, 2])]


def test_times_of_any_unit(spark):
    df = spark.range(1).select(calendar.decode_times(F.lit(1.5), "days since 2000-02-28").alias("d"), calendar.decode_times(F.lit(90), "seconds since 1999-12-31T23:59:00Z").alias("s"))
    assert [str(x) for x in df.selectExpr("cast(d as string)", "cast(s as string)").first()] == ["2000-02-29 12:00:00", "2000-01-01 00:00:30"]
    with pytest.raises(ValueError):
        calendar.decode_times(F.lit(1), "fortnights since 2000-01-01")


def test_routing_table(spark):
    meta = spark.createDataFrame([("r", 0, 5, 9, 3600.0, 0.2)], "region string, riverIndex int, riverId long, nextRiverId long, musk_k double, musk_x double")
    assert network.routing_table(meta).first().asDict() == {"region": "r", "riverIndex": 0, "river_id": 5, "next_river_id": 9, "k": 3600.0, "x": 0.2}


def test_each_pair_is_clipped_once(spark):
    rows = spark.createDataFrame([(1, [(False, [(0.1, 0.1), (2.5, 0.1), (2.5, 1.5)])])], RINGS)
    plan = polygons.pieces(rows, grid(spark), 1.0, polygons.plane)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("zip_with(") == 5  # four sides of the cell, and the area
    proportions = weights.ranked_proportions(polygons.pieces(rows, grid(spark), 1.0, polygons.plane))
    assert proportions._jdf.queryExecution().optimizedPlan().toString().count("zip_with(") == 5


def test_partitions_of_equal_cost(spark):
    rng = np.random.default_rng(2)
    costs = np.minimum(rng.pareto(1.1, 20_000) + 0.01, 300.0)
    df = spark.createDataFrame([(i, float(c)) for i, c in enumerate(costs)], "id long, cost double")
    for parts in (4, 24):
        got = balance.balanced(df, F.col("cost"), float(costs.sum()) / parts, "id", least=1)
        sums = {r[0]: r[1] for r in got.groupBy(F.spark_partition_id()).agg(F.sum("cost")).collect()}
        assert len(sums) == parts and max(sums.values()) <= 1.5 * costs.sum() / parts
        assert got.count() == 20_000 and got.columns == ["id", "cost"]
    assert balance.balanced(df.limit(0), F.col("cost"), 1.0, "id").count() == 0
    assert balance.balanced(df.withColumn("cost", F.lit(None).cast("double")), F.col("cost"), 1.0, "id").count() == 20_000


def test_polygon_work_is_spread(spark):
    """No task has more than 1.5 times its share of corners, though one river has most of them."""
    rng = np.random.default_rng(5)
    rows = [(i, [(False, star(rng, 400 if i == 0 else 6))]) for i in range(60)]
    joined = polygons.pieces(spark.createDataFrame(rows, RINGS), grid(spark), 1.0, polygons.plane)
    parts = {r[0]: r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()}
    assert len(parts) >= spark.sparkContext.defaultParallelism - 1


def test_no_table_is_broadcast_by_estimate(spark):
    """Rings and dealt cells look small to the planner; only the buckets of equal cost, of fixed size, are broadcast."""
    x, y = (F.col("id") % 5).cast("double"), F.floor(F.col("id") / 5 % 5).cast("double")
    corners = F.array(*[F.struct((x + a).alias("x"), (y + b).alias("y")) for a, b in ((0.1, 0.1), (1.5, 0.1), (0.1, 0.9))])
    catchments = spark.range(50).select(F.col("id").alias("river"), F.array(F.struct(F.lit(False).alias("hole"), corners.alias("points"))).alias("rings"))
    cells = spark.range(40).select(F.col("id").alias("cell"), x.alias("west"), y.alias("south"), (x + 1).alias("east"), (y + 1).alias("north"))
    got = polygons.pieces(catchments, cells, 1.0, polygons.plane)
    rows = got.collect()
    assert sum(r.area for r in rows if r.cell < 5) > 0 and len({r.river for r in rows}) == 50
    for plan in (got._jdf.queryExecution().sparkPlan().toString(), got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]):
        assert plan.count("BroadcastHashJoin") == 1 and plan.count("SortMergeJoin") == 2


def test_sums_of_buckets_take_little_of_the_driver(spark):
    """The driver holds arrays, not an object for each bucket, and gives out spans that leave no bucket out."""
    df = spark.range(1 << 18).withColumn("cost", F.lit(1.0))
    tracemalloc.start()
    dealt = balance.balanced(df, F.col("cost"), 1000.0, "id")
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24e6
    sizes = [r[1] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 1 << 18 and len(sizes) == 263 and max(sizes) < 1100


def test_spans_cover_every_bucket():
    costs = np.array([3.0, 0.0, 1.0, 4.0])
    assert balance.cuts(np.array([2, 3, 7, 9]), costs, 2, 16) == [(0, 0, 8), (1, 9, 15)]
    assert balance.cuts(np.array([2, 3]), np.zeros(2), 5, 16) == [(0, 0, 15)]
    assert balance.cuts(np.zeros(0, int), np.zeros(0), 1, 16) == [(0, 0, 15)]
