import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from freshet.functions import numerics as n


def bits(x):
    """Nearest-even rounding of the float32 bit pattern."""
    x = np.float32(x)
    if not np.isfinite(x) or x == 0:
        return x
    u = np.array([x], np.float32).view(np.uint32).astype(np.uint64)
    drop = 23 - n.KEEP_BITS
    half = np.uint64((1 << drop - 1) - 1) + ((u >> np.uint64(drop)) & np.uint64(1))
    u = ((u + half) >> np.uint64(drop)) << np.uint64(drop)
    return u.astype(np.uint32).view(np.float32)[0]


def test_keepbits(spark):
    rng = np.random.default_rng(1)
    values = [*np.exp(rng.normal(0, 20, 3000)), *-np.exp(rng.normal(0, 5, 500)), 0.0, 1.0, 2.0, 1e-40, 3e-42, float("inf"), float("-inf"), *[1 + (2 * k + 1) * 2.0**-14 for k in range(200)]]
    values = [float(np.float32(v)) for v in values]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "q double").select("q", n.keepbits(F.col("q")).alias("r"), n.keepbits(n.keepbits(F.col("q"))).alias("rr"))
    for row in df.collect():
        if row.q is None:
            assert row.r is None
        else:
            assert row.r == bits(row.q) and row.rr == row.r


def test_classes(spark):
    df = spark.createDataFrame([(None,), (0.5,), (1.0,), (9.99,), (10.0,), (99999.0,)], "q float").withColumn("t", F.array(*[F.lit(x).cast("float") for x in (1.0, 5.0, 10.0)]))
    rows = df.select(n.thickness_class(F.col("q")).alias("a"), n.period_class(F.col("q"), F.col("t")).alias("b")).collect()
    assert [tuple(r) for r in rows] == [(1, 0), (1, 0), (2, 1), (2, 2), (3, 3), (6, 3)]


def test_null_threshold_is_not_met(spark):
    row = spark.sql("select cast(9 as float) q, array(cast(1 as float), null, cast(8 as float)) t").select(n.period_class(F.col("q"), F.col("t")).alias("c")).first()
    assert row.c == 2


def test_nan_becomes_null(spark):
    assert spark.sql("select float('nan') q").select(n.null_nan(F.col("q")).alias("q")).first().q is None


def test_sphere(spark):
    row = spark.range(1).select(n.box_area(F.lit(-180.0), F.lit(-90.0), F.lit(180.0), F.lit(90.0)).alias("a"), n.wrap_longitude(F.lit(190.0)).alias("w")).first()
    assert row.a == pytest.approx(5.10065621724e14, rel=1e-9) and row.w == -170.0


def test_mercator(spark):
    row = spark.range(1).select(n.mercator_x(F.lit(180.0)).alias("x"), n.mercator_y(F.lit(0.0)).alias("y")).first()
    assert row.x == pytest.approx(math.pi * n.MERCATOR_RADIUS) and abs(row.y) < 1e-6
