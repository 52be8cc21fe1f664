"""The array store as a data source: round trip, chunks left out, other chunk formats."""

import json

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from freshet.sources import array_store as a


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    """70 rivers (ids 1000, 1003, ...) by 100 days from 1999-12-01, in chunks of 16 by 30; one chunk is missing."""
    a.register(spark)
    path = f"file://{tmp_path_factory.mktemp('store')}"
    rows = spark.range(70 * 100).select((F.col("id") % 70).alias("river"), F.floor(F.col("id") / 70).alias("time"), (F.col("id") * 0.5).cast("float").alias("value"))
    a.write_array(rows.where("not (river < 16 and time < 30)"), path, "q", ("river", "time"), (70, 100), (16, 30), attributes={"units": "m3 s-1"})
    a.write_array(rows.withColumn("value", F.col("value") + 1), path, "top", ("river", "time"), (70, 100), (16, 30), "float64", "gzip")
    a.write_array(spark.range(70).select(F.col("id").alias("river"), (1000 + 3 * F.col("id")).alias("value")), path, "river", ("river",), (70,), (50,), "int32", None)
    a.write_array(spark.range(100).select(F.col("id").alias("time"), F.col("id").alias("value")), path, "time", ("time",), (100,), (100,), "int32", None, {"units": "days since 1999-12-01"})
    return path


def read_chunks(df):
    """Chunks that the scan of a frame has as partitions, one chunk a task."""
    return df.rdd.getNumPartitions()


def test_round_trip_with_coordinates_years_and_fill(spark, store):
    df = a.read_arrays(spark, store, "q", "top")
    assert df.columns == ["river", "time", "year", "q", "top"] and dict(df.dtypes)["top"] == "double"
    got = {(r.river, r.time): r for r in df.collect()}
    assert len(got) == 7000
    for i in range(70):
        for t in (0, 29, 30, 31, 99):
            r = got[1000 + 3 * i, t]
            assert r.q == (None if i < 16 and t < 30 else (t * 70 + i) * 0.5) and r.top == (t * 70 + i) * 0.5 + 1
            assert r.year == (1999 if t < 31 else 2000)


@pytest.mark.parametrize(
    "where, chunks",
    [({}, 20), ({"river": (1000, 1047)}, 4), ({"river": (1048, 1048)}, 4), ({"river": [1000, 1207]}, 8), ({"year": (1999, 1999)}, 10), ({"year": (1999, 1999), "river": (1100, 1150)}, 4), ({"time": (95, 200), "river": (1000, 1002)}, 1), ({"river": (1001, 1002)}, 1)],
)
def test_filters_leave_chunks_out(spark, store, where, chunks):
    one = spark.read.format("array_store").option("path", store).option("variables", "q").option("taskBytes", "1").load()
    for c, v in where.items():
        one = one.where(F.col(c).isin(v) if isinstance(v, list) else F.col(c).between(*v))
    assert read_chunks(one) == chunks
    plain = [(1000 + 3 * i, t) for i in range(70) for t in range(100)]
    ok = {"river": lambda i, t: i, "time": lambda i, t: t, "year": lambda i, t: 1999 if t < 31 else 2000}
    want = [x for x in plain if all(ok[c](*x) in v if isinstance(v, list) else v[0] <= ok[c](*x) <= v[1] for c, v in where.items())]
    assert sorted((r.river, r.time) for r in one.collect()) == sorted(want)


class Doubled(a.ChunkReader):
    def decoded(self, data, array):
        return super().decoded(data, array) * (2 if array.name == "top" else 1)


def test_a_reader_of_ones_own(spark, store):
    a.register(spark, "doubled", Doubled)
    df = spark.read.format("doubled").option("path", store).option("variables", "top").load().where("time = 50")
    assert {r.top for r in df.collect()} == {((50 * 70 + i) * 0.5 + 1) * 2 for i in range(70)}


def test_what_cannot_be_read_is_an_error(spark, store, tmp_path):
    with pytest.raises(PySparkException):
        a.read_arrays(spark, store, "q", "river").collect()
    with pytest.raises(PySparkException):
        a.read_arrays(spark, store, "nothing").collect()
    spec = a.Array("q", (4,), (2,), "float32", ("x",), float("nan"), None, "/", {}).spec()
    spec["codecs"] = [{"name": "sharding_indexed"}]
    (tmp_path / "q").mkdir()
    (tmp_path / "q" / "zarr.json").write_text(json.dumps(spec))
    with pytest.raises(PySparkException):
        a.read_arrays(spark, f"file://{tmp_path}", "q").collect()


def test_a_failed_write_leaves_no_array(spark, tmp_path):
    a.register(spark)
    bad = spark.range(10).select(F.col("id").alias("x"), F.when(F.col("id") < 9, 1.0).otherwise(F.raise_error(F.lit("broken")).cast("double")).alias("value"))
    with pytest.raises(Exception):
        a.write_array(bad, f"file://{tmp_path}/s", "q", ("x",), (10,), (2,))
    assert not (tmp_path / "s" / "q" / "zarr.json").exists()


def test_years_of_units():
    assert a.years(np.array([0, 24 * 31]), "hours since 1999-12-01").tolist() == [1999, 2000]
    assert a.years(np.array([-1, 0]), "seconds since 1970-01-01T00:00:00Z").tolist() == [1969, 1970]
    assert a.years(np.array([0.0]), "minutes since 2001-02-03 04:05").tolist() == [2001]
