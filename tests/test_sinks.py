import json
import zlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from freshet.operators import frequency, thresholds
from freshet.plans import stand_ins
from freshet.sinks import blocks, manifest, writers
from freshet.sources import axes, tables
from freshet.streaming import windows


def test_write_once_and_resume(spark, tmp_path):
    path = str(tmp_path / "t")
    assert writers.write_once(spark.range(3), path) and not writers.write_once(spark.range(9), path)
    assert spark.read.parquet(path).count() == 3
    assert [r.id for r in writers.unfinished(spark.range(5), spark.read.parquet(path), "id").orderBy("id").collect()] == [3, 4]


def test_only_the_tail_is_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(4).select((2023 + F.col("id") % 2).alias("year"), "id")
    writers.write_partitions(rows, path, "year")
    writers.write_partitions(spark.range(1).select(F.lit(2024).cast("long").alias("year"), F.lit(99).cast("long").alias("id")), path, "year")
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 2, 99]


@pytest.mark.parametrize("by_part", [100_000, 2, 1])
def test_styles(spark, tmp_path, by_part):
    deltas = spark.createDataFrame([(r, [(r * 7 + s) % 256 for s in range(3)]) for r in (3, 0, 4, 1, 2)], "river int, deltas array<int>")
    writers.write_styles(deltas, str(tmp_path), "timeseries", "2024-01-01T00:00:00Z", ["a", "b", "c"], by_part=by_part)
    raw = zlib.decompress((tmp_path / "styles.bin").read_bytes())
    assert list(raw) == [(r * 7 + s) % 256 for r in range(5) for s in range(3)]
    head = json.loads((tmp_path / "styles.json").read_text())
    assert head["n_reaches"] == 5 and head["n_steps"] == 3 and head["ret_per_values"] == [0, 2, 5, 10, 25, 50, 100]
    with pytest.raises(ValueError, match="styleset"):
        writers.write_styles(deltas, str(tmp_path), "other", "x", ["a", "b", "c"])
    with pytest.raises(Exception, match="steps"):
        writers.write_styles(deltas, str(tmp_path / "new"), "timeseries", "x", ["a"])
    assert not (tmp_path / "new" / "styles.bin").exists()
    writers.write_styles(deltas.limit(0), str(tmp_path), "max-flow", "x", ["a"])
    assert zlib.decompress((tmp_path / "styles.bin").read_bytes()) == b""


def test_stylesets(spark):
    median = spark.createDataFrame([(1, 0, 1.0), (1, 1, 50.0), (1, 2, 50.0), (2, 0, 0.0), (2, 1, 0.0)], "river int, step int, q float")
    levels = spark.createDataFrame([(1, [2.0, 40.0, 60.0])], "river int, thresholds array<float>")
    low = spark.createDataFrame([(1, 2.0)], "river int, q95 float")
    got = {(r.river, r.styleset): (r.codes, r.deltas) for r in thresholds.stylesets(median, levels, low).collect()}
    assert got[1, "timeseries"] == ([1, 2 * 8 + 2, 2 * 8 + 2], [1, 17, 0]) and got[1, "max-flow"][0] == [18]
    assert got[1, "time-to-peak"][0] == [1] and got[1, "below-q95"][0] == [1]
    assert got[2, "time-to-peak"][0] == [255] and got[2, "below-q95"][0] == [255] and got[2, "timeseries"] == ([0, 0], [0, 0])
    with pytest.raises(ValueError, match="styleset"):
        thresholds.stylesets(median, levels, low, ("max-flow", "nothing"))


def test_history_is_written_once(spark, tmp_path):
    rows = lambda q: spark.sql(f"select 1 river, timestamp'2024-12-31 23:00:00' + make_interval(0, 0, 0, 0, cast(id as int)) ts, cast({q} as float) q from range(3)")
    path = str(tmp_path / "r")
    writers.write_record(rows(1), path)
    writers.write_record(rows(2), path)
    assert sorted((r.era, r.q) for r in writers.read_record(spark, path).collect()) == [("history", 1.0), ("tail", 2.0), ("tail", 2.0)]


def test_the_tail_is_swapped_in_one_step(spark, tmp_path):
    """Who reads during a write has the tail before; a write that fails changes nothing; old tails go."""
    path = str(tmp_path / "r")
    rows = lambda q, n=4: spark.sql(f"select id river, timestamp'2025-01-01 00:00:00' + make_interval(0, 0, 0, 0, cast(id as int)) ts, cast({q} as float) q from range({n})")
    with pytest.raises(FileNotFoundError):
        writers.read_record(spark, path)
    writers.write_record(rows(1), path)
    reader = writers.read_record(spark, path)
    seen = []
    plain_commit = writers._Commit.__exit__

    def slow(self, failure, *rest):
        seen.append(sorted(r.q for r in writers.read_record(spark, path).collect()))  # the new tail is whole, the pointer old
        plain_commit(self, failure, *rest)

    writers._Commit.__exit__ = slow
    try:
        writers.write_record(rows(2, 5), path)
    finally:
        writers._Commit.__exit__ = plain_commit
    assert seen == [[1.0] * 4] and sorted(r.q for r in reader.collect()) == [1.0] * 4
    assert sorted(r.q for r in writers.read_record(spark, path).collect()) == [2.0] * 5
    broken = rows(3).withColumn("q", F.when(F.col("river") < 3, F.col("q")).otherwise(F.raise_error(F.lit("lost")).cast("float")))
    with pytest.raises(Exception):
        writers.write_record(broken, path)
    assert sorted(r.q for r in writers.read_record(spark, path).collect()) == [2.0] * 5
    writers.write_record(rows(4), path)
    writers.write_record(rows(5), path)
    assert sorted(r.q for r in writers.read_record(spark, path).collect()) == [5.0] * 4
    assert len(list((tmp_path / "r").glob("tail-*"))) == 2


def test_a_partition_is_written_by_many_tasks(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so little data would be merged
    try:
        writers.write_partitions(spark.range(3000).selectExpr("id", "id % 2 year"), path, "year", tasks=5)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "p" / "year=0").glob("*.parquet"))) > 1 and spark.read.parquet(path).count() == 3000


def test_manifests_name_files_that_are_gone_or_cut(spark, tmp_path):
    path = str(tmp_path / "t")
    manifest.write(spark.range(1000).selectExpr("id", "id % 3 year").repartition(4, "id"), path, "year")
    assert manifest.read(spark, path).count() == 1000 and manifest.faults(spark, path).count() == 0
    assert manifest.load(spark, path).agg(F.sum("rows")).first()[0] == 1000
    names = sorted((tmp_path / "t").glob("year=*/*.parquet"))
    names[0].unlink()
    names[1].write_bytes(names[1].read_bytes()[:-20])
    names[2].rename(names[2].with_name("other.parquet"))
    got = {r.file: r.fault for r in manifest.faults(spark, path).collect()}
    name = lambda p: f"{p.parent.name}/{p.name}"
    assert got == {name(names[0]): "removed", name(names[1]): "truncated", name(names[2]): "removed", f"{names[2].parent.name}/other.parquet": "unknown"}
    with pytest.raises(ValueError, match="truncated"):
        manifest.read(spark, path)


def gumbel(block, rows):
    """Return-period flows of a block of rivers, by numpy alone."""
    import numpy as np
    import pyarrow as pa

    river, q = rows.column("river").to_numpy(), rows.column("q").to_numpy().astype(np.float64)
    out = {"river": [], "recurrence_interval": [], "flow": []}
    for r in np.unique(river):
        own = q[river == r]
        if len(own) >= 3:
            flows = np.full(len(frequency.INTERVALS), own[0]) if (own == own[0]).all() else own.mean() + np.array(frequency.GUMBEL_K) * own.std(ddof=1)
            out["river"] += [r] * len(flows)
            out["recurrence_interval"] += list(map(float, frequency.INTERVALS))
            out["flow"] += list(np.maximum(flows, 0))
    return pa.table({"river": pa.array(out["river"], pa.int64()), "recurrence_interval": pa.array(out["recurrence_interval"], pa.float32()), "flow": pa.array(out["flow"], pa.float64())})


def test_blocks_are_done_once_and_an_interrupted_run_goes_on(spark, tmp_path):
    maxima = stand_ins.maxima(spark, "/root/testdata/sf0.001").select(F.col("river").cast("long").alias("river"), "year", "q").union(spark.sql("select cast(100 + id as long), cast(2000 + id % 4 as int), cast(id as float) from range(80)"))
    maxima = maxima.repartition(3).persist()
    path = f"file://{tmp_path}/blocks"

    def fails(block, rows):
        if block == 5:
            raise RuntimeError("lost")
        return gumbel(block, rows)

    every = maxima.select(F.floor(F.col("river") / 25).alias("b")).distinct().count()
    with pytest.raises(Exception, match="lost"):
        blocks.run_blocks(maxima, path, fails, 25, "river")
    done = {r.block for r in blocks.done_blocks(spark, path).collect()}
    assert 5 not in done
    assert blocks.run_blocks(maxima, path, gumbel, 25, "river") == every - len(done)
    assert blocks.run_blocks(maxima, path, gumbel, 25, "river") == 0
    got = {(r.river, r.recurrence_interval): r.flow for r in blocks.read_blocks(spark, path).collect()}
    want = {(r.river, r.recurrence_interval): r.flow for r in frequency.return_periods(maxima, ("gumbel",)).collect()}
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k], rel=1e-3) for k in want)
    assert {r.river // 25 for r in blocks.read_blocks(spark, path, 4, 5).collect()} <= {4, 5}
    maxima.unpersist()


def test_equal_axes_whatever_gathers_them(spark):
    rows = [(m, p, v) for m in range(5) for p, v in enumerate([10, 20, 30, 30, 50])]
    rows += [(5, p, v) for p, v in enumerate([10, 20, 30, 50, 30])] + [(6, p, v) for p, v in enumerate([10, 20, 30, 30, 51])] + [(7, p, v) for p, v in enumerate([10, 20, 30, 30])] + [(8, p, v) for p, v in enumerate([10, None, 30, 30, 50])]
    df = spark.createDataFrame(rows, "member int, place int, value int").repartition(7)
    assert sorted(map(tuple, axes.differing(df, "member", "place", "value").collect())) == [(5, 5, 5), (6, 5, 5), (7, 4, 5), (8, 5, 5)]
    assert {r.member: r.like for r in axes.alike(df, "member", "place", "value").collect()} == {**dict.fromkeys(range(5), 0), 5: 5, 6: 6, 7: 7, 8: 8}
    with pytest.raises(ValueError, match="5 .5 values in place of 5., 6"):
        axes.require_equal(df, "member", {"step": df})
    axes.require_equal(df, "member", {"step": df.where("member < 5"), "none": df.limit(0)})
    assert sorted(map(tuple, axes.descents(df, "member", "place", "value").where("member in (0, 5, 8)").collect()), key=repr) == sorted([(0, 3, 30, 30), (5, 4, 30, 50), (8, 1, None, 10), (8, 2, 30, None), (8, 3, 30, 30)], key=repr)


def test_notes_and_stores(spark, tmp_path):
    writers.described(spark.sql("select 1 river, 2.0 q"), {"q": {"units": "m3 s-1"}}).write.parquet(str(tmp_path / "n"))
    assert spark.read.parquet(str(tmp_path / "n")).schema["q"].metadata == {"units": "m3 s-1"}
    for kind in writers.STORES:
        writers.create_named_store(spark, kind, f"store_{kind}", "River's record", str(tmp_path / kind))
        assert spark.table(f"store_{kind}").count() == 0
        facts = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES store_{kind}").collect()}
        assert facts["title"] == "River's record" and facts["keepbits"] == "13"
        with pytest.raises(PySparkException):
            writers.create_named_store(spark, kind, f"store_{kind}", "again", str(tmp_path / kind))
        spark.sql(f"DROP TABLE store_{kind}")


def test_global_needs_every_region(spark, tmp_path):
    parts = spark.createDataFrame([("a", 1), ("a", 0)], "region string, riverIndex int")
    regions = spark.createDataFrame([("a",), ("b",)], "region string")
    path = str(tmp_path / "g")
    assert not writers.write_global(parts, regions, path)
    assert writers.write_global(parts.union(spark.createDataFrame([("b", 2)], parts.schema)), regions, path)
    assert spark.read.parquet(path).count() == 3


def test_layouts_alerts_and_weights(spark, tmp_path):
    rows = spark.createDataFrame([(r, s, float(r)) for r in range(6) for s in range(2)], "riverIndex int, step int, q float")
    writers.write_by_step(rows, str(tmp_path / "steps"))
    assert "PartitionFilters: [isnotnull(step" in spark.read.parquet(str(tmp_path / "steps")).where("step = 1")._jdf.queryExecution().toString()
    writers.write_rivers(rows, str(tmp_path / "rivers"), 2)
    writers.write_alerts(rows, str(tmp_path / "alerts"))
    assert [int(r.riverIndex) for r in spark.read.option("header", True).csv(str(tmp_path / "alerts")).collect()] == sorted([*range(6)] * 2)
    w = spark.createDataFrame([(1, 2, 3, 4.0, 1.0)], "river_id int, x_index int, y_index int, area_sqm double, proportion double")
    writers.write_browser_weights(w, str(tmp_path / "w"))
    assert dict(spark.read.parquet(str(tmp_path / "w")).dtypes)["area_sqm"] == "float"


def test_scans_and_names(spark, tmp_path):
    spark.sql("select 1 region, float('nan') q, 'x' extra").write.parquet(str(tmp_path / "p"))
    assert tables.scan(spark, str(tmp_path / "p"), "q").first().q is None
    table = spark.createDataFrame([("1",), ("2",), ("global",)], "region string")
    assert tables.regions(table).count() == 2 and tables.regions(table, ["2"]).count() == 1
    with pytest.raises(PySparkException):
        tables.regions(table, ["3"]).collect()
    names = spark.createDataFrame([("cf_00_20240101.grib",), ("pf_07_20240102.grib",), ("other",)], "name string")
    assert tables.newest(names).first().newest == "20240102"
    steps = spark.createDataFrame([(0, s) for s in range(3)] + [(1, 0)], "member int, step int")
    assert [(r.member, r.n) for r in tables.incomplete(steps, range(3), 3).orderBy("member").collect()] == [(1, 1), (2, 0)]
    packed = spark.createDataFrame([(1, [3.0, 1.0, 2.0])], "river int, q array<float>")
    assert tables.packed_series(tables.long_series(packed)).first().q == [3.0, 1.0, 2.0]


def test_members_and_years(spark, tmp_path):
    for m in (0, 1):
        spark.range(3).selectExpr("cast(id as int) step", f"float({m}) q").write.parquet(str(tmp_path / f"member={m}"))
    paths = [str(tmp_path / f"member={m}") for m in (0, 1)]
    assert sorted((r.member, r.q) for r in tables.open_members(spark, paths).where("step = 2").collect()) == [(0, 0.0), (1, 1.0)]
    spark.range(2).selectExpr("cast(id as int) step", "float(2) q").write.parquet(str(tmp_path / "member=2"))
    with pytest.raises(PySparkException, match="step"):
        tables.open_members(spark, [*paths, str(tmp_path / "member=2")]).collect()
    spark.range(1).write.parquet(str(tmp_path / "r" / "year=2001"))
    spark.range(2).write.parquet(str(tmp_path / "r" / "2002.parquet"))
    assert tables.year_source(spark, str(tmp_path / "r"), 2001).count() == 1 and tables.year_source(spark, str(tmp_path / "r"), 2002).count() == 2
    with pytest.raises(FileNotFoundError):
        tables.year_source(spark, str(tmp_path / "r"), 2003)


def test_stream_equals_batch(spark, tmp_path):
    from freshet.operators import reductions

    rows = spark.sql("select cast(id % 3 as int) river, timestamp_seconds(1704067200 + id * 1000) ts, cast(id as float) q from range(500)")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    windows.run_available(windows.windowed_means(stream), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {tuple(r) for r in reductions.window_means(rows).collect()}
    assert got and got <= want
