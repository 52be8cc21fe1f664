"""State carried by streams, across micro-batches, restarts and failures."""

import datetime

import pytest
from pyspark.sql import functions as F

from freshet.operators import interpolation
from freshet.streaming import stateful

ROWS = "cell long, hours long, ro double"


def batches(spark, folder, n=3, cells=5):
    """``n`` files of accumulations, in the order of their hours; the cells' values rise by their number."""
    for k in range(n):
        rows = [(c, h, float(c * h)) for c in range(cells) for h in range(10 * k + 1, 10 * k + 11)]
        spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(f"{folder}/in{k}")


def stream(spark, folder, pattern="in*"):
    return spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(f"{folder}/{pattern}")


@pytest.fixture(autouse=True)
def stores(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    stateful.with_state_store(spark)
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def test_increments_over_batches_and_a_restart_equal_one_batch(spark, tmp_path):
    batches(spark, tmp_path, 2)
    sink = stateful.Resumable(f"{tmp_path}/out")
    stateful.resume(stateful.flowing_increments(stream(spark, tmp_path)), sink, f"{tmp_path}/checkpoint")
    first = sink.read(spark).count()
    rows = [(c, h, float(c * h)) for c in range(5) for h in range(21, 31)] + [(9, 3, 7.0), (1, 4, 99.0), (None, 1, 1.0), (2, None, 1.0)]
    spark.createDataFrame(rows, ROWS).coalesce(1).write.parquet(f"{tmp_path}/in2")
    stateful.resume(stateful.flowing_increments(stream(spark, tmp_path)), sink, f"{tmp_path}/checkpoint")  # goes on with the state
    got = sink.read(spark)
    whole = spark.read.schema(ROWS).parquet(f"{tmp_path}/in*").where("cell is not null and hours is not null and not (cell = 1 and hours = 4 and ro = 99)")
    want = {(r.cell, r.hours): r.step_ro for r in interpolation.increments(whole).collect()}
    assert first == 100 and {(r.cell, r.hours): r.step_ro for r in got.where("what = 'step'").collect()} == want
    assert [(r.cell, r.hours, r.ro, r.total) for r in got.where("what = 'late'").collect()] == [(1, 4, 99.0, None)]
    last = {r.cell: (r.hours, r.ro, r.total, r.n) for r in stateful.last_states(got).collect()}
    assert last == {c: (30, c * 30.0, c * 30.0, 30) for c in range(5)} | {9: (3, 7.0, 7.0, 1)}


def test_a_query_starts_with_the_state_of_another(spark, tmp_path):
    batches(spark, tmp_path, 3)
    start = spark.createDataFrame([(1, 20, 20.0, 500.0, 7), (77, 1, 1.0, 1.0, 1)], "cell long, hours long, ro double, total double, n long")
    sink = stateful.Resumable(f"{tmp_path}/out")
    stateful.resume(stateful.flowing_increments(stream(spark, tmp_path, "in2"), start), sink, f"{tmp_path}/checkpoint")
    rows = {(r.cell, r.hours): r for r in sink.read(spark).collect()}
    assert (rows[1, 21].step_ro, rows[1, 21].total, rows[1, 21].n) == (1.0, 501.0, 8) and rows[2, 21].step_ro == 42.0 and len(rows) == 50


def test_a_quiet_cell_is_closed_and_forgotten(spark, tmp_path):
    at = lambda h: datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=h)
    files = [[(1, 1, 5.0, at(1)), (2, 1, 1.0, at(1))], [(2, 30, 4.0, at(30))], [(2, 31, 6.0, at(31))], [(1, 2, 3.0, at(40))]]
    for k, rows in enumerate(files):
        spark.createDataFrame(rows, f"{ROWS}, ts timestamp").coalesce(1).write.parquet(f"{tmp_path}/in{k}")
        source = spark.readStream.schema(f"{ROWS}, ts timestamp").parquet(f"{tmp_path}/in*")
        sink = stateful.Resumable(f"{tmp_path}/out")
        stateful.resume(stateful.flowing_increments(source, quiet=24), sink, f"{tmp_path}/checkpoint")
    rows = sorted(((r.cell, r.hours, r.ro, r.step_ro, r.total, r.n, r.what) for r in sink.read(spark).where("what <> 'step' or n = 1").collect()), key=repr)
    assert (1, 1, 5.0, None, 5.0, 1, "closed") in [(c, h, ro, None, t, n, w) for c, h, ro, _, t, n, w in rows if w == "closed"]
    assert (1, 2, 3.0, 3.0, 3.0, 1, "step") in rows  # the first step after it was forgotten


@pytest.mark.parametrize("broken", [0, 1, 2])
def test_a_failure_between_data_and_progress_loses_and_doubles_nothing(spark, tmp_path, broken):
    batches(spark, tmp_path, 3)
    source = lambda: stream(spark, tmp_path).select("cell", "hours", "ro")

    def fail(number):
        if number == broken:
            raise RuntimeError("lost between data and progress")

    with pytest.raises(Exception, match="lost between"):
        stateful.resume(source(), stateful.Resumable(f"{tmp_path}/out", ("cell",), fail), f"{tmp_path}/checkpoint")
    sink = stateful.Resumable(f"{tmp_path}/out", ("cell",))
    assert sink.progress(spark) == {"batch": broken - 1} and (sink.read(spark).count() == 50 * broken)
    stateful.resume(source(), sink, f"{tmp_path}/checkpoint")
    assert sink.read(spark).count() == 150 and sink.read(spark).distinct().count() == 150 and sink.progress(spark) == {"batch": 2}
    stateful.resume(source(), sink, f"{tmp_path}/checkpoint")
    assert sink.read(spark).count() == 150


def test_another_layout_is_refused_before_anything_is_written(spark, tmp_path):
    batches(spark, tmp_path, 1)
    sink = stateful.Resumable(f"{tmp_path}/out")
    stateful.resume(stream(spark, tmp_path), sink, f"{tmp_path}/checkpoint")
    batches(spark, tmp_path, 1)
    with pytest.raises(Exception, match="has"):
        stateful.resume(stream(spark, tmp_path).withColumn("ro", F.col("ro").cast("float")), sink, f"{tmp_path}/checkpoint")
    with pytest.raises(stateful.Layout):
        stateful.Resumable(f"{tmp_path}/out", ("cell",))(spark.createDataFrame([(1, 1, 1.0)], ROWS), 9)
    assert sink.read(spark).count() == 50 and sink.progress(spark) == {"batch": 0}
