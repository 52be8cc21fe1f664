"""Reductions, ensembles, thresholds, interpolation: hand-made edge cases."""

import datetime as dt

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from freshet.functions import calendar
from freshet.operators import ensemble, interpolation, reductions, thresholds
from tests.test_numerics import bits


def hours(spark, start, values):
    t = dt.datetime.fromisoformat(start)
    return spark.createDataFrame([(1, t + dt.timedelta(hours=i), v) for i, v in enumerate(values)], "river int, ts timestamp, q float")


def test_late_first_day(spark):
    values = [float(i) for i in range(17 + 24)]
    by_day = reductions.days(hours(spark, "1940-01-01T07:00:00", values))
    rows = {r.day.day: r for r in by_day.collect()}
    assert rows[1].hours == 17 and rows[1].mean == bits(np.mean(values[:17])) and rows[2].mean == bits(np.mean(values[17:]))
    month = reductions.period_means(by_day, "month").first()
    assert month.hours == 41 and month["mean"] == bits(np.mean([bits(v) for v in values]))


def test_maxima_are_values_of_their_series(spark):
    rng = np.random.default_rng(3)
    by_day = reductions.days(hours(spark, "1996-02-27T00:00:00", [float(v) for v in rng.lognormal(3, 2, 96)]))
    top = reductions.annual_maxima(by_day).first()
    assert top.daily == max(r["mean"] for r in by_day.collect()) and top.hourly == max(r.top for r in by_day.collect())


def test_leap_february(spark):
    df = spark.createDataFrame([("1996-02-10",), ("1900-02-10",)], "d string").select(calendar.days_in_month(F.to_date("d")).alias("n"))
    assert [r.n for r in df.collect()] == [29, 28]


def test_record_times_leave_the_end_out(spark):
    assert calendar.record_times(spark, 1999, 2000, "day").count() == 731
    assert calendar.record_times(spark, 1999, 2000, "month").count() == 24


def test_no_series(spark):
    empty = hours(spark, "2000-01-01T00:00:00", [1.0]).where("q > 5")
    assert reductions.annual_maxima(reductions.days(empty)).count() == 0


def test_fifty_one_members_give_members(spark):
    df = spark.createDataFrame([(1, m, 0, float(50 - m)) for m in range(51)], "river int, member int, step int, q float")
    assert [r.q for r in ensemble.deciles(df).orderBy("percentile").collect()] == [float(x) for x in range(0, 51, 5)]


def test_peak_ties_and_no_flow(spark):
    df = spark.createDataFrame([(1, 0, 2.0), (1, 1, 7.0), (1, 2, 7.0), (2, 0, 0.0), (2, 1, -1.0), (3, 0, None)], "river int, step int, q float")
    rows = {r.river: r for r in ensemble.peaks(df).collect()}
    assert rows[1].peak_step == 1 and rows[1].time_to_peak == 1 and rows[2].time_to_peak == 255 and 3 not in rows


def members(spark, over, n=51, step=0, high=10.0):
    return spark.createDataFrame([(1, m, step, high if m < over else 0.0) for m in range(n)], "river int, member int, step int, q float")


CURVE = [(1, float(t), float(i + 1)) for i, t in enumerate((1.5, 2, 5, 10, 25, 50, 100))]


@pytest.mark.parametrize("over, alert, certainty", [(15, False, None), (16, True, "Possible"), (25, True, "Possible"), (26, True, "Likely")])
def test_shares(spark, over, alert, certainty):
    curves = spark.createDataFrame(CURVE, "river int, recurrence_interval float, flow float")
    levels = thresholds.alert_levels(thresholds.exceedance(members(spark, over), curves))
    assert (levels.count() == 1) == alert
    if alert:
        peaks = spark.createDataFrame([(1, 9.0, 3)], "river int, peak float, peak_step int")
        meta = spark.createDataFrame([(1, 77, 0, 1.0, 2.0)], "river int, riverId int, riverIndex int, lat double, lon double")
        row = thresholds.alert_table(levels, peaks, meta, F.lit("2024-05-01").cast("timestamp"), "x").first()
        assert tuple(row.asDict()) == thresholds.ALERT_COLUMNS
        assert row.certainty == certainty and row.severity == "Extreme" and row.urgency == "Immediate"
        assert row.identifier == "x-2024050100-77" and row.expires == "2024-05-16T00:00:00Z" and row.peak_time == "2024-05-01T09:00:00Z"


def test_alert_facts_equal_the_steps_that_they_are_made_of(spark):
    import numpy as np

    rng = np.random.default_rng(4)
    rows = [(r, m, s, None if rng.random() < 0.05 else float(rng.choice([0.0, 1.0, 2.5, 4.0, 7.0, 9.0]))) for r in range(12) for m in range(10) for s in range(6) if rng.random() < 0.9]
    rows += [(20, m, s, None) for m in range(4) for s in range(3)]
    df = spark.createDataFrame(rows, "river int, member int, step int, q float")
    curves = spark.createDataFrame([(r, t, f + r % 3) for r in range(10) for _, t, f in CURVE if (r + t) % 4] + [(20, 2.0, 0.5)], "river int, recurrence_interval float, flow float")
    levels = thresholds.alert_levels(thresholds.exceedance(df, curves))
    peaks = ensemble.peaks(ensemble.deciles(df).where("percentile = 50").drop("percentile"))
    want = levels.join(peaks, "river").select("river", "recurrence_interval", "flow", "share", "onset", "peak", "peak_step").collect()
    facts = thresholds.alert_facts(df, curves)
    assert sorted(map(tuple, facts.collect())) == sorted(map(tuple, want)) and len(want) > 5
    assert facts.columns == ["river", "recurrence_interval", "flow", "share", "onset", "peak", "peak_step"]


def test_equal_to_a_threshold(spark):
    curves = spark.createDataFrame([(1, 2.0, 5.0)], "river int, recurrence_interval float, flow float")
    assert thresholds.exceedance(members(spark, 51, high=5.0), curves).first().share == 0.0
    styles = thresholds.style_codes(spark.createDataFrame([(1, 0, 5.0)], "river int, step int, q float"), thresholds.threshold_arrays(curves))
    assert styles.first().period_class == 1


def test_delta_round_trip(spark):
    codes = spark.createDataFrame([(1, i, v) for i, v in enumerate((250, 3, 3, 0))], "river int, step int, style int")
    delta = [r.delta for r in thresholds.deltas(codes).orderBy("step").collect()]
    assert delta == [250, 9, 0, 253]
    assert list(np.cumsum(delta) % 256) == [250, 3, 3, 0]


def test_hourly_interpolation(spark):
    steps = [(1, 0, 99.0), (1, 1, 1.0), (1, 3, 5.0), (1, 9, 17.0)]
    df = spark.createDataFrame(steps, "cell int, hours int, ro float")
    got = {r.hour: r.ro for r in interpolation.at_every_hour(df).collect()}
    assert got == {h: pytest.approx(2 * h - 1) for h in range(1, 10)}
    assert interpolation.whole_hours(df).count() == 0
    assert interpolation.whole_hours(spark.createDataFrame([(1, 2, 1.0), (1, -1, 1.0)], "cell int, hours int, ro float")).count() == 1


def test_members(spark):
    df = spark.createDataFrame([("cf", 0), ("pf", 50)], "k string, n int").select(calendar.member_number(F.col("k"), F.col("n")).alias("m"))
    assert [r.m for r in df.collect()] == [0, 50]
    with pytest.raises(PySparkException):
        spark.createDataFrame([("pf", 51)], "k string, n int").select(calendar.member_number(F.col("k"), F.col("n"))).collect()
