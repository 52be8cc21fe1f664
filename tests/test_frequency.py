import math
import time

import numpy as np
import pytest

from freshet.operators import frequency as f


def maxima(spark, *rivers):
    return spark.createDataFrame([(i, y, float(q)) for i, qs in enumerate(rivers) for y, q in enumerate(qs)], "river int, year int, q float")


def test_flat_zero_and_tiny(spark):
    rows = f.return_periods(maxima(spark, [3.0] * 5, [0.0] * 4, [1e-5, 2e-5, 5e-5])).collect()
    assert {r.flow for r in rows if r.river == 0} == {3.0} and {r.flow for r in rows if r.river == 1} == {0.0}
    assert all(r.flow == pytest.approx(1e-4, rel=1e-3) for r in rows if r.river == 2 and r.distribution in ("lognormal", "logpearson3"))
    assert len(rows) == 3 * 4 * 7


def test_short_records_have_no_curve(spark):
    df = maxima(spark, [1.0, 2.0], [1.0, 2.0, 4.0])
    assert {r.river for r in f.gumbel(f.moments(df)).collect()} == {1}
    assert [r.river for r in f.enough_years(df).collect()] == [0]


@pytest.mark.parametrize("skew", [2.0, -2.0])
def test_pearson3_is_exponential(skew):
    got = f.pearson3_factors(np.array([skew]))[0]
    for x, t in zip(got, f.INTERVALS):
        p = 1 - 1 / t
        assert x == pytest.approx(-math.log(1 - p) - 1 if skew > 0 else 1 + math.log(p), abs=1e-12)


def lower_gamma(a, x):
    """Regularised, by Simpson's rule over t ** (1 / a), where the integrand is smooth."""
    if a < 1:
        u = np.linspace(0, x**a, 200_001)
        y = np.exp(-(u ** (1 / a))) / a
    else:
        lo = max(0.0, a - 12 * math.sqrt(a))
        u = np.linspace(lo, x, 200_001)
        with np.errstate(divide="ignore"):
            y = np.exp((a - 1) * np.log(np.maximum(u, 1e-300)) - u - math.lgamma(a))
        return float((y[0] + y[-1] + 4 * y[1:-1:2].sum() + 2 * y[2:-1:2].sum()) * (u[1] - u[0]) / 3)
    return float((y[0] + y[-1] + 4 * y[1:-1:2].sum() + 2 * y[2:-1:2].sum()) * (u[1] - u[0]) / 3) / math.gamma(a)


@pytest.mark.parametrize("skew", [0.01, -0.03, 0.2, -0.7, 1.4, -3.0, 5.0])
def test_pearson3_quantiles(skew):
    """The probability below each quantile, by numerical integration."""
    a = 4 / skew**2
    for x, t in zip(f.pearson3_factors(np.array([skew]))[0], f.INTERVALS):
        p = 1 - 1 / t if skew > 0 else 1 / t
        assert lower_gamma(a, (x + 2 / skew) * 2 / skew) == pytest.approx(p, abs=1e-5)


def test_pearson3_small_skew():
    for z, near in zip(f.NORMAL_Z, f.pearson3_factors(np.array([0.0, 0.00999, 0.01001, -0.01001])).T):
        assert near[0] == z and near[1] == pytest.approx(near[2], abs=2e-5) and abs(near[3] - z) < 0.02


def test_weibull_shape():
    k = np.array([0.5, 1.0, 3.6])
    cv = np.sqrt([math.gamma(1 + 2 / x) / math.gamma(1 + 1 / x) ** 2 - 1 for x in k])
    assert f.weibull_shape(cv) == pytest.approx(k, rel=1e-4)
    assert f.weibull_shape(np.array([0.0, 1e6])) == pytest.approx([200.0, 0.1])


def test_curves_rise(spark):
    rng = np.random.default_rng(5)
    rows = f.return_periods(maxima(spark, *[rng.lognormal(4, 1, 30) for _ in range(5)])).collect()
    for river in range(5):
        for d in f.FITS:
            flows = [r.flow for r in sorted(rows, key=lambda r: r.recurrence_interval) if r.river == river and r.distribution == d]
            assert flows == sorted(flows) and len(flows) == 7


def test_pearson3_takes_no_time():
    """Far below 3 ms a river, however the skews are mixed."""
    skews = np.random.default_rng(2).normal(0, 1, 5000)
    began = time.process_time()
    f.pearson3_factors(skews)
    assert time.process_time() - began < 5000 * 0.002


def test_both_series(spark):
    df = spark.createDataFrame([(1, y, float(10 + y), float(y)) for y in range(1, 9)], "river long, year int, hourly float, daily float")
    rows = f.return_periods(f.both_series(df), keys=("river", "series")).collect()
    assert len(rows) == 2 * 4 * 7 and {r.series for r in rows} == {"hourly", "daily"}
    for bad in (None, float("nan")):
        broken = df.union(spark.createDataFrame([(1, 9, 1.0, bad)], df.schema))
        with pytest.raises(Exception, match="maxim"):
            f.both_series(broken).collect()
