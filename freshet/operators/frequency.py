"""Return-period flows: four distributions fitted to annual maxima by moments.

Moments are SQL aggregates. Only what Spark has no function for (the shape of a Weibull distribution, the
quantile of Pearson III) is a vectorised function of one number for each river.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions.numerics import keepbits

# Intervals (years), normal quantiles and Gumbel factors of their non-exceedance probabilities.
INTERVALS = (1.5, 2.0, 5.0, 10.0, 25.0, 50.0, 100.0)
NORMAL_Z = (-0.43072729929545733, 0.0, 0.8416212335729144, 1.2815515655446008, 1.7506860712521695, 2.053748910631822, 2.3263478740408410)
GUMBEL_K = (-0.5233820161705003, -0.16428425793012688, 0.7194452367371932, 1.3045506812337815, 2.0438344544192764, 2.5922762640047763, 3.1366720862515307)
LOG_FLOOR = 1e-4
LEAST_YEARS = 3
SHAPES = (0.1, 200.0, 4000)


def moments(maxima: DataFrame, keys: tuple[str, ...] = ("river",)) -> DataFrame:
    """Of (keys, year, q): years, mean, std, moments of ln and log10, extremes, and the skew of log10."""
    x = F.col("q").cast("double")
    floored = F.greatest(x, F.lit(LOG_FLOOR))
    by_river = maxima.groupBy(*keys).agg(
        F.count("q").alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.avg(F.log(floored)).alias("ln_mean"), F.stddev_samp(F.log(floored)).alias("ln_std"),
        F.avg(F.log10(floored)).alias("lg_mean"), F.stddev_samp(F.log10(floored)).alias("lg_std"), F.min("q").alias("low"), F.max("q").alias("high"), F.skewness(F.log10(floored)).alias("_g"),
    )
    n = F.col("n").cast("double")
    # the population skew, adjusted for the number of years
    skew = F.when((F.col("n") >= LEAST_YEARS) & (F.col("lg_std") > 0), F.col("_g") * F.sqrt(n * (n - 1)) / (n - 2)).otherwise(0.0)
    return by_river.withColumn("skew", skew).drop("_g")


def enough_years(maxima: DataFrame, least: int = LEAST_YEARS) -> DataFrame:
    """(river, n) of the rivers whose record is too short to fit, or holds a missing maximum."""
    grouped = maxima.groupBy("river").agg(F.count("q").alias("n"), F.count_if(F.col("q").isNull()).alias("missing"))
    return grouped.where((F.col("n") < least) | (F.col("missing") > 0))


def _gumbel(m: DataFrame) -> tuple[DataFrame, list[Column]]:
    return m, [F.col("mean") + k * F.col("std") for k in GUMBEL_K]


def _lognormal(m: DataFrame) -> tuple[DataFrame, list[Column]]:
    return m, [F.exp(F.col("ln_mean") + z * F.col("ln_std")) for z in NORMAL_Z]


def _log_gamma(x: np.ndarray) -> np.ndarray:
    return np.fromiter(map(math.lgamma, x), float, len(x))


def weibull_shape(cv: np.ndarray) -> np.ndarray:
    """The shape whose coefficient of variation is given; beyond the table, its nearest end."""
    k = np.geomspace(*SHAPES)
    table = np.sqrt(np.exp(_log_gamma(1 + 2 / k) - 2 * _log_gamma(1 + 1 / k)) - 1)
    return np.interp(cv, table[::-1], k[::-1])


def _weibull(m: DataFrame) -> tuple[DataFrame, list[Column]]:
    @F.pandas_udf("struct<shape:double,scale:double>")
    def shape_and_scale(mean: pd.Series, cv: pd.Series) -> pd.DataFrame:
        shape = weibull_shape(cv.to_numpy(float))
        return pd.DataFrame({"shape": shape, "scale": mean.to_numpy(float) / np.exp(_log_gamma(1 + 1 / shape))})

    cv = F.coalesce(F.try_divide("std", "mean"), F.lit(0.0))
    m = m.withColumn("_fit", shape_and_scale("mean", cv))
    return m, [F.col("_fit.scale") * F.pow(F.lit(math.log(t)), 1 / F.col("_fit.shape")) for t in INTERVALS]


def _lower_gamma(a: np.ndarray, x: np.ndarray, log_gamma: np.ndarray) -> np.ndarray:
    """Regularised lower incomplete gamma function by its series, whose terms are all positive.

    From the first term on they rise to the one of x - a and then fall; the sum begins far enough before it.
    """
    skipped = np.maximum(np.floor(x - a - 9 * np.sqrt(x) - 30), 0)
    shifted = a + skipped
    log_first = shifted * np.log(x) - x - np.where(skipped > 0, _log_gamma(shifted + 1), log_gamma)
    term = np.ones_like(x)
    total, at = term.copy(), shifted.copy()
    for _ in range(100_000):
        at += 1
        term *= x / at
        total += term
        if (term <= total * 1e-17).all():
            break
    return np.exp(log_first) * total


def gamma_quantile(a: np.ndarray, p: np.ndarray) -> np.ndarray:
    """x at which the regularised lower incomplete gamma function of shape a is p: Newton steps in ln x within a
    shrinking bracket, from the cube-root approximation or, where that is too small, from the series' first term."""
    log_gamma = _log_gamma(a + 1)
    z = np.interp(p, _NORMAL_P, _NORMAL_AT)
    cube = a * np.maximum(1 - 1 / (9 * a) + z / (3 * np.sqrt(a)), 1e-3) ** 3
    low_end = (np.log(p) + log_gamma) / a
    u = np.where((a < 1) | (cube < 0.2 * a), np.minimum(low_end + np.minimum(np.exp(np.minimum(low_end, 0)) / (a + 1), 1), np.log(a + 8 * np.sqrt(a) + 30)), np.log(cube))
    low, high = low_end - 1e-9, np.log(a + 8 * np.sqrt(a) + 40)
    low = np.minimum(low, high - 1e-6)
    u = np.clip(u, low, high)
    rounding = 1e-15 + 1e-16 * a * np.abs(np.log(a))  # of the probability
    todo = np.arange(len(a))
    for _ in range(80):
        x = np.exp(u[todo])
        off = _lower_gamma(a[todo], x, log_gamma[todo]) - p[todo]
        low[todo], high[todo] = np.where(off < 0, u[todo], low[todo]), np.where(off < 0, high[todo], u[todo])
        slope = a[todo] * np.exp(a[todo] * u[todo] - x - log_gamma[todo])
        with np.errstate(divide="ignore", invalid="ignore"):
            step = off / slope
        done = (np.abs(off) <= rounding[todo]) | (np.abs(step) <= 1e-13)
        new = np.where(done, u[todo], u[todo] - step)
        outside = ~done & ~((new > low[todo]) & (new < high[todo]))
        new[outside] = (low[todo][outside] + high[todo][outside]) / 2
        u[todo] = new
        todo = todo[~done]
        if not len(todo):
            break
    return np.exp(u)


# Normal quantiles at the probabilities that are asked for, both tails, in ascending order.
_NORMAL_P, _NORMAL_AT = (np.array(x) for x in zip(*sorted({(q, s * z) for z, t in zip(NORMAL_Z, INTERVALS) for q, s in ((1 - 1 / t, 1), (1 / t, -1))})))


def pearson3_factors(skew: np.ndarray) -> np.ndarray:
    """Standard Pearson III quantiles, a row for each skew and a column for each interval; a series in the skew where
    that is too small for the gamma form. Shapes of like size are solved together: they need as many terms."""
    z, g = np.array(NORMAL_Z), np.asarray(skew, float)[:, None]
    out = z + (z * z - 1) * g / 6 + (z**3 - 7 * z) * g**2 / 144
    big = np.flatnonzero(np.abs(g[:, 0]) >= 0.01)
    size = np.floor(np.log2(np.abs(g[big, 0]))) if len(big) else big
    for k in np.unique(size):
        rows = big[size == k]
        own = np.broadcast_to(g[rows], (len(rows), len(z)))
        p = np.where(own > 0, 1 - 1 / np.array(INTERVALS), 1 / np.array(INTERVALS))
        out[rows] = gamma_quantile(4 / own.ravel() ** 2, p.ravel()).reshape(own.shape) * own / 2 - 2 / own
    return out


def _log_pearson3(m: DataFrame) -> tuple[DataFrame, list[Column]]:
    @F.pandas_udf("array<double>")
    def factors(skew: pd.Series) -> pd.Series:
        return pd.Series(list(pearson3_factors(skew.to_numpy(float))))

    m = m.withColumn("_factors", factors("skew"))
    return m, [F.pow(F.lit(10.0), F.col("lg_mean") + F.col("_factors")[i] * F.col("lg_std")) for i in range(len(INTERVALS))]


FITS = {"gumbel": _gumbel, "logpearson3": _log_pearson3, "lognormal": _lognormal, "weibull": _weibull}


def curves(fitted: DataFrame, distributions=tuple(FITS), keys: tuple[str, ...] = ("river",)) -> DataFrame:
    """(keys, distribution, recurrence_interval, flow) from ``moments``: one row a river carries all its fits, and
    is expanded last. A flat record gives its value, no flow is negative, short records are left out."""
    m = fitted.where(F.col("n") >= LEAST_YEARS)
    flat, parts = F.col("low") == F.col("high"), []
    for d in distributions:
        m, values = FITS[d](m)
        parts += [F.struct(F.lit(d).alias("d"), F.lit(t).cast("float").alias("t"), F.when(flat, F.col("low").cast("double")).otherwise(v).alias("v")) for t, v in zip(INTERVALS, values)]
    rows = m.select(*keys, F.explode(F.array(*parts)).alias("p"))
    return rows.select(*keys, F.col("p.d").alias("distribution"), F.col("p.t").alias("recurrence_interval"), keepbits(F.greatest(F.col("p.v"), F.lit(0.0))).alias("flow"))


def gumbel(fitted: DataFrame) -> DataFrame:
    return curves(fitted, ("gumbel",)).drop("distribution")


def lognormal(fitted: DataFrame) -> DataFrame:
    return curves(fitted, ("lognormal",)).drop("distribution")


def weibull(fitted: DataFrame) -> DataFrame:
    return curves(fitted, ("weibull",)).drop("distribution")


def log_pearson3(fitted: DataFrame) -> DataFrame:
    return curves(fitted, ("logpearson3",)).drop("distribution")


def return_periods(maxima: DataFrame, distributions=tuple(FITS), keys: tuple[str, ...] = ("river",)) -> DataFrame:
    """(keys, distribution, recurrence_interval, flow) of annual maxima (keys, year, q); one aggregate, one pass."""
    return curves(moments(maxima, keys), distributions, keys)


def both_series(annual: DataFrame) -> DataFrame:
    """(river, year, hourly, daily) to (river, series, year, q); a missing maximum is an error."""
    named = F.explode(F.array(*[F.struct(F.lit(x).alias("series"), F.col(x).alias("q")) for x in ("hourly", "daily")])).alias("s")
    q = F.coalesce(F.col("s.q"), F.raise_error(F.concat(F.lit("no maximum: river "), F.col("river").cast("string"), F.lit(", year "), F.col("year").cast("string"))).cast("float"))
    return annual.select("river", "year", named).select("river", "s.series", "year", F.when(~F.isnan(q), q).otherwise(F.raise_error(F.lit("NaN among maxima")).cast("float")).alias("q"))


def falls(curves: DataFrame) -> DataFrame:
    """(river, n_intervals, n_falls): how often a river's flow falls though the interval grows; 0 in a valid curve."""
    before = F.lag("flow").over(Window.partitionBy("river").orderBy("recurrence_interval"))
    marked = curves.withColumn("_falls", F.coalesce((F.col("flow") < before).cast("int"), F.lit(0)))
    return marked.groupBy("river").agg(F.count("flow").alias("n_intervals"), F.sum("_falls").alias("n_falls"))


def largest(maxima: DataFrame) -> DataFrame:
    return maxima.groupBy("river").agg(F.max("q").alias("max_simulated"))


def gumbel_of_block(block: int, rows: pa.Table) -> pa.Table:
    """Gumbel flows of the annual maxima (river, year, q) of a block of rivers, for ``blocks.run_blocks``: the moments of
    all rivers at once, no loop over rivers. Rivers of too few years have none; equal maxima are the flow at every
    interval."""
    river, q = rows.column("river").to_numpy(zero_copy_only=False), rows.column("q").to_numpy(zero_copy_only=False).astype(np.float64)
    kept = ~np.isnan(q)
    names, of, n = np.unique(river[kept], return_inverse=True, return_counts=True)
    q = q[kept]
    mean = np.bincount(of, weights=q, minlength=len(names)) / np.maximum(n, 1)
    std = np.sqrt(np.bincount(of, weights=(q - mean[of]) ** 2, minlength=len(names)) / np.maximum(n - 1, 1))
    low, high = np.full(len(names), np.inf), np.full(len(names), -np.inf)
    np.minimum.at(low, of, q)
    np.maximum.at(high, of, q)
    flows = np.maximum(np.where((low == high)[:, None], low[:, None], mean[:, None] + std[:, None] * np.array(GUMBEL_K)), 0)[n >= LEAST_YEARS]
    names = names[n >= LEAST_YEARS]
    intervals = np.tile(np.array(INTERVALS, np.float32), len(names))
    return pa.table({"river": pa.array(np.repeat(names, len(INTERVALS))), "recurrence_interval": pa.array(intervals), "flow": pa.array(flows.ravel())})
