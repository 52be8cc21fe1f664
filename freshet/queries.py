"""Registered queries over the stand-in tables, each with the SQL that must give the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.functions import calendar, numerics
from freshet.operators import ensemble, frequency, interpolation, network, polygons, reductions, thresholds, weights
from freshet.plans import stand_ins as data
from freshet.session import scratch_folder
from freshet.sinks import blocks, manifest, stores, writers
from freshet.sources import array_store, axes, geometry, tables
from freshet.streaming import stateful, windows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = " ".join(sql.split())
        return f

    return add


def kb(x: str) -> str:
    """SQL of keepbits over a column."""
    e = f"greatest(floor(log2(abs({x}::FLOAT::DOUBLE))), -126)"
    return f"(CASE WHEN {x} IS NULL OR isnan({x}::DOUBLE) OR isinf({x}::DOUBLE) OR {x}::FLOAT = 0 THEN {x}::FLOAT ELSE (round_even({x}::FLOAT::DOUBLE * pow(2.0, 13 - {e}), 0) * pow(2.0, {e} - 13))::FLOAT END)"


day = lambda c: F.date_format(c, "yyyy-MM-dd").alias("day")
HOURLY = "hourly AS (SELECT user_id AS river, date_trunc('hour', ts) AS ts, avg(value::FLOAT::DOUBLE)::FLOAT AS q FROM events GROUP BY ALL)"
ROUNDED = f"{HOURLY}, rounded AS (SELECT river, ts, {kb('q')} AS q FROM hourly)"
DAYS = f"{ROUNDED}, totals AS (SELECT river, date_trunc('day', ts) AS d, sum(q::DOUBLE) AS total, count(q) AS hours, max(q) AS top FROM rounded GROUP BY ALL), means AS (SELECT *, total / hours AS m FROM totals), days AS (SELECT river, d, total, hours, top, {kb('m')} AS mean FROM means)"
MAXIMA = "maxima AS (SELECT l_suppkey AS river, year(l_shipdate) AS year, max(l_extendedprice)::FLOAT AS q FROM lineitem GROUP BY ALL)"
MOMENTS = "moments AS (SELECT river, count(q) AS n, avg(q::DOUBLE) AS mean, stddev_samp(q::DOUBLE) AS std, avg(ln(greatest(q::DOUBLE, 1e-4))) AS ln_mean, stddev_samp(ln(greatest(q::DOUBLE, 1e-4))) AS ln_std, min(q) AS low, max(q) AS high FROM maxima GROUP BY ALL)"
GUMBEL_ROWS = ", ".join(f"({t}, {k!r})" for t, k in zip(frequency.INTERVALS, frequency.GUMBEL_K))
NORMAL_ROWS = ", ".join(f"({t}, {z!r}::DOUBLE)" for t, z in zip(frequency.INTERVALS, frequency.NORMAL_Z))
CURVE = "curve AS (SELECT river, t::FLOAT AS recurrence_interval, greatest(CASE WHEN low = high THEN low::DOUBLE ELSE v END, 0) AS v FROM fitted WHERE n >= 3)"
STEP = "((year(l_shipdate) - 1995) * 12 + month(l_shipdate) - 1)::INT"
MEMBERS = f"members AS (SELECT l_suppkey AS river, l_linenumber AS member, {STEP} AS step, max(l_extendedprice)::FLOAT AS q FROM lineitem GROUP BY ALL)"
MEDIAN = f"median AS (SELECT river, step, {kb('m')} AS q FROM (SELECT river, step, quantile_cont(q::DOUBLE, 0.5) AS m FROM members GROUP BY ALL))"
FLOOD_MAXIMA = "maxima AS (SELECT l_suppkey AS river, year, max(q)::FLOAT AS q FROM (SELECT l_suppkey, year(l_shipdate) AS year, month(l_shipdate) AS month, avg(l_extendedprice) AS q FROM lineitem GROUP BY ALL) GROUP BY ALL)"
FLOOD = f"{FLOOD_MAXIMA}, {MOMENTS}, fitted AS (SELECT m.*, t, mean + k * std AS v FROM moments m, (VALUES {GUMBEL_ROWS}) g(t, k)), {CURVE}, curves AS (SELECT river, recurrence_interval, {kb('v')} AS flow FROM curve)"
SHARES = f"{FLOOD}, {MEMBERS}, shares AS (SELECT m.river, step, recurrence_interval, any_value(flow) AS flow, avg((q > flow)::INT::DOUBLE) AS share FROM members m JOIN curves c USING (river) GROUP BY ALL)"
SERIES = "series AS (SELECT vec_id AS river, label AS region, (unnest(range(len(embedding))))::INT AS step, (abs(unnest(embedding)::DOUBLE) * 1000)::FLOAT AS q FROM embeddings)"
RIVERS = "numbered AS (SELECT c_nationkey AS region, c_custkey AS river, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS rn, count(*) OVER (PARTITION BY c_nationkey) AS n FROM customer), rivers AS (SELECT a.region, a.river, coalesce(b.river, -1) AS next, (a.n - a.rn)::INT AS index, (1.0 + a.river % 5)::DOUBLE AS k, (0.1::DOUBLE * (a.river % 5)) AS x FROM numbered a LEFT JOIN numbered b ON a.region = b.region AND a.rn // 2 = b.rn)"
PIECES = "pieces AS (SELECT l_suppkey AS river, l_partkey AS cell, sum(l_quantity) AS area FROM lineitem GROUP BY ALL)"
THICKNESS = "(1 + (coalesce(q, 0) >= 1)::INT + (coalesce(q, 0) >= 10)::INT + (coalesce(q, 0) >= 100)::INT + (coalesce(q, 0) >= 1000)::INT + (coalesce(q, 0) >= 10000)::INT)"
STYLE = f"{FLOOD}, {MEMBERS}, {MEDIAN}, classed AS (SELECT river, step, any_value(m.q) AS q, count(*) FILTER (m.q >= c.flow) AS period_class FROM median m LEFT JOIN (SELECT * FROM curves WHERE recurrence_interval >= 2) c USING (river) GROUP BY ALL), styled AS (SELECT river, step, q, period_class::INT AS period_class, {THICKNESS}::INT AS thickness, (period_class * 8 + {THICKNESS} - 1)::INT AS style FROM classed)"
ACCUMULATED = "per_hour AS (SELECT user_id AS cell, floor((epoch(ts) - 1704067200) / 3600)::INT AS hours, sum(round(value * 100)::BIGINT)::BIGINT AS cents FROM events GROUP BY ALL), accumulated AS (SELECT cell, hours, ((sum(cents) OVER (PARTITION BY cell ORDER BY hours))::DOUBLE / 100)::FLOAT AS ro FROM per_hour)"


def _days(spark, sf_dir):
    return reductions.days(data.hourly(spark, sf_dir))


@query(f"WITH {DAYS} SELECT river, strftime(d, '%Y-%m-%d') AS day, mean, hours FROM days")
def daily_mean(spark, sf_dir):
    return _days(spark, sf_dir).select("river", day("day"), "mean", "hours")


@query(f"WITH {DAYS}, m AS (SELECT river, date_trunc('month', d) AS start, sum(total) / sum(hours) AS m, sum(hours)::BIGINT AS hours FROM days GROUP BY ALL) SELECT river, strftime(start, '%Y-%m-%d') AS day, {kb('m')} AS mean, hours FROM m")
def monthly_mean(spark, sf_dir):
    return reductions.period_means(_days(spark, sf_dir), "month").select("river", day("start"), "mean", "hours")


@query(f"WITH {DAYS}, m AS (SELECT river, date_trunc('year', d) AS start, sum(total) / sum(hours) AS m, sum(hours)::BIGINT AS hours FROM days GROUP BY ALL) SELECT river, strftime(start, '%Y-%m-%d') AS day, {kb('m')} AS mean, hours FROM m")
def yearly_mean(spark, sf_dir):
    return reductions.period_means(_days(spark, sf_dir), "year").select("river", day("start"), "mean", "hours")


@query(f"WITH {DAYS} SELECT river, year(d)::INT AS year, max(top) AS hourly FROM days GROUP BY ALL")
def annual_max_hourly(spark, sf_dir):
    return reductions.annual_maxima(_days(spark, sf_dir)).select("river", "year", "hourly")


@query(f"WITH {DAYS} SELECT river, year(d)::INT AS year, max(mean) AS daily FROM days WHERE hours > 0 GROUP BY ALL")
def annual_max_daily(spark, sf_dir):
    return reductions.annual_maxima(_days(spark, sf_dir)).select("river", "year", "daily")


@query(f"WITH {HOURLY} SELECT river, strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, count(DISTINCT hour(ts)) AS hours, 24 - count(DISTINCT hour(ts)) AS missing, min(hour(ts))::INT AS first_hour FROM hourly GROUP BY ALL")
def hour_calendar_gaps(spark, sf_dir):
    return reductions.calendar_gaps(data.hourly(spark, sf_dir)).select("river", day("day"), "hours", "missing", "first_hour")


TUMBLING = f"WITH {HOURLY}, w AS (SELECT river, time_bucket(INTERVAL 3 HOUR, ts, TIMESTAMP '2000-01-01') AS t, avg(q::DOUBLE) AS m, count(q) AS n FROM hourly GROUP BY ALL) SELECT river, strftime(t, '%Y-%m-%d %H:%M') AS start, {kb('m')} AS q, n FROM w"


@query(TUMBLING)
def tumbling_3h_mean(spark, sf_dir):
    return reductions.window_means(data.hourly(spark, sf_dir)).select("river", F.date_format("ts", "yyyy-MM-dd HH:mm").alias("start"), "q", "n")


@query(f"WITH {MAXIMA}, {MOMENTS}, fitted AS (SELECT m.*, t, mean + k * std AS v FROM moments m, (VALUES {GUMBEL_ROWS}) g(t, k)), {CURVE} SELECT river, recurrence_interval, {kb('v')} AS flow FROM curve")
def return_periods_gumbel(spark, sf_dir):
    return frequency.gumbel(frequency.moments(data.maxima(spark, sf_dir)))


@query(f"WITH {MAXIMA}, {MOMENTS}, fitted AS (SELECT m.*, t, exp(ln_mean + z * ln_std) AS v FROM moments m, (VALUES {NORMAL_ROWS}) g(t, z)), {CURVE} SELECT river, recurrence_interval, {kb('v')} AS flow FROM curve")
def return_periods_lognormal(spark, sf_dir):
    return frequency.lognormal(frequency.moments(data.maxima(spark, sf_dir)))


WEIBULL = "shapes AS (SELECT i, 0.1::DOUBLE * pow(2000.0::DOUBLE, i / 3999.0::DOUBLE) AS k FROM range(4000) r(i)), curve_of AS (SELECT i, k, sqrt(exp(lgamma(1 + 2 / k) - 2 * lgamma(1 + 1 / k)) - 1) AS cv FROM shapes), segments AS (SELECT cv AS hi, k AS k_hi, lead(cv) OVER (ORDER BY i) AS lo, lead(k) OVER (ORDER BY i) AS k_lo FROM curve_of), ends AS (SELECT max(cv) AS top, min(cv) AS bottom FROM curve_of), clamped AS (SELECT m.*, least(greatest(coalesce(std / nullif(mean, 0), 0), bottom), top) AS cv FROM moments m, ends), shaped AS (SELECT c.*, k_lo + (cv - lo) * (k_hi - k_lo) / (hi - lo) AS shape FROM clamped c JOIN segments s ON cv >= lo AND (cv < hi OR (cv = hi AND k_hi = 0.1))), fitted AS (SELECT s.*, t, mean / exp(lgamma(1 + 1 / shape)) * pow(ln(t::DOUBLE), 1 / shape) AS v FROM shaped s, (VALUES (1.5), (2.0), (5.0), (10.0), (25.0), (50.0), (100.0)) g(t))"


@query(f"WITH {MAXIMA}, {MOMENTS}, {WEIBULL}, {CURVE} SELECT river, recurrence_interval, {kb('v')} AS flow FROM curve")
def return_periods_weibull(spark, sf_dir):
    return frequency.weibull(frequency.moments(data.maxima(spark, sf_dir)))


# The quantile of Pearson III by bisection of a sum of Poisson terms.
LOG_MOMENTS = "logs AS (SELECT river, q, log10(greatest(q::DOUBLE, 1e-4)) AS x FROM maxima), lg AS (SELECT river, count(x) AS n, avg(x) AS m, stddev_samp(x) AS sd, min(q) AS low, max(q) AS high FROM logs GROUP BY ALL), skewed AS (SELECT lg.*, coalesce(s.skew, 0) AS g FROM lg LEFT JOIN (SELECT river, any_value(n) / ((any_value(n) - 1.0) * (any_value(n) - 2.0)) * sum(pow((x - m) / sd, 3)) AS skew FROM logs JOIN lg USING (river) WHERE n >= 3 AND sd > 0 GROUP BY river) s USING (river) WHERE n >= 3)"
BISECTION = f"asked AS (SELECT river, t, z, g, 4 / (g * g) AS a, CASE WHEN g > 0 THEN 1 - 1 / t ELSE 1 / t END AS p FROM skewed, (VALUES {NORMAL_ROWS}) v(t, z) WHERE abs(g) >= 0.01), halved(river, t, a, p, i, lo, hi) AS (SELECT river, t, a, p::DOUBLE, 0, 0::DOUBLE, a + 8 * sqrt(a) + 40 FROM asked UNION ALL SELECT river, t, a, p, i + 1, CASE WHEN below < p THEN mid ELSE lo END, CASE WHEN below < p THEN hi ELSE mid END FROM (SELECT *, list_sum(list_transform(range(0, (12 * sqrt(a + mid) + greatest(mid - a, 0) + 60)::BIGINT), lambda k: exp((a + k) * ln(mid) - mid - lgamma(a + k + 1)))) AS below FROM (SELECT *, (lo + hi) / 2 AS mid FROM halved WHERE i < 52))), factors AS (SELECT river, t, (lo + hi) / 2 AS x FROM halved WHERE i = 52)"
LP3 = f"{LOG_MOMENTS}, {BISECTION}, fitted AS (SELECT s.river, n, low, high, v.t, pow(10, m + sd * CASE WHEN abs(g) < 0.01 THEN v.z + (v.z * v.z - 1) * g / 6 + (pow(v.z, 3) - 7 * v.z) * g * g / 144 ELSE x * g / 2 - 2 / g END) AS v FROM skewed s CROSS JOIN (VALUES {NORMAL_ROWS}) v(t, z) LEFT JOIN factors f ON f.river = s.river AND f.t = v.t)"


@query(f"WITH RECURSIVE {MAXIMA}, {LP3}, {CURVE} SELECT river, recurrence_interval, {kb('v')} AS flow FROM curve")
def return_periods_logpearson3(spark, sf_dir):
    return frequency.log_pearson3(frequency.moments(data.maxima(spark, sf_dir)))


def _all_fits(key: str = "river") -> str:
    """SQL of all distributions over a table maxima."""
    fits = {"gumbel": f"SELECT m.*, t, mean + k * std AS v FROM moments m, (VALUES {GUMBEL_ROWS}) g(t, k)", "lognormal": f"SELECT m.*, t, exp(ln_mean + z * ln_std) AS v FROM moments m, (VALUES {NORMAL_ROWS}) g(t, z)"}
    named = lambda cte, d: cte.replace("fitted AS", f"{d} AS")
    union = " UNION ALL ".join(f"SELECT '{d}' AS distribution, river, n, low, high, t, v FROM {d}" for d in ("gumbel", "logpearson3", "lognormal", "weibull"))
    parts = [MOMENTS, *[f"{d} AS ({q})" for d, q in fits.items()], named(WEIBULL, "weibull"), named(LP3, "logpearson3"), f"fitted AS ({union})", CURVE.replace("SELECT river", "SELECT river, distribution")]
    return ", ".join(parts)


@query(f"WITH RECURSIVE {MAXIMA}, {_all_fits()} SELECT river, distribution, recurrence_interval, {kb('v')} AS flow FROM curve")
def return_periods_all(spark, sf_dir):
    return frequency.return_periods(data.maxima(spark, sf_dir))


@query(f"WITH RECURSIVE {FLOOD_MAXIMA.replace('maxima AS', 'monthly AS')}, maxima AS (SELECT 'hourly:' || l_suppkey AS river, year(l_shipdate) AS year, max(l_extendedprice)::FLOAT AS q FROM lineitem GROUP BY ALL UNION ALL SELECT 'daily:' || river, year, q FROM monthly), {_all_fits()} SELECT split_part(river, ':', 2)::BIGINT AS river, split_part(river, ':', 1) AS series, distribution, recurrence_interval, {kb('v')} AS flow FROM curve")
def return_periods_both_series(spark, sf_dir):
    """All fits of the hourly and of the daily maxima, from one pass."""
    return frequency.return_periods(frequency.both_series(data.annual(spark, sf_dir)), keys=("river", "series"))


@query(f"WITH {MAXIMA}, logs AS (SELECT river, log10(greatest(q::DOUBLE, 1e-4)) AS x FROM maxima), m AS (SELECT river, count(x) AS n, avg(x) AS mean, stddev_samp(x) AS std FROM logs GROUP BY ALL) SELECT river, any_value(n) AS n, round(any_value(mean), 9) AS lg_mean, round(any_value(std), 9) AS lg_std, round(any_value(n) / ((any_value(n) - 1.0) * (any_value(n) - 2.0)) * sum(pow((x - mean) / std, 3)), 7) AS skew FROM logs JOIN m USING (river) WHERE n >= 3 AND std > 0 GROUP BY river")
def log_moments(spark, sf_dir):
    m = frequency.moments(data.maxima(spark, sf_dir)).where("n >= 3 and lg_std > 0")
    return m.select("river", "n", F.round("lg_mean", 9).alias("lg_mean"), F.round("lg_std", 9).alias("lg_std"), F.round("skew", 7).alias("skew"))


@query(f"WITH {MAXIMA} SELECT river, max(q) AS max_simulated FROM maxima GROUP BY ALL")
def max_simulated(spark, sf_dir):
    return frequency.largest(data.maxima(spark, sf_dir))


@query("WITH maxima AS (SELECT o_custkey AS river, year(o_orderdate) AS year, max(o_totalprice)::FLOAT AS q FROM orders GROUP BY ALL) SELECT river, count(q) AS n, count(*) FILTER (q IS NULL) AS missing FROM maxima GROUP BY river HAVING count(q) < 3 OR count(*) FILTER (q IS NULL) > 0")
def short_records_refused(spark, sf_dir):
    return frequency.enough_years(data.short_maxima(spark, sf_dir))


@query(f"WITH {MEMBERS}, d AS (SELECT river, step, (p * 10)::INT AS percentile, quantile_cont(q::DOUBLE, 0.0) AS q0, list_extract(quantile_cont(q::DOUBLE, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]), (p + 1)::INT) AS m FROM members, range(11) r(p) GROUP BY river, step, p) SELECT river, step, percentile, {kb('m')} AS q FROM d")
def ensemble_deciles(spark, sf_dir):
    return ensemble.deciles(data.members(spark, sf_dir))


@query(f"WITH {MEMBERS}, m AS (SELECT river, step, avg(q::DOUBLE) AS m FROM members GROUP BY ALL) SELECT river, step, {kb('m')} AS q FROM m")
def ensemble_mean(spark, sf_dir):
    return ensemble.mean(data.members(spark, sf_dir))


def _median(spark, sf_dir):
    return ensemble.deciles(data.members(spark, sf_dir)).where("percentile = 50").drop("percentile")


@query(f"WITH {MEMBERS}, {MEDIAN}, ranked AS (SELECT *, row_number() OVER (PARTITION BY river ORDER BY q DESC, step) AS r FROM median) SELECT river, q AS peak, step AS peak_step, (CASE WHEN q > 0 THEN step ELSE 255 END)::INT AS time_to_peak FROM ranked WHERE r = 1")
def peak_and_time_to_peak(spark, sf_dir):
    return ensemble.peaks(_median(spark, sf_dir))


@query(f"WITH {SERIES}, ranked AS (SELECT *, row_number() OVER (PARTITION BY river ORDER BY q DESC, step) AS r FROM series) SELECT river, q AS peak, step AS peak_step, (CASE WHEN q > 0 THEN step ELSE 255 END)::INT AS time_to_peak FROM ranked WHERE r = 1")
def series_peaks(spark, sf_dir):
    return ensemble.peaks(tables.long_series(data.series(spark, sf_dir)))


@query(f"WITH {MEMBERS}, {MEDIAN}, low AS (SELECT l_suppkey AS river, quantile_cont(l_extendedprice, 0.05)::FLOAT AS q95 FROM lineitem GROUP BY ALL), lowest AS (SELECT river, min(q) AS lowest FROM median GROUP BY ALL) SELECT river, lowest, q95, (CASE WHEN lowest IS NULL OR q95 IS NULL THEN 255 ELSE (lowest < q95)::INT END)::INT AS below FROM lowest LEFT JOIN low USING (river)")
def below_low_flow(spark, sf_dir):
    low = data.table(spark, sf_dir, "lineitem", "l_suppkey", "l_extendedprice").groupBy(F.col("l_suppkey").alias("river")).agg(F.percentile("l_extendedprice", 0.05).cast("float").alias("q95"))
    return ensemble.below_low_flow(_median(spark, sf_dir), low)


@query(f"WITH {SERIES} SELECT river, step, q, {kb('q')} AS rounded FROM series")
def keepbits(spark, sf_dir):
    return tables.long_series(data.series(spark, sf_dir)).select("river", "step", "q", numerics.keepbits(F.col("q")).alias("rounded"))


@query(f"WITH flows AS (SELECT value::FLOAT AS q FROM events UNION ALL SELECT l_extendedprice::FLOAT FROM lineitem) SELECT {THICKNESS}::INT AS thickness, count(*) AS n, min(q) AS low, max(q) AS high FROM flows GROUP BY 1")
def thickness_class(spark, sf_dir):
    flows = data.table(spark, sf_dir, "events", "value").select(F.col("value").cast("float").alias("q")).unionByName(data.table(spark, sf_dir, "lineitem", "l_extendedprice").select(F.col("l_extendedprice").cast("float").alias("q")))
    return flows.groupBy(numerics.thickness_class(F.col("q")).alias("thickness")).agg(F.count("*").alias("n"), F.min("q").alias("low"), F.max("q").alias("high"))


def _curves(spark, sf_dir):
    return frequency.gumbel(frequency.moments(data.monthly_maxima(spark, sf_dir)))


def _styles(spark, sf_dir):
    return thresholds.style_codes(_median(spark, sf_dir), thresholds.threshold_arrays(_curves(spark, sf_dir)))


@query(f"WITH {STYLE} SELECT river, step, q, period_class FROM styled")
def return_period_class(spark, sf_dir):
    return _styles(spark, sf_dir).select("river", "step", "q", "period_class")


@query(f"WITH {STYLE} SELECT river, step, thickness, style FROM styled")
def style_byte(spark, sf_dir):
    return _styles(spark, sf_dir).select("river", "step", "thickness", "style")


@query(f"WITH {STYLE} SELECT river, step, style, (((style - coalesce(lag(style) OVER (PARTITION BY river ORDER BY step), 0)) % 256 + 256) % 256)::INT AS delta FROM styled")
def style_delta(spark, sf_dir):
    return thresholds.deltas(_styles(spark, sf_dir))


SETS = f"{STYLE}, low AS (SELECT l_suppkey AS river, quantile_cont(l_extendedprice, 0.05)::FLOAT AS q95 FROM lineitem GROUP BY ALL), best AS (SELECT * FROM styled QUALIFY row_number() OVER (PARTITION BY river ORDER BY q DESC, step) = 1), lowest AS (SELECT river, min(q) AS lowest FROM styled GROUP BY ALL), coded AS (SELECT river, 'timeseries' AS styleset, step, style AS code FROM styled UNION ALL SELECT river, 'max-flow', 0, style FROM best UNION ALL SELECT river, 'time-to-peak', 0, (CASE WHEN q > 0 THEN step ELSE 255 END)::INT FROM best UNION ALL SELECT river, 'below-q95', 0, (CASE WHEN lowest IS NULL OR q95 IS NULL THEN 255 ELSE (lowest < q95)::INT END)::INT FROM lowest LEFT JOIN low USING (river)), differenced AS (SELECT *, ((code - coalesce(lag(code) OVER (PARTITION BY river, styleset ORDER BY step), 0)) % 256 + 256) % 256 AS delta FROM coded)"


@query(f"WITH {SETS} SELECT river, styleset, string_agg(code::VARCHAR, ',' ORDER BY step) AS codes, string_agg(delta::INT::VARCHAR, ',' ORDER BY step) AS deltas FROM differenced GROUP BY ALL")
def map_stylesets(spark, sf_dir):
    """The four map stylesets as one product, packed by river."""
    low = data.table(spark, sf_dir, "lineitem", "l_suppkey", "l_extendedprice").groupBy(F.col("l_suppkey").alias("river")).agg(F.percentile("l_extendedprice", 0.05).cast("float").alias("q95"))
    sets = thresholds.stylesets(_median(spark, sf_dir), thresholds.threshold_arrays(_curves(spark, sf_dir)), low)
    joined = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
    return sets.select("river", "styleset", joined("codes"), joined("deltas"))


def _shares(spark, sf_dir):
    return thresholds.exceedance(data.members(spark, sf_dir), _curves(spark, sf_dir))


@query(f"WITH {SHARES} SELECT river, step, recurrence_interval, flow, round(share, 9) AS share FROM shares")
def exceedance_share(spark, sf_dir):
    return _shares(spark, sf_dir).withColumn("share", F.round("share", 9))


ALERTS = f"""{SHARES}, {MEDIAN}, by_level AS (SELECT river, recurrence_interval, any_value(flow) AS flow, max(share) AS share, min(step) FILTER (share >= 0.3) AS onset FROM shares GROUP BY river, recurrence_interval),
levels AS (SELECT * FROM by_level WHERE onset IS NOT NULL QUALIFY row_number() OVER (PARTITION BY river ORDER BY recurrence_interval DESC) = 1),
peaks AS (SELECT river, q AS peak, step AS peak_step FROM median QUALIFY row_number() OVER (PARTITION BY river ORDER BY q DESC, step) = 1),
meta AS (SELECT s_suppkey AS river, s_suppkey AS riverId, s_suppkey - 1 AS riverIndex, n_regionkey::DOUBLE AS lat, s_nationkey::DOUBLE AS lon FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey)
SELECT 'flood-2001010100-' || riverId AS identifier, '2001-01-01T00:00:00Z' AS sent, 'River flood' AS event, CASE WHEN onset * 3 <= 24 THEN 'Immediate' WHEN onset * 3 <= 72 THEN 'Expected' ELSE 'Future' END AS urgency,
CASE WHEN recurrence_interval <= 2 THEN 'Minor' WHEN recurrence_interval <= 10 THEN 'Moderate' WHEN recurrence_interval <= 50 THEN 'Severe' ELSE 'Extreme' END AS severity, CASE WHEN share >= 0.5 THEN 'Likely' ELSE 'Possible' END AS certainty,
strftime(TIMESTAMP '2001-01-01' + to_hours(onset * 3), '%Y-%m-%dT%H:%M:%SZ') AS onset, '2001-01-16T00:00:00Z' AS expires, riverId AS "riverId", riverIndex AS "riverIndex", lat, lon, recurrence_interval, flow AS return_period_flow, round(share, 9) AS exceedance_probability,
strftime(TIMESTAMP '2001-01-01' + to_hours(peak_step * 3), '%Y-%m-%dT%H:%M:%SZ') AS peak_time, peak AS peak_median_flow FROM levels JOIN peaks USING (river) LEFT JOIN meta USING (river)"""


@query(f"WITH {ALERTS}")
def alerts(spark, sf_dir):
    start = F.lit("2001-01-01").cast("timestamp")
    facts = thresholds.alert_facts(data.members(spark, sf_dir), _curves(spark, sf_dir))
    table = thresholds.alert_table(facts, None, data.metadata(spark, sf_dir), start, "flood")
    return table.withColumn("exceedance_probability", F.round("exceedance_probability", 9))


@query(f"WITH {ACCUMULATED}, kept AS (SELECT * FROM accumulated WHERE hours <> 0), hour_of AS (SELECT cell, unnest(range(min(hours), max(hours) + 1))::INT AS hour FROM kept GROUP BY cell), after AS (SELECT h.cell, h.hour, a.hours AS h1, a.ro AS q1 FROM hour_of h ASOF JOIN kept a ON h.cell = a.cell AND h.hour <= a.hours), both_sides AS (SELECT a.*, b.hours AS h0, b.ro AS q0 FROM after a ASOF LEFT JOIN kept b ON a.cell = b.cell AND a.hour > b.hours) SELECT cell, hour, (CASE WHEN h0 IS NULL THEN q1 ELSE ((q1 - q0) * ((hour - h0)::DOUBLE / (h1 - h0))::FLOAT + q0)::FLOAT END) AS ro FROM both_sides")
def accumulation_interpolation(spark, sf_dir):
    return interpolation.at_every_hour(data.accumulated(spark, sf_dir))


@query(f"WITH {ACCUMULATED} SELECT cell, hours, ro, (ro - coalesce(lag(ro) OVER (PARTITION BY cell ORDER BY hours), 0::FLOAT))::FLOAT AS step_ro FROM accumulated")
def deaccumulation(spark, sf_dir):
    return interpolation.increments(data.accumulated(spark, sf_dir)).withColumn("step_ro", F.col("step_ro").cast("float"))


@query(f"WITH {RIVERS} SELECT region, count(*) AS n_rivers, count(*) FILTER (next = -1) AS n_outlets, 0::BIGINT AS n_open, 0::BIGINT AS n_unordered, (max(index) - min(index) + 1 - count(DISTINCT index))::BIGINT AS n_gaps, (count(*) - count(DISTINCT river))::BIGINT AS n_repeated, count(*) FILTER (NOT (k > 0 AND x BETWEEN 0 AND 0.5)) AS n_invalid FROM rivers GROUP BY region")
def network_checks(spark, sf_dir):
    return network.network_checks(data.rivers(spark, sf_dir))


@query(f"WITH {RIVERS} SELECT a.region, a.river, a.next, a.index, b.index AS next_index FROM rivers a LEFT JOIN rivers b ON a.region = b.region AND a.next = b.river")
def downstream_position(spark, sf_dir):
    return network.downstream(data.rivers(spark, sf_dir))


@query(f"WITH {RIVERS}, sizes AS (SELECT region, count(*) AS n FROM rivers GROUP BY ALL), placed AS (SELECT region, n, coalesce(sum(n) OVER (ORDER BY region ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first FROM sizes) SELECT region, first, n, true AS covered FROM placed")
def region_coverage(spark, sf_dir):
    rivers = data.rivers(spark, sf_dir)
    sizes = rivers.groupBy("region").count()
    offsets = sizes.select("region", F.coalesce(F.sum("count").over(Window.orderBy("region").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    return network.region_spans(rivers.join(F.broadcast(offsets), "region").withColumn("index", F.col("index") + F.col("offset")))


@query("WITH present AS (SELECT DISTINCT o_custkey AS region, year(o_orderdate)::INT AS year FROM orders) SELECT r.region, y.year FROM (SELECT DISTINCT region FROM present) r, (SELECT DISTINCT year FROM present) y WHERE (r.region, y.year) NOT IN (SELECT (region, year) FROM present)")
def missing_region_years(spark, sf_dir):
    """Customers stand for regions: many have no order in some year."""
    o = data.table(spark, sf_dir, "orders", "o_custkey", "o_orderdate")
    return network.missing_region_years(o.select(F.col("o_custkey").alias("region"), F.year("o_orderdate").alias("year")).distinct())




@query(f"WITH {PIECES} SELECT river, cell, area, (area / sum(area) OVER (PARTITION BY river))::FLOAT AS proportion FROM pieces WHERE area > 0")
def weight_proportions(spark, sf_dir):
    return weights.proportions(data.pieces(spark, sf_dir))


@query(f"WITH {PIECES} SELECT river, cell, area, row_number() OVER (PARTITION BY river ORDER BY area DESC, cell)::INT AS place FROM pieces")
def weight_order(spark, sf_dir):
    return weights.ranked(data.pieces(spark, sf_dir))


@query(f"WITH {PIECES} SELECT river, sum(area) AS area, count(cell) AS n_pieces, min(area) AS least, max(area) AS most FROM pieces GROUP BY river")
def catchment_area(spark, sf_dir):
    return weights.areas(data.pieces(spark, sf_dir))


@query(f"WITH {PIECES} SELECT count(DISTINCT river) AS n_rivers, count(DISTINCT cell) AS n_cells, count(*) AS n_pairs, count(*) FILTER (area IS NULL OR isnan(area)) AS n_missing FROM pieces")
def cell_counts(spark, sf_dir):
    return weights.counts(data.pieces(spark, sf_dir))


@query(f"WITH {PIECES} SELECT river, round(sum(p_retailprice * area), 4) AS inflow, count(cell) AS pieces FROM pieces JOIN part ON cell = p_partkey GROUP BY river")
def lateral_inflow(spark, sf_dir):
    return weights.lateral_inflow(data.pieces(spark, sf_dir), data.runoff(spark, sf_dir)).withColumn("inflow", F.round("inflow", 4))


@query("WITH pieces AS (SELECT o_custkey AS river FROM orders) SELECT s_suppkey AS river, 'no weights' AS side FROM supplier WHERE s_suppkey NOT IN (SELECT river FROM pieces) UNION ALL SELECT DISTINCT river, 'no river' FROM pieces WHERE river NOT IN (SELECT s_suppkey FROM supplier)")
def unmatched_weights(spark, sf_dir):
    """Suppliers against customers with orders: either side has keys that the other lacks."""
    return weights.unmatched(data.table(spark, sf_dir, "supplier", "s_suppkey").select(F.col("s_suppkey").alias("river")), data.table(spark, sf_dir, "orders", "o_custkey").select(F.col("o_custkey").alias("river")))



@query("WITH boxes AS (SELECT o_orderkey AS id, (o_custkey % 100)::DOUBLE AS west, (o_orderkey % 97)::DOUBLE AS south, (o_custkey % 100) + 1.5 AS east, (o_orderkey % 97) + 0.5 AS north FROM orders), cells AS (SELECT p_partkey AS id, (p_partkey % 50) * 2.0 AS west, (p_partkey // 50) * 2.0 AS south, (p_partkey % 50) * 2.0 + 2 AS east, (p_partkey // 50) * 2.0 + 2 AS north FROM part) SELECT b.id AS box, c.id AS cell, ((least(b.east, c.east) - greatest(b.west, c.west)) * (least(b.north, c.north) - greatest(b.south, c.south)))::DOUBLE AS area FROM boxes b JOIN cells c ON b.east > c.west AND b.west < c.east AND b.north > c.south AND b.south < c.north")
def box_overlap(spark, sf_dir):
    o, p = data.table(spark, sf_dir, "orders", "o_orderkey", "o_custkey"), data.table(spark, sf_dir, "part", "p_partkey")
    w, s = (F.col("o_custkey") % 100).cast("double"), (F.col("o_orderkey") % 97).cast("double")
    boxes = o.select(F.col("o_orderkey").alias("id"), w.alias("west"), s.alias("south"), (w + 1.5).alias("east"), (s + 0.5).alias("north"))
    w, s = (F.col("p_partkey") % 50) * 2.0, F.floor(F.col("p_partkey") / 50) * 2.0
    cells = p.select(F.col("p_partkey").alias("id"), w.alias("west"), s.alias("south"), (w + 2).alias("east"), (s + 2).alias("north"))
    return weights.overlaps(boxes, cells, 4.0)


@query("WITH centers AS (SELECT p_brand AS axis, p_partkey AS i, (p_retailprice + p_partkey * 1000)::DOUBLE AS center FROM part), n AS (SELECT *, lag(center) OVER w AS a, lead(center) OVER w AS b FROM centers WINDOW w AS (PARTITION BY axis ORDER BY center)) SELECT axis, i, center, coalesce((a + center) / 2, center - (b - center) / 2, center) AS low, coalesce((center + b) / 2, center + (center - a) / 2, center) AS high FROM n")
def cell_edges(spark, sf_dir):
    p = data.table(spark, sf_dir, "part", "p_brand", "p_partkey", "p_retailprice")
    return weights.cell_edges(p.select(F.col("p_brand").alias("axis"), F.col("p_partkey").alias("i"), (F.col("p_retailprice") + F.col("p_partkey") * 1000).alias("center")))


@query("SELECT s_suppkey AS river, round(6378137.0 * radians(s_acctbal / 100), 3) AS x, round(6378137.0 * ln(tan(pi() / 4 + radians(s_nationkey) / 2)), 3) AS y, round((((s_acctbal / 10 + 180) % 360) + 360) % 360 - 180, 6) AS lon FROM supplier")
def projected(spark, sf_dir):
    s = data.table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey", "s_acctbal")
    return s.select(F.col("s_suppkey").alias("river"), F.round(numerics.mercator_x(F.col("s_acctbal") / 100), 3).alias("x"), F.round(numerics.mercator_y(F.col("s_nationkey").cast("double")), 3).alias("y"), F.round(numerics.wrap_longitude(F.col("s_acctbal") / 10), 6).alias("lon"))


@query("WITH names AS (SELECT CASE WHEN l_linenumber = 1 THEN 'cf_00_' ELSE 'pf_' || lpad((l_linenumber - 1)::VARCHAR, 2, '0') || '_' END || strftime(l_shipdate, '%Y%m%d') || '.grib' AS name FROM lineitem) SELECT max(regexp_extract(name, '_([0-9]{8})', 1)) AS newest FROM names")
def latest_initialization(spark, sf_dir):
    return tables.newest(_names(spark, sf_dir))


def _names(spark, sf_dir):
    t = data.table(spark, sf_dir, "lineitem", "l_linenumber", "l_shipdate")
    kind = F.when(F.col("l_linenumber") == 1, "cf_00_").otherwise(F.concat(F.lit("pf_"), F.lpad((F.col("l_linenumber") - 1).cast("string"), 2, "0"), F.lit("_")))
    return t.select(F.concat(kind, F.date_format("l_shipdate", "yyyyMMdd"), F.lit(".grib")).alias("name"))


@query("SELECT CASE WHEN l_linenumber = 1 THEN 'cf' ELSE 'pf' END AS kind, (l_linenumber - 1)::INT AS member, count(*) AS n, min(strftime(l_shipdate, '%Y%m%d')) AS oldest FROM lineitem GROUP BY ALL")
def file_names(spark, sf_dir):
    m = _names(spark, sf_dir).select(tables.member_name(F.col("name")).alias("m"))
    return m.groupBy("m.kind", calendar.member_number(F.col("m.kind"), F.col("m.number")).alias("member")).agg(F.count("*").alias("n"), F.min("m.stamp").alias("oldest"))


@query("SELECT DISTINCT o_custkey AS river, year(o_orderdate)::INT AS year FROM orders WHERE 'discharge_era5_' || year(o_orderdate) || '01_' || year(o_orderdate) || '12.zarr' LIKE 'discharge_era5_%'")
def discharge_files(spark, sf_dir):
    o = data.table(spark, sf_dir, "orders", "o_custkey", "o_orderdate")
    y = F.date_format("o_orderdate", "yyyy")
    named = o.select(F.col("o_custkey").alias("river"), tables.discharge_name(F.concat(F.lit("discharge_era5_"), y, F.lit("01_"), y, F.lit("12.zarr"))).alias("f"))
    return named.where("f.year is not null").select("river", F.col("f.year").alias("year")).distinct()


@query(f"WITH {SERIES} SELECT step, count(*) AS n_rivers, round(sum(q::DOUBLE), 2) AS total FROM series GROUP BY step")
def layout_by_step(spark, sf_dir):
    return tables.long_series(data.series(spark, sf_dir)).groupBy("step").agg(F.count("*").alias("n_rivers"), F.round(F.sum(F.col("q").cast("double")), 2).alias("total"))


@query(f"WITH {SERIES} SELECT river, region, step, q FROM series")
def packed_to_long(spark, sf_dir):
    return tables.long_series(data.series(spark, sf_dir), ("river", "region"))


@query(f"WITH {MEMBERS} SELECT river, member, string_agg(step::VARCHAR || ':' || round(q)::BIGINT::VARCHAR, ',' ORDER BY step) AS packed, count(*) AS n FROM members GROUP BY ALL")
def long_to_packed(spark, sf_dir):
    m = data.members(spark, sf_dir).select("river", "member", "step", F.concat_ws(":", F.col("step").cast("string"), F.round(F.col("q")).cast("long").cast("string")).alias("q"))
    return tables.packed_series(m, ("river", "member")).select("river", "member", F.array_join("q", ",").alias("packed"), F.size("q").cast("long").alias("n"))


@query(f"WITH {MEMBERS}, every AS (SELECT river, member::INT AS member FROM (SELECT DISTINCT river FROM members), range(1, 9) r(member)) SELECT river, member, count(DISTINCT step) AS n FROM every LEFT JOIN members USING (river, member) GROUP BY ALL HAVING count(DISTINCT step) <> 84")
def incomplete_members(spark, sf_dir):
    """Of eight wanted members of 84 steps, those that lack some; the eighth is missing everywhere."""
    return tables.incomplete(data.members(spark, sf_dir), range(1, 9), data.MEMBER_STEPS, ("river",))


@query("SELECT strftime(d, '%Y-%m-%d') AS day, day(last_day(d))::INT AS days, count(*) AS n FROM (SELECT date_trunc('month', o_orderdate)::DATE AS d FROM orders) GROUP BY ALL")
def month_lengths(spark, sf_dir):
    o = data.table(spark, sf_dir, "orders", "o_orderdate").select(F.trunc("o_orderdate", "month").alias("d"))
    return o.groupBy(day("d"), calendar.days_in_month(F.col("d")).alias("days")).agg(F.count("*").alias("n"))


@query("SELECT user_id AS river, json_extract_string(props, '$.k')::INT AS k, count(*) AS n FROM events GROUP BY ALL")
def json_properties(spark, sf_dir):
    e = data.table(spark, sf_dir, "events", "user_id", "props")
    return e.groupBy(F.col("user_id").alias("river"), F.from_json("props", "k int")["k"].alias("k")).agg(F.count("*").alias("n"))


@query("WITH a AS (SELECT DISTINCT l_partkey AS region FROM lineitem), b AS (SELECT DISTINCT o_custkey AS region FROM orders) SELECT region, 'first' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT region, 'second' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)")
def region_differences(spark, sf_dir):
    """Parts that are sold against customers that order."""
    a = data.table(spark, sf_dir, "lineitem", "l_partkey").withColumnRenamed("l_partkey", "region")
    return network.one_sided(a, data.table(spark, sf_dir, "orders", "o_custkey").withColumnRenamed("o_custkey", "region"), "region")


@query(f"SELECT l_suppkey AS river, min(strftime(TIMESTAMP '2001-01-01' + to_hours(3 * {STEP}), '%Y-%m-%d %H:%M')) AS first_time, max(strftime(TIMESTAMP '2001-01-01' + to_hours(3 * {STEP}), '%Y-%m-%d %H:%M')) AS last_time, max(3 * {STEP})::INT AS lead_hours FROM lineitem GROUP BY ALL")
def forecast_times(spark, sf_dir):
    at = F.date_format(calendar.forecast_time(F.lit("2001-01-01").cast("timestamp"), F.col("step")), "yyyy-MM-dd HH:mm")
    return data.members(spark, sf_dir).groupBy("river").agg(F.min(at).alias("first_time"), F.max(at).alias("last_time"), F.max(F.col("step") * calendar.STEP_HOURS).alias("lead_hours"))


@query("SELECT user_id AS river, count(DISTINCT floor((epoch(ts) - 1704067200) / 3600)) AS n, min(strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M')) AS first_time, max(strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M')) AS last_time FROM events GROUP BY ALL")
def decoded_times(spark, sf_dir):
    steps = data.accumulated(spark, sf_dir).select(F.col("cell").alias("river"), "hours")
    at = F.date_format(calendar.decode_hours(F.col("hours"), "2024-01-01"), "yyyy-MM-dd HH:mm")
    return steps.groupBy("river").agg(F.countDistinct("hours").alias("n"), F.min(at).alias("first_time"), F.max(at).alias("last_time"))


@query("SELECT strftime(d, '%Y-%m-%d') AS day, strftime(date_trunc('month', d - 4) - INTERVAL 1 MONTH, '%Y-%m-%d') AS last_full, count(*) AS n FROM (SELECT o_orderdate::DATE AS d FROM orders) GROUP BY ALL")
def last_full_month(spark, sf_dir):
    o = data.table(spark, sf_dir, "orders", "o_orderdate").select(F.to_date("o_orderdate").alias("d"))
    return o.groupBy(day("d"), F.date_format(calendar.last_full_month(F.col("d")), "yyyy-MM-dd").alias("last_full")).agg(F.count("*").alias("n"))


@query(f"WITH {RIVERS}, sizes AS (SELECT region, count(*) AS n FROM rivers GROUP BY ALL), placed AS (SELECT region, coalesce(sum(n) OVER (ORDER BY region ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first FROM sizes) SELECT river, region, first + index AS river_index, CASE WHEN next = -1 THEN -1 ELSE next END AS next FROM rivers JOIN placed USING (region)")
def global_layout(spark, sf_dir):
    return network.layout(data.rivers(spark, sf_dir))


@query("SELECT s_suppkey AS river, round(6378137.0::DOUBLE * 6378137.0 / 2 * radians(1.0) * (1 - 0.00669437999014) * ((sin(radians(s_nationkey + 1)) / (1 - 0.00669437999014 * pow(sin(radians(s_nationkey + 1)), 2)) - ln((1 - sqrt(0.00669437999014::DOUBLE) * sin(radians(s_nationkey + 1))) / (1 + sqrt(0.00669437999014::DOUBLE) * sin(radians(s_nationkey + 1)))) / (2 * sqrt(0.00669437999014::DOUBLE))) - (sin(radians(s_nationkey)) / (1 - 0.00669437999014 * pow(sin(radians(s_nationkey)), 2)) - ln((1 - sqrt(0.00669437999014::DOUBLE) * sin(radians(s_nationkey))) / (1 + sqrt(0.00669437999014::DOUBLE) * sin(radians(s_nationkey)))) / (2 * sqrt(0.00669437999014::DOUBLE)))) / 1e6, 3) AS area_km2 FROM supplier")
def box_areas(spark, sf_dir):
    s = data.table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    south = F.col("s_nationkey").cast("double")
    return s.select(F.col("s_suppkey").alias("river"), F.round(numerics.box_area(F.lit(0.0), south, F.lit(1.0), south + 1) / 1e6, 3).alias("area_km2"))


@query("SELECT year(l_shipdate)::INT AS year, count(DISTINCT l_suppkey) AS n, strftime(date_trunc('hour', min(l_shipdate)), '%Y-%m-%d %H:%M') AS first, date_trunc('hour', min(l_shipdate)) <> make_timestamp(year(l_shipdate), 1, 1, 0, 0, 0.0) AS late, (date_trunc('hour', min(l_shipdate)) = make_timestamp(year(l_shipdate), 1, 1, 0, 0, 0.0) OR year(l_shipdate) = (SELECT min(year(l_shipdate)) FROM lineitem)) AS allowed FROM lineitem GROUP BY year(l_shipdate)")
def year_starts(spark, sf_dir):
    """Only the first year of a record may start late."""
    return network.record_starts(data.table(spark, sf_dir, "lineitem", "l_suppkey", "l_shipdate"), "l_suppkey", "l_shipdate").withColumn("first", F.date_format("first", "yyyy-MM-dd HH:mm"))


STREAMED = TUMBLING.split("), w AS")[0] + "), w AS (SELECT user_id AS river, time_bucket(INTERVAL 3 HOUR, ts, TIMESTAMP '2000-01-01') AS t, avg(value::FLOAT::DOUBLE) AS m, count(value) AS n FROM events GROUP BY ALL) SELECT river, strftime(t, '%Y-%m-%d %H:%M') AS start, " + kb("m") + " AS q, n FROM w WHERE t + INTERVAL 3 HOUR <= (SELECT max(ts) - INTERVAL 6 HOUR FROM events)"


@query(STREAMED)
def streamed_3h_mean(spark, sf_dir):
    """The windows that a watermark of six hours has closed, from a stream of the events."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    stream = spark.readStream.schema(events.schema).parquet(f"{sf_dir}/events.parque[t]")  # a stream reads folders or patterns
    named = stream.select(F.col("user_id").alias("river"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").cast("float").alias("q"))
    root = f"{scratch_folder(spark)}/stream-{uuid.uuid4().hex}"
    windows.run_available(windows.windowed_means(named), f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out").select("river", F.date_format("ts", "yyyy-MM-dd HH:mm").alias("start"), "q", "n")


ALL_REDUCED = f"""{DAYS}, held AS (SELECT *, date_trunc('month', d) AS month, date_trunc('year', d) AS year FROM days WHERE hours > 0), means_of AS (SELECT river, 'daily' AS reduction, d AS start, total / hours AS m, hours FROM held UNION ALL SELECT river, 'monthly', month, sum(total) / sum(hours), sum(hours) FROM held GROUP BY river, month UNION ALL SELECT river, 'yearly', year, sum(total) / sum(hours), sum(hours) FROM held GROUP BY river, year)
SELECT river, reduction, strftime(start, '%Y-%m-%d') AS day, {kb('m')} AS value, hours::BIGINT AS hours FROM means_of UNION ALL SELECT river, 'max_hourly', strftime(year, '%Y-%m-%d'), max(top), NULL FROM held GROUP BY river, year UNION ALL SELECT river, 'max_daily', strftime(year, '%Y-%m-%d'), max(mean), NULL FROM held GROUP BY river, year"""


@query(f"WITH {ALL_REDUCED}")
def all_reductions(spark, sf_dir):
    """The five reductions of an hourly series from one day stage."""
    return reductions.all_reductions(data.hourly(spark, sf_dir)).select("river", "reduction", day("start"), "value", "hours")


def _half_plane(name: str, before: str, axis: str, bound: str, sign: str) -> str:
    other = "y" if axis == "x" else "x"
    p, q = "p[i]", "p[i % len(p) + 1]"
    across = f"{p}.{other} + ({bound} - {p}.{axis}) / ({q}.{axis} - {p}.{axis}) * ({q}.{other} - {p}.{other})"
    point = f"{{'x': {bound}, 'y': {across}}}" if axis == "x" else f"{{'x': {across}, 'y': {bound}}}"
    a, b = f"{sign}({p}.{axis} - {bound}) >= 0", f"{sign}({q}.{axis} - {bound}) >= 0"
    return f"{name} AS (SELECT * EXCLUDE (p), flatten(list_transform(range(1, len(p) + 1), lambda i: CASE WHEN {a} AND {b} THEN [{p}] WHEN {a} THEN [{p}, {point}] WHEN {b} THEN [{point}] ELSE [] END)) AS p FROM {before})"


_S, _E2 = "tanh(p[i].y / 6378137.0)", "0.00669437999014::DOUBLE"
_Y = "(6378137.0 / 2 * (1 - {e}) * ({s} / (1 - {e} * {s} * {s}) - ln((1 - sqrt({e}) * {s}) / (1 + sqrt({e}) * {s})) / (2 * sqrt({e}))))".format(s=_S, e=_E2)
CATCHMENTS = "placed AS (SELECT c_custkey AS river, (c_custkey % 97 + 0.3) * 100000::DOUBLE AS cx, (c_custkey // 97 % 37 + 0.7) * 100000::DOUBLE AS cy, (c_custkey % 7) / 10.0::DOUBLE AS r FROM customer), rings AS (SELECT river, false AS hole, [{'x': cx, 'y': cy}, {'x': cx + 300000, 'y': cy}, {'x': cx + 300000, 'y': cy + 200000}, {'x': cx + 150000, 'y': cy + (0.5 + r) * 100000}, {'x': cx, 'y': cy + 200000}] AS p FROM placed UNION ALL SELECT river, true, [{'x': cx + 25000, 'y': cy + 10000}, {'x': cx + 75000, 'y': cy + 10000}, {'x': cx + 50000, 'y': cy + 40000}] FROM placed)"
CELLS = "cells AS (SELECT p_partkey AS cell, (p_partkey % 50) * 200000::DOUBLE AS w, (p_partkey // 50) * 200000::DOUBLE AS s, (p_partkey % 50) * 200000::DOUBLE + 200000 AS e, (p_partkey // 50) * 200000::DOUBLE + 200000 AS n FROM part)"
CUT = f"""{CATCHMENTS}, {CELLS}, met AS (SELECT river, cell, hole, w, s, e, n, p FROM rings JOIN cells ON list_max([c.x for c in p]) > w AND list_min([c.x for c in p]) < e AND list_max([c.y for c in p]) > s AND list_min([c.y for c in p]) < n),
{_half_plane('c1', 'met', 'x', 'w', '')}, {_half_plane('c2', 'c1', 'x', 'e', '-')}, {_half_plane('c3', 'c2', 'y', 's', '')}, {_half_plane('c4', 'c3', 'y', 'n', '-')},
projected AS (SELECT river, cell, hole, list_transform(range(1, len(p) + 1), lambda i: {{'x': p[i].x, 'y': {_Y}}}) AS p FROM c4 WHERE len(p) > 2), ringed AS (SELECT river, cell, hole, abs(list_sum(list_transform(range(1, len(p) + 1), lambda i: p[i].x * p[i % len(p) + 1].y - p[i % len(p) + 1].x * p[i].y))) / 2 AS area FROM projected),
cut_pieces AS (SELECT river, cell, sum(CASE WHEN hole THEN -area ELSE area END) AS area FROM ringed GROUP BY ALL HAVING sum(CASE WHEN hole THEN -area ELSE area END) > 0)"""


def _catchments(spark, sf_dir):
    """A concave catchment with a hole for each customer, on a grid of cells from parts."""
    c = data.table(spark, sf_dir, "customer", "c_custkey")
    x = (F.col("c_custkey") % 97 + 0.3) * 100000.0
    y = (F.floor(F.col("c_custkey") / 97) % 37 + 0.7) * 100000.0
    r = (F.col("c_custkey") % 7) / 10.0
    ring = lambda hole, *ps: F.struct(F.lit(hole).alias("hole"), F.array(*[F.struct((x + a).alias("x"), (y + b).alias("y")) for a, b in ps]).alias("points"))
    outer = ring(False, (F.lit(0.0), F.lit(0.0)), (F.lit(300000.0), F.lit(0.0)), (F.lit(300000.0), F.lit(200000.0)), (F.lit(150000.0), (r + 0.5) * 100000.0), (F.lit(0.0), F.lit(200000.0)))
    return c.select(F.col("c_custkey").alias("river"), F.array(outer, ring(True, (F.lit(25000.0), F.lit(10000.0)), (F.lit(75000.0), F.lit(10000.0)), (F.lit(50000.0), F.lit(40000.0)))).alias("rings"))


def _cells(spark, sf_dir):
    w, s = (F.col("p_partkey") % 50) * 200000.0, F.floor(F.col("p_partkey") / 50) * 200000.0
    return data.table(spark, sf_dir, "part", "p_partkey").select(F.col("p_partkey").alias("cell"), w.alias("west"), s.alias("south"), (w + 200000.0).alias("east"), (s + 200000.0).alias("north"))


@query(f"WITH {CUT} SELECT river, cell, round(area / 1e6, 3) AS area_km2 FROM cut_pieces WHERE round(area / 1e6, 3) > 0")
def polygon_weights(spark, sf_dir):
    """Areas on the ellipsoid of catchments cut by grid cells."""
    found = polygons.pieces(_catchments(spark, sf_dir), _cells(spark, sf_dir), 200000.0)
    return found.select("river", "cell", F.round(F.col("area") / 1e6, 3).alias("area_km2")).where("area_km2 > 0")


@query(f"WITH {CUT} SELECT river, cell, (round(area / 1e6, 3) / sum(round(area / 1e6, 3)) OVER (PARTITION BY river))::FLOAT AS proportion, row_number() OVER (PARTITION BY river ORDER BY round(area / 1e6, 3) DESC, cell)::INT AS place FROM cut_pieces WHERE round(area / 1e6, 3) > 0")
def polygon_proportions(spark, sf_dir):
    """The weight table of polygons: shares of a river's cells, largest first."""
    found = polygon_weights(spark, sf_dir).withColumnRenamed("area_km2", "area")
    return weights.ranked_proportions(found).drop("area")


@query(f"WITH {CATCHMENTS}, {CELLS}, b AS (SELECT river, list_min([c.x for c in p]) AS w, list_min([c.y for c in p]) AS s, list_max([c.x for c in p]) AS e, list_max([c.y for c in p]) AS n FROM rings WHERE NOT hole), g AS (SELECT min(w) AS w, min(s) AS s, max(e) AS e, max(n) AS n FROM cells) SELECT s_suppkey AS river, 'no river' AS fault FROM supplier WHERE false UNION ALL SELECT river, 'no river' FROM b WHERE river NOT IN (SELECT s_suppkey FROM supplier) UNION ALL SELECT river, 'outside' FROM b, g WHERE b.w < g.w OR b.s < g.s OR b.e > g.e OR b.n > g.n")
def catchment_faults(spark, sf_dir):
    """Catchments of customers against the rivers of suppliers and the grid of parts."""
    rivers = data.table(spark, sf_dir, "supplier", "s_suppkey").withColumnRenamed("s_suppkey", "river")
    return polygons.catchment_faults(_catchments(spark, sf_dir), rivers, _cells(spark, sf_dir))


@query("WITH s AS (SELECT o_orderkey AS id, (o_orderkey * 37) % 20000 AS a, (o_orderkey * 37) % 20000 + o_custkey % 90 AS b FROM orders), t AS (SELECT p_partkey AS id, p_partkey * 10 AS a, p_partkey * 10 + p_size AS b FROM part) SELECT s.id AS segment, t.id AS block, greatest(s.a, t.a)::BIGINT AS first, least(s.b, t.b)::BIGINT AS \"end\" FROM s JOIN t ON s.a < t.b AND s.b > t.a AND s.a < s.b AND t.a < t.b")
def segment_overlap(spark, sf_dir):
    """Segments of a record against the blocks that hold it."""
    o, p = data.table(spark, sf_dir, "orders", "o_orderkey", "o_custkey"), data.table(spark, sf_dir, "part", "p_partkey", "p_size")
    a = (F.col("o_orderkey") * 37) % 20000
    segments = o.select(F.col("o_orderkey").alias("id"), a.alias("first"), (a + F.col("o_custkey") % 90).alias("end"))
    blocks = p.select(F.col("p_partkey").alias("id"), (F.col("p_partkey") * 10).alias("first"), (F.col("p_partkey") * 10 + F.col("p_size")).cast("long").alias("end"))
    return weights.interval_overlaps(segments, blocks, 64)


@query("SELECT p_brand AS axis, (p_size * 7.5)::DOUBLE AS center, count(*) AS n FROM part GROUP BY ALL HAVING count(*) > 1")
def repeated_coordinates(spark, sf_dir):
    return weights.repeated_coordinates(data.table(spark, sf_dir, "part", "p_brand", "p_size").select(F.col("p_brand").alias("axis"), (F.col("p_size") * 7.5).alias("center")))


@query("SELECT p_brand AS axis, p_partkey AS i, round((p_partkey * 7.5 + 180) % 360 - 180, 6)::DOUBLE AS shifted, (row_number() OVER (PARTITION BY p_brand ORDER BY (p_partkey * 7.5 + 180) % 360 - 180, p_partkey) - 1)::INT AS place FROM part")
def ordered_axis(spark, sf_dir):
    p = data.table(spark, sf_dir, "part", "p_brand", "p_partkey").select(F.col("p_brand").alias("axis"), F.col("p_partkey").alias("i"), (F.col("p_partkey") * 7.5).alias("center"))
    return weights.ordered_axis(p).withColumn("shifted", F.round("shifted", 6))


@query("SELECT l_orderkey AS region, l_linenumber AS place, l_partkey AS part, l_returnflag AS key FROM lineitem QUALIFY lag(l_returnflag) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_returnflag) IS DISTINCT FROM l_returnflag")
def run_starts(spark, sf_dir):
    """Where the flag changes along the lines of an order."""
    t = data.table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag").toDF("region", "place", "part", "key")
    return weights.run_starts(t, "region", ("place", "part", "key"), "key")


@query("SELECT o_custkey AS region, count(DISTINCT year(o_orderdate))::INT AS n, string_agg(DISTINCT year(o_orderdate)::VARCHAR, ',' ORDER BY year(o_orderdate)::VARCHAR) AS years FROM orders GROUP BY ALL HAVING count(DISTINCT year(o_orderdate)) > 1")
def uneven_years(spark, sf_dir):
    o = data.table(spark, sf_dir, "orders", "o_custkey", "o_orderdate").select(F.col("o_custkey").alias("region"), F.year("o_orderdate").cast("string").alias("year"))
    return network.uneven(o, "region", "year").select("region", "n", F.array_join("values", ",").alias("years"))


@query("WITH years AS (SELECT DISTINCT o_custkey AS region, year(o_orderdate)::INT AS year FROM orders), states AS (SELECT DISTINCT o_custkey AS region, year(o_orderdate)::INT AS year FROM orders WHERE o_orderstatus = 'F'), every AS (SELECT y.*, s.region IS NOT NULL AS finished, lead(y.year) OVER (PARTITION BY y.region ORDER BY y.year) - y.year AS gap FROM years y LEFT JOIN states s USING (region, year)), r AS (SELECT region, min(year) AS first, least(min(year) FILTER (NOT finished), min(year + 1) FILTER (gap > 1), max(year) + 1) AS resume FROM every GROUP BY region) SELECT region, (resume - first)::INT AS done, resume::INT AS resume FROM r")
def resume_years(spark, sf_dir):
    """Customers' years with orders; a finished order stands for the saved state of a year."""
    o = data.table(spark, sf_dir, "orders", "o_custkey", "o_orderdate", "o_orderstatus").select(F.col("o_custkey").alias("region"), F.year("o_orderdate").alias("year"), "o_orderstatus")
    return network.resume_after(o, o.where("o_orderstatus = 'F'"))


@query("SELECT o_orderkey AS id, strftime(TIMESTAMP '1940-01-01' + to_days(o_orderkey % 30000), '%Y-%m-%d %H:%M:%S') AS by_day, strftime(TIMESTAMP '1990-06-01 06:00:00' + to_minutes(o_orderkey), '%Y-%m-%d %H:%M:%S') AS by_minute, strftime(TIMESTAMP '1970-01-01' + to_seconds(o_custkey), '%Y-%m-%d %H:%M:%S') AS by_second, o_orderdate = date_trunc('day', o_orderdate) AS midnight FROM orders")
def decoded_units(spark, sf_dir):
    o = data.table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    at = lambda c, units: F.date_format(calendar.decode_times(c, units), "yyyy-MM-dd HH:mm:ss")
    return o.select(
        F.col("o_orderkey").alias("id"), at(F.col("o_orderkey") % 30000, "days since 1940-01-01").alias("by_day"), at(F.col("o_orderkey"), "minutes since 1990-06-01 06:00").alias("by_minute"),
        at(F.col("o_custkey"), "seconds since 1970-01-01").alias("by_second"), calendar.is_midnight(F.col("o_orderdate").cast("timestamp")).alias("midnight"),
    )


@query(f"WITH {MAXIMA}, {MOMENTS}, fitted AS (SELECT m.*, t, mean + k * std AS v FROM moments m, (VALUES {GUMBEL_ROWS}) g(t, k)), {CURVE}, c AS (SELECT river, recurrence_interval, {kb('v')} AS flow FROM curve), l AS (SELECT *, lag(flow) OVER (PARTITION BY river ORDER BY recurrence_interval) AS before FROM c) SELECT river, count(flow) AS n_intervals, count(*) FILTER (flow < before) AS n_falls FROM l GROUP BY ALL")
def falling_curves(spark, sf_dir):
    """Whether the flows of a curve ascend with their intervals."""
    return frequency.falls(return_periods_gumbel(spark, sf_dir))


@query(f"WITH {HOURLY}, y AS (SELECT river, year(ts)::INT AS year, count(DISTINCT ts) AS hours, min(ts) AS first FROM hourly GROUP BY ALL) SELECT river, year, hours, strftime(first, '%Y-%m-%d %H:%M') AS first, date_diff('hour', first, make_timestamp(year + 1, 1, 1, 0, 0, 0.0)) - hours AS missing, date_diff('hour', first, make_timestamp(year + 1, 1, 1, 0, 0, 0.0)) = hours AS whole FROM y")
def whole_years(spark, sf_dir):
    """Whether a river's year has every hour from its first."""
    return reductions.whole_years(data.hourly(spark, sf_dir)).withColumn("first", F.date_format("first", "yyyy-MM-dd HH:mm"))


@query("SELECT DISTINCT n_name AS region FROM customer JOIN nation ON c_nationkey = n_nationkey")
def region_list(spark, sf_dir):
    """Regions that a table has rows of."""
    named = data.table(spark, sf_dir, "customer", "c_nationkey").join(F.broadcast(data.table(spark, sf_dir, "nation", "n_nationkey", "n_name")), F.col("c_nationkey") == F.col("n_nationkey"))
    return tables.regions(named.withColumnRenamed("n_name", "region"))


@query("WITH s AS (SELECT l_suppkey AS cell, l_orderkey % 400 - 20 AS hours FROM lineitem), d AS (SELECT cell, hours FROM s WHERE hours <> 0), m AS (SELECT *, lag(hours) OVER (PARTITION BY cell ORDER BY hours) AS before FROM d) SELECT cell, hours, before FROM m WHERE hours <= 0 OR hours <= before")
def broken_steps(spark, sf_dir):
    """Accumulations at hours that are not positive or that repeat."""
    t = data.table(spark, sf_dir, "lineitem", "l_suppkey", "l_orderkey")
    return interpolation.whole_hours(t.select(F.col("l_suppkey").alias("cell"), (F.col("l_orderkey") % 400 - 20).alias("hours")))


@query(f"WITH {SERIES} SELECT river, step, (1995 + step // 12)::INT AS year, q, {kb('q')} AS rounded FROM series")
def array_store_series(spark, sf_dir):
    """Series written as chunked arrays with their coordinates (months of years since 1995) and read back."""
    array_store.register(spark)
    path = f"{scratch_folder(spark)}/array-store-{uuid.uuid4().hex}"
    packed = data.series(spark, sf_dir)
    n, steps = packed.agg(F.count("river"), F.max(F.size("q"))).first()
    places = network.places(packed.select("river"), "river")
    rows = tables.long_series(packed).join(places, "river").select(F.col("place").alias("river"), F.col("step").alias("time"), F.col("q").alias("value"))
    shape, chunks = (n, steps or 0), (256, 24)
    array_store.write_array(rows, path, "q", ("river", "time"), shape, chunks, attributes={"units": "m3 s-1"})
    array_store.write_array(rows.withColumn("value", numerics.keepbits(F.col("value"))), path, "rounded", ("river", "time"), shape, chunks)
    array_store.write_array(places.select(F.col("place").alias("river"), F.col("river").alias("value")), path, "river", ("river",), shape[:1], (4096,), "int64")
    start = F.lit("1995-01-01").cast("date")
    months = spark.range(steps or 0).select(F.col("id").alias("time"), F.datediff(F.add_months(start, F.col("id").cast("int")), start).alias("value"))
    array_store.write_array(months, path, "time", ("time",), shape[1:], (4096,), "int32", attributes={"units": "days since 1995-01-01"})
    read = array_store.read_arrays(spark, path, "q", "rounded")
    step = F.months_between(F.date_add(start, F.col("time")), start).cast("int")
    return read.select("river", step.alias("step"), "year", "q", "rounded")


def _saver(spark):
    folder = f"{scratch_folder(spark)}/rounds-{uuid.uuid4().hex}"

    def save(df, name):
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    return save


@query(f"WITH RECURSIVE {RIVERS}, down(river, pos) AS (SELECT river, river FROM rivers UNION ALL SELECT d.river, r.next FROM down d JOIN rivers r ON d.pos = r.river WHERE r.next <> -1) SELECT pos AS river, count(*) AS n_upstream, sum(round(c_acctbal * 100)::BIGINT)::BIGINT AS cents FROM down JOIN customer ON c_custkey = down.river GROUP BY ALL")
def upstream_area(spark, sf_dir):
    """What lies upstream of every customer in its nation's network: how many, and the sum of their balances."""
    cents = data.table(spark, sf_dir, "customer", "c_custkey", "c_acctbal").select(F.col("c_custkey").alias("river"), F.round(F.col("c_acctbal") * 100).cast("long").alias("cents"))
    sums, _, _ = network.upstream_sums(data.rivers(spark, sf_dir).select("river", "next").join(cents, "river"), _saver(spark), ("cents",))
    return sums.select("river", "n_upstream", "cents")


@query("WITH RECURSIVE edges AS (SELECT l_partkey AS river, max(l_suppkey * 20 + l_linenumber) AS next FROM lineitem GROUP BY ALL), walk(start, pos, n) AS (SELECT river, next, 1 FROM edges UNION SELECT start, e.next, n + 1 FROM walk JOIN edges e ON walk.pos = e.river WHERE pos <> start AND n < 500), found AS (SELECT start FROM walk WHERE pos = start), reach(river, pos) AS (SELECT start, start FROM found UNION SELECT reach.river, e.next FROM reach JOIN edges e ON pos = e.river) SELECT river, min(pos) AS cycle FROM reach GROUP BY ALL")
def network_cycles(spark, sf_dir):
    """Cycles in a network whose rivers are parts; each drains into a part that its largest supplier and line name."""
    t = data.table(spark, sf_dir, "lineitem", "l_partkey", "l_suppkey", "l_linenumber")
    edges = t.groupBy(F.col("l_partkey").alias("river")).agg(F.max(F.col("l_suppkey") * 20 + F.col("l_linenumber")).alias("next"))
    return network.cycles(edges, _saver(spark))


@query(f"WITH {ACCUMULATED}, steps AS (SELECT cell, hours, ro, ro::DOUBLE - coalesce(lag(ro::DOUBLE) OVER (PARTITION BY cell ORDER BY hours), 0) AS step_ro, row_number() OVER (PARTITION BY cell ORDER BY hours) AS n FROM accumulated) SELECT cell, hours, round(step_ro, 6) AS step_ro, round(ro::DOUBLE, 6) AS total, n FROM steps")
def streamed_increments(spark, sf_dir):
    """Increments and running totals of accumulations from a stream in micro-batches, with a restart between each two."""
    stateful.with_state_store(spark)
    root = f"{scratch_folder(spark)}/flow-{uuid.uuid4().hex}"
    rows = data.accumulated(spark, sf_dir)
    edges = rows.approxQuantile("hours", [0.25, 0.5, 0.75], 0.01)
    quarter = sum((F.when(F.col("hours") > e, 1).otherwise(0) for e in edges), F.lit(0))
    rows.withColumn("quarter", quarter).repartition("quarter").write.partitionBy("quarter").parquet(f"{root}/in")
    sink = stateful.Resumable(f"{root}/out")
    for k in range(4):  # each query goes on from the checkpoint of the one before
        source = spark.readStream.schema(rows.schema).parquet(f"{root}/in/quarter=[0-{k}]")
        stateful.resume(stateful.flowing_increments(source), sink, f"{root}/checkpoint")
    steps = sink.read(spark).where("what = 'step'")
    return steps.select("cell", F.col("hours").cast("int").alias("hours"), F.round("step_ro", 6).alias("step_ro"), F.round("total", 6).alias("total"), "n")


def _fresh(spark, name):
    return f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query(f"WITH {CUT} SELECT river, count(*) AS n_cells, round(sum(round(area / 1e6, 3)), 3) AS area_km2 FROM cut_pieces WHERE round(area / 1e6, 3) > 0 GROUP BY river")
def decoded_catchments(spark, sf_dir):
    """Catchments written as well-known binary, decoded in bounded batches and cut by the grid."""
    path = _fresh(spark, "catchments")
    geometry.with_binary(_catchments(spark, sf_dir)).write.parquet(path)
    rings = geometry.with_rings(spark.read.parquet(path), "geometry")
    cut = polygons.pieces(rings, _cells(spark, sf_dir), 200000.0).select("river", F.round(F.col("area") / 1e6, 3).alias("area")).where("area > 0")
    return cut.groupBy("river").agg(F.count("area").alias("n_cells"), F.round(F.sum("area"), 3).alias("area_km2"))


@query("WITH a AS (SELECT o_custkey AS store, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS place, year(o_orderdate) AS value FROM orders), lists AS (SELECT store, count(*) AS n, string_agg(value::VARCHAR, ',' ORDER BY place) AS l FROM a GROUP BY store) SELECT store, n, min(store) OVER (PARTITION BY l) AS \"like\" FROM lists")
def equal_axes(spark, sf_dir):
    """Customers whose orders have the same years in the same order, by the fingerprint of that axis."""
    o = data.table(spark, sf_dir, "orders", "o_custkey", "o_orderkey", "o_orderdate")
    place = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).alias("place")
    return axes.alike(o.select(F.col("o_custkey").alias("store"), place, F.year("o_orderdate").alias("value")), "store", "place", "value")


@query("SELECT * FROM (SELECT o_custkey AS store, o_orderkey AS place, year(o_orderdate)::INT AS value, lag(year(o_orderdate)::INT) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS before FROM orders) WHERE value <= before")
def axis_descents(spark, sf_dir):
    """Where the years of a customer's orders do not ascend."""
    o = data.table(spark, sf_dir, "orders", "o_custkey", "o_orderkey", "o_orderdate")
    return axes.descents(o.select(F.col("o_custkey").alias("store"), F.col("o_orderkey").alias("place"), F.year("o_orderdate").alias("value")), "store", "place", "value")


@query("SELECT l_returnflag AS flag, year(l_shipdate)::INT AS year, count(*) AS n_rows, 0::BIGINT AS n_faults FROM lineitem GROUP BY ALL")
def manifest_rows(spark, sf_dir):
    """Lines written by flag and year with a manifest, its rows by partition, and the faults that a check finds."""
    path = _fresh(spark, "lines")
    t = data.table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate").withColumn("year", F.year("l_shipdate"))
    manifest.write(t.withColumnRenamed("l_returnflag", "flag").repartition("flag", "year"), path, "flag", "year")
    part = lambda name: F.regexp_extract("file", f"{name}=([^/]*)", 1)
    known = manifest.load(spark, path).join(manifest.faults(spark, path).select("file", F.lit(1).alias("bad")), "file", "left")
    return known.groupBy(part("flag").alias("flag"), part("year").cast("int").alias("year")).agg(F.sum("rows").alias("n_rows"), F.count("bad").alias("n_faults"))


@query(f"WITH {MAXIMA}, {MOMENTS}, fitted AS (SELECT m.*, t, mean + k * std AS v FROM moments m, (VALUES {GUMBEL_ROWS}) g(t, k)), {CURVE} SELECT river, recurrence_interval, {kb('v')} AS flow FROM curve")
def block_return_periods(spark, sf_dir):
    """The Gumbel fit as a function of blocks of rivers, each block committed by itself."""
    path = _fresh(spark, "blocks")
    blocks.run_blocks(data.maxima(spark, sf_dir), path, frequency.gumbel_of_block, 64, "river")
    return blocks.read_blocks(spark, path).withColumn("flow", numerics.keepbits(F.col("flow")))


@query(f"WITH {HOURLY} SELECT river, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'history' ELSE 'tail' END AS era, count(*) AS n, max(q) AS top FROM hourly GROUP BY ALL")
def record_parts(spark, sf_dir):
    """A record whose tail is swapped: first with half of its rivers, then whole."""
    path, hours = _fresh(spark, "record"), data.hourly(spark, sf_dir)
    writers.write_record(hours.where("ts < '2024-01-16' or hash(river) > 0"), path, split="2024-01-16")
    writers.write_record(hours, path, split="2024-01-16")
    return writers.read_record(spark, path).groupBy("river", "era").agg(F.count("ts").alias("n"), F.max("q").alias("top"))


@query(f"WITH {MEMBERS}, d AS (SELECT river, step, (p * 10)::INT AS percentile, list_extract(quantile_cont(q::DOUBLE, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]), (p + 1)::INT) AS m FROM members, range(11) r(p) GROUP BY river, step, p), means AS (SELECT river, step, avg(q::DOUBLE) AS mean FROM members GROUP BY ALL) SELECT river, percentile, step, {kb('m')} AS q, {kb('mean')} AS mean FROM d JOIN means USING (river, step)")
def forecast_store(spark, sf_dir):
    """An ensemble in the forecast store, its percentiles and mean read back."""
    path = _fresh(spark, "forecast")
    stores.write_forecast_store(_saver(spark)(data.members(spark, sf_dir), "members"), path, "months since 1995-01-01")
    mean = array_store.read_arrays(spark, path, "mean").where("mean is not null")
    return array_store.read_arrays(spark, path, "percentiles").where("percentiles is not null").join(mean, ["river", "step"]).select("river", "percentile", "step", F.col("percentiles").alias("q"), "mean")


@query(f"WITH {MAXIMA}, {MOMENTS}, fitted AS (SELECT m.*, t, mean + k * std AS v FROM moments m, (VALUES {GUMBEL_ROWS}) g(t, k)), {CURVE}, top AS (SELECT river, max(q) AS max_simulated_hourly FROM maxima GROUP BY river) SELECT river, recurrence_interval, {kb('v')} AS gumbel_hourly, max_simulated_hourly FROM curve JOIN top USING (river)")
def return_period_store(spark, sf_dir):
    """All fits of both series and the largest maxima in the return-period store, two of its arrays read back."""
    path = _fresh(spark, "return-periods")
    stores.write_return_period_store(_saver(spark)(data.annual(spark, sf_dir), "annual"), path)
    top = array_store.read_arrays(spark, path, "max_simulated_hourly")
    return array_store.read_arrays(spark, path, "gumbel_hourly").join(top, "river").select("river", "recurrence_interval", "gumbel_hourly", "max_simulated_hourly")


@query("WITH b AS (SELECT o_custkey AS store, date_trunc('month', min(o_orderdate)) AS f, date_trunc('month', max(o_orderdate)) AS l FROM orders GROUP BY 1), every AS (SELECT store, unnest(generate_series(f::TIMESTAMP, l::TIMESTAMP, INTERVAL 1 MONTH)) AS m FROM b), have AS (SELECT DISTINCT o_custkey AS store, date_trunc('month', o_orderdate)::TIMESTAMP AS m FROM orders) SELECT store, strftime(m, '%Y-%m') AS month FROM every ANTI JOIN have USING (store, m)")
def months_to_fetch(spark, sf_dir):
    """Months without an order between a customer's first and last."""
    o = data.table(spark, sf_dir, "orders", "o_custkey", "o_orderdate").withColumnRenamed("o_custkey", "store")
    return calendar.month_plan(o, "store", "o_orderdate").select("store", F.date_format("month", "yyyy-MM").alias("month"))
