"""Map codes and flood alerts from forecasts and return-period flows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions.calendar import STAMP, STEP_HOURS, STEPS, forecast_time
from freshet.functions.numerics import NO_DATA, STYLE_PERIODS, keepbits, period_class, style_byte, thickness_class
from freshet.operators.frequency import INTERVALS
from freshet.sinks.writers import STYLESETS

# Fixed values.
ALERT_SHARE, LIKELY_SHARE = 0.3, 0.5
SEVERITY = {1.5: "Minor", 2.0: "Minor", 5.0: "Moderate", 10.0: "Moderate", 25.0: "Severe", 50.0: "Severe", 100.0: "Extreme"}
URGENCY = ((24, "Immediate"), (72, "Expected"))
ALERT_COLUMNS = ("identifier", "sent", "event", "urgency", "severity", "certainty", "onset", "expires", "riverId", "riverIndex", "lat", "lon", "recurrence_interval", "return_period_flow", "exceedance_probability", "peak_time", "peak_median_flow")


def threshold_arrays(curves: DataFrame, periods=STYLE_PERIODS) -> DataFrame:
    """(river, recurrence_interval, flow) to (river, thresholds array<float>), the wanted intervals ascending."""
    kept = curves.where(F.col("recurrence_interval").isin(*periods))
    packed = F.array_sort(F.collect_list(F.struct("recurrence_interval", "flow")))
    return kept.groupBy("river").agg(F.transform(packed, lambda x: x["flow"]).alias("thresholds"))


def style_codes(series: DataFrame, thresholds: DataFrame) -> DataFrame:
    """(river, step, q) with its class and byte; a river without thresholds has class 0."""
    joined = series.join(thresholds, "river", "left")
    level = F.coalesce(period_class(F.col("q"), F.col("thresholds")), F.lit(0))
    thickness = thickness_class(F.col("q"))
    return joined.select("river", "step", "q", level.alias("period_class"), thickness.alias("thickness"), style_byte(level, thickness).alias("style"))


def deltas(codes: DataFrame) -> DataFrame:
    """Differences along a river's steps, modulo 256; the first is kept."""
    before = F.lag("style").over(Window.partitionBy("river").orderBy("step"))
    return codes.select("river", "step", "style", F.pmod(F.col("style") - F.coalesce(before, F.lit(0)), F.lit(256)).alias("delta"))


def exceedance(members: DataFrame, curves: DataFrame, intervals=INTERVALS) -> DataFrame:
    """(river, step, recurrence_interval, flow, share): the share of members strictly above each flow.

    Thresholds come as one array a river and every share is one conditional average, so no member row is
    multiplied before the shuffle; only the results are expanded, one for each of ``intervals`` that a river has.
    """
    packed = F.map_from_entries(F.collect_list(F.struct("recurrence_interval", "flow"))).alias("levels")
    joined = members.join(curves.groupBy("river").agg(packed), "river")
    level = lambda t: F.try_element_at("levels", F.lit(t).cast("float"))
    shares = [F.avg(F.coalesce(F.col("q") > level(t), F.lit(False)).cast("double")).alias(f"share{i}") for i, t in enumerate(intervals)]
    flows = [F.first(level(t)).alias(f"flow{i}") for i, t in enumerate(intervals)]
    found = joined.groupBy("river", "step").agg(*shares, *flows)
    each = [F.struct(F.lit(t).cast("float").alias("recurrence_interval"), F.col(f"flow{i}").alias("flow"), F.col(f"share{i}").alias("share")) for i, t in enumerate(intervals)]
    return found.select("river", "step", F.explode(F.array(*each)).alias("x")).select("river", "step", "x.*").where("flow is not null")


def alert_levels(shares: DataFrame) -> DataFrame:
    """Of each alerting river: the largest interval that enough members exceed at some step, its flow, the
    largest share at that interval, and the first step with enough."""
    likely = F.col("share") >= ALERT_SHARE
    by_level = shares.groupBy("river", "recurrence_interval").agg(F.first("flow").alias("flow"), F.max("share").alias("share"), F.min(F.when(likely, F.col("step"))).alias("onset"))
    reached = by_level.where("onset is not null")
    best = F.max_by(F.struct("recurrence_interval", "flow", "share", "onset"), "recurrence_interval")
    return reached.groupBy("river").agg(best.alias("a")).select("river", "a.*")


def alert_facts(members: DataFrame, curves: DataFrame, intervals=INTERVALS) -> DataFrame:
    """(river, recurrence_interval, flow, share, onset, peak, peak_step): what ``alert_levels`` and the peak of the members'
    median say, from one aggregate over the members by river and step and one over that by river."""
    packed = F.map_from_entries(F.collect_list(F.struct("recurrence_interval", "flow"))).alias("levels")
    joined = members.join(curves.groupBy("river").agg(packed), "river")
    level = lambda t: F.try_element_at("levels", F.lit(t).cast("float"))
    shares = [F.avg(F.coalesce(F.col("q") > level(t), F.lit(False)).cast("double")).alias(f"share{i}") for i, t in enumerate(intervals)]
    flows = [F.first(level(t)).alias(f"flow{i}") for i, t in enumerate(intervals)]
    median = keepbits(F.percentile(F.col("q").cast("double"), F.lit(0.5))).alias("median")
    steps = joined.groupBy("river", "step").agg(*shares, *flows, median)
    by_level = [x for i in range(len(intervals)) for x in (F.first(f"flow{i}").alias(f"flow{i}"), F.max(f"share{i}").alias(f"share{i}"), F.min(F.when(F.col(f"share{i}") >= ALERT_SHARE, F.col("step"))).alias(f"onset{i}"))]
    first = F.max_by("step", F.when(F.col("median").isNotNull(), F.struct(F.col("median"), -F.col("step")))).alias("peak_step")
    rivers = steps.groupBy("river").agg(*by_level, F.max("median").alias("peak"), first)
    each = F.array(*[F.struct(F.lit(t).cast("float").alias("recurrence_interval"), F.col(f"flow{i}").alias("flow"), F.col(f"share{i}").alias("share"), F.col(f"onset{i}").alias("onset")) for i, t in enumerate(intervals)])
    reached = F.filter(each, lambda x: x["onset"].isNotNull() & x["flow"].isNotNull())
    return rivers.select("river", F.try_element_at(reached, F.lit(-1)).alias("a"), "peak", "peak_step").where("a is not null").select("river", "a.*", "peak", "peak_step")


def _severity(interval: Column) -> Column:
    pairs = [x for k, v in SEVERITY.items() for x in (F.lit(k).cast("float"), F.lit(v))]
    return F.coalesce(F.create_map(*pairs)[interval], F.raise_error(F.concat(F.lit("no severity for interval "), interval.cast("string"))).cast("string"))


def alert_table(levels: DataFrame, peaks: DataFrame | None, metadata: DataFrame, start: Column, prefix: str) -> DataFrame:
    """``peaks``: river, peak, peak_step of the median, none if ``levels`` has them (``alert_facts``); ``metadata``: river,
    riverId, riverIndex, lat, lon."""
    joined = (levels if peaks is None else levels.join(peaks, "river")).join(metadata, "river", "left")
    hours = F.col("onset") * STEP_HOURS
    urgency = F.when(hours <= URGENCY[0][0], URGENCY[0][1]).when(hours <= URGENCY[1][0], URGENCY[1][1]).otherwise("Future")
    stamp = lambda t: F.date_format(t, STAMP)
    return joined.select(
        F.concat(F.lit(f"{prefix}-"), F.date_format(start, "yyyyMMddHH"), F.lit("-"), F.col("riverId").cast("string")).alias("identifier"),
        stamp(start).alias("sent"), F.lit("River flood").alias("event"), urgency.alias("urgency"), _severity(F.col("recurrence_interval")).alias("severity"),
        F.when(F.col("share") >= LIKELY_SHARE, "Likely").otherwise("Possible").alias("certainty"),
        stamp(forecast_time(start, F.col("onset"))).alias("onset"), stamp(forecast_time(start, F.lit(STEPS))).alias("expires"), "riverId", "riverIndex", "lat", "lon",
        "recurrence_interval", F.col("flow").alias("return_period_flow"), F.col("share").alias("exceedance_probability"),
        stamp(forecast_time(start, F.col("peak_step"))).alias("peak_time"), F.col("peak").alias("peak_median_flow"),
    )


def stylesets(median: DataFrame, thresholds: DataFrame, low: DataFrame, names=STYLESETS) -> DataFrame:
    """The map codes of all stylesets, packed: (river, styleset, codes array<int>, deltas array<int>).

    ``median`` is (river, step, q), ``thresholds`` from ``threshold_arrays``, ``low`` (river, q95). A river's series
    is gathered once; codes of the series and of its peak, the step of the peak and the low-flow mark all come
    from that row. Unknown names are refused.
    """
    if unknown := sorted(set(names) - set(STYLESETS)):
        raise ValueError(f"no such styleset: {', '.join(unknown)}")
    packed = median.groupBy("river").agg(F.array_sort(F.collect_list(F.struct("step", "q"))).alias("s")).select("river", F.transform("s", lambda x: x["q"]).alias("q"), F.transform("s", lambda x: x["step"]).alias("steps"))
    joined = packed.join(thresholds, "river", "left").join(low, "river", "left")

    def code(q: Column) -> Column:
        return style_byte(F.coalesce(period_class(q, F.col("thresholds")), F.lit(0)), thickness_class(q))

    peak = F.array_max("q")
    place = F.element_at("steps", F.array_position("q", peak).cast("int"))
    lowest = F.array_min("q")
    codes = {
        "timeseries": F.transform("q", code),
        "max-flow": F.array(code(peak)),
        "time-to-peak": F.array(F.when((peak > 0) & (peak < float("inf")), place).otherwise(NO_DATA)),
        "below-q95": F.array(F.when(lowest.isNull() | F.col("q95").isNull(), NO_DATA).otherwise((lowest < F.col("q95")).cast("int"))),
    }
    rows = joined.select("river", F.explode(F.array(*[F.struct(F.lit(x).alias("styleset"), codes[x].alias("codes")) for x in names])).alias("x")).select("river", "x.styleset", "x.codes")
    before = F.concat(F.array(F.lit(0)), F.slice("codes", 1, F.size("codes") - 1))
    return rows.withColumn("deltas", F.zip_with("codes", before, lambda a, b: F.pmod(a - b, F.lit(256))))
