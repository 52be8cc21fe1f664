"""Hourly series to daily, monthly and yearly means and to annual maxima.

The day is the common stage: it keeps the sum and the number of its hours, from which longer means follow
(not from rounded daily means), and its rounded mean, from which the daily maximum follows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.functions.numerics import keepbits


def days(hourly: DataFrame) -> DataFrame:
    """(river, ts, q float) to (river, day, total, hours, mean, top); q is rounded before all else."""
    rounded = hourly.where("q is not null").select("river", "ts", keepbits(F.col("q")).alias("q"))
    grouped = rounded.groupBy("river", F.to_date("ts").alias("day")).agg(F.sum(F.col("q").cast("double")).alias("total"), F.count("q").alias("hours"), F.max("q").alias("top"))
    return grouped.withColumn("mean", keepbits(F.try_divide("total", F.col("hours").cast("double"))))


def period_means(by_day: DataFrame, unit: str) -> DataFrame:
    """Means over months or years: all hours count alike."""
    grouped = by_day.groupBy("river", F.trunc("day", unit).alias("start")).agg(F.sum("total").alias("total"), F.sum("hours").alias("hours"))
    return grouped.select("river", "start", keepbits(F.try_divide("total", F.col("hours").cast("double"))).alias("mean"), "hours")


def annual_maxima(by_day: DataFrame) -> DataFrame:
    """(river, year, hourly, daily): the largest rounded hour, and the largest rounded daily mean."""
    held = by_day.where("hours > 0")
    return held.groupBy("river", F.year("day").alias("year")).agg(F.max("top").alias("hourly"), F.max("mean").alias("daily"))


def calendar_gaps(hourly: DataFrame) -> DataFrame:
    """Hours that a river-day lacks: (river, day, hours, missing, first_hour)."""
    per_day = hourly.where("q is not null").groupBy("river", F.to_date("ts").alias("day")).agg(F.countDistinct(F.hour("ts")).alias("hours"), F.min(F.hour("ts")).alias("first_hour"))
    return per_day.select("river", "day", "hours", (24 - F.col("hours")).alias("missing"), "first_hour")


def whole_years(hourly: DataFrame) -> DataFrame:
    """(river, year, hours, first, missing, whole): a year is whole if it has every hour from its first to its end."""
    per_year = hourly.where("q is not null").groupBy("river", F.year("ts").alias("year")).agg(F.countDistinct(F.date_trunc("hour", "ts")).alias("hours"), F.min(F.date_trunc("hour", "ts")).alias("first"))
    end = F.make_timestamp(F.col("year") + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    missing = ((F.unix_timestamp(end) - F.unix_timestamp("first")) / 3600).cast("long") - F.col("hours")
    return per_year.select("river", "year", "hours", "first", missing.alias("missing"), (missing == 0).alias("whole"))


def window_means(hourly: DataFrame, hours: int = 3) -> DataFrame:
    """Left-labelled means over windows of ``hours``."""
    window = F.window("ts", f"{hours} hours")
    grouped = hourly.where("q is not null").groupBy("river", window.alias("w")).agg(F.avg(F.col("q").cast("double")).alias("q"), F.count("q").alias("n"))
    return grouped.select("river", F.col("w.start").alias("ts"), keepbits(F.col("q")).alias("q"), "n")


def all_reductions(hourly: DataFrame) -> DataFrame:
    """(river, reduction, start, value, hours): daily, monthly and yearly means and both annual maxima at once.

    The days are made once; months, years and the days themselves are grouping sets over them. ``hours`` is
    what a mean is made of, and null for a maximum.
    """
    d = days(hourly).where("hours > 0").withColumns({"month": F.trunc("day", "month"), "year": F.trunc("day", "year")})
    sets = [[F.col("river"), F.col(x)] for x in ("day", "month", "year")]
    found = d.groupingSets(sets, F.col("river"), F.col("day"), F.col("month"), F.col("year")).agg(F.sum("total").alias("total"), F.sum("hours").alias("hours"), F.max("top").alias("top"), F.max("mean").alias("mean"))
    value = keepbits(F.try_divide("total", F.col("hours").cast("double")))
    none = F.lit(None).cast("long")
    row = lambda name, v, h: F.struct(F.lit(name).alias("reduction"), v.alias("value"), h.alias("hours"))
    kinds = F.when(F.col("day").isNotNull(), F.array(row("daily", value, F.col("hours")))).when(F.col("month").isNotNull(), F.array(row("monthly", value, F.col("hours"))))
    kinds = kinds.otherwise(F.array(row("yearly", value, F.col("hours")), row("max_hourly", F.col("top"), none), row("max_daily", F.col("mean"), none)))
    return found.select("river", F.coalesce("day", "month", "year").alias("start"), F.explode(kinds).alias("x")).select("river", "x.reduction", "start", "x.value", "x.hours")
