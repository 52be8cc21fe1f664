"""Time axes: record and forecast labels, months, file stamps."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STEP_HOURS, STEPS = 3, 120
STAMP = "yyyy-MM-dd'T'HH:mm:ss'Z'"
UNITS = {"hour": "interval 1 hour", "day": "interval 1 day", "month": "interval 1 month", "year": "interval 1 year"}


def record_times(spark: SparkSession, first_year: int, last_year: int, unit: str) -> DataFrame:
    """(unit, ts): period starts from the first of ``first_year`` to before the year after ``last_year``."""
    bounds = spark.range(1).select(F.lit(f"{first_year}-01-01").cast("timestamp").alias("a"), F.lit(f"{last_year + 1}-01-01").cast("timestamp").alias("b"))
    every = F.explode(F.sequence("a", "b", F.expr(UNITS[unit])))
    return bounds.select(F.lit(unit).alias("unit"), every.alias("ts"), "b").where("ts < b").drop("b")


def forecast_time(start: Column, step: Column, hours: int = STEP_HOURS) -> Column:
    return F.timestamp_add("HOUR", step * hours, start)


def days_in_month(day: Column) -> Column:
    return F.dayofmonth(F.last_day(day))


def decode_hours(hours: Column, since: str) -> Column:
    """Times stored as whole hours since a date."""
    return F.timestamp_add("HOUR", hours, F.lit(since).cast("timestamp"))


# Seconds of the units of stored times.
UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def decode_times(offset: Column, units: str) -> Column:
    """Times stored as ``'<unit> since <date or time>'``; fractions of a unit count to the microsecond."""
    found = re.fullmatch(r"(second|minute|hour|day)s? since (\d{4}-\d{2}-\d{2}(?:[ T]\d{2}:\d{2}(?::\d{2})?)?)(?:Z| UTC)?", units.strip())
    if not found:
        raise ValueError(f"not a unit of time: {units}")
    micros = F.round(offset.cast("double") * (UNIT_SECONDS[found[1]] * 1_000_000)).cast("long")
    return F.timestamp_micros(F.unix_micros(F.lit(found[2]).cast("timestamp")) + micros)


def is_midnight(ts: Column) -> Column:
    """Whether a run starts at 00 UTC, the only ones that are published in full."""
    return ts == F.date_trunc("day", ts)


def last_full_month(today: Column, lag_days: int = 5) -> Column:
    """First day of the last month that a source ``lag_days`` behind has in full."""
    return F.add_months(F.trunc(F.date_sub(today, lag_days - 1), "month"), -1)


def member_number(kind: Column, number: Column) -> Column:
    """Control forecast: 0. Perturbed forecast: 1 to 50. Anything else is an error."""
    ok = F.when((kind == "cf") & (number == 0), F.lit(0)).when((kind == "pf") & number.between(1, 50), number)
    return F.coalesce(ok, F.raise_error(F.concat(F.lit("no such member: "), kind, F.lit(" "), number.cast("string"))).cast("int")).cast("int")


def month_plan(rows: DataFrame, by: str, ts: str) -> DataFrame:
    """(by, month): the months, from the first to the last that a group has, of which it has no rows: what is to be fetched
    month by month. Months are made from two dates a group, and met by an anti-join of distinct months."""
    month = F.trunc(ts, "month").alias("month")
    have = rows.select(by, month).where("month is not null").distinct()
    span = have.groupBy(by).agg(F.min("month").alias("first"), F.max("month").alias("last"))
    every = span.select(by, F.explode(F.sequence("first", "last", F.expr("interval 1 month"))).alias("month"))
    return every.join(have, [by, "month"], "left_anti")
