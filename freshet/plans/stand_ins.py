"""River relations derived from the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.sources.tables import scan


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return scan(spark, f"{sf_dir}/{name}.parquet", *columns)


def hourly(spark, sf_dir) -> DataFrame:
    """Hourly discharge: a river's events of an hour, averaged."""
    e = table(spark, sf_dir, "events", "user_id", "ts", "value")
    return e.groupBy(F.col("user_id").alias("river"), F.date_trunc("hour", "ts").alias("ts")).agg(F.avg(F.col("value").cast("float").cast("double")).cast("float").alias("q"))


def maxima(spark, sf_dir) -> DataFrame:
    """Annual maxima: seven years of each supplier."""
    t = table(spark, sf_dir, "lineitem", "l_suppkey", "l_shipdate", "l_extendedprice")
    return t.groupBy(F.col("l_suppkey").alias("river"), F.year("l_shipdate").alias("year")).agg(F.max("l_extendedprice").cast("float").alias("q"))


def short_maxima(spark, sf_dir) -> DataFrame:
    t = table(spark, sf_dir, "orders", "o_custkey", "o_orderdate", "o_totalprice")
    return t.groupBy(F.col("o_custkey").alias("river"), F.year("o_orderdate").alias("year")).agg(F.max("o_totalprice").cast("float").alias("q"))


FIRST_YEAR, MEMBER_STEPS = 1995, 84


def members(spark, sf_dir) -> DataFrame:
    """An ensemble of up to seven members: the months of all years since 1995 are its steps."""
    t = table(spark, sf_dir, "lineitem", "l_suppkey", "l_linenumber", "l_shipdate", "l_extendedprice")
    step = ((F.year("l_shipdate") - FIRST_YEAR) * 12 + F.month("l_shipdate") - 1).cast("int").alias("step")
    return t.groupBy(F.col("l_suppkey").alias("river"), F.col("l_linenumber").alias("member"), step).agg(F.max("l_extendedprice").cast("float").alias("q"))


def annual(spark, sf_dir) -> DataFrame:
    """Annual maxima of both series: of single values, and of monthly means."""
    return maxima(spark, sf_dir).withColumnRenamed("q", "hourly").join(monthly_maxima(spark, sf_dir).withColumnRenamed("q", "daily"), ["river", "year"])


def monthly_maxima(spark, sf_dir) -> DataFrame:
    """Annual maxima of monthly means, which forecast members exceed more or less often."""
    t = table(spark, sf_dir, "lineitem", "l_suppkey", "l_shipdate", "l_extendedprice")
    months = t.groupBy("l_suppkey", F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month")).agg(F.avg("l_extendedprice").alias("q"))
    return months.groupBy(F.col("l_suppkey").alias("river"), "year").agg(F.max("q").cast("float").alias("q"))


def series(spark, sf_dir) -> DataFrame:
    """Packed series: 64 steps of each vector."""
    t = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    return t.select(F.col("vec_id").alias("river"), F.col("label").alias("region"), F.transform("embedding", lambda x: (F.abs(x.cast("double")) * 1000).cast("float")).alias("q"))


def rivers(spark, sf_dir) -> DataFrame:
    """A network for each nation: customer n drains into customer n div 2; larger numbers come first."""
    c = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    by_nation = Window.partitionBy("c_nationkey").orderBy("c_custkey")
    numbered = c.select(F.col("c_nationkey").alias("region"), F.col("c_custkey").alias("river"), F.row_number().over(by_nation).alias("rn"), F.count("*").over(Window.partitionBy("c_nationkey")).alias("n"))
    up = numbered.select(F.col("region").alias("r2"), F.col("rn").alias("rn2"), F.col("river").alias("to"))
    joined = numbered.join(up, (F.col("region") == F.col("r2")) & (F.floor(F.col("rn") / 2) == F.col("rn2")), "left")
    k, x = 1.0 + F.pmod("river", F.lit(5)), 0.1 * F.pmod("river", F.lit(5))
    return joined.select("region", "river", F.coalesce("to", F.lit(-1)).cast("long").alias("next"), (F.col("n") - F.col("rn")).cast("int").alias("index"), k.cast("double").alias("k"), x.cast("double").alias("x"))


def pieces(spark, sf_dir) -> DataFrame:
    t = table(spark, sf_dir, "lineitem", "l_suppkey", "l_partkey", "l_quantity")
    return t.groupBy(F.col("l_suppkey").alias("river"), F.col("l_partkey").alias("cell")).agg(F.sum("l_quantity").alias("area"))


def runoff(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part", "p_partkey", "p_retailprice").select(F.col("p_partkey").alias("cell"), F.col("p_retailprice").alias("ro"))


def metadata(spark, sf_dir) -> DataFrame:
    s = table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey", "s_acctbal")
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
    joined = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey, "left")
    return joined.select(F.col("s_suppkey").alias("river"), F.col("s_suppkey").alias("riverId"), (F.col("s_suppkey") - 1).alias("riverIndex"), F.col("n_regionkey").cast("double").alias("lat"), F.col("s_nationkey").cast("double").alias("lon"))


def accumulated(spark, sf_dir) -> DataFrame:
    """Running totals of each user's events at whole hours since the start of the month."""
    e = table(spark, sf_dir, "events", "user_id", "ts", "value")
    hours = F.floor((F.unix_timestamp("ts") - F.lit(1704067200)) / 3600).cast("int")
    per_hour = e.groupBy(F.col("user_id").alias("cell"), hours.alias("hours")).agg(F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents"))
    return per_hour.select("cell", "hours", (F.sum("cents").over(Window.partitionBy("cell").orderBy("hours")) / 100).cast("float").alias("ro"))
