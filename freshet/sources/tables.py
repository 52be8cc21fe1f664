"""Scans: partitioned tables, runoff by year, names of files, completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.functions.numerics import null_nan
from freshet.sources import axes

DISCHARGE_NAME = r"^discharge_([a-z0-9]+)_(\d{4})01_(\d{4})12"
MEMBER_NAME = r"^(cf|pf)_(\d+)_(\d{8})\.grib"


def scan(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Parquet with only these columns; NaN of float columns becomes NULL."""
    table = spark.read.parquet(path)
    table = table.select(*columns) if columns else table
    return table.select(*[null_nan(F.col(c)).alias(c) if t in ("float", "double") else F.col(c) for c, t in table.dtypes])


def year_source(spark: SparkSession, root: str, year: int) -> DataFrame:
    """The table of a year: the folder year=<year> of ``root``, else its file <year>.parquet; neither is an error."""
    jvm = spark._jvm.org.apache.hadoop.fs
    for path in (f"{root}/year={year}", f"{root}/{year}.parquet"):
        target = jvm.Path(path)
        if target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
            return spark.read.parquet(path)
    raise FileNotFoundError(f"no runoff of {year} in {root}")


def open_members(spark: SparkSession, paths: list[str], axis: str | tuple[str, ...] = "step") -> DataFrame:
    """The tables of all members, each in a folder member=<number>, with that number as a column. Members whose values
    of an axis (of each of several) are not those of the others raise an error when they are read. Axes are compared by
    fingerprints of their distinct values: no task gathers an axis, and one row a member is broadcast."""
    table = spark.read.parquet(*paths).withColumn("member", F.regexp_extract(F.col("_metadata.file_path"), r"member=(\d+)", 1).cast("int"))
    for name in (axis,) if isinstance(axis, str) else axis:
        found = axes.fingerprints(table.select("member", F.col(name).alias("place"), F.col(name).alias("value")).distinct(), "member", "place", "value")
        same = F.size(F.collect_set(F.struct("n", "sum1", "sum2")).over(Window.partitionBy(F.lit(0)))) == 1  # a row a member
        checked = found.select("member", F.when(same, True).otherwise(F.raise_error(F.lit(f"members differ in {name}")).cast("boolean")).alias("_same"))
        table = table.join(F.broadcast(checked), "member").where("_same").drop("_same")
    return table


def regions(table: DataFrame, only: list[str] | None = None) -> DataFrame:
    """Distinct regions but the global one; an unknown wanted region is an error."""
    found = table.select(F.col("region").cast("string").alias("region")).distinct().where("region <> 'global'")
    if only is None:
        return found
    wanted = table.sparkSession.createDataFrame([(r,) for r in only], "region string")
    joined = wanted.join(found.withColumn("known", F.lit(True)), "region", "left")
    return joined.select(F.when(F.col("known"), F.col("region")).otherwise(F.raise_error(F.concat(F.lit("no such region: "), F.col("region")))).cast("string").alias("region"))


def discharge_name(name: Column) -> Column:
    """struct(model, year) of a yearly discharge file's name; NULL for other names."""
    year, end = F.regexp_extract(name, DISCHARGE_NAME, 2), F.regexp_extract(name, DISCHARGE_NAME, 3)
    return F.when(name.rlike(DISCHARGE_NAME) & (year == end), F.struct(F.regexp_extract(name, DISCHARGE_NAME, 1).alias("model"), year.cast("int").alias("year")))


def member_name(name: Column) -> Column:
    """struct(kind, number, stamp) of a member file's name; NULL for other names."""
    part = lambda i: F.regexp_extract(name, MEMBER_NAME, i)
    return F.when(name.rlike(MEMBER_NAME), F.struct(part(1).alias("kind"), part(2).cast("int").alias("number"), part(3).alias("stamp")))


def newest(names: DataFrame) -> DataFrame:
    return names.select(member_name(F.col("name")).alias("m")).agg(F.max("m.stamp").alias("newest"))


def incomplete(steps: DataFrame, members, per_member: int, by: tuple[str, ...] = ()) -> DataFrame:
    """Of the wanted ``members`` (of each ``by``), those that lack steps or are missing altogether: (by, member, n)."""
    have = steps.groupBy(*by, "member").agg(F.countDistinct("step").alias("n"))
    every = steps.select(*by).distinct() if by else steps.sparkSession.range(1)
    every = every.select(*by, F.explode(F.array(*[F.lit(int(m)) for m in members])).alias("member"))
    n = F.coalesce("n", F.lit(0)).alias("n")
    return every.join(have, [*by, "member"], "left").select(*by, "member", n).where(F.col("n") != per_member)


def long_series(packed: DataFrame, keys: tuple[str, ...] = ("river",)) -> DataFrame:
    """Arrays q to rows (step, q)."""
    return packed.select(*keys, F.posexplode("q").alias("step", "q"))


def packed_series(rows: DataFrame, keys: tuple[str, ...] = ("river",)) -> DataFrame:
    """Rows (step, q) to one array for each key, in step order."""
    return rows.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("step", "q"))), lambda x: x["q"]).alias("q"))
