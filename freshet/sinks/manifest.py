"""Manifests: which files a table has, how large they are and how many rows they hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _relative(path: str, column: str = "file_path"):
    """A file's name below the table's folder."""
    return F.regexp_extract(F.col(column), f"{path.rstrip('/').rpartition('/')[2]}/((?:[^/]+=[^/]*/)*[^/]+)$", 1)


def files(spark: SparkSession, path: str) -> DataFrame:
    """(file, size) of the table's data files, listed and not read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "[!_.]*").option("recursiveFileLookup", "false").load(path)
    return listed.select(_relative(path, "path").alias("file"), F.col("length").alias("size"))


def write(df: DataFrame, path: str, *partitions: str) -> None:
    """Writes ``df`` and then, in its folder, the manifest: (file, size, rows) from what Spark says of each row's file."""
    spark = df.sparkSession
    df.write.mode("overwrite").partitionBy(*partitions).parquet(path)
    rows = spark.read.parquet(path).select("_metadata.file_path", "_metadata.file_size")
    counted = rows.groupBy("file_path", "file_size").agg(F.count(F.lit(1)).alias("rows"))
    known = counted.select(_relative(path).alias("file"), F.col("file_size").alias("size"), "rows")
    listed = files(spark, path).join(known.drop("size"), "file", "left").select("file", "size", F.coalesce("rows", F.lit(0).cast("long")).alias("rows"))
    listed.coalesce(1).write.mode("overwrite").parquet(f"{path}/_manifest")  # a row a file


def load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path.rstrip('/')}/_manifest")


def faults(spark: SparkSession, path: str) -> DataFrame:
    """(file, fault, size, expected): files that are removed, of another size or not in the manifest. Files are listed,
    not read, so one that is cut off does not stop the check."""
    now, known = files(spark, path).withColumnRenamed("size", "now"), load(spark, path).select("file", F.col("size").alias("expected"))
    both = known.join(now, "file", "full")
    fault = F.when(F.col("now").isNull(), "removed").when(F.col("expected").isNull(), "unknown").when(F.col("now") < F.col("expected"), "truncated").when(F.col("now") > F.col("expected"), "grown")
    return both.select("file", fault.alias("fault"), F.col("now").alias("size"), "expected").where("fault is not null")


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table, if it is what its manifest says; an error names the first faults."""
    bad = faults(spark, path).orderBy("file").limit(10).collect()
    if bad:
        raise ValueError(f"{path} is not what its manifest says: " + ", ".join(f"{r['file']} {r['fault']}" for r in bad))
    return spark.read.parquet(path)
