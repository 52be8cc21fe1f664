"""Shared scratch tables: lineage is cut by writing Parquet where every executor can read it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from freshet.session import scratch_folder


class Scratch:
    """Intermediate tables of one operator call. ``finish`` keeps the result and deletes the rest."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{scratch_folder(spark)}/freshet-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            self._delete(f"{self.root}/{name}")

    def finish(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}-result"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        self.close()
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        self._delete(self.root)

    def _delete(self, path: str) -> None:
        sc = self.spark.sparkContext
        target = sc._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)
