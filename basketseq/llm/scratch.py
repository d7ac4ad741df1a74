"""Intermediate tables of one operator call, in the folder all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketseq.sources.shared import new_folder


class Scratch:
    """Writes tables and drops those that nothing reads any more."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.folder = new_folder(spark, label)
        self.count = 0

    def write(self, df: DataFrame, label: str, *partition_by: str) -> tuple[DataFrame, str]:
        self.count += 1
        path = f"{self.folder}/{self.count}-{label}"
        df.write.partitionBy(*partition_by).parquet(path)
        # The schema is known; reading it again would cost a job.
        return self.spark.read.schema(df.schema).parquet(path), path

    def drop(self, path: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)
