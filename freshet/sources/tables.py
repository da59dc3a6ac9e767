"""Plain Parquet tables by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def dealt(scan: DataFrame) -> DataFrame:
    """A plain scan, dealt out over all cores when its files make fewer tasks than there are cores.

    A file of one row group is one task, however much work each row is. Large
    tables have tasks enough and are returned as they are, without a shuffle.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
