"""Reading what is new: keyset pages and a stored cursor."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_ROWS = 500


def keyset_page(df: DataFrame, key: str, after: int, rows: int = PAGE_ROWS) -> DataFrame:
    """The next page in key order. The condition reaches the scan, the sort keeps a page per task."""
    return df.where(F.col(key) > after).orderBy(key).limit(rows)


def read_cursor(spark: SparkSession, path: str, name: str = "default") -> int:
    """The last key that was fully processed; 0 before the first run."""
    try:
        row = spark.read.parquet(path).where(F.col("name") == name).agg(F.max("last_id")).first()
    except AnalysisException:
        return 0
    return row[0] or 0


def write_cursor(spark: SparkSession, path: str, last_id: int, name: str = "default") -> None:
    """Record progress, after the page itself has been written. Cursors only move forward."""
    spark.createDataFrame([(name, last_id)], "name string, last_id bigint").coalesce(1).write.mode("append").parquet(path)
