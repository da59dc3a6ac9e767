"""Where results go: keyed messages, appended rows, database tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.operators.decode import flatten_message


def keyed_messages(df: DataFrame, key: str) -> DataFrame:
    """``key`` and ``value`` for a message topic; the value is the whole row as JSON."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def edit_rows(events: DataFrame) -> DataFrame:
    """The six columns of the edits table; a missing bot flag is false."""
    return events.select(
        F.timestamp_seconds("ts_epoch").alias("event_time"),
        "wiki",
        "title",
        "user_name",
        F.coalesce("bot", F.lit(False)).alias("bot"),
        F.col("type").alias("change_type"),
    )


def append_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def batch_writer(fmt: str = "jdbc", shape=flatten_message, mode: str = "append", **options):
    """A ``foreachBatch`` function that appends the shaped rows; empty batches write nothing.

    ``fmt`` and ``options`` are those of `DataFrameWriter`, so a database and a
    folder of files are the same code.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        shape(batch).write.format(fmt).options(**options).mode(mode).save()

    return write
