"""Captured event-stream text files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions.json_text import drop_byte_order_mark, is_json

END_MARK = "[DONE]"


def _field(lines: Column, name: str) -> Column:
    wanted = F.filter(lines, lambda x: F.startswith(x, F.lit(name + ":")))
    return F.transform(wanted, lambda x: F.ltrim(F.substring(x, len(name) + 2, 2**30)))


def parse_frames(frames: DataFrame, text: str = "value") -> DataFrame:
    """One event per frame: ``event_type``, ``id`` and ``data``.

    Comment lines are skipped, several data lines are joined by a line break,
    frames without data vanish.
    """
    lines = F.split(F.replace(F.col(text), F.lit("\r"), F.lit("")), "\n")
    return (
        frames.withColumn("_lines", lines)
        .select(
            F.try_element_at(_field(F.col("_lines"), "event"), F.lit(-1)).alias("event_type"),
            F.try_element_at(_field(F.col("_lines"), "id"), F.lit(-1)).alias("id"),
            F.trim(F.array_join(_field(F.col("_lines"), "data"), "\n")).alias("data"),
        )
        .where(F.col("data") != "")
    )


def read_frames(spark: SparkSession, path: str, line_ending: str = "\n") -> DataFrame:
    """Events of capture files, framed by blank lines.

    Files are split at blank lines while reading, so a large capture is read by
    many tasks. Name the line ending of large captures that use CRLF; unnamed,
    such files are still framed right, but each arrives as one text.
    """
    frames = spark.read.option("lineSep", line_ending * 2).text(path)
    pieces = F.split(F.replace(F.col("value"), F.lit("\r"), F.lit("")), "\n\n+")
    return parse_frames(frames.select(F.explode(pieces).alias("value")))


def parse_lines(lines: DataFrame, text: str = "value") -> DataFrame:
    """Every ``data:`` line is one event; empty ones and the end mark are skipped."""
    body = F.trim(F.regexp_replace(F.substring(F.col(text), 6, 2**30), "[\r\t]", " "))
    return (
        lines.where(F.startswith(F.col(text), F.lit("data:")))
        .select(body.alias("data"))
        .where((F.col("data") != "") & (F.col("data") != END_MARK) & is_json("data"))
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return parse_lines(spark.read.text(path))


def read_objects(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON objects, one per line, that may start with a byte-order mark."""
    text = spark.read.text(path).select(drop_byte_order_mark("value").alias("value")).where(F.trim("value") != "")
    return text.select(F.from_json("value", schema).alias("o")).select("o.*")
