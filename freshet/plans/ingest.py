"""Queries that write a given table in a source's form and read it back: captures, cursor, objects, sinks, late rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.functions.json_text import repair_utf8
from freshet.plans import Registry
from freshet.session import shared_dir
from freshet.sources.frames import read_frames, read_lines, read_objects
from freshet.sources.increments import keyset_page, read_cursor, write_cursor
from freshet.sources.sinks import append_parquet
from freshet.sources.tables import table
from freshet.streaming.flows import late_rows

registry = Registry()
query = registry.query


@query("SELECT event_type, CAST(event_id AS VARCHAR) AS id, props || chr(10) || props AS data FROM events")
def capture_frames(spark, d):
    """Events as a capture file: a comment, the type, the id, and two data lines each."""
    path = shared_dir(spark, "capture")
    e = table(spark, d, "events")
    frame = F.format_string(": kept alive\nevent: %s\nid: %d\ndata: %s\ndata: %s\n", "event_type", "event_id", "props", "props")
    e.select(frame.alias("value")).write.text(path)
    return read_frames(spark, path)


@query("SELECT props AS data FROM events")
def capture_lines(spark, d):
    """Events line by line, between lines that are no data, broken data and end marks."""
    path = shared_dir(spark, "lines")
    line = F.format_string("id: %d\n\ndata: %s\ndata: {broken\ndata:\ndata: [DONE]", "event_id", "props")
    table(spark, d, "events").select(line.alias("value")).write.text(path)
    return read_lines(spark, path)


@query("SELECT conv_id, turn, role, text FROM conversations")
def object_files(spark, d):
    """Conversations as JSON objects, each file starting with a byte-order mark."""
    path = shared_dir(spark, "objects")
    rows = table(spark, d, "conversations").select(F.concat(F.lit("﻿"), F.to_json(F.struct("conv_id", "turn", "role", "text"))).alias("value"))
    rows.write.text(path)
    return read_objects(spark, path, "conv_id bigint, turn bigint, role string, text string")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 0")
def cursor_pages(spark, d):
    """Orders copied page by page: each page is written, then the cursor moves on. A page is a fourth of the table."""
    rows, target, cursor = table(spark, d, "orders").select("o_orderkey", "o_custkey"), shared_dir(spark, "pages"), shared_dir(spark, "cursor")
    size = max(1, -(-rows.count() // 4))
    while True:
        page = keyset_page(rows, "o_orderkey", read_cursor(spark, cursor), size)
        last = page.agg(F.max("o_orderkey")).first()[0]
        if last is None:
            break
        append_parquet(page, target)
        write_cursor(spark, cursor, last)
    return spark.read.schema(rows.schema).parquet(target)


@query("SELECT c_custkey, c_nationkey FROM customer UNION ALL SELECT s_suppkey, s_nationkey FROM supplier")
def plain_append(spark, d):
    """Two tables appended to one folder."""
    path = shared_dir(spark, "appended")
    append_parquet(table(spark, d, "customer").select("c_custkey", "c_nationkey"), path)
    append_parquet(table(spark, d, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_nationkey").alias("c_nationkey")), path)
    return spark.read.parquet(path)


@query("SELECT doc_id, text || chr(65533) || '.' AS replaced, text || '.' AS ignored FROM documents")
def utf8_repair(spark, d):
    """Documents with a broken byte before the last sign."""
    broken = F.concat(F.encode("text", "UTF-8"), F.unhex(F.lit("FF2E")))
    rows = table(spark, d, "documents").select("doc_id", broken.alias("b"))
    return rows.select("doc_id", repair_utf8("b").alias("replaced"), repair_utf8("b", "ignore").alias("ignored"))


@query("SELECT event_id, ts FROM events WHERE ts < (SELECT max(ts) FROM events) - INTERVAL 10 DAY")
def late_events(spark, d):
    """Events behind a watermark of ten days, as they would go to a side table."""
    events = table(spark, d, "events").select("event_id", "ts")
    mark = events.agg((F.max("ts") - F.expr("INTERVAL 10 DAY")).cast("string")).first()[0]
    return late_rows(events, "ts", mark)
