"""Bronze, Silver and Gold tables, and retention."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions.keys import doc_key
from freshet.functions.text import _col, blank_to_null, has_text, normalize_text, strip_blanks
from freshet.functions.times import epoch_time
from freshet.operators.content import link, with_content
from freshet.operators.filters import keep_condition
from freshet.operators.merge import first_per_key, merge
from freshet.session import stored

POSITION = ["kafka_topic", "kafka_partition", "kafka_offset"]


def bronze(envelopes: DataFrame, order: str = "ord") -> DataFrame:
    """The newest payload at each position (a repeat replaces it) and the source that came first."""
    return merge(envelopes, POSITION, [order], {"source": "first", "payload": "last", "ingested_at": "last"})


def silver(events: DataFrame, **filters) -> DataFrame:
    """Cleaned events: noise dropped, text built, one row per position."""
    rows = events.where(keep_condition(**filters))
    first = first_per_key(rows, POSITION, ["ord"])
    return with_content(first).select(
        *POSITION,
        "ord",
        "type",
        strip_blanks(F.coalesce("wiki", F.lit(""))).alias("wiki"),
        strip_blanks(F.coalesce("title", F.lit(""))).alias("title"),
        link("title_url", "meta_uri").alias("url"),
        "user_name",
        F.coalesce("bot", F.lit(False)).alias("bot"),
        F.coalesce("minor", F.lit(False)).alias("minor"),
        epoch_time("ts_epoch").alias("event_time"),
        "comment",
        "content",
    )


def gold(docs: DataFrame, text: str = "text", short_chars: int = 200) -> DataFrame:
    """Curated documents: ``doc_key``, normalised text and quality flags, one row per key.

    ``docs`` has ``doc_id, source, title, url, lang, event_time`` and the text.
    """
    clean = docs.where(has_text(text)).withColumn("text", normalize_text(text))
    keyed = clean.withColumn("doc_key", doc_key("source", "title", "url", "text"))
    flags = F.array_compact(
        F.array(
            F.when(F.char_length("text") < short_chars, F.lit("short")),
            F.when(blank_to_null("title").isNull(), F.lit("no_title")),
            F.when(blank_to_null("url").isNull(), F.lit("no_url")),
        )
    )
    payload = ["doc_id", "text", "source", "title", "url", "lang", "event_time"]
    merged = merge(keyed, ["doc_key"], ["doc_id"], {c: "first" for c in payload})
    return merged.withColumn("quality_flags", flags)


def newest_rows(df: DataFrame, ts: str, tie: str, k: int = 10) -> DataFrame:
    """The newest ``k`` whole rows; rows without a time come last. Each task sends ``k`` rows at most."""
    return df.orderBy(F.col(ts).desc_nulls_last(), F.col(tie).desc()).limit(k)


def write_by_date(df: DataFrame, path: str, ts: str, mode: str = "append") -> None:
    """Parquet under one folder per event date, which time filters prune."""
    df.withColumn("event_date", F.to_date(F.col(ts))).write.mode(mode).partitionBy("event_date").parquet(path)


def replace_dates(df: DataFrame, path: str, ts: str) -> None:
    """Write ``df`` by event date; the dates it has are replaced, all others stay as they are. (An action.)"""
    dated = df.withColumn("event_date", F.to_date(F.col(ts))).hint("rebalance", "event_date")
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path)


def upsert_dates(df: DataFrame, path: str, ts: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """Add rows to a table by date, of each key the first by ``order``; only the dates of the new rows are read and written.

    Rows of one key must have one date. Running a batch again changes nothing. (An action.)
    """
    spark = df.sparkSession
    if not _dates(spark, path):
        return replace_dates(first_per_key(df, keys, order), path, ts)
    # One row per date of the batch.
    touched = [r[0] for r in df.select(F.to_date(F.col(ts))).distinct().collect()]
    day = F.col("event_date")
    chosen = day.isin(*[d for d in touched if d is not None]) | (day.isNull() if None in touched else F.lit(False))
    before = spark.read.schema(df.withColumn("event_date", F.to_date(F.col(ts))).schema).parquet(path).where(chosen).select(*df.columns)
    replace_dates(stored(first_per_key(before.unionByName(df), keys, order), "dates"), path, ts)


def _dates(spark: SparkSession, path: str) -> dict[str, str]:
    """The date folders of a table and their paths."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath() for s in files.listStatus(root)] if files.exists(root) else []
    return {p.getName().removeprefix("event_date="): p.toString() for p in found if p.getName().startswith("event_date=")}


def expire_dates(spark: SparkSession, path: str, ts: str, days: int, as_of: datetime) -> int:
    """Drop rows more than ``days`` days older than ``as_of`` from a table by date; how many whole dates went.

    Folders of older dates go unread; only the date in which the limit lies is filtered and written again. Rows without a
    time stay. (An action.)
    """
    limit = as_of - timedelta(days=days)
    edge = limit.date().isoformat()
    hadoop = spark._jvm.org.apache.hadoop.fs

    def drop(folder: str) -> None:
        where = hadoop.Path(folder)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)

    folders = _dates(spark, path)
    old = [d for d in folders if d < edge and d[:1].isdigit()]
    for d in old:
        drop(folders[d])
    if edge in folders:
        rows = spark.read.parquet(path).where(F.col("event_date") == F.lit(edge).cast("date")).drop("event_date")
        left = stored(retained(rows, ts, days, as_of.isoformat(sep=" ")), "edge")
        if left.isEmpty():
            drop(folders[edge])
        else:
            replace_dates(left, path, ts)
    return len(old)


def _expired(ts: Column | str, days: int, as_of: Column | datetime | str) -> Column:
    now = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    return F.coalesce(_col(ts).cast("timestamp") < now - F.make_dt_interval(days=F.lit(days)), F.lit(False))


def retained(df: DataFrame, ts: str, days: int, as_of: Column | datetime | str) -> DataFrame:
    """Rows that stay; rows without a time stay too."""
    return df.where(~_expired(ts, days, as_of))


def pruned_count(df: DataFrame, ts: str, days: int, as_of: Column | datetime | str) -> DataFrame:
    return df.agg(F.count_if(_expired(ts, days, as_of)).alias("deleted"))
