"""The common event shape, built from the `events` table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.functions.times import epoch_seconds

# Every twentieth event arrives a second time, as after a consumer restart.
REPLAY_EVERY = 20


def common_events(events: DataFrame) -> DataFrame:
    """All events with position, order, wiki-like fields, blanks, nulls and replays; one scan."""
    e = F.col("event_id")
    replays = F.when(e % REPLAY_EVERY == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    page = (e % 200).cast("string")
    wiki = F.col("user_id") % 4
    tenths = F.floor(F.col("value") * 10).cast("int")
    return events.withColumn("replay", F.explode(replays)).select(
        F.lit("events").alias("kafka_topic"),
        (F.col("user_id") % 3).cast("int").alias("kafka_partition"),
        e.alias("kafka_offset"),
        (e * 2 + F.col("replay")).alias("ord"),
        F.when(F.col("event_type").isin("view", "click"), "edit")
        .when(F.col("event_type") == "purchase", "new")
        .when(F.col("event_type") == "signup", "log")
        .otherwise("categorize")
        .alias("type"),
        F.when(wiki == 0, "enwiki").when(wiki == 1, "frwiki").when(wiki == 2, "wikidatawiki").otherwise("").alias("wiki"),
        F.when(e % 9 != 0, F.concat(F.lit("h"), wiki.cast("string"), F.lit(".example.org"))).alias("server_name"),
        F.when(e % 11 == 0, F.lit(None)).when(e % 5 == 0, 1).otherwise(0).cast("int").alias("namespace"),
        F.concat(F.lit("Page "), page).alias("title"),
        F.when(e % 6 != 0, F.concat(F.lit("https://h.example.org/wiki/Page_"), page)).alias("title_url"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("user_name"),
        F.when(e % 17 != 0, F.col("user_id") % 10 == 0).alias("bot"),
        (e % 2 == 0).alias("minor"),
        F.when(e % 7 != 0, F.concat(F.lit("  changed  <b>"), F.col("props"), F.lit("</b>&amp; more "))).alias("parsedcomment"),
        F.when(e % 14 != 3, F.concat(F.lit(" plain\u00a0 note "), F.col("props"), F.lit(" "))).alias("raw_comment"),
        F.when(e % 4 == 0, F.concat(F.lit("https://h.example.org/w/index.php?diff="), e.cast("string"))).alias("notify_url"),
        F.when(e % 8 != 6, F.concat(F.lit(" https://h.example.org/uri/"), page)).alias("meta_uri"),
        epoch_seconds("ts").alias("ts_epoch"),
        F.when(F.col("replay") == 1, e).otherwise(e - 1).alias("rev_old"),
        e.alias("rev_new"),
        tenths.alias("bytes_old"),
        F.when(e % 13 != 0, tenths + 5).alias("bytes_new"),
    )


def stored_content(events: DataFrame) -> DataFrame:
    """The common events as stored key=value rows, the input of the natural-key star."""
    from freshet.operators.content import build_kv

    return events.select(
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        "ord",
        F.col("ord").alias("id"),
        "title",
        F.col("title_url").alias("url"),
        build_kv("type", "wiki", "title", "user_name", "bot", "raw_comment", "server_name", "ts_epoch").alias("content"),
        F.timestamp_seconds(F.col("ts_epoch") + 60).alias("created_at"),
    )


def envelopes(events: DataFrame) -> DataFrame:
    """The message-broker envelope: key, JSON value, topic, partition, offset, timestamp."""
    payload = [c for c in events.columns if not c.startswith("kafka_")]
    return events.select(
        F.concat_ws("/", "kafka_topic", F.col("kafka_partition").cast("string"), F.col("kafka_offset").cast("string")).alias("key"),
        F.to_json(F.struct(*payload)).alias("value"),
        F.col("kafka_topic").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.timestamp_seconds("ts_epoch").alias("timestamp"),
    )


# The JSON value of an envelope.
PAYLOAD_SCHEMA = (
    "ord bigint, type string, wiki string, server_name string, namespace int, title string, title_url string, "
    "user_name string, bot boolean, minor boolean, parsedcomment string, raw_comment string, notify_url string, meta_uri string, "
    "ts_epoch bigint, rev_old bigint, rev_new bigint, bytes_old int, bytes_new int"
)


def from_envelopes(messages: DataFrame) -> DataFrame:
    """Back to the common event shape; works on batches and streams alike."""
    body = F.from_json(F.col("value").cast("string"), PAYLOAD_SCHEMA)
    return messages.select(
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        body.alias("b"),
    ).select("kafka_topic", "kafka_partition", "kafka_offset", "b.*")
