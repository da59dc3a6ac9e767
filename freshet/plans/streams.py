"""Queries that run a stream over the events table until it is drained, and read back its table."""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.functions.times import plain_time
from freshet.operators.filters import keep_condition
from freshet.operators.metrics import LATENCY_BOUNDS
from freshet.operators.star import POSITION
from freshet.plans import Registry
from freshet.plans import shared_sql as S
from freshet.plans.flow import _cumulative_quantile
from freshet.plans.modelling import _EDITS
from freshet.session import shared_dir, stored
from freshet.sources.events import common_events, envelopes, from_envelopes, stored_content
from freshet.sources.tables import table
from freshet.streaming import flows
from freshet.streaming.reader import read_stream
from freshet.streaming.snapshots import SnapshotTable, idempotent_writer
from freshet.streaming.star import advance, star_tables

registry = Registry()
query = registry.query

BATCHES = 4


def _sent(messages, path) -> int:
    """Messages as files that follow each other in time, so that a replay meets them in that order. The number of files.

    There are as many as the session has shuffle partitions. The time of a file, by which a stream takes them, is set
    after its place in the range.
    """
    spark = messages.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    messages.repartitionByRange(parts, "timestamp", "offset").write.mode("append").parquet(path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    held = sorted((f.getPath().getName(), f) for f in files.listStatus(folder) if f.getPath().getName().startswith("part-"))
    last = max(f.getModificationTime() for _, f in held)
    for i, (_, f) in enumerate(held):
        files.setTimes(f.getPath(), last + 1000 * i, -1)
    return len(held)


def _stream_of(spark, path, files):
    """The files as a stream of about ``BATCHES`` micro-batches, each of as many tasks as it has files."""
    return read_stream(spark, "parquet", path, maxFilesPerTrigger=str(max(1, -(-files // BATCHES))), maxFileAge="3650d")


def _messages(spark, d):
    """The events table written as envelope files, read as a stream of several micro-batches."""
    path = shared_dir(spark, "messages")
    files = _sent(envelopes(common_events(table(spark, d, "events"))), path)
    return _stream_of(spark, path, files), shared_dir(spark, "checkpoint"), shared_dir(spark, "sink")


@query(
    f"""WITH {S.EV}, c AS (SELECT ord, type, wiki, {S.content()} AS x FROM ev WHERE {S.KEEP})
SELECT ord, type, wiki, {S.truncate('x', 700)} AS content FROM c"""
)
def stream_cleaned(spark, d):
    messages, checkpoint, sink = _messages(spark, d)
    flows.drain(flows.cleaned(messages), checkpoint, each=idempotent_writer(sink))
    return spark.read.parquet(sink).select("ord", "type", "wiki", "content")


@query(
    f"""WITH {S.EV} SELECT user_name, arg_max(bot, ord) FILTER (bot IS NOT NULL) AS bot, min(ord) AS first_ord, arg_max(title, ord) AS title
FROM ev GROUP BY user_name"""
)
def stream_upsert(spark, d):
    messages, checkpoint, sink = _messages(spark, d)
    users = from_envelopes(messages).withColumn("first_ord", F.col("ord"))
    target = SnapshotTable(spark, sink, ["user_name"], ["ord"], {"bot": "last_non_null", "first_ord": "min", "title": "last"})
    flows.drain(users, checkpoint, each=target.writer())
    return target.read()


@query(
    f"""WITH {S.EV}, r AS (SELECT ord, ts_epoch, row_number() OVER (PARTITION BY ts_epoch // 60 ORDER BY ts_epoch, kafka_offset, ord) AS n
    FROM ev WHERE {S.KEEP}) SELECT ord, ts_epoch FROM r WHERE n <= 1"""
)
def stream_quota(spark, d):
    messages, checkpoint, sink = _messages(spark, d)
    kept = from_envelopes(messages).where(keep_condition()).withColumn("at", F.timestamp_seconds("ts_epoch"))
    admitted = flows.quota(kept, "at", ["ts_epoch", "kafka_offset", "ord"], 1)
    flows.drain(admitted.select("ord", "ts_epoch"), checkpoint, path=sink)
    return spark.read.parquet(sink)


@query(f"WITH {S.EV} SELECT kafka_partition, kafka_offset, min(ts_epoch) AS ts_epoch FROM ev GROUP BY 1, 2")
def stream_dedup(spark, d):
    messages, checkpoint, sink = _messages(spark, d)
    timed = from_envelopes(messages).withColumn("at", F.timestamp_seconds("ts_epoch"))
    unique = flows.dedup(timed, POSITION, "at").select("kafka_partition", "kafka_offset", "ts_epoch")
    flows.drain(unique, checkpoint, path=sink)
    return spark.read.parquet(sink)


@query(
    f"""WITH {S.EV} SELECT type, time_bucket(INTERVAL 10 MINUTE, make_timestamp(ts_epoch * 1000000), TIMESTAMP '1970-01-01') AS window_start, count(*) AS n
FROM ev GROUP BY 1, 2"""
)
def stream_windows(spark, d):
    """Each batch writes the windows it changed; the largest count of a window is its last."""
    messages, checkpoint, sink = _messages(spark, d)
    timed = from_envelopes(messages).withColumn("at", F.timestamp_seconds("ts_epoch"))
    counts = flows.windowed_counts(timed, "at", "10 minutes", by=["type"])
    flows.drain(counts, checkpoint, each=idempotent_writer(sink), mode="update")
    return (
        spark.read.parquet(sink)
        .groupBy("type", "window_start")
        .agg(F.max("n").alias("n"))
        .select("type", plain_time("window_start").alias("window_start"), "n")
    )


_BUCKETS = ", ".join(f"count(*) FILTER (v <= {b}) AS le_{i}" for i, b in enumerate(LATENCY_BOUNDS))


@query(
    f"""WITH {S.EV}, r AS (SELECT wiki, type, bytes_old / 200.0 AS v, ts_epoch // 7200 * 7200 - 7200 * unnest([0, 1, 2]) AS w FROM ev),
bk AS (SELECT wiki, w, {_BUCKETS}, count(v) AS le_inf, count(*) AS n, count(*) FILTER (type = 'categorize') AS failures FROM r GROUP BY 1, 2)
SELECT wiki, make_timestamp(w * 1000000) AS window_start, n, round({_cumulative_quantile(0.95)}, 6) AS p95,
    round(100.0 * failures / greatest(CAST(n - failures AS DOUBLE), 1e-9), 6) AS error_ratio FROM bk"""
)
def stream_p95(spark, d):
    """Latency and failures of six hours, every two hours, kept as bucket counts with a lateness of minutes."""
    messages, checkpoint, sink = _messages(spark, d)
    timed = from_envelopes(messages).withColumn("at", F.timestamp_seconds("ts_epoch"))
    found = flows.windowed_latency(timed, "at", F.col("bytes_old") / 200, F.col("type") == "categorize", "6 hours", "2 hours", ["wiki"])
    flows.drain(found, checkpoint, each=idempotent_writer(sink), mode="update")
    # Each batch writes the windows it changed; the one with most rows is a window's last.
    last = spark.read.parquet(sink).groupBy("wiki", "window_start").agg(F.max(F.struct("n", "quantile", "error_ratio")).alias("x"))
    return last.select(
        "wiki", plain_time("window_start").alias("window_start"), "x.n", F.round("x.quantile", 6).alias("p95"), F.round("x.error_ratio", 6).alias("error_ratio")
    )


# Every 40th event arrives when all others are there.
_HELD_BACK = "kafka_offset % 40 = 7"


@query(
    f"""WITH {S.EV}, m AS (SELECT max(ts_epoch) - 600 AS mark FROM ev WHERE NOT {_HELD_BACK}),
r AS (SELECT type, ts_epoch // 600 * 600 AS window_start, {_HELD_BACK} AND ts_epoch < mark AS late FROM ev, m)
SELECT type, window_start, count(*) FILTER (NOT late) AS n, count(*) FILTER (late) AS late FROM r GROUP BY 1, 2"""
)
def stream_late(spark, d):
    """Counts by window of the rows on time, and of the late ones that went aside; the stream is stopped and goes on in between."""
    path, checkpoint, sink = (shared_dir(spark, name) for name in ("messages", "checkpoint", "sink"))
    events = common_events(table(spark, d, "events"))
    key = ["type", "window_start"]
    counts = SnapshotTable(spark, f"{sink}/counts", key, ["n"], {"n": "sum"})
    start = F.floor(F.col("ts_epoch") / 600) * 600
    counted = counts.writer(lambda df: df.groupBy("type", start.alias("window_start")).agg(F.count(F.lit(1)).alias("n")))
    aside = idempotent_writer(f"{sink}/late", lambda df: df.select("type", start.alias("window_start"), "ord"))
    for part in (~F.expr(_HELD_BACK), F.expr(_HELD_BACK)):
        stream = _stream_of(spark, path, _sent(envelopes(events.where(part)), path))
        timed = from_envelopes(stream).withColumn("at", F.timestamp_seconds("ts_epoch")).withWatermark("at", flows.LATENESS)
        flows.drain(timed, checkpoint, each=flows.split_late(checkpoint, "at", counted, aside))
    late = spark.read.parquet(f"{sink}/late").groupBy(*key).agg(F.count(F.lit(1)).alias("late"))
    both = counts.read().join(late, key, "full")
    return both.select(*key, *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n", "late")])


@query(
    f"""WITH {S.EV}, {_EDITS},
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY kafka_topic, kafka_partition, kafka_offset ORDER BY ord) AS n FROM e) WHERE n = 1),
w AS (SELECT wiki, arg_max(server, ord) FILTER (server IS NOT NULL) AS wiki_server FROM e WHERE wiki IS NOT NULL GROUP BY wiki),
u AS (SELECT user_name, arg_min(edited_at, ord) AS user_since FROM e GROUP BY user_name),
p AS (SELECT wiki, url, arg_max_null(title, ord) AS page_title FROM e WHERE wiki IS NOT NULL AND url IS NOT NULL GROUP BY wiki, url)
SELECT f.kafka_partition, f.kafka_offset, f.event_type, f.edited_at, w.wiki_server, u.user_since, p.page_title
FROM f LEFT JOIN w ON w.wiki = f.wiki LEFT JOIN u ON u.user_name = f.user_name LEFT JOIN p ON p.wiki = f.wiki AND p.url = f.url"""
)
def star_incremental(spark, d):
    """The star built over several batches of stored rows, the table growing in between, and joined again."""
    rows = stored(stored_content(common_events(table(spark, d, "events"))), "rows")
    star = star_tables(spark, shared_dir(spark, "star"), fold_every=3)
    low, high = rows.agg(F.min("ord"), F.max("ord")).first()
    page = max(1, (high - low) // 4) if high is not None else 1
    advance(star, rows.where(F.col("ord") <= (low or 0) + 2 * page), page)
    advance(star, rows, page)
    wiki, user, place = (star.read(f"dim_{name}") for name in ("wiki", "user", "page"))
    facts = star.read("fact_edit").join(wiki.select("wiki", F.col("server").alias("wiki_server")), "wiki", "left")
    facts = facts.join(user.select("user_name", F.col("first_seen_at").alias("user_since")), "user_name", "left")
    facts = facts.join(place.select("wiki", "url", F.col("title").alias("page_title")), ["wiki", "url"], "left")
    times = [plain_time(c).alias(c) for c in ("edited_at", "user_since")]
    return facts.select("kafka_partition", "kafka_offset", "event_type", "wiki_server", "page_title", *times)
