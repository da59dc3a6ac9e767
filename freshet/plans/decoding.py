"""Queries over messages: decoding, validation, incremental reads, sinks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from freshet.functions.times import as_zoned, plain_time
from freshet.operators import decode as D
from freshet.operators.embedding import pending
from freshet.operators.filters import recent
from freshet.operators.merge import evolve
from freshet.operators.tables import newest_rows
from freshet.plans import Registry
from freshet.plans.shared_sql import EV
from freshet.sources.events import common_events
from freshet.sources.increments import keyset_page
from freshet.sources.sinks import edit_rows, keyed_messages
from freshet.sources.tables import dealt, table

registry = Registry()
query = registry.query


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, props AS raw_json FROM events")
def decode_props(spark, d):
    return D.decode(table(spark, d, "events").select("event_id", "props"), "k bigint", "props")


def _quoted(c: str) -> Column:
    escaped = F.replace(F.replace(F.col(c), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.concat(F.lit('"'), escaped, F.lit('"'))


@query(
    """
WITH m AS (SELECT event_id, CASE event_type WHEN 'view' THEN props WHEN 'click' THEN CAST(to_json(props) AS VARCHAR)
    WHEN 'purchase' THEN '[' || props || ']' WHEN 'signup' THEN '   ' || props || '  ' ELSE '' END AS value FROM events),
u AS (SELECT event_id, CASE WHEN starts_with(trim(value), '"') THEN json_extract_string(trim(value), '$') ELSE trim(value) END AS body
      FROM m),
r AS (SELECT event_id, body, CASE WHEN body = '' THEN 'empty' WHEN NOT json_valid(body) THEN 'malformed'
      WHEN json_type(body) <> 'OBJECT' THEN 'not_an_object' END AS reason FROM u)
SELECT event_id, reason, CASE WHEN reason IS NULL THEN CAST(json_extract(body, '$.k') AS BIGINT) END AS k FROM r
"""
)
def double_decode(spark, d):
    kind = F.col("event_type")
    value = (
        F.when(kind == "view", F.col("props"))
        .when(kind == "click", _quoted("props"))
        .when(kind == "purchase", F.concat(F.lit("["), "props", F.lit("]")))
        .when(kind == "signup", F.concat(F.lit("   "), "props", F.lit("  ")))
        .otherwise("")
    )
    messages = table(spark, d, "events").select("event_id", value.alias("value"))
    return D.decode_double(messages).select(
        "event_id", "reason", F.from_json("body", "k bigint")["k"].alias("k")
    )


def _mixed_texts(spark, d):
    events = table(spark, d, "events").select(F.lit("e").alias("kind"), F.col("event_id").alias("id"), F.col("props").alias("value"))
    talk = table(spark, d, "conversations").select(
        F.lit("c").alias("kind"), (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("text").alias("value")
    )
    return events.unionByName(talk)


_MIXED = """m AS (SELECT 'e' AS kind, event_id AS id, props AS value FROM events
    UNION ALL SELECT 'c', conv_id * 1000 + turn, text FROM conversations)"""


@query(
    f"""
WITH {_MIXED}
SELECT kind, id, CASE WHEN value IS NULL OR value = '' THEN '{{}}' WHEN json_valid(value) THEN value
    ELSE CAST(json_object('raw', value) AS VARCHAR) END AS body FROM m
"""
)
def lenient_decode(spark, d):
    return D.lenient(_mixed_texts(spark, d)).select("kind", "id", "body")


@query(f"WITH {_MIXED} SELECT kind, id, value FROM m WHERE json_valid(value)")
def drop_malformed(spark, d):
    return D.drop_malformed(_mixed_texts(spark, d))


# Messages with every kind of content problem, made from whole documents.
_MESSAGES_SQL = """
m AS (SELECT doc_id, CASE
    WHEN n_chars % 7 = 0 THEN NULL
    WHEN n_chars % 7 = 1 THEN text
    WHEN n_chars % 7 = 2 THEN CAST(json_object('source', source, 'content', n_chars) AS VARCHAR)
    WHEN n_chars % 7 = 3 THEN CAST(json_object('source', source) AS VARCHAR)
    WHEN n_chars % 7 = 4 THEN CAST(json_object('source', source, 'content', '') AS VARCHAR)
    ELSE CAST(json_object('source', source, 'content', text) AS VARCHAR) END AS value FROM documents),
r AS (SELECT doc_id, value, CASE WHEN value IS NULL THEN 'tombstone' WHEN NOT json_valid(value) THEN 'malformed'
    WHEN json_type(value) <> 'OBJECT' THEN 'not_an_object'
    WHEN json_type(value, '$.content') IS NULL OR json_type(value, '$.content') = 'NULL' THEN 'content_missing'
    WHEN json_type(value, '$.content') <> 'VARCHAR' THEN 'content_not_text'
    WHEN json_extract_string(value, '$.content') = '' THEN 'content_empty' END AS reason FROM m)
"""


def _document_messages(spark, d):
    kind = F.col("n_chars") % 7
    value = (
        F.when(kind == 0, F.lit(None))
        .when(kind == 1, F.col("text"))
        .when(kind == 2, F.to_json(F.struct("source", F.col("n_chars").alias("content"))))
        .when(kind == 3, F.to_json(F.struct("source")))
        .when(kind == 4, F.to_json(F.struct("source", F.lit("").alias("content"))))
        .otherwise(F.to_json(F.struct("source", F.col("text").alias("content"))))
    )
    return dealt(table(spark, d, "documents").select("doc_id", "text", "source", "n_chars")).select("doc_id", value.alias("value"))


@query(f"WITH {_MESSAGES_SQL} SELECT doc_id, reason FROM r WHERE reason <> 'tombstone'")
def quarantine(spark, d):
    return D.split_valid(_document_messages(spark, d))[1].select("doc_id", "reason")


@query(
    f"""WITH {_MESSAGES_SQL}
SELECT CASE WHEN reason IS NULL THEN 'ok' WHEN reason = 'tombstone' THEN 'skipped' ELSE 'error' END AS result, count(*) AS n
FROM r GROUP BY 1"""
)
def result_label(spark, d):
    return D.classify(_document_messages(spark, d)).groupBy("result").agg(F.count(F.lit(1)).alias("n"))


@query(
    """
WITH m AS (SELECT event_id, CAST(json_object('type', event_type, 'event', NULL,
    'title', CASE WHEN event_type = 'error' THEN to_json(event_id) ELSE to_json('Page ' || CAST(event_id AS VARCHAR)) END,
    'user', CASE WHEN event_type = 'click' THEN to_json(user_id) ELSE to_json('user' || CAST(user_id AS VARCHAR)) END,
    'timestamp', CASE WHEN event_type IN ('signup', 'click') THEN to_json(CAST(ts AS VARCHAR)) ELSE to_json(event_id) END,
    'extra', true) AS VARCHAR) AS value FROM events)
SELECT event_id, concat_ws(',',
    CASE WHEN json_type(value, '$.type') NOT IN ('VARCHAR', 'NULL') THEN 'type' END,
    CASE WHEN json_type(value, '$.event') NOT IN ('VARCHAR', 'NULL') THEN 'event' END,
    CASE WHEN json_type(value, '$.title') NOT IN ('VARCHAR', 'NULL') THEN 'title' END,
    CASE WHEN json_type(value, '$.user') NOT IN ('VARCHAR', 'NULL') THEN 'user' END,
    CASE WHEN json_type(value, '$.timestamp') NOT IN ('BIGINT', 'UBIGINT', 'NULL') THEN 'timestamp' END) AS violations FROM m
"""
)
def schema_check(spark, d):
    def text_or_number(number_when: Column, number: Column, text: Column) -> Column:
        return F.when(number_when, number.cast("string")).otherwise(F.concat(F.lit('"'), text, F.lit('"')))

    kind = F.col("event_type")
    title = text_or_number(kind == "error", F.col("event_id"), F.concat(F.lit("Page "), F.col("event_id").cast("string")))
    user = text_or_number(kind == "click", F.col("user_id"), F.concat(F.lit("user"), F.col("user_id").cast("string")))
    stamp = text_or_number(~kind.isin("signup", "click"), F.col("event_id"), F.col("ts").cast("string"))
    value = F.concat(
        F.lit('{"type":"'), kind, F.lit('","event":null,"title":'), title, F.lit(',"user":'), user,
        F.lit(',"timestamp":'), stamp, F.lit(',"extra":true}'),
    )
    messages = table(spark, d, "events").select("event_id", value.alias("value"))
    return D.type_violations(messages).select("event_id", F.array_join("violations", ",").alias("violations"))


@query(
    """
SELECT CAST(event_id AS VARCHAR) AS doc_id, event_type AS source, props AS text,
    'p' || CAST(user_id % 3 AS VARCHAR) AS project, CAST(user_id AS VARCHAR) AS username,
    strftime(ts, '%Y-%m-%dT%H:%M:%S') AS event_ts FROM events
"""
)
def flatten_props(spark, d):
    message = F.struct(
        F.col("event_id").cast("string").alias("doc_id"),
        F.col("event_type").alias("source"),
        F.col("props").alias("text"),
        F.struct(
            F.concat(F.lit("p"), (F.col("user_id") % 3).cast("string")).alias("project"),
            F.col("user_id").cast("string").alias("user"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ts"),
        ).alias("meta"),
    )
    messages = table(spark, d, "events").select(F.to_json(message).alias("value"))
    return D.flatten_message(D.decode(messages, D.MESSAGE_SCHEMA)).drop("raw_json")


@query("SELECT event_id, user_id, event_type, value FROM events WHERE event_id > 250 ORDER BY event_id LIMIT 500", name="keyset_page")
def _keyset_page(spark, d):
    events = table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    return keyset_page(events, "event_id", after=250)


@query("SELECT d.doc_id, d.lang FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id WHERE e.embedding IS NULL")
def backfill_pending(spark, d):
    stored = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    docs = table(spark, d, "documents").select("doc_id", "lang")
    return pending(docs.join(stored, "doc_id", "left")).select("doc_id", "lang")


@query(
    """
SELECT CAST(event_id AS VARCHAR) AS key, event_id, event_type, user_id FROM events
"""
)
def keyed_json(spark, d):
    events = table(spark, d, "events").select("event_id", "event_type", "user_id")
    sent = keyed_messages(events, "event_id")
    return sent.select("key", F.from_json("value", "event_id bigint, event_type string, user_id bigint").alias("v")).select(
        "key", "v.*"
    )


@query(
    """SELECT event_id, '{"event_id":' || CAST(event_id AS VARCHAR) || ',"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g')
    || '","user_id":' || CAST(user_id AS VARCHAR) || ',"event_type":"' || event_type || '","value":' || CAST(value AS VARCHAR)
    || ',"props":' || CAST(to_json(props) AS VARCHAR) || '}' AS content FROM events"""
)
def json_row(spark, d):
    events = table(spark, d, "events")
    return events.select("event_id", F.to_json(F.struct(*events.columns)).alias("content"))


@query(
    f"""WITH {EV}
SELECT make_timestamp(ts_epoch * 1000000) AS event_time, wiki, title, user_name, coalesce(bot, false) AS bot, type AS change_type
FROM ev""",
    name="edit_rows",
)
def _edit_rows(spark, d):
    rows = edit_rows(common_events(table(spark, d, "events")))
    return rows.withColumn("event_time", plain_time("event_time"))


@query("SELECT event_id, ts, event_type, user_id FROM events ORDER BY ts DESC NULLS LAST, event_id DESC LIMIT 10")
def recent_events(spark, d):
    events = table(spark, d, "events").select("event_id", "ts", "event_type", "user_id")
    return events.orderBy(F.col("ts").desc_nulls_last(), F.col("event_id").desc()).limit(10)


_SNAPSHOT = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
             "labels conversations").split()


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in _SNAPSHOT))
def table_snapshot(spark, d):
    out = None
    for name in _SNAPSHOT:
        one = table(spark, d, name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT * FROM orders ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC LIMIT 10")
def newest_orders(spark, d):
    """Whole rows, as a look at a table's newest ones."""
    return newest_rows(table(spark, d, "orders"), "o_orderdate", "o_orderkey")


@query(
    """
SELECT event_id AS id, event_type, CAST(NULL AS VARCHAR) AS role, props AS text FROM events
UNION ALL SELECT conv_id * 1000 + turn, NULL, role, text FROM conversations
"""
)
def schema_evolve(spark, d):
    old = table(spark, d, "events").select(F.col("event_id").alias("id"), "event_type", F.col("props").alias("text"))
    new = table(spark, d, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "role", "text"
    )
    return evolve(old, new)


@query(
    """SELECT event_id, ts FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 720 MINUTE"""
)
def recent_minutes(spark, d):
    events = table(spark, d, "events").select("event_id", "ts")
    newest = events.agg(F.max(as_zoned("ts"))).scalar()
    return recent(events.withColumn("at", as_zoned("ts")), "at", 720, newest).drop("at")
