"""Queries over tables and keys: medallion, merge, star schemas, joins, retention."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from freshet.functions.keys import doc_key
from freshet.functions.times import plain_time
from freshet.functions.vectors import fixed
from freshet.operators import star as ST
from freshet.operators import tables as TB
from freshet.operators.joins import lookup, only_new, violations
from freshet.operators.merge import first_per_key, merge
from freshet.plans import Registry
from freshet.plans import shared_sql as S
from freshet.session import shared_dir
from freshet.sources.events import common_events, stored_content
from freshet.sources.tables import dealt, table

registry = Registry()
query = registry.query

POSITION = "kafka_topic, kafka_partition, kafka_offset"


def _events(spark, d):
    return common_events(table(spark, d, "events"))


def _edits(spark, d):
    return ST.edits_from_content(stored_content(common_events(dealt(table(spark, d, "events")))))


# The whole event as JSON, missing fields as null.
_PAYLOAD = "ord type wiki server_name namespace title title_url user_name bot minor parsedcomment raw_comment notify_url meta_uri ts_epoch rev_old rev_new bytes_old bytes_new".split()


@query(
    f"""WITH {S.EV}, j AS (SELECT *, to_json({{{', '.join(f"'{c}': {c}" for c in _PAYLOAD)}}})::VARCHAR AS payload,
    CASE WHEN ord % 2 = 1 THEN 'replay' ELSE 'live' END AS source FROM ev)
SELECT {POSITION}, arg_min(source, ord) AS source, sha256(arg_max(payload, ord)) AS payload_sha256, max(ord) AS ingested_at FROM j GROUP BY {POSITION}"""
)
def bronze_latest(spark, d):
    payload = F.to_json(F.struct(*_PAYLOAD), {"ignoreNullFields": "false"})
    source = F.when(F.col("ord") % 2 == 1, "replay").otherwise("live")
    rows = _events(spark, d).select(*TB.POSITION, "ord", source.alias("source"), payload.alias("payload"), F.col("ord").alias("ingested_at"))
    return TB.bronze(rows).select(*TB.POSITION, "source", F.sha2("payload", 256).alias("payload_sha256"), "ingested_at")


@query(
    f"""WITH {S.EV}, k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {POSITION} ORDER BY ord) AS n FROM ev WHERE {S.KEEP}) WHERE n = 1),
c AS (SELECT *, {S.content()} AS x, {S.COMMENT} AS comment FROM k)
SELECT {POSITION}, ord, type, wiki, title, trim(coalesce(title_url, meta_uri, '')) AS url, user_name, coalesce(bot, false) AS bot, minor,
    make_timestamp(ts_epoch * 1000000) AS event_time, comment, {S.truncate('x', 700)} AS content FROM c"""
)
def silver_events(spark, d):
    return TB.silver(_events(spark, d)).withColumn("event_time", plain_time("event_time"))


@query(
    f"""WITH p AS (SELECT doc_id, source, lang, {S.normalize('text')} AS text,
    CASE WHEN doc_id % 10 = 3 THEN NULL ELSE left(text, 30) END AS title,
    CASE WHEN doc_id % 8 = 5 THEN '' ELSE 'https://docs.example.org/' || source END AS url FROM documents),
k AS (SELECT *, {S.sha1_key('source', 'title', 'url', 'text')} AS doc_key FROM p WHERE text <> '')
SELECT doc_key, min(doc_id) AS doc_id, arg_min(text, doc_id) AS text, arg_min(lang, doc_id) AS lang,
    concat_ws(',', CASE WHEN length(arg_min(text, doc_id)) < 200 THEN 'short' END,
      CASE WHEN coalesce(any_value(title), '') = '' THEN 'no_title' END,
      CASE WHEN coalesce(any_value(url), '') = '' THEN 'no_url' END) AS quality_flags
FROM k GROUP BY doc_key"""
)
def gold_documents(spark, d):
    doc = F.col("doc_id")
    docs = dealt(table(spark, d, "documents").select("doc_id", "text", "source", "lang")).select(
        "doc_id",
        "text",
        "source",
        "lang",
        F.when(doc % 10 != 3, F.left("text", F.lit(30))).alias("title"),
        F.when(doc % 8 == 5, "").otherwise(F.concat(F.lit("https://docs.example.org/"), "source")).alias("url"),
        F.lit(None).cast("timestamp").alias("event_time"),
    )
    return TB.gold(docs).select("doc_key", "doc_id", "text", "lang", F.array_join("quality_flags", ",").alias("quality_flags"))


_AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"


@query(f"SELECT event_id, ts FROM events WHERE NOT coalesce(ts < {_AS_OF} - INTERVAL 7 DAY, false)")
def retention_keep(spark, d):
    return TB.retained(table(spark, d, "events").select("event_id", "ts"), "ts", 7, "2024-01-31 00:00:00")


@query(f"SELECT count(*) FILTER (ts < {_AS_OF} - INTERVAL 7 DAY) AS deleted FROM events")
def retention_deleted(spark, d):
    return TB.pruned_count(table(spark, d, "events"), "ts", 7, "2024-01-31 00:00:00")


@query(
    f"""WITH {S.EV}, k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {POSITION} ORDER BY ord) AS n FROM ev WHERE {S.KEEP}) WHERE n = 1)
SELECT {POSITION}, ord, CAST(make_timestamp(ts_epoch * 1000000) AS DATE) AS event_date, {S.truncate(S.content(), 700)} AS content FROM k"""
)
def silver_daily(spark, d):
    """Silver by date, filled by three batches that all touch most dates; repeats meet across batches."""
    path = shared_dir(spark, "silver")
    for part in range(3):
        rows = TB.silver(_events(spark, d).where(F.col("ord") % 3 == part))
        TB.upsert_dates(rows, path, "event_time", TB.POSITION, ["ord"])
    return spark.read.parquet(path).select(*TB.POSITION, "ord", "event_date", "content")


@query(
    """SELECT CAST(ts AS DATE) AS event_date, count(*) AS n, min(event_id) AS first_id FROM events
WHERE ts >= TIMESTAMP '2024-01-30 05:30:00' - INTERVAL 7 DAY GROUP BY 1"""
)
def retention_partitions(spark, d):
    """What is left of the events by date after the old ones were dropped by folder."""
    path = shared_dir(spark, "dated")
    TB.replace_dates(table(spark, d, "events").select("event_id", "ts"), path, "ts")
    TB.expire_dates(spark, path, "ts", 7, datetime(2024, 1, 30, 5, 30))
    return spark.read.parquet(path).groupBy("event_date").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"))


# --- merge ---------------------------------------------------------------------

# Documents arrive by id; copies of one text from one source are the same chunk.
# Titles differ in blanks only, and only some arrivals carry a vector.
_CHUNK_IN = f"""
a AS (SELECT d.doc_id AS ord, d.source, CASE WHEN d.doc_id % 2 = 0 THEN ' Doc ' ELSE 'Doc' END AS title,
    'https://docs.example.org/' || d.source AS url, d.text AS content, e.embedding
  FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id),
k AS (SELECT *, {S.sha1_key('source', 'title', 'url', 'content')} AS doc_key FROM a)"""


def _vector_hash(x: str) -> str:
    return f"sha256(array_to_string(list_transform({x}, lambda y: printf('%.8f', y)), ','))"


def _with_vectors(spark, d):
    """Documents, some of them with the vector of the same number."""
    vectors = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    return table(spark, d, "documents").join(vectors, "doc_id", "left")


def _hashed(df, name: str = "embedding"):
    text = F.array_join(F.transform(F.col(name).cast("array<double>"), lambda y: fixed(y, 8)), ",")
    return df.withColumn(name, F.sha2(text, 256))


@query(
    f"""WITH {_CHUNK_IN}, m AS (SELECT doc_key, arg_max(source, ord) AS source, arg_max(title, ord) AS title, arg_max(url, ord) AS url, arg_max(content, ord) AS content,
    max(ord) AS last_ord, arg_max(embedding, ord) FILTER (embedding IS NOT NULL) AS embedding, min(ord) AS created_at FROM k GROUP BY doc_key)
SELECT * REPLACE ({_vector_hash('embedding')} AS embedding) FROM m"""
)
def chunk_upsert(spark, d):
    """Whole rows through the merge; vectors are shown by their hash."""
    doc = F.col("doc_id")
    rows = _with_vectors(spark, d).select(
        doc.alias("ord"),
        doc.alias("last_ord"),
        doc.alias("created_at"),
        F.when(doc % 2 == 0, " Doc ").otherwise("Doc").alias("title"),
        F.concat(F.lit("https://docs.example.org/"), "source").alias("url"),
        "source",
        F.col("text").alias("content"),
        "embedding",
    )
    keyed = rows.withColumn("doc_key", doc_key("source", "title", "url", "content"))
    rules = {"source": "last", "title": "last", "url": "last", "content": "last", "last_ord": "max", "embedding": "last_non_null", "created_at": "min"}
    return _hashed(merge(keyed, ["doc_key"], ["ord"], rules))


@query(
    f"""WITH a AS (SELECT d.doc_id AS ord, sha1(d.text) AS id, d.source, CAST(d.doc_id AS VARCHAR) AS doc_id, CAST(d.doc_id % 5 AS INT) AS chunk_index, d.text,
    to_json({{'lang': d.lang, 'n_chars': d.n_chars}})::VARCHAR AS metadata, e.embedding FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id),
m AS (SELECT id, arg_min(source, ord) AS source, arg_min(doc_id, ord) AS doc_id, arg_min(chunk_index, ord) AS chunk_index, arg_max(text, ord) AS text,
    arg_max(metadata, ord) AS metadata, arg_max_null(embedding, ord) AS embedding FROM a GROUP BY id)
SELECT * REPLACE ({_vector_hash('embedding')} AS embedding) FROM m"""
)
def rag_chunk_upsert(spark, d):
    """Whole rows; the last text, metadata and vector stay, and a missing vector replaces one that was there."""
    doc = F.col("doc_id")
    rows = _with_vectors(spark, d).select(
        doc.alias("ord"),
        F.sha1("text").alias("id"),
        "source",
        doc.cast("string").alias("doc_id"),
        (doc % 5).cast("int").alias("chunk_index"),
        "text",
        F.to_json(F.struct("lang", "n_chars"), {"ignoreNullFields": "false"}).alias("metadata"),
        "embedding",
    )
    rules = {"source": "first", "doc_id": "first", "chunk_index": "first", "text": "last", "metadata": "last", "embedding": "last"}
    return _hashed(merge(rows, ["id"], ["ord"], rules))


@query("SELECT min(doc_id) AS doc_id, arg_min(source, doc_id) AS source, sha256(text) AS text_hash FROM documents GROUP BY sha256(text)")
def dedup_docs(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", F.sha2("text", 256).alias("text_hash"))
    return first_per_key(docs, ["text_hash"], ["doc_id"]).select("doc_id", "source", "text_hash")


@query(
    f"""WITH {S.EV} SELECT {S.surrogate('wiki')} AS wiki_id, wiki AS wiki_code, arg_max_null(server_name, ord) AS domain
FROM ev WHERE wiki <> '' GROUP BY wiki"""
)
def dim_wiki_last(spark, d):
    return ST.dim_wiki(_events(spark, d))


@query(
    f"""WITH {S.EV} SELECT {S.surrogate('wiki', 'namespace', 'title')} AS page_id, {S.surrogate('wiki')} AS wiki_id,
    wiki AS wiki_code, namespace, title, arg_max(title_url, ord) FILTER (title_url IS NOT NULL) AS url
FROM ev WHERE wiki <> '' AND title <> '' GROUP BY wiki, namespace, title"""
)
def dim_page_coalesce(spark, d):
    return ST.dim_page(_events(spark, d))


@query(
    f"""WITH {S.EV} SELECT {S.surrogate('user_name')} AS user_id, user_name AS username,
    arg_max(bot, ord) FILTER (bot IS NOT NULL) AS is_bot FROM ev WHERE user_name <> '' GROUP BY user_name"""
)
def dim_user_bot(spark, d):
    return ST.dim_user(_events(spark, d))


_FACT = f"""f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {POSITION} ORDER BY ord) AS n FROM ev) WHERE n = 1),
fact AS (SELECT {POSITION}, kafka_topic || '/' || CAST(kafka_partition AS VARCHAR) || '/' || CAST(kafka_offset AS VARCHAR) AS doc_key,
    make_timestamp(nullif(greatest(ts_epoch, 0), 0) * 1000000) AS occurred_at,
    CASE WHEN wiki <> '' THEN {S.surrogate('wiki')} END AS wiki_id,
    CASE WHEN wiki <> '' THEN {S.surrogate('wiki', 'namespace', 'title')} END AS page_id,
    {S.surrogate('user_name')} AS user_id, type AS event_type, raw_comment AS comment, bot AS is_bot, minor AS is_minor,
    rev_old, rev_new, bytes_old, bytes_new, notify_url, server_name AS server FROM f)"""


@query(f"WITH {S.EV}, {_FACT} SELECT * FROM fact")
def fact_edit(spark, d):
    return ST.fact_edit(_events(spark, d)).withColumn("occurred_at", plain_time("occurred_at"))


@query(
    f"""WITH {S.EV}, {_FACT},
w AS (SELECT {S.surrogate('wiki')} AS wiki_id, wiki AS wiki_code, arg_max_null(server_name, ord) AS domain FROM ev WHERE wiki <> '' GROUP BY wiki),
p AS (SELECT {S.surrogate('wiki', 'namespace', 'title')} AS page_id, namespace, title, arg_max(title_url, ord) FILTER (title_url IS NOT NULL) AS url
      FROM ev WHERE wiki <> '' GROUP BY wiki, namespace, title),
u AS (SELECT {S.surrogate('user_name')} AS user_id, user_name AS username, arg_max(bot, ord) FILTER (bot IS NOT NULL) AS user_is_bot FROM ev GROUP BY user_name)
SELECT f.kafka_offset, f.event_type, w.wiki_code, w.domain, p.namespace, p.title, p.url, u.username, u.user_is_bot
FROM fact f LEFT JOIN w USING (wiki_id) LEFT JOIN p USING (page_id) LEFT JOIN u USING (user_id)"""
)
def star_join(spark, d):
    view = ST.star_view(ST.build_star(_events(spark, d)))
    return view.select("kafka_offset", "event_type", "wiki_code", "domain", "namespace", "title", "url", "username", "user_is_bot")


@query(
    """SELECT r_name, n_name, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total
FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
LEFT JOIN region ON r_regionkey = n_regionkey GROUP BY r_name, n_name"""
)
def star_join_orders(spark, d):
    # Orders are summed per customer before any join.
    per_customer = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total")
    )
    customers = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    nations = table(spark, d, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").alias("r_regionkey"))
    view = lookup(per_customer, customers, ["c_custkey"])
    view = lookup(lookup(view, nations, ["n_nationkey"]), table(spark, d, "region"), ["r_regionkey"])
    return view.groupBy("r_name", "n_name").agg(
        F.sum("n").alias("n_orders"), F.round(F.sum("total"), 2).alias("total")
    )


@query(
    """SELECT 'lineitem.l_orderkey' AS reference, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL)
UNION ALL SELECT 'orders.o_custkey', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL)
UNION ALL SELECT 'events.doc_id', count(*) FROM events WHERE event_id NOT IN (SELECT doc_id FROM documents WHERE doc_id IS NOT NULL)"""
)
def fk_violations(spark, d):
    pairs = (
        ("lineitem.l_orderkey", "lineitem", "l_orderkey", "orders", "o_orderkey"),
        ("orders.o_custkey", "orders", "o_custkey", "customer", "c_custkey"),
        ("events.doc_id", "events", "event_id", "documents", "doc_id"),
    )
    out = None
    for name, fact, fk, dim, pk in pairs:
        bad = violations(table(spark, d, fact).select(fk), table(spark, d, dim).select(pk), fk, pk)
        one = bad.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("reference"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT event_id, event_type FROM events WHERE event_id NOT IN (SELECT doc_id FROM documents WHERE doc_id IS NOT NULL)")
def new_only(spark, d):
    stored = table(spark, d, "documents").select(F.col("doc_id").alias("event_id"))
    return only_new(table(spark, d, "events").select("event_id", "event_type"), stored, ["event_id"])


# --- natural-key star ------------------------------------------------------------

# The text of the key=value content is checked by `kv_parse`; here its fields are taken from the event.
_EDITS = f"""
e AS (SELECT {POSITION}, ord, ord AS chunk_id, type AS event_type, nullif(wiki, '') AS wiki, title, title_url AS url, user_name, bot AS is_bot,
    {S.strip('raw_comment')} AS comment, server_name AS server, make_timestamp(ts_epoch * 1000000) AS edited_at,
    make_timestamp((ts_epoch + 60) * 1000000) AS ingested_at FROM ev)"""


@query(
    f"""WITH {S.EV}, {_EDITS} SELECT wiki, arg_max(server, ord) FILTER (server IS NOT NULL) AS server, arg_min(edited_at, ord) AS first_seen_at
FROM e WHERE wiki IS NOT NULL GROUP BY wiki"""
)
def dim_wiki_first_seen(spark, d):
    return ST.dim_wiki_seen(_edits(spark, d)).withColumn("first_seen_at", plain_time("first_seen_at"))


@query(f"WITH {S.EV}, {_EDITS} SELECT user_name, arg_min(edited_at, ord) AS first_seen_at FROM e GROUP BY user_name")
def dim_user_first(spark, d):
    return ST.dim_user_seen(_edits(spark, d)).withColumn("first_seen_at", plain_time("first_seen_at"))


@query(
    f"""WITH {S.EV}, {_EDITS} SELECT wiki, url, arg_max_null(title, ord) AS title, arg_min(edited_at, ord) AS first_seen_at
FROM e WHERE wiki IS NOT NULL AND url IS NOT NULL GROUP BY wiki, url"""
)
def dim_page_title(spark, d):
    return ST.dim_page_seen(_edits(spark, d)).withColumn("first_seen_at", plain_time("first_seen_at"))


@query(
    """WITH p AS (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS wiki,
    regexp_extract(url, '^[^?#]+', 0) AS url, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages)
SELECT wiki, url, arg_max(title, page_id) AS title, min(page_id) AS first_page FROM p GROUP BY wiki, url"""
)
def dim_page_title_pages(spark, d):
    pages = table(spark, d, "pages").select(
        "page_id",
        F.col("page_id").alias("first_page"),
        F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1).alias("wiki"),
        F.regexp_extract("url", "^[^?#]+", 0).alias("url"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
    )
    return merge(pages, ["wiki", "url"], ["page_id"], {"title": "last", "first_page": "min"})


@query(
    f"""WITH {S.EV}, {_EDITS} SELECT {POSITION}, chunk_id, event_type, wiki, title, url, user_name, is_bot, comment, server, edited_at, ingested_at
FROM (SELECT *, row_number() OVER (PARTITION BY {POSITION} ORDER BY ord) AS n FROM e) WHERE n = 1"""
)
def fact_edit_kv(spark, d):
    facts = ST.fact_edit_seen(_edits(spark, d))
    return facts.withColumn("edited_at", plain_time("edited_at")).withColumn("ingested_at", plain_time("ingested_at"))


@query(
    f"""WITH {S.EV}, g AS (SELECT count(*) AS n FROM ev GROUP BY {POSITION})
SELECT CAST(sum(n) AS BIGINT) AS offered, count(*) AS inserted, CAST(sum(n - 1) AS BIGINT) AS ignored FROM g"""
)
def fact_inserted(spark, d):
    return ST.inserted_counts(_edits(spark, d))
