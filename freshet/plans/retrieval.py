"""Queries over search: vectors, keywords, gates, context."""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.functions.text import preview
from freshet.functions.times import as_zoned, event_time
from freshet.functions.vectors import as_double
from freshet.operators import context as X
from freshet.operators import keyword as W
from freshet.operators import vector_search as V
from freshet.operators.ann import ivf_build, ivf_topk
from freshet.operators.embedding import embed_by_id
from freshet.operators.filters import metadata_equals, recent
from freshet.operators.gates import gated_search as gated
from freshet.operators.gates import search_modes as modes
from freshet.plans import Registry
from freshet.plans import shared_sql as S
from freshet.session import shared_dir, stored
from freshet.sources.events import common_events
from freshet.sources.tables import dealt, table

registry = Registry()
query = registry.query

# A user's query vector; every value is exact in binary.
QUERY_VECTOR = [((i * 37) % 64 - 32) / 64 for i in range(64)]
_QV = "CAST([" + ", ".join(str(x) for x in QUERY_VECTOR) + "] AS DOUBLE[])"
_COS = f"list_cosine_distance(CAST(embedding AS DOUBLE[]), {_QV})"
_L2 = f"list_distance(CAST(embedding AS DOUBLE[]), {_QV})"


def _vectors(spark, d):
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")


@query(
    f"""SELECT e.vec_id AS id, left(coalesce(d.text, ''), 240) AS content_preview, round({_COS}, 6) AS distance, round(1 - {_COS}, 6) AS similarity
FROM embeddings e LEFT JOIN documents d ON d.doc_id = e.vec_id ORDER BY round({_COS}, 9), e.vec_id LIMIT 10"""
)
def cosine_topk(spark, d):
    # The text is fetched for the few hits only.
    hits = V.vector_topk(_vectors(spark, d).select("id", "embedding"), QUERY_VECTOR, 10)
    shown = X.public_rows(hits.join(_documents(spark, d), "id", "left"), chars=240)
    return shown.select(
        "id", "content_preview", F.round("distance", 6).alias("distance"), F.round(1 - F.col("distance"), 6).alias("similarity")
    )


@query(f"SELECT vec_id AS id, label, round({_L2}, 6) AS distance FROM embeddings ORDER BY round({_L2}, 9), vec_id LIMIT 10")
def l2_topk(spark, d):
    return V.vector_topk(_vectors(spark, d), QUERY_VECTOR, 10, "l2").select("id", "label", F.round("distance", 6).alias("distance"))


@query(
    f"""WITH {S.EV}, f AS (SELECT DISTINCT kafka_offset FROM ev WHERE wiki = 'enwiki' AND
      make_timestamp(ts_epoch * 1000000) >= (SELECT max(ts) FROM events) - INTERVAL 43000 MINUTE)
SELECT vec_id AS id, label, round({_COS}, 6) AS distance FROM embeddings JOIN f ON f.kafka_offset = vec_id
ORDER BY round({_COS}, 9), vec_id LIMIT 5"""
)
def vector_filtered(spark, d):
    events = table(spark, d, "events")
    newest = events.agg(F.max(as_zoned("ts"))).scalar()
    metadata = F.to_json(F.struct("wiki", F.col("ts_epoch").cast("string").alias("event_time")))
    rows = common_events(events).select(F.col("kafka_offset").alias("id"), metadata.alias("metadata"))
    at = event_time(F.get_json_object("metadata", "$.event_time"))
    allowed = recent(rows.where(metadata_equals("metadata", "wiki", "enwiki")), at, 43000, newest).select("id")
    return V.vector_topk(_vectors(spark, d).join(allowed, "id", "left_semi"), QUERY_VECTOR, 5).select(
        "id", "label", F.round("distance", 6).alias("distance")
    )


# The query batch: one mean vector per label, over the whole table.
_CENTRES = """
u AS (SELECT label, unnest(range(1, 65)) AS i, unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings),
c AS (SELECT label, list(x ORDER BY i) AS v FROM (SELECT label, i, round(avg(x), 6) AS x FROM u GROUP BY label, i) GROUP BY label)"""
_HITS = f"""{_CENTRES},
h AS (SELECT c.label AS query_id, e.vec_id AS id, round(list_cosine_distance(CAST(e.embedding AS DOUBLE[]), c.v), 9) AS distance FROM c CROSS JOIN embeddings e),
hits AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM h) WHERE rank <= 8)"""


def _centres(spark, d):
    """``id, embedding``: the mean vector of every label, one row per label."""
    rows = table(spark, d, "embeddings").select("label", as_double("embedding").alias("v"))
    means = rows.groupBy("label").agg(*[F.round(F.avg(F.col("v")[i]), 6).alias(f"m{i}") for i in range(64)])
    return means.select(F.col("label").cast("bigint").alias("id"), F.array(*[F.col(f"m{i}") for i in range(64)]).alias("embedding"))


def _hits(spark, d, k: int = 8):
    return V.batch_topk(_vectors(spark, d), _centres(spark, d), k)


def _documents(spark, d):
    doc = F.col("doc_id")
    return table(spark, d, "documents").select(
        doc.alias("id"),
        "source",
        F.when(doc % 6 != 0, F.concat(F.lit("Doc "), doc.cast("string"))).alias("title"),
        F.when(doc % 9 != 0, F.concat(F.lit("https://docs.example.org/"), doc.cast("string"))).alias("url"),
        F.col("text").alias("content"),
    )


_DOCS = """
docs AS (SELECT doc_id AS id, source, CASE WHEN doc_id % 6 <> 0 THEN 'Doc ' || CAST(doc_id AS VARCHAR) END AS title,
    CASE WHEN doc_id % 9 <> 0 THEN 'https://docs.example.org/' || CAST(doc_id AS VARCHAR) END AS url, text AS content FROM documents)"""


def _hit_docs(spark, d):
    return stored(_hits(spark, d), "hits").join(_documents(spark, d), "id")


@query(f"WITH {_HITS} SELECT query_id, id, rank, round(distance, 6) AS distance FROM hits")
def batch_topk(spark, d):
    return _hits(spark, d).select("query_id", "id", F.col("rank").cast("bigint").alias("rank"), F.round("distance", 6).alias("distance"))


@query(
    f"""WITH {_HITS}, {_DOCS} SELECT query_id, string_agg('[' || CAST(rank AS VARCHAR) || '] title: ' || coalesce(title, '(no title)') || chr(10) || 'url: '
    || coalesce(url, '') || chr(10) || 'content: ' || left(content, 240), chr(10) || chr(10) ORDER BY rank) AS sources
FROM hits JOIN docs USING (id) GROUP BY query_id"""
)
def source_blocks(spark, d):
    return X.source_blocks(_hit_docs(spark, d))


@query(f"WITH {_HITS}, {_DOCS} SELECT query_id, rank, id, source, title, url, round(1 - distance, 6) AS score FROM hits JOIN docs USING (id) WHERE rank <= 5")
def citations(spark, d):
    return X.citations(_hit_docs(spark, d)).withColumn("rank", F.col("rank").cast("bigint"))


@query(
    f"""WITH {_HITS}, {_DOCS}, t AS (SELECT query_id, string_agg(content, chr(10) || chr(10) ORDER BY rank) AS context
    FROM hits JOIN docs USING (id) WHERE rank <= 5 AND query_id % 2 = 0 GROUP BY query_id)
SELECT c.label AS query_id, coalesce(t.context, '{X.NO_CONTEXT}') AS context FROM c LEFT JOIN t ON t.query_id = c.label"""
)
def context_text(spark, d):
    asked = _centres(spark, d).select(F.col("id").alias("query_id"))
    # Odd queries ask with a filter that lets nothing through.
    hits = _hit_docs(spark, d).where(F.col("query_id") % 2 == 0)
    return X.context_text(asked, hits)


@query(
    f"""WITH {_HITS}, {_DOCS}, b AS (SELECT query_id, rank, id, sum(length(content)) OVER (PARTITION BY query_id ORDER BY rank) AS used_chars
    FROM hits JOIN docs USING (id))
SELECT query_id, rank, id, CAST(used_chars AS BIGINT) AS used_chars FROM b WHERE used_chars <= 6000"""
)
def context_budget(spark, d):
    return X.within_budget(_hit_docs(spark, d), budget=6000).select("query_id", F.col("rank").cast("bigint").alias("rank"), "id", "used_chars")


@query(
    f"""WITH {_HITS}, b AS (SELECT query_id, max(1 - distance) AS best FROM hits GROUP BY query_id)
SELECT query_id, round(best, 6) AS best_score, CASE WHEN query_id % 5 = 1 THEN 'llm' WHEN query_id % 5 = 2 THEN 'retrieve_only'
    WHEN best >= 0.33 THEN 'llm' ELSE 'retrieve_only' END AS mode_used FROM b"""
)
def answer_mode(spark, d):
    number = F.col("query_id") % 5
    asked = _centres(spark, d).select(F.col("id").alias("query_id")).withColumn(
        "mode", F.when(number == 1, "llm").when(number == 2, "retrieve_only").otherwise("auto")
    )
    return X.answer_mode(asked, _hits(spark, d)).select("query_id", F.round("best_score", 6).alias("best_score"), "mode_used")


# --- keywords ----------------------------------------------------------------------


@query(
    f"""WITH {_DOCS} SELECT id, source, title, url, left(content, 240) AS content_preview FROM docs
WHERE content ILIKE '%tion_in%' OR title ILIKE '%tion_in%' ORDER BY id DESC LIMIT 10"""
)
def keyword_topk(spark, d):
    # The underscore stays a wildcard.
    return W.keyword_topk(_documents(spark, d), "tion_in", 10).select(
        "id", "source", "title", "url", preview("content").alias("content_preview")
    )


_STOP = f"NOT IN ({S.STOPS})"
_INDEX = f"""
w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{S.WORDS}')) AS token FROM documents),
ix AS (SELECT token, doc_id, count(*) AS n FROM w WHERE token {_STOP} GROUP BY token, doc_id)"""


@query(f"WITH {_INDEX} SELECT token, count(*) AS documents, CAST(sum(n) AS BIGINT) AS occurrences FROM ix GROUP BY token")
def token_index(spark, d):
    return W.token_stats(W.token_index(dealt(table(spark, d, "documents").select("doc_id", "text"))))


@query(
    f"""WITH {_INDEX}, q AS (SELECT item_id AS query_id, text AS query FROM benchmark),
t AS (SELECT DISTINCT query_id, unnest(regexp_extract_all(lower(query), '{S.WORDS}')) AS token FROM q),
t2 AS (SELECT * FROM t WHERE token {_STOP}), need AS (SELECT query_id, count(*) AS needed FROM t2 GROUP BY query_id),
met AS (SELECT query_id, doc_id, count(*) AS met, CAST(sum(n) AS BIGINT) AS occurrences FROM ix JOIN t2 USING (token) GROUP BY query_id, doc_id)
SELECT query_id, doc_id, occurrences FROM met JOIN need USING (query_id) WHERE met = needed"""
)
def fts_search(spark, d):
    """Documents that hold all words of a whole benchmark text."""
    queries = table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    docs = dealt(table(spark, d, "documents").select("doc_id", "text"))
    return W.fts_search(stored(W.token_index(docs, only=W.query_words(queries)), "word_index"), queries)


# --- gates, modes, approximate ---------------------------------------------------------


def _asked(spark, d):
    asked = table(spark, d, "benchmark").select(F.col("item_id").alias("id"), F.col("text").alias("query"))
    return asked.join(embed_by_id(asked, "id", "query"), "id")


@query(
    f"""WITH b AS (SELECT item_id AS id, text AS query FROM benchmark), {S.hash_vectors('qv', 'b', 'id', 'query')},
{S.hash_vectors('dv', 'documents', 'doc_id', 'text')},
r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM
    (SELECT qv.id AS query_id, dv.doc_id AS id, round(list_cosine_distance(qv.v, dv.v), 9) AS distance FROM qv CROSS JOIN dv)) WHERE rank <= 3),
best AS (SELECT query_id, min(distance) AS best FROM r GROUP BY query_id),
near AS (SELECT r.query_id, CASE WHEN best <= 0.05 THEN 'vector_strict' ELSE 'vector_relaxed' END AS mode, rank, id, distance
    FROM r JOIN best USING (query_id) WHERE best <= 0.12 AND distance <= CASE WHEN best <= 0.05 THEN 0.05 ELSE 0.12 END),
words AS (SELECT * FROM (SELECT b.id AS query_id, 'text_fallback' AS mode, row_number() OVER (PARTITION BY b.id ORDER BY d.doc_id DESC) AS rank, d.doc_id AS id,
    CAST(NULL AS DOUBLE) AS distance FROM b JOIN documents d ON d.text ILIKE '%' || b.query || '%' WHERE b.id NOT IN (SELECT query_id FROM near)) WHERE rank <= 3),
found AS (SELECT * FROM near UNION ALL SELECT * FROM words)
SELECT b.id AS query_id, coalesce(mode, 'no_hit') AS mode, rank, found.id AS id, round(distance, 6) AS distance
FROM b LEFT JOIN found ON found.query_id = b.id"""
)
def gated_search(spark, d):
    """Benchmark texts asked against all documents; gates tightened so that every tier occurs."""
    docs = dealt(table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("content")))
    chunks = docs.join(embed_by_id(docs, "id", "content"), "id").withColumn("title", F.lit(None).cast("string"))
    # The searchable table is written once; vector and keyword search both read it.
    chunks = stored(chunks, "chunks")
    hits = gated(chunks, stored(_asked(spark, d), "asked"), k=3, strict=0.05, relaxed=0.12)
    return hits.select("query_id", "mode", F.col("rank").cast("bigint").alias("rank"), "id", F.round("distance", 6).alias("distance"))


@query(
    """SELECT item_id, CASE WHEN item_id % 7 = 0 THEN 'empty_query' ELSE 'vector' END AS mode,
    CASE WHEN item_id % 7 = 0 THEN item_id - 3 WHEN item_id = 3 THEN 3 ELSE least(greatest(item_id - 3, 1), 20) END AS top_k FROM benchmark"""
)
def search_modes(spark, d):
    item = F.col("item_id")
    asked = table(spark, d, "benchmark").select(
        "item_id", F.when(item % 7 == 0, "  ").otherwise(F.col("text")).alias("query"), (item - 3).alias("top_k")
    )
    usable = V.any_usable(table(spark, d, "embeddings"))
    return modes(asked, usable).select("item_id", "mode", F.col("top_k").cast("bigint").alias("top_k"))


@query(f"WITH {_HITS} SELECT query_id, id, rank, round(distance, 6) AS distance FROM hits", name="ivf_topk")
def _ivf_topk(spark, d):
    """The index with all lists probed gives the exact hits; the recall test probes fewer."""
    path = shared_dir(spark, "ivf")
    ivf_build(_vectors(spark, d), path, lists=16)
    return ivf_topk(spark, path, _centres(spark, d), 8, nprobe=16).select(
        "query_id", "id", "rank", F.round("distance", 6).alias("distance")
    )
