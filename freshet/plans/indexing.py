"""Queries over chunks and vectors: chunking, embedding, backfill, caches."""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.functions.keys import text_sha256
from freshet.functions.text import normalize_text
from freshet.functions.vectors import fixed
from freshet.operators import answer_cache as AC
from freshet.operators import embedding as E
from freshet.operators.chunking import chunk
from freshet.operators.merge import first_per_key
from freshet.plans import Registry
from freshet.plans import shared_sql as S
from freshet.sources.tables import dealt, table

registry = Registry()
query = registry.query


def _documents(spark, d):
    return dealt(table(spark, d, "documents").select("doc_id", "text"))


@query(
    f"""WITH {S.chunks('documents', 'doc_id', 'text', 1200, 150)}
SELECT doc_id, chunk_index, CAST(doc_id AS VARCHAR) || '#' || CAST(chunk_index AS VARCHAR) AS chunk_id, chunk_text FROM ch"""
)
def chunk_docs(spark, d):
    return chunk(_documents(spark, d)).select("doc_id", F.col("chunk_index").cast("bigint").alias("chunk_index"), "chunk_id", "chunk_text")


@query(
    f"""WITH {S.chunks('documents', 'doc_id', 'text', 1200, 150)}
SELECT d.lang, count(*) AS n_chunks, CAST(sum(length(chunk_text)) AS BIGINT) AS n_chars, CAST(max(length(chunk_text)) AS BIGINT) AS longest
FROM ch JOIN documents d USING (doc_id) GROUP BY d.lang"""
)
def chunk_stats(spark, d):
    chunks = chunk(dealt(table(spark, d, "documents").select("doc_id", "lang", "text")))
    size = F.char_length("chunk_text")
    return chunks.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_chunks"), F.sum(size).alias("n_chars"), F.max(size).cast("bigint").alias("longest")
    )


@query(
    f"""WITH {S.chunks('documents', 'doc_id', 'text', 1200, 200)} SELECT doc_id, chunk_index, sha1(chunk_text) AS chunk_sha1 FROM ch"""
)
def chunk_overlap200(spark, d):
    return chunk(_documents(spark, d), overlap=200).select(
        "doc_id", F.col("chunk_index").cast("bigint").alias("chunk_index"), F.sha1("chunk_text").alias("chunk_sha1")
    )


_ROUNDED = "array_to_string(list_transform(v, lambda x: printf('%.6f', x + 0.0)), ',')"


def _rounded(c: str):
    # Adding zero turns a negative zero into a plain one.
    return F.array_join(F.transform(c, lambda x: fixed(x + F.lit(0.0), 6)), ",")


@query(f"WITH {S.hash_vectors('hv', 'documents', 'doc_id', 'text')} SELECT doc_id, {_ROUNDED} AS vector FROM hv")
def hash_embed(spark, d):
    return E.embed_by_id(_documents(spark, d), "doc_id").select("doc_id", _rounded("embedding").alias("vector"))


@query(
    f"""WITH t AS (SELECT DISTINCT sha256(text) AS text_hash, text FROM documents), {S.hash_vectors('hv', 't', 'text_hash', 'text')}
SELECT d.doc_id, hv.text_hash, {_ROUNDED} AS vector FROM documents d JOIN hv ON hv.text_hash = sha256(d.text)"""
)
def embed_distinct(spark, d):
    return E.embed(_documents(spark, d)).select("doc_id", "text_hash", _rounded("embedding").alias("vector"))


@query("SELECT vec_id, len(embedding) = 64 AS width_ok, len(embedding) = 1536 AS fits_1536 FROM embeddings")
def dims_check(spark, d):
    rows = E.check_width(table(spark, d, "embeddings").select("vec_id", "embedding"), 64)
    wide = E.check_width(rows.withColumnRenamed("width_ok", "width_64"), 1536)
    return wide.select("vec_id", F.col("width_64").alias("width_ok"), F.col("width_ok").alias("fits_1536"))


@query(
    f"""WITH m AS (SELECT d.doc_id, d.text FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id WHERE e.embedding IS NULL),
{S.hash_vectors('hv', 'm', 'doc_id', 'text')},
f AS (SELECT d.doc_id, e.embedding IS NULL AS filled, coalesce(CAST(e.embedding AS DOUBLE[]), hv.v) AS v
    FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id LEFT JOIN hv ON hv.doc_id = d.doc_id)
SELECT doc_id, filled, {_ROUNDED} AS vector FROM f"""
)
def backfill_merge(spark, d):
    vectors = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    rows = _documents(spark, d).join(vectors, "doc_id", "left").withColumn("filled", F.col("embedding").isNull())
    return E.backfill(rows).select("doc_id", "filled", _rounded("embedding").alias("vector"))


@query(
    """WITH c AS (SELECT sha256(d.text) AS text_hash, arg_min(e.vec_id, e.vec_id) AS cached_id FROM documents d JOIN embeddings e ON e.vec_id = d.doc_id
    GROUP BY sha256(d.text))
SELECT d.doc_id, c.cached_id IS NOT NULL AS hit, c.cached_id FROM documents d LEFT JOIN c ON c.text_hash = sha256(d.text)"""
)
def cache_split(spark, d):
    docs = _documents(spark, d).select("doc_id", text_sha256("text").alias("text_hash"))
    stored = docs.join(table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id")), "doc_id")
    cache = first_per_key(stored, ["text_hash"], ["doc_id"]).withColumnRenamed("doc_id", "cached_id")
    return E.cache_split(docs, cache).select("doc_id", "hit", "cached_id")


# --- answer cache ----------------------------------------------------------------

# A user turn and the turn that follows it are a question and its answer.
# Questions are compared by the hash of their whole text, with blanks and case made equal.
_QA = f"""
q AS (SELECT u.conv_id, u.turn, u.conv_id * 1000 + u.turn AS ord, sha256(lower({S.normalize('u.text')})) AS query_hash,
    a.text AS answer FROM conversations u LEFT JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
    WHERE u.role = 'user'),
c AS (SELECT query_hash, arg_min(ord, ord) AS cache_id, arg_min(sha1(answer), ord) AS answer_sha1 FROM q WHERE answer IS NOT NULL GROUP BY query_hash)
"""


def _questions(spark, d):
    """All questions with their answers, by the hash of the whole question."""
    talk = table(spark, d, "conversations")
    asked = talk.where(F.col("role") == "user").select(
        "conv_id",
        "turn",
        (F.col("turn") + 1).alias("next"),
        F.sha2(F.lower(normalize_text("text")), 256).alias("query_hash"),
    )
    answers = talk.select("conv_id", F.col("turn").alias("next"), F.col("text").alias("answer"))
    # Conversation and turn together are unique, so a long conversation is no hot key.
    return asked.join(answers, ["conv_id", "next"], "left").withColumn("ord", F.col("conv_id") * 1000 + F.col("turn"))


def _qa_cache(questions):
    answered = questions.where(F.col("answer").isNotNull()).select(
        "query_hash", F.col("ord").alias("cache_id"), F.sha1("answer").alias("answer_sha1")
    )
    return AC.cache_entries(answered, ["cache_id"])


@query(f"WITH {_QA} SELECT q.conv_id, q.turn, c.cache_id, c.answer_sha1 FROM q LEFT JOIN c USING (query_hash)")
def qa_exact(spark, d):
    asked = _questions(spark, d)
    return AC.exact_lookup(asked.select("conv_id", "turn", "query_hash"), _qa_cache(asked)).select(
        "conv_id", "turn", "cache_id", "answer_sha1"
    )


@query(
    f"""WITH {_QA}, h AS (SELECT query_hash, count(*) AS n, max(ord) AS newest FROM q GROUP BY query_hash)
SELECT c.cache_id, CAST(coalesce(h.n, 0) AS BIGINT) AS use_count, greatest(c.cache_id, h.newest) AS last_used_at
FROM c LEFT JOIN h USING (query_hash)"""
)
def qa_hits(spark, d):
    asked = _questions(spark, d)
    cache = _qa_cache(asked).select(
        "query_hash", "cache_id", F.lit(0).cast("bigint").alias("use_count"), F.col("cache_id").alias("last_used_at")
    )
    hits = asked.select("query_hash", F.col("ord").alias("used_at"))
    return AC.touch(cache, hits).select("cache_id", "use_count", "last_used_at")


# Random unit vectors are far apart, so the similarity threshold of these two checks is low.
_LOW = 0.35

_PAIRS = f"""
p AS (SELECT a.vec_id AS query_id, b.vec_id AS match_id,
    round(list_cosine_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 9) AS dist
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
m AS (SELECT query_id, match_id, dist, row_number() OVER (PARTITION BY query_id ORDER BY dist, match_id) AS n FROM p WHERE dist <= {1 - _LOW})"""


def _vectors(spark, d):
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding")


@query(
    f"""WITH {_PAIRS} SELECT e.vec_id AS query_id, m.match_id, round(1 - m.dist, 6) AS similarity
FROM embeddings e LEFT JOIN m ON m.query_id = e.vec_id AND m.n = 1"""
)
def qa_semantic(spark, d):
    rows = _vectors(spark, d)
    found = AC.semantic_lookup(rows, rows, threshold=_LOW, skip_same=True)
    return found.select("query_id", "match_id", F.round("similarity", 6).alias("similarity"))


@query(f"WITH {_PAIRS} SELECT query_id, match_id, round(1 - dist, 6) AS similarity FROM m WHERE n = 1")
def semantic_pairs(spark, d):
    from freshet.operators.vector_search import best_match

    rows = _vectors(spark, d)
    # The block join, as for a query table of any size.
    found = best_match(rows, rows, _LOW, skip_same=True, broadcast_bytes=0)
    return found.select("query_id", "match_id", F.round("similarity", 6).alias("similarity"))


# The whole join: classes of equal vectors are compared once, and their rows are listed beside them.
_CLASSES = """
c AS (SELECT min(vec_id) AS class_id, embedding FROM embeddings GROUP BY embedding)"""


@query(
    f"""WITH {_CLASSES}, p AS (SELECT a.class_id AS query_id, b.class_id AS match_id,
    round(list_cosine_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 9) AS dist
  FROM c a JOIN c b ON a.class_id < b.class_id)
SELECT query_id, match_id, round(1 - dist, 6) AS similarity FROM p WHERE dist <= {1 - _LOW}"""
)
def semantic_pairs_all(spark, d):
    from freshet.operators.vector_search import similar_pairs

    found = similar_pairs(_vectors(spark, d), _LOW)
    return found.select("query_id", "match_id", F.round(1 - F.col("distance"), 6).alias("similarity"))


@query(f"WITH {_CLASSES} SELECT class_id, vec_id FROM c JOIN embeddings USING (embedding)")
def semantic_classes(spark, d):
    from freshet.operators.vector_search import equal_classes

    return equal_classes(_vectors(spark, d)).select("class_id", F.col("id").alias("vec_id"))
