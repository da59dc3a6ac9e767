"""Queries over stored indexes: stemmed words with places, sequences of three signs, coded vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.functions.stems import stem_sql
from freshet.functions.text import upper_each
from freshet.operators import ann
from freshet.operators import keyword as W
from freshet.operators import word_index as X
from freshet.plans import Registry
from freshet.plans import shared_sql as S
from freshet.plans.retrieval import _DOCS, _HITS, _STOP, _centres, _documents, _vectors
from freshet.session import shared_dir
from freshet.sources.tables import dealt, table

registry = Registry()
query = registry.query

# Words of queries and of documents with their places, those of the title first.
_PLACED = f"""{_DOCS},
tt AS (SELECT id, regexp_extract_all(lower(coalesce(title, '')), '{S.WORDS}') AS t, regexp_extract_all(lower(coalesce(content, '')), '{S.WORDS}') AS c FROM docs),
pw AS (SELECT id, len(t) AS n_title, unnest(list_concat(t, c)) AS token, unnest(range(1, len(t) + len(c) + 1)) AS position FROM tt),
dw AS (SELECT * FROM pw WHERE token {_STOP}),
dl AS (SELECT DISTINCT token FROM dw), ds AS ({stem_sql('dl')}),
post AS (SELECT ds.w AS stem, id, list(position ORDER BY position) AS positions, count(*) FILTER (position <= n_title) AS in_title
    FROM dw JOIN ds USING (token) GROUP BY ALL),
entries AS (SELECT *, list_sum(list_transform(range(1, len(positions) + 1), lambda i: CASE WHEN i <= in_title THEN 1.0 ELSE CAST(0.1 AS DOUBLE) END / (i * i)))
    / 1.64493406685 AS score FROM post)"""


@query(f"WITH {_PLACED} SELECT stem, count(*) AS documents, sum(len(positions))::BIGINT AS places, round(sum(score), 6) AS score FROM entries GROUP BY stem")
def word_stems(spark, d):
    index = X.word_index(dealt(_documents(spark, d)))
    return index.groupBy("stem").agg(
        F.count(F.lit(1)).alias("documents"), F.sum(F.size("positions")).alias("places"), F.round(F.sum("score"), 6).alias("score")
    )


@query(
    f"""WITH {_PLACED},
q AS (SELECT item_id AS query_id, unnest(regexp_extract_all(lower(text), '{S.WORDS}')) AS token,
    unnest(range(1, len(regexp_extract_all(lower(text), '{S.WORDS}')) + 1)) AS place FROM benchmark),
qw AS (SELECT * FROM q WHERE token {_STOP}), ql AS (SELECT DISTINCT token FROM qw), qs AS ({stem_sql('ql')}),
asked AS (SELECT query_id, qs.w AS stem, place FROM qw JOIN qs USING (token)),
need AS (SELECT query_id, count(DISTINCT stem) AS words, count(*) AS places FROM asked GROUP BY query_id),
hit AS (SELECT query_id, id, sum(score) AS total, count(*) AS words FROM (SELECT DISTINCT query_id, stem FROM asked) JOIN entries USING (stem) GROUP BY query_id, id),
found AS (SELECT hit.query_id, hit.id, total / need.words AS rank, need.places FROM hit JOIN need USING (query_id) WHERE hit.words = need.words),
begins AS (SELECT query_id, id, unnest(positions) - place AS b FROM found JOIN asked USING (query_id) JOIN entries USING (stem, id)),
phrase AS (SELECT DISTINCT query_id, id FROM (SELECT query_id, id, b, count(*) AS n FROM begins GROUP BY ALL) JOIN need USING (query_id) WHERE n = need.places),
r AS (SELECT f.query_id, f.id, f.rank, p.id IS NOT NULL AS phrase FROM found f LEFT JOIN phrase p ON p.query_id = f.query_id AND p.id = f.id),
o AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY phrase DESC, round(rank, 9) DESC, id) AS place FROM r)
SELECT query_id, id, place, phrase, round(rank, 6) AS rank FROM o WHERE place <= 10"""
)
def fts_rank(spark, d):
    """Whole benchmark texts against the stored index of all documents: the ten best, phrases first."""
    path = shared_dir(spark, "words")
    X.write_index(X.word_index(dealt(_documents(spark, d))), path)
    asked = table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    found = X.ranked_search(*X.read_index(spark, path), asked, 10)
    return found.select("query_id", "id", F.col("place").cast("bigint").alias("place"), "phrase", F.round("rank", 6).alias("rank"))


# --- patterns in batches ---------------------------------------------------------------

# Each benchmark text as it is, two signs of it replaced by a wildcard, two parts of it in order, and a short part; blank ones ask nothing.
_PATTERNS = """
pt AS (SELECT item_id * 4 AS query_id, text AS query FROM benchmark
    UNION ALL SELECT item_id * 4 + 1, left(text, 20) || '_' || substring(text, 22) FROM benchmark WHERE length(text) > 30
    UNION ALL SELECT item_id * 4 + 2, upper(left(text, 12)) || '%' || right(text, 9) FROM benchmark
    UNION ALL SELECT item_id * 4 + 3, substring(text, 3, 2) || '_' || substring(text, 6, 5) FROM benchmark)"""


def _patterns(spark, d):
    item, text = F.col("item_id"), F.col("text")
    shapes = {
        0: text,
        1: F.when(F.char_length(text) > 30, F.concat(F.left(text, F.lit(20)), F.lit("_"), F.expr("substring(text, 22)"))),
        2: F.concat(upper_each(F.left(text, F.lit(12))), F.lit("%"), F.right(text, F.lit(9))),
        3: F.concat(F.expr("substring(text, 3, 2)"), F.lit("_"), F.expr("substring(text, 6, 5)")),
    }
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), q.alias("query")) for i, q in shapes.items()])).alias("p")
    asked = table(spark, d, "benchmark").select(item, each)
    return asked.select((item * 4 + F.col("p.i")).alias("id"), "p.query").where("query IS NOT NULL")


@query(
    f"""WITH {_DOCS}, {_PATTERNS}, q AS (SELECT query_id, {S.strip('query')} AS query FROM pt),
r AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY id DESC) AS rank
    FROM q JOIN docs ON content ILIKE '%' || query || '%' OR title ILIKE '%' || query || '%' WHERE query <> '')
SELECT query_id, id, rank FROM r WHERE rank <= 10"""
)
def keyword_batch(spark, d):
    """A batch of patterns, wildcards included: the ten newest documents of each."""
    docs = dealt(_documents(spark, d))
    found = W.batch_keyword_topk(docs, _patterns(spark, d), 10)
    return found.select("query_id", "id", F.col("rank").cast("bigint").alias("rank"))


# --- coded vectors ------------------------------------------------------------------------


@query(f"WITH {_HITS} SELECT query_id, id, rank, round(distance, 6) AS distance FROM hits")
def pq_topk(spark, d):
    """Product-quantised codes under all lists; the bound of the codes makes the result exact, the recall test probes fewer."""
    path = shared_dir(spark, "pq")
    ann.pq_build(_vectors(spark, d), path, lists=16)
    found = ann.pq_topk(spark, path, _centres(spark, d), 8, nprobe=16)
    return found.select("query_id", "id", F.col("rank").cast("bigint").alias("rank"), F.round("distance", 6).alias("distance"))
