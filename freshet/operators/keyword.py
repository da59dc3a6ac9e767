"""Keyword search: substring match and an inverted word index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions.text import tokens
from freshet.operators.grams import batch_match

# English words that carry no search meaning.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "he", "in", "is", "it", "its",
    "of", "on", "or", "that", "the", "this", "to", "was", "were", "will", "with",
)


def matches(query: str | Column, *cols: str, literal: bool = False) -> Column:
    """Case-blind containment in any column. ``%`` and ``_`` in the query stay wild unless ``literal``."""
    text = F.lit(query) if isinstance(query, str) else query
    out = F.lit(False)
    for c in cols:
        col = F.col(c)
        hit = F.contains(F.lower(col), F.lower(text)) if literal else F.ilike(col, F.concat(F.lit("%"), text, F.lit("%")))
        out |= F.coalesce(hit, F.lit(False))
    return out


def keyword_topk(chunks: DataFrame, query: str, k: int, cols=("content", "title"), key: str = "id", literal=False) -> DataFrame:
    """The newest ``k`` rows that contain the query."""
    return chunks.where(matches(query, *cols, literal=literal)).orderBy(F.col(key).desc()).limit(k)


def batch_keyword_topk(
    chunks: DataFrame,
    queries: DataFrame,
    k: int,
    cols: Sequence[str] = ("content", "title"),
    literal: bool = False,
    key: str = "id",
    index: DataFrame | None = None,
) -> DataFrame:
    """``query_id, id, rank``: for each query (``id, query``) the newest ``k`` rows that contain it.

    Rows are found through the sequences of signs they share with a query (``grams.batch_match``), with wildcards as
    without; ``index`` is a stored index of ``chunks``. Ids may be numbers or texts. Each task keeps ``k`` rows
    per query before the last shuffle.
    """
    found = batch_match(chunks, queries, cols, key, literal, index)
    w = Window.partitionBy("query_id").orderBy(F.col("id").desc())
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def token_index(
    df: DataFrame, key: str = "doc_id", text: str = "text", stop_words=STOP_WORDS, only: DataFrame | None = None
) -> DataFrame:
    """Postings: one row per word and document with its count.

    Kept as rows, not as a list per word, so a word that is in every document
    is no larger than the tasks it is spread over. With ``only`` (a column
    ``token``) other words are dropped before anything is counted.
    """
    words = df.select(key, F.explode(tokens(text)).alias("token")).where(~F.col("token").isin(*stop_words))
    if only is not None:
        words = words.join(only.select("token").distinct(), "token", "left_semi")
    return words.groupBy("token", key).agg(F.count(F.lit(1)).alias("n"))


def query_words(queries: DataFrame, stop_words=STOP_WORDS) -> DataFrame:
    """``query_id, token`` for queries with ``query_id, query``."""
    words = queries.select("query_id", F.explode(F.array_distinct(tokens("query"))).alias("token"))
    return words.where(~F.col("token").isin(*stop_words))


def token_stats(index: DataFrame) -> DataFrame:
    return index.groupBy("token").agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("occurrences"))


def fts_search(index: DataFrame, queries: DataFrame, key: str = "doc_id", stop_words=STOP_WORDS) -> DataFrame:
    """Documents that hold every word of a query: ``query_id``, key, ``occurrences``.

    ``queries`` has ``query_id, query``. Only documents with a query's rarest word
    become candidates, so a common word brings no rows of its own. The words that any
    query asks for are gathered once per candidate document, and each candidate is compared with
    its query in one expression. Store ``index`` first: it is read three times.
    """
    words = query_words(queries, stop_words)
    used = index.join(words.select("token").distinct(), "token", "left_semi")
    spread = used.groupBy("token").agg(F.count(F.lit(1)).alias("documents"))
    known = words.join(spread, "token", "left")
    # A word in no document leaves its query without candidates.
    rarest = known.groupBy("query_id").agg(F.min(F.struct(F.coalesce("documents", F.lit(0)), "token"))["token"].alias("token"))
    candidates = used.select("token", key).join(rarest, "token").select("query_id", key)
    held = used.join(candidates.select(key).distinct(), key, "left_semi").groupBy(key)
    held = held.agg(F.map_from_entries(F.collect_list(F.struct("token", "n"))).alias("_held"))
    wanted = words.groupBy("query_id").agg(F.collect_set("token").alias("_wanted"))
    met = candidates.join(held, key).join(wanted, "query_id").where(F.forall("_wanted", lambda w: F.map_contains_key(F.col("_held"), w)))
    total = F.aggregate("_wanted", F.lit(0).cast("long"), lambda acc, w: acc + F.col("_held")[w])
    return met.select("query_id", key, total.alias("occurrences"))
