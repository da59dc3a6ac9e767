"""Numbered sources, citations and the text handed to an answerer.

Hits are ``query_id, rank`` with document columns; a search leaves only a few
per query, so one list per query is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions.text import blank_to_null, preview

CITATIONS = 5
CONTEXT_CHARS, MIN_CONTEXT_CHARS, MAX_CONTEXT_CHARS = 12_000, 2_000, 60_000
ANSWER_THRESHOLD = 0.33

# Fixed value: shown when no text passed the filters.
NO_CONTEXT = "No chunks match your filters yet. Widen the time window (minutes) or remove the wiki filter."


def _joined(block: Column, sep: str = "\n\n") -> Column:
    ordered = F.array_sort(F.collect_list(F.struct(F.col("rank"), block.alias("block"))))
    return F.array_join(F.transform(ordered, lambda e: e["block"]), sep)


def public_rows(hits: DataFrame, content: str = "content", chars: int = 500) -> DataFrame:
    """What a caller gets to see of a hit."""
    return hits.select("id", "source", "title", "url", preview(content, chars).alias("content_preview"), "distance")


def source_blocks(hits: DataFrame, content: str = "content", chars: int = 240) -> DataFrame:
    """One text per query that numbers its sources."""
    block = F.concat(
        F.lit("["), F.col("rank").cast("string"), F.lit("] title: "),
        F.coalesce(blank_to_null("title"), F.lit("(no title)")),
        F.lit("\nurl: "), F.coalesce("url", F.lit("")),
        F.lit("\ncontent: "), preview(content, chars),
    )
    return hits.groupBy("query_id").agg(_joined(block).alias("sources"))


def citations(hits: DataFrame, limit: int = CITATIONS) -> DataFrame:
    return hits.where(F.col("rank") <= limit).select(
        "query_id", "rank", "id", "source", "title", "url", F.round(1 - F.col("distance"), 6).alias("score")
    )


def context_text(queries: DataFrame, hits: DataFrame, content: str = "content", limit: int = CITATIONS) -> DataFrame:
    """The first texts of each query, or the fixed message for a query without any."""
    text = F.coalesce(F.col(content), F.lit(""))
    joined = hits.where(F.col("rank") <= limit).groupBy("query_id").agg(_joined(text).alias("context"))
    return queries.select("query_id").join(joined, "query_id", "left").withColumn(
        "context", F.coalesce("context", F.lit(NO_CONTEXT))
    )


def within_budget(hits: DataFrame, content: str = "content", budget: int = CONTEXT_CHARS) -> DataFrame:
    """The best hits whose texts fit the budget together; the budget is kept in its allowed range."""
    budget = max(MIN_CONTEXT_CHARS, min(budget, MAX_CONTEXT_CHARS))
    w = Window.partitionBy("query_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    used = F.sum(F.char_length(F.coalesce(F.col(content), F.lit("")))).over(w)
    return hits.withColumn("used_chars", used).where(F.col("used_chars") <= budget)


def answer_mode(queries: DataFrame, hits: DataFrame, threshold: float = ANSWER_THRESHOLD) -> DataFrame:
    """``auto`` generates only from a good enough best hit; fixed modes stay as asked.

    ``queries``: ``query_id, mode``. ``hits``: ``query_id, distance``.
    """
    best = hits.groupBy("query_id").agg(F.max(1 - F.col("distance")).alias("best_score"))
    joined = queries.join(best, "query_id", "left")
    return joined.withColumn(
        "mode_used",
        F.when(F.col("mode") != "auto", F.col("mode"))
        .when(F.coalesce(F.col("best_score") >= threshold, F.lit(False)), "llm")
        .otherwise("retrieve_only"),
    )
