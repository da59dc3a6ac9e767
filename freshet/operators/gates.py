"""Quality gates: strict vector hits, else relaxed ones, else keyword hits, else none."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions.text import strip_blanks
from freshet.operators.keyword import batch_keyword_topk
from freshet.operators.vector_search import batch_topk
from freshet.session import stored

STRICT, RELAXED = 0.25, 0.35


def gated_search(
    chunks: DataFrame,
    queries: DataFrame,
    k: int = 3,
    strict: float = STRICT,
    relaxed: float = RELAXED,
    vectors: bool = True,
) -> DataFrame:
    """``query_id, mode, rank, id, distance``; a query without hits has one row with mode ``no_hit``.

    ``chunks``: ``id, title, content, embedding``. ``queries``: ``id, query, embedding``.
    Every query picks its own tier in the plan. Keyword hits are only looked
    for where the vector gates let nothing through.
    """
    asked = queries.withColumn("query", strip_blanks(F.coalesce("query", F.lit("")))).where("query <> ''")
    if vectors:
        # At most k rows per query; stored, because three later steps read it.
        near = stored(batch_topk(chunks, asked, k), "near")
        best = F.min("distance").over(Window.partitionBy("query_id"))
        passed = (
            near.withColumn("best", best)
            .withColumn("mode", F.when(F.col("best") <= strict, "vector_strict").when(F.col("best") <= relaxed, "vector_relaxed"))
            .where(F.col("distance") <= F.when(F.col("mode") == "vector_strict", strict).otherwise(F.lit(relaxed)))
            .select("query_id", "mode", "rank", "id", "distance")
        )
        rest = asked.join(passed.select(F.col("query_id").alias("id")).distinct(), "id", "left_anti")
        label = "text_fallback"
    else:
        passed, rest, label = None, asked, "text"
    words = batch_keyword_topk(chunks, rest, k).select(
        "query_id", F.lit(label).alias("mode"), "rank", "id", F.lit(None).cast("double").alias("distance")
    )
    hits = words if passed is None else passed.unionByName(words)
    return (
        asked.select(F.col("id").alias("query_id"))
        .join(hits, "query_id", "left")
        .withColumn("mode", F.coalesce("mode", F.lit("no_hit")))
    )


def search_modes(queries: DataFrame, usable: bool, top: int = 20, default: int = 3) -> DataFrame:
    """How each request (``query, top_k``) will be answered, and its bounded ``top_k``."""
    text = strip_blanks(F.coalesce("query", F.lit("")))
    asked = F.coalesce(F.nullif("top_k", F.lit(0)), F.lit(default))
    return queries.withColumn(
        "mode", F.when(text == "", "empty_query").when(F.lit(usable), "vector").otherwise("keyword")
    ).withColumn("top_k", F.when(text == "", F.col("top_k")).otherwise(F.least(F.greatest(asked, F.lit(1)), F.lit(top))))
