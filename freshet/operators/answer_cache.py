"""Answer cache: exact and semantic lookup, and the accounting of hits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.operators.joins import lookup
from freshet.operators.merge import merge
from freshet.operators.vector_search import best_match

THRESHOLD = 0.92


def cache_entries(answers: DataFrame, order: list[str]) -> DataFrame:
    """One entry per ``query_hash``: the first answer stays."""
    rest = [c for c in answers.columns if c != "query_hash"]
    return merge(answers, ["query_hash"], order, {c: "first" for c in rest})


def exact_lookup(queries: DataFrame, cache: DataFrame) -> DataFrame:
    """Queries with the cached entry of the same hash; one popular query may be most of them."""
    return lookup(queries, cache, ["query_hash"], split_hot=True)


def semantic_lookup(queries: DataFrame, cache: DataFrame, threshold: float = THRESHOLD, skip_same: bool = False, **kw) -> DataFrame:
    """Every query (``id, embedding``) with its best cached match at or above the threshold, else nulls."""
    found = best_match(cache, queries, threshold, skip_same, **kw)
    return queries.select(F.col("id").cast("bigint").alias("query_id")).join(found, "query_id", "left")


def touch(cache: DataFrame, hits: DataFrame) -> DataFrame:
    """Adds uses and moves the last use. ``hits``: ``query_hash, used_at``, one row per use."""
    uses = hits.groupBy("query_hash").agg(F.count(F.lit(1)).alias("_uses"), F.max("used_at").alias("_at"))
    return (
        cache.join(uses, "query_hash", "left")
        .withColumn("use_count", F.col("use_count") + F.coalesce("_uses", F.lit(0)))
        .withColumn("last_used_at", F.greatest("last_used_at", "_at"))
        .drop("_uses", "_at")
    )
