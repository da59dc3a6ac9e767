"""A corpus pipeline: language, near-duplicates, benchmark passages, personal data, pieces.

Each stage works on all that its predecessor kept. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm import language, leaks, near, pieces, pii
from freshet.session import prepare, shared_dir
from freshet.sources.tables import table

# A document whose best language has less than this share of its words is rejected.
LEAST_SHARE = 0.5


def _without(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """The rows whose doc_id is not in ``decided``; rows without a doc_id cannot be named by it and stay."""
    return docs.join(decided.select("doc_id").where("doc_id IS NOT NULL").distinct(), "doc_id", "left_anti").select(*docs.columns)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops text without letters and text of which no language has ``LEAST_SHARE`` of the words.

    When there is nothing to learn from (no row that may be learned from has both
    text and ``lang``), only text that is null or has no letter is dropped.
    """
    model = language.learn(language.learnable(docs))
    if model is None:
        return _without(docs, docs.where(~F.coalesce(F.col("text").cast("string"), F.lit("")).rlike(r"\p{L}")))
    found = language.labelled(docs, model)
    return _without(docs, found.where((F.col("lang_pred") == language.UNKNOWN) | (F.col("score") < LEAST_SHARE)))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group of near-duplicates."""
    return _without(docs, near.near_duplicates(docs).where(~F.col("kept")))


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a passage of a benchmark item."""
    return _without(docs, leaks.leaks(docs, table(spark, sf_dir, "benchmark")))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the kind of personal data in its place; ``n_chars`` follows the text."""
    out = pii.redacted(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else out


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of every document, and whether they decode to its text."""
    return pieces.encoded(docs).select("doc_id", "ids", "n_tokens", "n_byte_tokens", "ids_sha256", "round_trip")


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_stage),
    ("benchmark_leaks", leak_stage),
    ("personal_data", pii_stage),
    ("pieces", pieces_stage),
]
# Models, minima and piece paths have no SQL form; the tests run a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
