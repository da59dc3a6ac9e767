"""Overlapping character windows over whole texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions.text import _col, let, strip_blanks

MAX_CHARS = 1200
OVERLAP = 150


def windows(text: Column | str, max_chars: int = MAX_CHARS, overlap: int = OVERLAP) -> Column:
    """The stripped, non-blank windows of a text, in order.

    The text is cut once into steps of ``max_chars - overlap`` characters, and
    each window joins its own step with the start of the following ones. Work
    grows linearly with the text; repeated ``substring`` calls would each walk
    it from the beginning.
    """
    body = strip_blanks(F.coalesce(_col(text), F.lit("")))
    if max_chars <= 0:
        return F.when(body == "", F.array().cast("array<string>")).otherwise(F.array(body))
    overlap = max(0, min(overlap, max_chars - 1))
    step = max_chars - overlap
    # A window spans its own step and this many further ones.
    span = 1 + -(-overlap // step)

    def cut(steps: Column) -> Column:
        # All steps but the last are full, and a window is due until one reaches the end.
        length = (F.size(steps) - 1) * step + F.char_length(F.element_at(steps, -1))
        count = 1 + F.ceil(F.greatest(length - max_chars, F.lit(0)) / step).cast("int")
        pieces = F.transform(
            F.sequence(F.lit(1), count),
            lambda i: strip_blanks(F.left(F.array_join(F.slice(steps, i, span), ""), F.lit(max_chars))),
        )
        return F.filter(pieces, lambda p: p != "")

    steps = F.regexp_extract_all(body, F.lit(f"(?s).{{1,{step}}}"), F.lit(0))
    return let(steps, lambda s: F.when(F.size(s) > 0, cut(s)).otherwise(F.array().cast("array<string>")))


def chunk(
    df: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    max_chars: int = MAX_CHARS,
    overlap: int = OVERLAP,
) -> DataFrame:
    """One row per window: the other columns, ``chunk_index``, ``chunk_id`` and ``chunk_text``."""
    rest = [c for c in df.columns if c != text]
    out = df.select(*rest, F.posexplode(windows(text, max_chars, overlap)).alias("chunk_index", "chunk_text"))
    return out.withColumn("chunk_id", F.concat_ws("#", F.col(key).cast("string"), F.col("chunk_index").cast("string")))
