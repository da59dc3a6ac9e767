"""The embedding step: once per distinct text, with a pluggable model.

The default model hashes words into signed buckets and scales to length one.
A custom model is a function from a list of texts to a list
of vectors and runs over Arrow batches (`embed_with`).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from hashlib import sha1

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.functions.keys import text_sha256
from freshet.functions.text import strip_blanks, tokens
from freshet.functions.vectors import as_double, has_width
from freshet.operators.joins import HOT_SHARE, lookup
from freshet.session import stored

DIMS = 64
BATCH_TEXTS = 25
SUM_ROWS = 1024  # texts whose words are summed at once


def distinct_texts(df: DataFrame, text: str = "text") -> DataFrame:
    """``text_hash`` and one copy of each distinct non-blank text, with its number of copies."""
    usable = df.where(strip_blanks(F.coalesce(F.col(text), F.lit(""))) != "")
    # The text is a grouping key, not an aggregate, so that copies are folded by hash on the map side.
    return usable.groupBy(text_sha256(text).alias("text_hash"), F.col(text).alias("text")).agg(
        F.count(F.lit(1)).alias("copies")
    )


def _word_sums(texts: DataFrame, text: str, dims: int) -> DataFrame:
    """``texts`` with ``_sums``, what the words of a row add to each of ``dims`` buckets, in the place of ``text``.

    Spark cuts the words; a task hashes each different word of some rows once.
    """
    others = [c for c in texts.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @lru_cache(1 << 18)
        def hashed(word: bytes) -> int:
            return int.from_bytes(sha1(word).digest()[:4])

        for batch in batches:
            for lo in range(0, batch.num_rows, SUM_ROWS):
                part = batch.slice(lo, SUM_ROWS)
                words = part.column("_words")
                found = words.flatten().dictionary_encode()
                hashes = np.array([hashed(w) for w in found.dictionary.cast(pa.large_binary()).to_pylist()], np.int64)
                at = found.indices.to_numpy()
                row = np.repeat(np.arange(len(words)), pc.list_value_length(words).to_numpy())
                sign = 1 - 2 * (hashes // dims % 2)
                sums = np.bincount(row * dims + (hashes % dims)[at], sign[at], len(words) * dims).astype(np.int64)
                offsets = pa.array(np.arange(len(words) + 1, dtype=np.int32) * dims)
                columns = [part.column(c) for c in others] + [pa.ListArray.from_arrays(offsets, pa.array(sums))]
                yield pa.record_batch(columns, names=[*others, "_sums"])

    source = texts.select(*others, tokens(text).alias("_words"))
    kinds = [f"{c} {texts.schema[c].dataType.simpleString()}" for c in others]
    return source.mapInArrow(run, ", ".join([*kinds, "_sums array<bigint>"]))


def _unit(sums: DataFrame) -> DataFrame:
    """``_sums`` as ``embedding`` of length one; zeros stay zeros."""
    length = F.sqrt(F.aggregate("_sums", F.lit(0).cast("bigint"), lambda acc, s: acc + s * s))
    scaled = F.transform("_sums", lambda s: F.when(F.col("_length") == 0, F.lit(0.0)).otherwise(s / F.col("_length")))
    return sums.withColumn("_length", length).withColumn("embedding", scaled).drop("_sums", "_length")


def hash_embed(texts: DataFrame, key: str = "text_hash", text: str = "text", dims: int = DIMS) -> DataFrame:
    """``key`` and ``embedding`` for a table of texts; the words of all rows of a key count together.

    Every word adds +1 or -1 to one of ``dims`` buckets, both taken from its
    hash. Words of one text are summed in its task, so one row of ``dims``
    numbers per text travels, however long it is. Texts without words, or
    whose buckets cancel out, get a vector of zeros.
    """
    sums = _word_sums(texts.select(key, text), text, dims).groupBy(key).agg(*[F.sum(F.col("_sums")[i]).alias(f"_{i}") for i in range(dims)])
    return _unit(sums.select(key, F.array(*[f"_{i}" for i in range(dims)]).alias("_sums")))


def embed_with(
    texts: DataFrame,
    model: Callable[[list[str]], list[Sequence[float] | None]],
    key: str = "text_hash",
    text: str = "text",
    batch: int = BATCH_TEXTS,
) -> DataFrame:
    """Run a custom model over Arrow batches. Blank text gives a null vector.

    A model that answers with too few or too many vectors, or with vectors of
    different width, fails the job. ``check_width`` compares with a wanted width.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        width = 0
        for frame in frames:
            vectors: list = [None] * len(frame)
            usable = [i for i, t in enumerate(frame[text]) if t is not None and t.strip()]
            for lo in range(0, len(usable), batch):
                part = usable[lo : lo + batch]
                answers = model([frame[text].iloc[i] for i in part])
                if len(answers) != len(part):
                    raise ValueError(f"the model gave {len(answers)} vectors for {len(part)} texts")
                for i, v in zip(part, answers):
                    vectors[i] = None if v is None else [float(x) for x in v]
                    width = width or len(vectors[i] or ())
                    if vectors[i] is not None and len(vectors[i]) != width:
                        raise ValueError(f"the model gave vectors of {width} and of {len(vectors[i])} values")
            yield pd.DataFrame({key: frame[key], "embedding": vectors})

    source = texts.select(key, text)
    kind = source.schema[key].dataType.simpleString()
    return source.mapInPandas(run, f"{key} {kind}, embedding array<double>")


def _vectors_once(distinct: DataFrame, dims: int, model: Callable | None) -> tuple[DataFrame, DataFrame | None]:
    """The stored vectors of ``distinct_texts``, and which texts hold a large share of the rows, where their copies were kept."""
    if model is not None:
        return stored(embed_with(distinct, model), "vectors"), None
    vectors = stored(_unit(_word_sums(distinct, "text", dims)), "vectors")
    total = vectors.agg(F.sum("copies")).scalar()
    return vectors.drop("copies"), vectors.where(F.col("copies") >= total * F.lit(HOT_SHARE)).select("text_hash")


def embed(
    df: DataFrame,
    text: str = "text",
    dims: int = DIMS,
    model: Callable[[list[str]], list[Sequence[float] | None]] | None = None,
) -> DataFrame:
    """Adds ``text_hash`` and ``embedding``; each distinct text is embedded once.

    The vectors are written before they are joined back, so that the model runs
    once per text whatever the plan does. Copies of one text may be a large
    part of the table, so the way back to the rows keeps hot texts apart.
    """
    vectors, hot = _vectors_once(distinct_texts(df, text), dims, model)
    return lookup(df.withColumn("text_hash", text_sha256(text)), vectors, ["text_hash"], split_hot=True, hot=hot)


def embed_by_id(df: DataFrame, key: str, text: str = "text", dims: int = DIMS) -> DataFrame:
    """``key`` and ``embedding`` without looking for copies: right where ids are unique and copies few."""
    return hash_embed(df.select(key, text), key=key, text=text, dims=dims)


def pending(df: DataFrame, embedding: str = "embedding") -> DataFrame:
    return df.where(F.col(embedding).isNull())


def backfill(
    df: DataFrame,
    text: str = "text",
    dims: int = DIMS,
    model: Callable[[list[str]], list[Sequence[float] | None]] | None = None,
) -> DataFrame:
    """Fill null embeddings in one job; rows that have one keep it."""
    vectors, hot = _vectors_once(distinct_texts(pending(df), text), dims, model)
    # Only rows that lack a vector carry the key, the rest cannot match.
    keyed = df.withColumn("_hash", F.when(F.col("embedding").isNull(), text_sha256(text)))
    found = lookup(
        keyed,
        vectors.select(F.col("text_hash").alias("_hash"), F.col("embedding").alias("_new")),
        ["_hash"],
        split_hot=True,
        hot=hot.withColumnRenamed("text_hash", "_hash") if hot is not None else None,
    )
    return found.withColumn("embedding", F.coalesce(as_double("embedding"), "_new")).drop("_hash", "_new")


def check_width(df: DataFrame, dims: int, embedding: str = "embedding", strict: bool = False) -> DataFrame:
    """Marks rows whose vector has another width; ``strict`` fails the job instead."""
    ok = has_width(embedding, dims)
    if strict:
        bad = F.raise_error(F.concat(F.lit(f"embedding width is not {dims}: "), F.size(embedding).cast("string")))
        return df.withColumn(embedding, F.when(F.col(embedding).isNull() | ok, F.col(embedding)).otherwise(bad))
    return df.withColumn("width_ok", ok)


def cache_split(requests: DataFrame, cache: DataFrame, key: str = "text_hash") -> DataFrame:
    """Requests with ``hit`` and the cached vector. ``cache`` has one row per key."""
    return lookup(requests, cache.withColumn("_hit", F.lit(True)), [key], split_hot=True).withColumn(
        "hit", F.coalesce("_hit", F.lit(False))
    ).drop("_hit")
