"""Repeated runs of words, found by recompression.

Each round renames the whole corpus alike: equal neighbours join to a run, and of
other neighbours those join to a pair whose left symbol is of the left kind and
right symbol of the right kind. Names are hashes of what they stand for, and kinds
are bits of the names, so that every task gives equal parts equal names without an
exchange. Inside a repeat all symbols but those at its ends are therefore the
same everywhere. Spark counts the names around interior symbol borders over all
documents; shared ones reveal the repeats, and their windows are then verified.

Two rounds are used: a border that survives both has up to three words of
context on each side, so a window of 13 words has such a border inside
whatever surrounds the window (or lies in a run, and then is its own name).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.common import documents, dropped, flushed, kept, query, rows_of, texts
from freshet.llm.near import WordHasher, pair
from freshet.llm.repeats import contested, covered, in_filter, removals, removed_of, runs_of, shared_filter, spread, unit_minima, units_of

WINDOW = 13
REACH = 3  # words of context on each side of a border
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
LEFT = np.uint64(1 << 40)  # the bit of a name that makes it a left symbol
LONGEST_UNIT = 64
NAMES_PER_SIGN = 0.04  # about one name for five words


def words_of(text: str) -> list[bytes]:
    """Words between blanks (space, tab to carriage return), unchanged."""
    return text.encode("utf-8", "surrogatepass").split()


def borders(h: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Positions (before a word) of borders that survive both rounds, decided by ``REACH`` words on each side."""
    n = len(h)
    left = (h & LEFT) != 0
    kept = np.ones(n + 1, bool)
    kept[1:n] = (h[1:] != h[:-1]) & ~(left[:-1] & ~left[1:])
    begin = np.flatnonzero(kept)
    size = np.diff(begin)
    begin = begin[:-1]
    symbol = h[begin]
    longer = size >= 2
    symbol[longer] = pairs[begin[longer]]
    left = (symbol & LEFT) != 0
    stays = (symbol[1:] != symbol[:-1]) & ~(left[:-1] & ~left[1:]) & (size[:-1] <= 2) & (size[1:] <= 2)
    at = begin[1:][stays]
    return at[(at >= REACH) & (at + REACH <= n)]


def _window_hashes(h: np.ndarray, two: np.ndarray, four: np.ndarray) -> np.ndarray:
    """Hashes of ``WINDOW`` = 8 + 4 + 1 words from each position on."""
    n = len(h) - WINDOW + 1
    eight = pair(four[:-4], four[4:])
    return pair(pair(eight[:n], four[8 : 8 + n]), h[12 : 12 + n])


def window_names(h: np.ndarray) -> tuple[np.ndarray, Callable[[], np.ndarray]]:
    """For each window the least name of the borders inside it, or its own hash where it has none; and a function for all hashes."""
    n = len(h) - WINDOW + 1
    if n <= 0:
        return np.empty(0, np.uint64), lambda: np.empty(0, np.uint64)
    two = pair(h[:-1], h[1:])
    four = pair(two[:-2], two[2:])
    value = np.full(len(h) + 1, NONE, np.uint64)
    at = borders(h, two)
    value[at] = pair(four[at - REACH], two[at + 1])
    span = WINDOW - 2 * REACH + 1  # borders from REACH to WINDOW - REACH
    least, width = value, 1
    while 2 * width <= span:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    least = np.minimum(least[: len(least) - (span - width)], least[span - width :]) if span > width else least
    out = least[REACH : REACH + n].copy()
    hashes = lambda: _window_hashes(h, two, four)
    lost = np.flatnonzero(out == NONE)
    if len(lost):
        out[lost] = hashes()[lost]
    return out, hashes


def _names_maker():
    hasher = WordHasher()

    def names(text: str) -> np.ndarray:
        found, _ = window_names(hasher(text.encode("utf-8", "surrogatepass")))
        found = np.sort(found[runs_of(found, len(found) or 1)[0]])
        return found[np.concatenate([[True], found[1:] != found[:-1]])] if len(found) else found

    return names


def _unit_maker():
    hasher, empty = WordHasher(), np.empty(0, np.uint64)

    def units(text: str, bloom: np.ndarray) -> tuple:
        h = hasher(text.encode("utf-8", "surrogatepass"))
        names, hashes = window_names(h)
        lo, n = runs_of(names, LONGEST_UNIT)
        keep = in_filter(bloom, spread(names[lo]))
        if not keep.any():
            return empty, empty, lo[:0], n[:0], []
        lo, n = lo[keep], n[keep]
        raw, windows = h.tobytes(), hashes().tobytes()
        spans = list(zip(lo.tolist(), n.tolist()))
        digests = b"".join([blake2b(raw[8 * a : 8 * (a + k + WINDOW - 1)], digest_size=8).digest() for a, k in spans])
        return names[lo], np.frombuffer(digests, np.uint64), lo, n, [windows[8 * a : 8 * (a + k)] for a, k in spans]

    def many(texts: list[str], bloom: np.ndarray) -> Iterator[tuple]:
        for i, text in enumerate(texts):
            name, *rest = units(text, bloom)
            yield np.full(len(name), i), name, *rest

    return many


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        bodies = b.column("body").to_pylist()
        sizes = np.array([len(x) // 8 for x in bodies], np.int64)
        each = np.repeat(np.arange(len(sizes)), sizes)
        window = np.frombuffer(b"".join(bodies), np.int64)
        at = np.arange(len(each)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        cut = b.select(["name", "unit", "least"]).take(pa.array(each))
        yield pa.record_batch([*cut.columns, pa.array(window), pa.array(at.astype(np.int32))], names=["name", "unit", "least", "window", "at"])


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` for every row; ``kept`` is the remaining words joined by a blank.

    A word goes when one of its windows of ``WINDOW`` words also starts in a document with a
    smaller doc_id; windows are judged on the input. A null text has no words. Texts of
    fewer words stay whole. Rows with one doc_id do not remove words of each
    other; a row without a doc_id neither loses words nor takes any.
    """
    docs = texts(docs, id_col, text_col)
    bloom = docs.sparkSession.sparkContext.broadcast(shared_filter(docs, _names_maker, NAMES_PER_SIGN))
    units = units_of(docs, bloom, _unit_maker, bodies=True)
    minima = kept(unit_minima(units), "unit_minima")
    windows = contested(minima).mapInArrow(_windows, "name long, unit long, least long, window long, at int")
    first = windows.groupBy("name", "window").agg(F.min("least").alias("first"))
    late = kept(windows.join(first, ["name", "window"]).where("first < least").select("name", "unit", "at", F.lit(1).alias("n")), "late")
    gone = removals(units, minima, late)
    dropped(units, minima, late)
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for (key, text), removed in zip(rows_of(batch, "doc_id", "text"), removed_of(batch)):
                    words = words_of(text or "")
                    if removed is not None:
                        out = covered(removed, WINDOW, len(words))
                        kept = [w for w, x in zip(words, out.tolist()) if not x]
                    else:
                        kept = words
                    yield key, len(words), len(words) - len(kept), b" ".join(kept).decode("utf-8", "surrogatepass")

        yield from flushed(rows(), schema, 256)

    keyed = docs.withColumn("_k", F.xxhash64("text"))
    gone = gone.select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_t"), "removed")
    found = keyed.join(gone, (F.col("doc_id") == F.col("_d")) & (F.col("_k") == F.col("_t")), "left").select("doc_id", "text", "removed")
    return found.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept string")


SQL = r"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
win AS (SELECT r, doc_id, i, array_to_string(ws[i:i+12], ' ') AS k FROM (SELECT *, unnest(range(1, len(ws) - 11)) AS i FROM w)),
f AS (SELECT k, min(doc_id) AS least FROM win GROUP BY k),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS j FROM win JOIN f USING (k) WHERE least < doc_id),
words AS (SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM w),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY j) AS kept, count(*) AS n FROM words ANTI JOIN gone USING (r, j) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (r)
"""


@query(SQL)
def op7_recompress(spark, d):
    return deduplicated(documents(spark, d)).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
