"""Benchmark decontamination by spaced seeds.

A seed hashes the words that a fixed mask keeps and ignores the others, so it
still meets when the ignored words were replaced. Seeds of test items and of
documents are joined; around each hit the words are compared on the diagonal,
and the longest stretch with few enough replacements counts as an overlap.

Seeds of documents are first looked up in a Bloom filter of the test seeds. Its
size is fixed whatever the number of items, so it can be sent to every task; it
only keeps rows out of the join that cannot match.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.common import documents, flushed, query, rows_of, texts
from freshet.llm.near import pair
from freshet.session import stored
from freshet.sources.tables import table

# Whatever is replaced of 13 words (two), 15 (three), 20 (four) or 25 (five), a seed of one of these masks is left (see the
# tests). Every other allowed stretch of 13 to 25 words holds one of these, and a longer one can be cut into pieces of 13
# to 25 words, of which one at least has no larger share replaced than the whole: so none is without a seed.
MASKS = ("1101111", "11100010011", "1010000101011")
# The same for whole items of LEAST_SHORT to 12 words.
SHORT_MASKS = ("1111", "11011", "10111", "11101")
LEAST = 13
LEAST_SHORT = 5
MOST_REPLACED = 0.2
FILTER_BITS = 25  # 4 MB
PROBES = 3
KEEP_WORDS = 500_000
WORD = re.compile(r"\w+")
# Scripts without blanks between words; each of their signs counts as a word.
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
UNSPACED = re.compile(f"[{_UNSPACED}]")
WORD_OR_SIGN = re.compile(rf"[^\W{_UNSPACED}]+|(?=\w)[{_UNSPACED}]")


class WordHashes(dict):
    """64-bit hashes of words; remembers a bounded number."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KEEP_WORDS:
            self.clear()
        h = self[word] = int.from_bytes(blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return h

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words_of(text: str | None) -> list[str]:
    text = (text or "").lower()
    return (WORD if text.isascii() or not UNSPACED.search(text) else WORD_OR_SIGN).findall(text)


def hashes_of(text: str | None, seen: WordHashes) -> np.ndarray:
    return seen.of(words_of(text))


def seeds(words: np.ndarray, mask: str) -> np.ndarray:
    """The seed that starts at each position."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.full(n, int(mask, 2), np.uint64)
    for i, bit in enumerate(mask):
        if bit == "1":
            h = pair(h, words[i : i + n])
    return h


def _probes(h: np.ndarray) -> np.ndarray:
    """Bit numbers (probe, seed) in the filter."""
    shifts = np.arange(PROBES, dtype=np.uint64)[:, None] * np.uint64(13)
    return (h[None, :] >> shifts) & np.uint64((1 << FILTER_BITS) - 1)


def longest_overlap(same: np.ndarray, most_replaced: float = MOST_REPLACED) -> tuple[int, int]:
    """The longest stretch (start, end) with at most this share of replaced words, equal at both ends; the first of equals."""
    n = len(same)
    best = (0, 0)
    if not same.any():
        return best
    # A stretch is fine when its score is not negative; prefix scores that are new minima can start one.
    prefix = np.concatenate([[0.0], np.cumsum(np.where(same, most_replaced, most_replaced - 1))])
    prefix = np.round(prefix, 9)
    starts = [0]
    for i in range(1, n):
        if prefix[i] < prefix[starts[-1]]:
            starts.append(i)
    end = n
    for s in reversed(starts):
        while end > s and prefix[end] < prefix[s]:
            end -= 1
        a, b = s, end
        while a < b and not same[a]:
            a += 1
        while b > a and not same[b - 1]:
            b -= 1
        if b - a >= best[1] - best[0] and b > a:
            best = (a, b)
        end = n
    return best


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = WordHashes()
    schema = pa.schema([("item_id", pa.int64()), ("n_item", pa.int32()), ("at", pa.int32()), ("seed", pa.int64()), ("item_words", pa.binary())])

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for key, text in rows_of(batch, "doc_id", "text"):
                w = hashes_of(text, seen)
                yield key, len(w), None, None, w.tobytes()
                for mask in MASKS if len(w) >= LEAST else SHORT_MASKS if len(w) >= LEAST_SHORT else ():
                    for at, s in enumerate(seeds(w, mask).view(np.int64).tolist()):
                        yield key, len(w), at, s, None

    yield from flushed(rows(), schema)


def _filter_words(items: DataFrame) -> np.ndarray:
    """The Bloom filter: at most 2**(FILTER_BITS - 6) rows come to the driver, whatever the number of seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = _probes(batch.column("seed").to_numpy().view(np.uint64)).ravel()
            yield pa.record_batch(
                [pa.array((bits >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (bits & np.uint64(63))).view(np.int64))], names=["word", "bits"]
            )

    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    found = items.where("seed IS NOT NULL").select("seed").mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    for word, bits in found.toArrow().to_pandas().itertuples(index=False):
        out[word] = np.uint64(bits & 0xFFFFFFFFFFFFFFFF)
    return out


SUSPECT = "doc_id long, text_key binary, words binary, hits array<struct<seed:long,at:int>>"


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, doc_start, item_start, n_words, n_replaced``: the longest overlap of each document and test item.

    Words are runs of letters, digits and underscores in lower case; in scripts
    without blanks each sign is one. An overlap has at least ``LEAST`` words, at most
    ``MOST_REPLACED`` of them replaced; ties go to the earlier place in the document,
    then in the item. Items of fewer words must appear whole, with the same share
    replaced at any place; items of fewer than five words, and null or empty texts,
    match nothing. Repeated rows give one row; null ids are kept as null
    and are told apart by their text.
    """
    items = stored(texts(items, item_id_col, item_text_col).mapInArrow(_item_rows, "item_id long, n_item int, at int, seed long, item_words binary"), "items")
    known = docs.sparkSession.sparkContext.broadcast(_filter_words(items))
    short = not items.where(f"item_words IS NOT NULL AND n_item BETWEEN {LEAST_SHORT} AND {LEAST - 1}").isEmpty()
    masks = (*MASKS, *SHORT_MASKS) if short else MASKS
    schema = pa.schema(
        [("doc_id", pa.int64()), ("text_key", pa.binary()), ("words", pa.binary()), ("hits", pa.list_(pa.struct([("seed", pa.int64()), ("at", pa.int32())])))]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, bloom = WordHashes(), known.value

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for key, text in rows_of(batch, "doc_id", "text"):
                    w, hits = hashes_of(text, seen), []
                    for mask in masks:
                        s = seeds(w, mask)
                        bit = s & np.uint64((1 << FILTER_BITS) - 1)
                        at = np.flatnonzero((bloom[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1))
                        if len(at):
                            bits = _probes(s[at])
                            at = at[((bloom[bits >> np.uint64(6)] >> (bits & np.uint64(63))) & np.uint64(1)).all(0)]
                        hits += [{"seed": x, "at": p} for x, p in zip(s[at].view(np.int64).tolist(), at.tolist())]
                    if hits:
                        yield key, blake2b(w.tobytes(), digest_size=16).digest(), w.tobytes(), hits

        yield from flushed(rows(), schema, 256)

    suspects = stored(texts(docs, id_col, text_col).mapInArrow(scan, SUSPECT), "suspects")
    asked = suspects.select("doc_id", "text_key", F.explode("hits").alias("hit")).select("doc_id", "text_key", F.col("hit.seed").alias("seed"), F.col("hit.at").alias("doc_at"))
    tests = items.where("seed IS NOT NULL").select("item_id", "n_item", "at", "seed")
    met = asked.join(tests, "seed").select("doc_id", "text_key", "item_id", "n_item", (F.col("doc_at") - F.col("at")).alias("diagonal")).distinct()
    bodies = suspects.select("text_key", "words").groupBy("text_key").agg(F.any_value("words").alias("words"))

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("diagonal", pa.int32()), ("part", pa.binary())])

        def rows() -> Iterator[tuple]:
            for b in batches:
                for key, item, n, diagonal, words in rows_of(b, "doc_id", "item_id", "n_item", "diagonal", "words"):
                    yield key, item, diagonal, words[8 * max(0, diagonal) : 8 * max(0, diagonal + n)]

        yield from flushed(rows(), out)

    parts = met.join(bodies, "text_key").select("doc_id", "item_id", "n_item", "diagonal", "words").mapInArrow(slices, "doc_id long, item_id long, diagonal int, part binary")
    whole = items.where("item_words IS NOT NULL").select(F.col("item_id").alias("_item"), "item_words").distinct()

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("doc_id", "item_id", "doc_start", "item_start", "n_words", "n_replaced")
        out = pa.schema([(n, pa.int64() if n.endswith("id") else pa.int32()) for n in names])

        def rows() -> Iterator[tuple]:
            for b in batches:
                for key, item, diagonal, part, words in rows_of(b, "doc_id", "item_id", "diagonal", "part", "item_words"):
                    x, y = np.frombuffer(part, np.uint64), np.frombuffer(words, np.uint64)
                    first = max(0, -diagonal)
                    same = x == y[first : first + len(x)]
                    start, end = longest_overlap(same)
                    size = end - start
                    if len(y) < LEAST:
                        # The whole item counts, replaced words at its ends too.
                        start, size = 0, len(y)
                        end = size
                        if len(same) < size or size - same.sum() > MOST_REPLACED * size:
                            continue
                    if size >= LEAST or len(y) < LEAST:
                        yield key, item, diagonal + first + start, first + start, size, int(size - same[start:end].sum())

        yield from flushed(rows(), out)

    found = parts.join(whole, F.col("item_id").eqNullSafe(F.col("_item"))).select("doc_id", "item_id", "diagonal", "part", "item_words")
    found = found.mapInArrow(verify, "doc_id long, item_id long, doc_start int, item_start int, n_words int, n_replaced int")
    best = F.min(F.struct((-F.col("n_words")).alias("less"), "doc_start", "item_start", "n_replaced")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "best.doc_start", "best.item_start", (-F.col("best.less")).alias("n_words"), "best.n_replaced"
    )


@query()
def op1_leaks(spark, d):
    return leaks(documents(spark, d), table(spark, d, "benchmark"))
