"""A positional word index: stems with their places, weights of title and text, phrases and ranks.

The index is one row per stem and document, written once in the order of the stems,
so that a lookup reads the row groups of its words only. Tasks gather the places of
many documents by stem before anything is shuffled, and only such gathered lists are.
A stem's documents are dealt to parts, so that a word in every document is no heavier than a part.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.functions.stems import stem_of, with_stems
from freshet.functions.text import tokens
from freshet.operators.keyword import STOP_WORDS
from freshet.session import stored

# Weights of words of the title and of the text, and the sum of 1 / i**2 that ranks are divided by.
TITLE_WEIGHT, TEXT_WEIGHT = 1.0, 0.1
ALL_PLACES = 1.64493406685

PART_SIGNS = 400_000_000  # signs of the documents of a part, about
FLUSH_WORDS = 4_000_000  # words a task holds before it sends them
KNOWN_WORDS = 1_000_000  # words whose stems a task remembers, about
ENTRY_WORDS = 1_000_000  # places whose entries are made at once, about
SENT_ROWS = 1 << 16  # rows of an index that leave a task at once
SENT_KEYS = 200_000  # stems or documents that are sent to the tasks; more are joined


def _stems(words: DataFrame) -> DataFrame:
    """The different words with their stems, written once: filters on the stem would else be pushed into all its rules."""
    return stored(with_stems(words.select("token").distinct()), "stems")


def _scores(count: np.ndarray, in_title: np.ndarray) -> np.ndarray:
    """What a word's places add to a rank: weight / i**2 for its i-th place, title first, over the sum for endless places."""
    pairs, at = np.unique(count.astype(np.int64) << 32 | in_title, return_inverse=True)
    out = np.empty(len(pairs))
    for j, (n, t) in enumerate((p >> 32, p & 0xFFFFFFFF) for p in pairs.tolist()):
        i = np.arange(1, n + 1, dtype=np.float64)
        out[j] = np.cumsum(np.where(i <= t, TITLE_WEIGHT, TEXT_WEIGHT) / (i * i))[-1] / ALL_PLACES
    return out[at]


def _starts(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.empty(0, np.int64)


def _lists(sizes: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), values)


class _Gathered:
    """The words of some documents in a task, until they are sent by stem and part."""

    def __init__(self, stop_words: Sequence[str]):
        self.stop = frozenset(stop_words)
        self.clear()

    def clear(self) -> None:
        self.words: dict[str, int] = {}
        self.numbers: dict[str, int] = {}
        self.sent()

    def sent(self) -> None:
        self.size, self.docs = 0, 0
        self.ids, self.parts, self.titles, self.held = [], [], [], []

    def _number(self, word: str) -> int:
        """The number of the word's stem, -1 for a stop word."""
        stem = None if word in self.stop else stem_of(word)
        at = self.words[word] = -1 if stem is None else self.numbers.setdefault(stem, len(self.numbers))
        return at

    def add(self, batch: pa.RecordBatch) -> None:
        """Rows of ``id, part, title`` (how many words of it) and ``words``."""
        words = batch.column("words")
        known = words.flatten().dictionary_encode()
        get, number = self.words.get, self._number
        of_word = np.array([at if (at := get(w)) is not None else number(w) for w in known.dictionary.to_pylist()], np.int32)
        begin = words.offsets.to_numpy().astype(np.int64)
        sizes = np.diff(begin)
        stem = of_word[known.indices.to_numpy()] if len(of_word) else np.empty(0, np.int32)
        place = np.arange(len(stem), dtype=np.int64) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
        doc = np.repeat(np.arange(batch.num_rows) + self.docs, sizes)
        some = stem >= 0
        self.held.append((stem[some], doc[some].astype(np.int32), place[some].astype(np.int32)))
        self.ids.append(batch.column("id"))
        self.parts.append(batch.column("part").to_numpy())
        self.titles.append(batch.column("title").to_numpy())
        self.docs += batch.num_rows
        self.size += int(some.sum())

    def flush(self) -> Iterator[pa.RecordBatch]:
        """One row per stem and part: its documents, how many places of each are in the title, and the places; the first of a document is negative."""
        stem, doc, place = (np.concatenate(x) for x in zip(*self.held))
        part, title, ids = np.concatenate(self.parts), np.concatenate(self.titles), pa.concat_arrays(self.ids)
        names = pa.array(list(self.numbers))
        # The words stand in the order of documents and places, which stays.
        order = np.argsort(stem.astype(np.int64) * (int(part.max(initial=0)) + 1) + part[doc], kind="stable")
        stem, doc, place = stem[order], doc[order], place[order]
        first = _starts(stem.astype(np.int64) << 32 | doc)  # the documents of a stem are of one part each
        in_title = np.add.reduceat(place <= title[doc], first, dtype=np.int32) if len(first) else np.empty(0, np.int32)
        place[first] *= -1
        one = _starts(stem[first].astype(np.int64) << 32 | part[doc[first]])
        docs, places = np.diff(one, append=len(first)), np.diff(first[one], append=len(place))
        for a in range(0, len(one), SENT_ROWS):
            b = min(a + SENT_ROWS, len(one))
            x, y = one[a], one[b] if b < len(one) else len(first)
            p, q = first[x], first[y] if y < len(first) else len(place)
            held = [_lists(docs[a:b], ids.take(pa.array(doc[first[x:y]]))), _lists(docs[a:b], pa.array(in_title[x:y])), _lists(places[a:b], pa.array(place[p:q]))]
            keys = [names.take(pa.array(stem[first[one[a:b]]])), pa.array(part[doc[first[one[a:b]]]])]
            yield pa.record_batch([*keys, *held], names=["stem", "part", "ids", "in_title", "places"])


def _gathered(docs: DataFrame, key: str, text: str, title: str | None, stop_words: Sequence[str]) -> DataFrame:
    """``stem, part, ids, in_title, places``: gathered lists of the places of stems, several rows per stem and part."""
    signs = docs.agg(F.sum(F.length(text))).first()[0] or 0
    parts = max(1, -(-signs // PART_SIGNS))
    id_type = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Gathered(stop_words)
        for batch in batches:
            held.add(batch)
            if held.size >= FLUSH_WORDS:
                yield from held.flush()
                held.clear() if len(held.words) >= KNOWN_WORDS else held.sent()
        if held.size:
            yield from held.flush()

    part = F.pmod(F.xxhash64(key), F.lit(parts)).cast("int").alias("part")  # rows of one id are in one part
    begin = F.size(tokens(title)) if title else F.lit(0)
    words = F.concat(*[tokens(c) for c in (title, text) if c]).alias("words")
    rows = docs.select(F.col(key).alias("id"), part, begin.cast("int").alias("title"), words)
    return rows.mapInArrow(run, f"stem string, part int, ids array<{id_type}>, in_title array<int>, places array<int>")


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The gathered lists as one row per stem and document; rows of one id count together, in the order of the places."""
    for batch in batches:
        # Some rows at once, of about ENTRY_WORDS places.
        cut = np.cumsum(np.diff(batch.column("places").offsets.to_numpy().astype(np.int64))) // ENTRY_WORDS
        begin = _starts(cut).tolist()
        for a, b in zip(begin, [*begin[1:], batch.num_rows]):
            out = _entry_rows(batch.slice(a, b - a))
            for at in range(0, out.num_rows, SENT_ROWS):
                yield out.slice(at, SENT_ROWS)


def _entry_rows(rows: pa.RecordBatch) -> pa.RecordBatch:
    ids, in_title, place = (rows.column(c).flatten() for c in ("ids", "in_title", "places"))
    in_title, place = in_title.to_numpy(), place.to_numpy()
    row = np.repeat(np.arange(rows.num_rows), np.diff(rows.column("ids").offsets.to_numpy()))
    sizes = np.diff(np.flatnonzero(place < 0), append=len(place))
    place = np.abs(place)
    doc = ids.dictionary_encode(null_encoding="encode")
    key = row * len(doc.dictionary) + doc.indices.to_numpy()
    order = np.argsort(key, kind="stable")
    new = _starts(key[order])
    if len(new) < len(key):
        own = np.empty(len(key), np.int64)
        own[order] = np.repeat(np.arange(len(new)), np.diff(new, append=len(key)))
        place = place[np.lexsort((place, np.repeat(own, sizes)))]
        in_title, sizes = (np.add.reduceat(x[order], new) for x in (in_title, sizes))
        ids, row = ids.take(pa.array(order[new])), row[order[new]]
    held = [ids, _lists(sizes, pa.array(place)), pa.array(in_title.astype(np.int32)), pa.array(_scores(sizes, in_title))]
    return pa.record_batch([rows.column("stem").take(pa.array(row)), *held], names=["stem", "id", "positions", "in_title", "score"])


def word_index(
    docs: DataFrame, key: str = "id", text: str = "content", title: str | None = "title", stop_words: Sequence[str] = STOP_WORDS
) -> DataFrame:
    """``stem, id, positions, in_title, score``: sorted places of each stem in each row, the title's before the text's.

    Words of ``stop_words`` have no entry but count as places. Null texts have no words. Rows are in ranges of their
    stems and in the order of these; a frequent stem may fill several ranges. The texts are read once and their gathered
    words stored; these alone are shuffled. (An action.)
    """
    parts = stored(_gathered(docs, key, text, title, stop_words), "gathered")
    lists = [F.flatten(F.collect_list(c)).alias(c) for c in ("ids", "in_title", "places")]
    whole = parts.repartitionByRange("stem", "part").groupBy("stem", "part").agg(*lists).sortWithinPartitions("stem", "part")
    id_type = docs.schema[key].dataType.simpleString()
    return whole.mapInArrow(_entries, f"stem string, id {id_type}, positions array<int>, in_title int, score double")


def write_index(index: DataFrame, path: str) -> None:
    """Store the index as ``word_index`` gives it, in the order of its stems, and ``documents`` per stem beside it. (An action.)"""
    index.write.mode("overwrite").parquet(f"{path}/postings")
    stored = index.sparkSession.read.parquet(f"{path}/postings")
    stored.groupBy("stem").agg(F.count(F.lit(1)).alias("documents")).write.mode("overwrite").parquet(f"{path}/stems")


def read_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The postings and the number of documents per stem."""
    return spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/stems")


def query_stems(queries: DataFrame, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """``query_id, stem, places``: the different stems of each query (``query_id, query``) and where they stand in it."""
    words = queries.select("query_id", F.posexplode(tokens("query")).alias("position", "token")).where(~F.col("token").isin(*stop_words))
    stems = _stems(words)
    return words.join(stems, "token").groupBy("query_id", "stem").agg(F.sort_array(F.collect_list("position")).alias("places"))


def _sent(few: DataFrame) -> DataFrame:
    """To be sent to the tasks in a join when it has at most ``SENT_KEYS`` rows; otherwise both sides meet by key."""
    return F.broadcast(few) if few.limit(SENT_KEYS + 1).count() <= SENT_KEYS else few


def match_all(postings: DataFrame, stems: DataFrame, asked: DataFrame) -> DataFrame:
    """``query_id, id, rank, phrase``: documents that hold every stem of a query (``query_stems``).

    ``rank`` is the mean of the words' scores. ``phrase`` says whether the words stand in the document just as
    they stand in the query, stop words in between counted. A query without words matches nothing.

    Documents of a query's rarest stem are its candidates. The entries of these for all asked stems are
    gathered by document once, and each candidate is compared with its query's words in one expression.
    """
    asked = stored(asked, "asked")
    known = asked.join(stems, "stem", "left")
    # A stem in no document leaves its query without candidates.
    rarest = known.groupBy("query_id").agg(F.min(F.struct(F.coalesce("documents", F.lit(0)).alias("n"), "stem"))["stem"].alias("stem"))
    used = postings.join(_sent(asked.select("stem").distinct()), "stem", "left_semi")
    # Stored, as the postings are read for them once; entries of other documents are not shuffled while they are few.
    candidates = stored(postings.select("stem", "id").join(_sent(rarest), "stem").select("query_id", "id"), "candidates")
    entry = F.struct("stem", F.struct("positions", "score").alias("e"))
    held = used.join(_sent(candidates.select("id").distinct()), "id", "left_semi").groupBy("id").agg(F.map_from_entries(F.collect_list(entry)).alias("held"))
    wanted = asked.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("stem", "places"))).alias("wanted"))
    met = candidates.join(held, "id").join(wanted, "query_id")
    met = met.where(F.forall("wanted", lambda w: F.map_contains_key(F.col("held"), w["stem"])))
    total = F.aggregate("wanted", F.lit(0.0), lambda acc, w: acc + F.col("held")[w["stem"]]["score"])
    # Where the query would have to begin for a word to stand in its place; a phrase has a beginning that suits all.
    begins = F.flatten(F.transform("wanted", lambda w: F.transform(w["places"], lambda p: F.transform(F.col("held")[w["stem"]]["positions"], lambda x: x - p))))
    met = met.select("query_id", "id", (total / F.size("wanted")).alias("rank"), begins.alias("_b"))
    common = F.aggregate("_b", F.element_at("_b", 1), lambda acc, x: F.array_intersect(acc, x))
    return met.select("query_id", "id", "rank", (F.size(common) > 0).alias("phrase"))


def ranked_search(postings: DataFrame, stems: DataFrame, queries: DataFrame, k: int, phrase_only: bool = False) -> DataFrame:
    """``query_id, id, place, rank, phrase``: the best ``k`` documents of each query, phrases first, ties to the smaller id."""
    found = match_all(postings, stems, query_stems(queries))
    if phrase_only:
        found = found.where("phrase")
    best = Window.partitionBy("query_id").orderBy(F.col("phrase").desc(), F.round("rank", 9).desc(), "id")
    return found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)
