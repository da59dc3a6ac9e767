"""Two tokenizers over the same texts: which tokens of one meet which of the other.

Both token sequences cover the same bytes. All documents of a batch are walked at
once: one NumPy state holds, for every walker, its place in the A tokens and in
the B tokens. A step links the two tokens of each walker, marks a cut where both
end, moves the one that ends first (both at a cut) and lets go of walkers that are
done. A text longer than ``LANE`` bytes is walked by several walkers, each from
its own byte on, so a very long text does not hold up the others.

Both tokenizers cut at a blank that follows a visible sign (each vocabulary is asked
whether it does), so what stands between such blanks is tokenized once in a task and remembered.

How many documents hold a linked pair of ids is summed within each task before
the exchange. The most frequent pairs, at most ``FREQUENT``, go to all tasks;
links of other pairs find their counts by a join.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import documents, flushed, kept, query, rows_of, texts

A_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
B_VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
VOCABULARY_BYTES = 64 << 20  # a larger vocabulary file is refused
LANE = 1 << 10  # bytes of a text that one walker covers
SLICE = 1 << 20  # bytes of text walked at once
FREQUENT = 1 << 20  # pairs of ids sent to all tasks
HELD_PAIRS = 1 << 21  # different pairs a task holds before it sends their counts
KNOWN_PARTS = 1 << 19  # parts of texts whose tokens a task remembers, and
KNOWN_SIGNS = 1 << 24  # how many signs they have in all
TOGETHER = 512  # parts tokenized as one text


def vocabulary(spark: SparkSession, path: str) -> bytes:
    """A vocabulary file from any path that Spark reads."""
    found = spark.read.format("binaryFile").load(path).where(F.col("length") <= VOCABULARY_BYTES).select("content").head()
    if found is None:
        raise ValueError(f"no vocabulary of at most {VOCABULARY_BYTES} bytes at {path}")
    return bytes(found[0])


def _byte_of_sign() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: visible Latin-1 signs for themselves, the rest from U+0100 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteLevel:
    """Tokenizer A: ids of space + text, and the bytes of each id."""

    def __init__(self, raw: bytes):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(raw.decode())
        spec = json.loads(raw)
        # Words are told apart by the usual pattern, in which a blank opens what follows it.
        self.cuts_at_blanks = spec["normalizer"] is None and (spec["pre_tokenizer"] or {}).get("type") == "ByteLevel" and spec["pre_tokenizer"].get("use_regex", True)
        self.model.encode_special_tokens = True
        byte = _byte_of_sign()
        known = self.model.get_vocab(with_added_tokens=True)
        self.tokens = [b""] * (max(known.values()) + 1)
        for token, i in known.items():
            self.tokens[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()

    def __call__(self, found: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast([" " + t for t in found], add_special_tokens=False)]


class Pieces:
    """Tokenizer B: ids of text, to which it adds the space itself, and the bytes of each id."""

    def __init__(self, raw: bytes):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_proto=raw)
        size = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(size)]
        self.cuts_at_blanks = not any("▁" in p.lstrip("▁") for p in pieces)
        self.tokens = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]

    def __call__(self, found: list[str]) -> list[list[int]]:
        return self.model.encode(found, num_threads=1)


def lockstep(end_a: np.ndarray, end_b: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """All walkers at once over two cuttings of the same bytes.

    ``end_a`` and ``end_b`` are the bytes at which tokens end, rising. A walker emits the links
    whose common bytes begin in its ``[begin, stop)``. Gives the linked token numbers (of A,
    of B), and for the tokens of A and of B whether they end at a cut.
    """
    i, j = np.searchsorted(end_a, begin, "right"), np.searchsorted(end_b, begin, "right")
    first = np.maximum(np.where(i > 0, end_a[i - 1], 0), np.where(j > 0, end_b[j - 1], 0))
    # What the walker before has linked already is passed over.
    early = first < begin
    p = np.minimum(end_a[i], end_b[j])
    i, j = i + (early & (end_a[i] == p)), j + (early & (end_b[j] == p))
    on = ~early | (p < stop)
    i, j, stop = i[on], j[on], stop[on]
    cut_a, cut_b = np.zeros(len(end_a), bool), np.zeros(len(end_b), bool)
    links_a, links_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    while len(i):
        links_a.append(i)
        links_b.append(j)
        a, b = end_a[i], end_b[j]
        p = np.minimum(a, b)
        a, b = a == p, b == p
        both = a & b
        cut_a[i[both]] = True
        cut_b[j[both]] = True
        i, j = i + a, j + b
        on = p < stop
        if not on.all():
            i, j, stop = i[on], j[on], stop[on]
    return np.concatenate(links_a), np.concatenate(links_b), cut_a, cut_b


def packed(numbers: np.ndarray) -> bytes:
    """Numbers as bytes, the lowest bytes of all first, so that the high ones compress away."""
    width = 4 if not len(numbers) or int(numbers.max()) < 1 << 32 else 8
    plane = numbers.astype(f"<u{width}").view(np.uint8).reshape(-1, width)
    return bytes([width]) + plane.T.tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    plane = np.frombuffer(raw, np.uint8, offset=1).reshape(raw[0], -1)
    return np.ascontiguousarray(plane.T).view(f"<u{raw[0]}").ravel().astype(np.int64)


class Tokens:
    """The tokens of parts of texts, in one flat array with the begin of each part."""

    def __init__(self, model: ByteLevel | Pieces):
        self.model = model
        self.width = np.fromiter(map(len, model.tokens), np.int64)
        self.clear()

    def clear(self) -> None:
        self.flat, self.begin = array("i"), array("q", [0])
        self.whole = bytearray()

    def add(self, parts: list[str]) -> None:
        """Parts that end in a visible sign are tokenized as one text, which is cut where they meet; others one by one."""
        at = 0
        while at < len(parts):
            size = 1
            if not parts[at][-1:].isspace():
                size = next((i for i, p in enumerate(parts[at : at + TOGETHER]) if p[-1:].isspace()), min(TOGETHER, len(parts) - at))
            self._add(parts[at : at + size])
            at += size

    def _add(self, parts: list[str]) -> None:
        ids = self.model([" ".join(parts)])[0]
        raw = [b" " + p.encode() for p in parts]
        if b"".join(map(self.model.tokens.__getitem__, ids)) == b"".join(raw):
            ends = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum([len(r) for r in raw])) + 1
            self.begin.extend((len(self.flat) + ends).tolist())
            self.flat.extend(ids)
            self.whole.extend(b"\1" * len(parts))
        elif len(parts) > 1:
            for p in parts:
                self._add([p])
        else:
            self.begin.append(len(self.flat))
            self.whole.append(0)

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of the numbered parts, one after the other, and how many each has."""
        begin = np.frombuffer(self.begin, np.int64)
        first, size = begin[numbers], begin[numbers + 1] - begin[numbers]
        place = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return np.array(np.frombuffer(self.flat, np.int32)[place], np.int64) if len(place) else np.empty(0, np.int64), size


class Aligner:
    """Aligned tokens of a list of texts."""

    def __init__(self, raw_a: bytes, raw_b: bytes):
        self.a, self.b = ByteLevel(raw_a), Pieces(raw_b)
        self.size_a, self.size_b = len(self.a.tokens), len(self.b.tokens)
        # Each id in decimal with the sign behind it: "," within a group, "|" or ";" at its end.
        self.written = [f"{i}{s}" for size, signs in ((self.size_a, ",|"), (self.size_b, ",;")) for s in signs for i in range(size)]
        self.in_parts = self.a.cuts_at_blanks and self.b.cuts_at_blanks
        self.number: dict[str, int] = {}
        self.signs = 0
        self.tokens = Tokens(self.a), Tokens(self.b)

    def parts(self, text: str) -> list[str]:
        """Space + text, cut before each blank that follows a visible sign; the parts without their first blank."""
        if not text or not self.in_parts:
            return [text] if text else []
        if text[-1] != " " and not re.search(r"(^|\s) ", text):
            return text.split(" ")
        out = re.split(r"(?s)(?<=\S) (?=.)", " " + text)
        return [out[0][1:], *out[1:]]

    def _numbered(self, parts: list[str]) -> np.ndarray:
        new = [p for p in dict.fromkeys(parts) if p not in self.number]
        if new:
            self.signs += sum(map(len, new))
            if len(self.number) + len(new) > KNOWN_PARTS or self.signs > KNOWN_SIGNS:
                self.number.clear()
                new = list(dict.fromkeys(parts))
                self.signs = sum(map(len, new))
                for t in self.tokens:
                    t.clear()
            base = len(self.number)
            self.number.update((p, base + i) for i, p in enumerate(new))
            for t in self.tokens:
                t.add(new)
        return np.fromiter(map(self.number.__getitem__, parts), np.int64, len(parts))

    def __call__(self, found: list[str]) -> tuple:
        """Per text (n_a, n_b, n_groups, n_links, groups), and number of text, pair, and times of every different link, sorted."""
        cut = [self.parts(t) for t in found]
        numbers = self._numbered([p for parts in cut for p in parts])
        doc = np.repeat(np.arange(len(found)), [len(p) for p in cut])
        whole = np.ones(len(found), bool)
        for t in self.tokens:
            whole[doc[np.frombuffer(t.whole, np.uint8)[numbers] == 0]] = False
        numbers, doc = numbers[whole[doc]], doc[whole[doc]]
        (a, of_a), (b, of_b) = (t.of(numbers) for t in self.tokens)
        sizes = np.stack([np.bincount(doc, n, len(found)).astype(np.int64) for n in (of_a, of_b)])
        end_a, end_b = np.cumsum(self.tokens[0].width[a]), np.cumsum(self.tokens[1].width[b])
        ends = np.concatenate([[0], end_a])[np.concatenate([[0], np.cumsum(sizes[0])])]
        width = np.diff(ends)
        # Walkers: every LANE bytes of every text.
        lanes = -(-width // LANE)
        nth = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        last = np.repeat(np.cumsum(width), lanes)
        begin = last - np.repeat(width, lanes) + nth * LANE
        link_a, link_b, cut_a, cut_b = lockstep(end_a, end_b, begin, np.minimum(begin + LANE, last))
        doc_a, doc_b = (np.repeat(np.arange(len(found)), n) for n in sizes)
        pairs = self.size_a * self.size_b
        key, times = np.unique(doc_a[link_a] * pairs + a[link_a] * self.size_b + b[link_b], return_counts=True)
        n_links = np.bincount(doc_a[link_a], minlength=len(found))
        n_groups = np.bincount(doc_a[cut_a], minlength=len(found))
        # Tokens in the order groups are written: by group, those of A first.
        group = np.concatenate([np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b]) * 2
        group[len(a) :] += 1
        sign = np.concatenate([a + self.size_a * cut_a, 2 * self.size_a + b + self.size_b * cut_b])
        order = np.argsort(group, kind="stable")
        upto = np.cumsum(sizes.sum(0))
        sign = sign[order].tolist()
        write = self.written.__getitem__
        groups = ["".join(map(write, sign[e - n : e]))[:-1] for e, n in zip(upto.tolist(), sizes.sum(0).tolist())]
        return (sizes[0], sizes[1], n_groups, n_links, groups), key // pairs, key % pairs, times


DOC_FIELDS = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs binary, times binary"


def aligned(docs: DataFrame, a: str = A_VOCABULARY, b: str = B_VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The alignment of every row, and rows with counts of pairs.

    Rows of documents: ``row`` (a number of its own), ``doc_id, n_a, n_b, n_groups, n_links, groups``
    (``a1,a2|b1;a3|b2,b3``), and the different linked id pairs with how often each is linked, packed.
    Rows of counts: ``pair`` (id of A * size of B + id of B) and ``n_docs``, the rest null; a pair can
    have several. Texts that are null, empty, or whose tokens do not give back space + text have no
    tokens: zeros and an empty ``groups``. Repeated rows and rows without a doc_id are documents of
    their own. Special tokens within texts are plain text.
    """
    spark = docs.sparkSession
    raw_a, raw_b = (spark.sparkContext.broadcast(vocabulary(spark, path)) for path in (a, b))
    schema = pa.schema(
        [(n, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[t]) for n, t in (f.split() for f in DOC_FIELDS.split(", "))]
        + [("pair", pa.int64()), ("n_docs", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = Aligner(raw_a.value, raw_b.value)
        seen, counts = np.empty(0, np.int64), np.empty(0, np.int64)

        def tally() -> Iterator[tuple]:
            for pair, n in zip(seen.tolist(), counts.tolist()):
                yield (None,) * 9 + (pair, n)

        for rows in _slices(batches):
            found = [r[2] or "" for r in rows]
            (n_a, n_b, n_groups, n_links, groups), doc, pair, times = align(found)
            edge = np.searchsorted(doc, np.arange(len(rows) + 1))
            out = []
            for d, (row, key, _) in enumerate(rows):
                lo, hi = edge[d], edge[d + 1]
                links = (packed(np.diff(pair[lo:hi], prepend=0)), packed(times[lo:hi]))
                out.append((row, key, int(n_a[d]), int(n_b[d]), int(n_groups[d]), int(n_links[d]), groups[d], *links, None, None))
            yield from flushed(iter(out), schema, 256)
            new, n = np.unique(pair, return_counts=True)
            seen, back = np.unique(np.concatenate([seen, new]), return_inverse=True)
            counts = np.bincount(back, np.concatenate([counts, n]), len(seen)).astype(np.int64)
            if len(seen) > HELD_PAIRS:
                yield from flushed(tally(), schema, 1 << 15)
                seen, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        yield from flushed(tally(), schema, 1 << 15)

    known = texts(docs, id_col, text_col).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return known.mapInArrow(run, DOC_FIELDS + ", pair long, n_docs long")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows (row, doc_id, text) in lists of about ``SLICE`` signs; a longer text is a list of its own."""
    held, size = [], 0
    for batch in batches:
        for row in rows_of(batch, "row", "doc_id", "text"):
            held.append(row)
            size += len(row[2] or "")
            if size >= SLICE:
                yield held
                held, size = [], 0
    if held:
        yield held


def pair_counts(found: DataFrame, size_b: int) -> DataFrame:
    """``pair, n_docs, best``: in how many documents a pair is linked, and whether no pair of the same A id is in more."""
    counts = kept(found.where("pair IS NOT NULL").groupBy("pair").agg(F.sum("n_docs").alias("n_docs")), "pair_counts")
    of_a = F.floor(F.col("pair") / size_b).alias("a")
    best = counts.groupBy(of_a).agg(F.max("n_docs").alias("_most"))
    return counts.withColumn("a", of_a).join(best, "a").select("pair", "n_docs", (F.col("n_docs") == F.col("_most")).alias("best"))


def _frequent_from(counts: DataFrame, most: int) -> int:
    """The least power of two so that at most ``most`` pairs are in as many documents or more."""
    power = F.floor(F.log2("n_docs") + 1e-9).cast("int").alias("power")
    total = 0
    for power, n in sorted((tuple(r) for r in counts.groupBy(power).agg(F.count(F.lit(1))).collect()), reverse=True):  # at most 63 rows
        total += n
        if total > most:
            return 1 << (power + 1)
    return 1


def scored(found: DataFrame, size_b: int, frequent: int = FREQUENT) -> DataFrame:
    """The document rows of a stored ``aligned`` table with ``n_best`` and ``count_sum``.

    ``n_best``: links whose pair is in as many documents as any pair of the same A id. ``count_sum``: the
    documents of its pair, summed over all links.
    """
    spark = found.sparkSession
    counts = kept(pair_counts(found, size_b), "pairs")
    limit = _frequent_from(counts, frequent)
    top = counts.where(F.col("n_docs") >= limit).toArrow()  # at most ``frequent`` rows of 17 bytes
    order = np.argsort(top.column("pair").to_numpy())
    table = spark.sparkContext.broadcast([top.column(c).to_numpy(zero_copy_only=False)[order] for c in ("pair", "n_docs", "best")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n_docs, best = table.value
        for batch in batches:
            if not batch.num_rows:
                continue
            gaps = [unpacked(x) for x in batch.column("pairs").to_pylist()]
            times = np.concatenate([unpacked(x) for x in batch.column("times").to_pylist()])
            doc = np.repeat(np.arange(len(gaps)), [len(g) for g in gaps])
            pair = np.concatenate([np.cumsum(g) for g in gaps])
            at = np.minimum(np.searchsorted(pairs, pair), max(len(pairs) - 1, 0))
            known = pairs[at] == pair if len(pairs) else np.zeros(len(pair), bool)
            sums = []
            for value in (best, n_docs):
                each = np.zeros(len(pair), np.int64)
                each[known] = value[at[known]] * times[known]
                total = np.concatenate([[0], np.cumsum(each)])
                edge = np.searchsorted(doc, np.arange(len(gaps) + 1))
                sums.append(pa.array(total[edge[1:]] - total[edge[:-1]]))
            rare = ~known
            offsets = np.searchsorted(doc[rare], np.arange(len(gaps) + 1))
            lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(x[rare], pa.int64())) for x in (pair, times)]
            plain = batch.drop_columns(["pairs", "times"])
            yield pa.RecordBatch.from_arrays([*plain.columns, *sums, *lists], names=[*plain.schema.names, "_best", "_sum", "_pairs", "_times"])

    docs = found.where("row IS NOT NULL").drop("pair", "n_docs")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema if f.name not in ("pairs", "times"))
    part = kept(docs.mapInArrow(run, fields + ", _best long, _sum long, _pairs array<long>, _times array<long>"), "part_sums")
    rare = part.where("size(_pairs) > 0").select("row", F.explode(F.arrays_zip("_pairs", "_times")).alias("x")).select("row", F.col("x._pairs").alias("pair"), F.col("x._times").alias("t"))
    rest = rare.join(counts.where(F.col("n_docs") < limit), "pair").groupBy("row")
    rest = rest.agg(F.sum(F.col("t") * F.col("best").cast("long")).alias("_more_best"), F.sum(F.col("t") * F.col("n_docs")).alias("_more_sum"))
    out = part.drop("_pairs", "_times").join(rest, "row", "left")
    return out.select(
        *[c for c in docs.columns if c not in ("row", "pairs", "times")],
        (F.col("_best") + F.coalesce("_more_best", F.lit(0))).alias("n_best"), (F.col("_sum") + F.coalesce("_more_sum", F.lit(0))).alias("count_sum"),
    )


def alignment(docs: DataFrame, a: str = A_VOCABULARY, b: str = B_VOCABULARY, frequent: int = FREQUENT, **columns: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum`` of every row; see ``aligned`` and ``scored``."""
    size_b = len(Pieces(vocabulary(docs.sparkSession, b)).tokens)
    digest = F.when(F.col("groups") != "", F.sha2("groups", 256)).when(F.col("groups") == "", "").alias("groups_sha256")
    found = aligned(docs, a, b, **columns).select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", digest, "pairs", "times", "pair", "n_docs")
    return scored(kept(found, "aligned"), size_b, frequent)


@query()
def op11_alignment(spark, d):
    return alignment(documents(spark, d))
