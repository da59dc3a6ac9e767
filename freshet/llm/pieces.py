"""SentencePiece encoding and decoding by a weighted finite-state transducer.

Compiled once per worker from the public vocabulary: arcs of the normaliser
(a leading blank mark, blanks to marks), one arc per piece, and byte arcs for
signs without a piece. Each input is composed with it, and the shortest path in
the tropical semiring (least sum of weights) is the encoding.

For a unigram vocabulary the weight of an arc is minus the score of its piece.
For a merge (BPE) vocabulary the path is restricted by a second machine whose
state is the last piece: two pieces may follow each other only when merging
their joined text gives just these two. Merges inside pieces do not depend on
what stands further away, so a path of allowed neighbours is the merge result,
and there is one such path.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import documents, query, texts

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
# Segments up to this length are remembered, this many at a time.
REMEMBER_SIGNS, REMEMBER = 32, 300_000
BEHIND = 1 << 60  # a rank behind all others


def read_vocabulary(path: str = MODEL, kind: str = "bpe") -> dict:
    """Pieces, scores and byte ids of a model file, read on the driver."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(m.get_piece_size())
    special = lambda i: m.is_control(i) or m.is_unknown(i) or m.is_unused(i)
    return {
        "kind": kind,
        "pieces": [None if special(i) or m.is_byte(i) else m.id_to_piece(i) for i in ids],
        "scores": [m.get_score(i) for i in ids],
        "bytes": {i: int(m.id_to_piece(i)[3:5], 16) for i in ids if m.is_byte(i)},
        "unknown": m.unk_id(),
    }


class Transducer:
    def __init__(self, vocabulary: dict):
        self.bpe = vocabulary["kind"] == "bpe"
        pieces, self.scores, self.unknown = vocabulary["pieces"], vocabulary["scores"], vocabulary["unknown"]
        self.id_of = {p: i for i, p in enumerate(pieces) if p}
        self.byte_id = {b: i for i, b in vocabulary["bytes"].items()}
        self.prefixes = {p[:n] for p in self.id_of for n in range(1, len(p) + 1)}
        self.out = [(p or "").encode() for p in pieces]
        for i, b in vocabulary["bytes"].items():
            self.out[i] = bytes([b])
        self.worst = min((self.scores[i] for i in self.id_of.values()), default=0.0) - 10
        # A segment may end only where no piece goes on: after a sign before a mark, and around signs of no longer piece.
        inside = {c for p in self.id_of if len(p) > 1 for c in p}
        alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in inside)
        marks_lead = not any(MARK in p.lstrip(MARK) for p in self.id_of)
        one = f"[{alone}]|" if alone else ""
        self.cut = re.compile(f"{one}{MARK}*[^{MARK}{alone}]+|{MARK}+" if marks_lead else f"{one}[^{alone}]+")
        self.seen: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.whole: dict[str, bool] = {}
        self.last: dict[str, str] = {}
        by_score = sorted(self.id_of.items(), key=lambda x: -self.scores[x[1]])
        self.rank_of = {p: i for i, (p, _) in enumerate(by_score)}
        self.splits: dict[str, tuple[str, str] | None] = {}
        self.longest = max(map(len, self.id_of), default=1)

    def split_of(self, piece: str) -> tuple[str, str] | None:
        """The two parts whose merge makes ``piece``; None for a piece that merging never makes.

        Of all neighbours that join to a piece the best score goes first, then the leftmost.
        """
        if piece in self.splits:
            return self.splits[piece]
        part, rank_of = list(piece), self.rank_of
        while len(part) > 2:
            ranks = [rank_of.get(x + y, BEHIND) for x, y in zip(part, part[1:])]
            best = min(ranks)
            if best == BEHIND:
                break
            i = ranks.index(best)
            part[i : i + 2] = [part[i] + part[i + 1]]
        self.splits[piece] = (part[0], part[1]) if len(part) == 2 else None
        return self.splits[piece]

    def neighbours(self, left: str, right: str) -> bool:
        """Whether merging the joined text of two pieces gives just these two.

        The merges of both are undone from the last one on. While two parts face each
        other at the border, joining them must not come before the merge just undone;
        of equal merges the leftmost comes first.
        """
        rank_of, limit = self.rank_of, BEHIND
        while True:
            joined = rank_of.get(left + right)
            if joined is not None and joined < limit:
                return False
            a = rank_of[left] if len(left) > 1 else -1
            b = rank_of[right] if len(right) > 1 else -1
            if a > b:
                limit, left = a, self.split_of(left)[1]
            elif b < 0:
                return True
            else:
                limit, right = b + 1, self.split_of(right)[0]

    def allowed(self, left: str, right: str) -> bool:
        """The second machine: whether ``right`` may follow ``left`` ("" at the start)."""
        own = self.whole.get(right)
        if own is None:
            own = self.whole[right] = len(right) == 1 or self.split_of(right) is not None
        if not own or not left:
            return own
        key = (left, right)
        fits = self.pairs.get(key)
        if fits is None:
            if len(self.pairs) >= REMEMBER:
                self.pairs.clear()
            fits = self.pairs[key] = self.neighbours(left, right)
        return fits

    def shortest(self, segment: str) -> list[str]:
        """The pieces (or single signs without a piece) on the shortest path through ``segment``."""
        return self.path_of_pairs(segment) if self.bpe else self.path_of_weights(segment)

    def path_of_weights(self, segment: str) -> list[str]:
        n = len(segment)
        best: list[tuple[float, int]] = [(0.0, 0)] + [(float("inf"), 0)] * n
        for i in range(n):
            so_far = best[i][0]
            for j in range(i + 1, n + 1):
                arc = segment[i:j]
                k = self.id_of.get(arc)
                if k is not None or j == i + 1:
                    weight = so_far - (self.worst if k is None else self.scores[k])
                    if weight < best[j][0]:
                        best[j] = (weight, i)
                if arc not in self.prefixes:
                    break
        out, at = [], n
        while at:
            out.append(segment[best[at][1] : at])
            at = best[at][1]
        return out[::-1]

    def path_of_pairs(self, segment: str) -> list[str]:
        """All allowed paths have the same weight, and every prefix has exactly one; its last piece is remembered."""
        last, id_of, allowed, longest = self.last, self.id_of, self.allowed, self.longest
        n = len(segment)
        short = n <= REMEMBER_SIGNS
        if short and len(last) >= REMEMBER:
            last.clear()
        ends = last if short else {}  # of a long segment, by position
        at = n
        while at and (segment[:at] if short else at) not in ends:
            at -= 1
        for i in range(at + 1, n + 1):
            for j in range(max(0, i - longest), i):
                arc = segment[j:i]
                if (arc in id_of or j == i - 1) and allowed(ends[segment[:j] if short else j] if j else "", arc):
                    ends[segment[:i] if short else i] = arc
                    break
        out, at = [], n
        while at:
            piece = ends[segment[:at] if short else at]
            out.append(piece)
            at -= len(piece)
        return out[::-1]

    def segment_ids(self, segment: str) -> bytes:
        ids: list[int] = []
        for piece in self.shortest(segment):
            k = self.id_of.get(piece)
            if k is not None:
                ids.append(k)
            elif self.byte_id:
                ids += [self.byte_id[b] for b in piece.encode()]
            else:
                ids.append(self.unknown)
        return np.array(ids, np.int32).tobytes()

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        seen, found = self.seen, []
        for s in self.cut.findall(MARK + text.replace(" ", MARK)):
            ids = seen.get(s)
            if ids is None:
                ids = self.segment_ids(s)
                if len(s) <= REMEMBER_SIGNS:
                    if len(seen) >= REMEMBER:
                        seen.clear()
                    seen[s] = ids
            found.append(ids)
        return np.frombuffer(b"".join(found), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The inverse machine: bytes of pieces, marks to blanks, without the leading mark."""
        text = b"".join(map(self.out.__getitem__, ids.tolist())).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


def machine_of(vocabulary: dict) -> Transducer:
    """Compiled once for each worker: kept in the broadcast value, where later tasks of the worker find it."""
    if "machine" not in vocabulary:
        vocabulary["machine"] = Transducer(vocabulary)
    return vocabulary["machine"]


def encoded(docs: DataFrame, model: str = MODEL, kind: str = "bpe", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids, n_tokens, n_byte_tokens, ids_sha256, decoded, round_trip`` for every row.

    ``decoded`` is the text that the ids decode to; a blank mark in the input comes
    back as a blank. ``round_trip`` says whether it equals the input up to that.
    A null text has null ids and null ``round_trip``, an empty one has no ids.
    Repeated rows and null ids are encoded like any other row.
    """
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(read_vocabulary(model, kind))  # bounded by the vocabulary
    int_list = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = machine_of(vocabulary.value)
        first_byte = np.isin(np.arange(len(machine.out)), list(machine.byte_id.values()))
        for batch in batches:
            rows = batch.column("text").to_pylist()
            lists = [None if t is None else machine.encode(t) for t in rows]
            decoded = [None if x is None else machine.decode(x) for x in lists]
            sizes = np.array([0 if x is None else len(x) for x in lists], np.int64)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            flat = np.concatenate([x for x in lists if x is not None] or [np.empty(0, np.int32)])
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat), mask=pa.array([x is None for x in lists]))
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    ids.cast(int_list),
                    pa.array(sizes),
                    pa.array([0 if x is None else int(first_byte[x].sum()) for x in lists], pa.int64()),
                    pa.array([None if x is None else sha256(x.astype("<i4").tobytes()).hexdigest() for x in lists], pa.string()),
                    pa.array(decoded, pa.string()),
                    pa.array([None if t is None else t.replace(MARK, " ") == o for t, o in zip(rows, decoded)], pa.bool_()),
                ],
                names=["doc_id", "ids", "n_tokens", "n_byte_tokens", "ids_sha256", "decoded", "round_trip"],
            )

    schema = "doc_id long, ids array<int>, n_tokens long, n_byte_tokens long, ids_sha256 string, decoded string, round_trip boolean"
    return texts(docs, id_col, text_col).mapInArrow(run, schema)


def decoded(tokens: DataFrame, spark: SparkSession, model: str = MODEL, kind: str = "bpe", ids_col: str = "ids") -> DataFrame:
    """The rows with a column ``decoded``: the text of ``ids_col``; null ids give null."""
    vocabulary = spark.sparkContext.broadcast(read_vocabulary(model, kind))

    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = machine_of(vocabulary.value)
        for ids in batches:
            yield ids.map(lambda x: None if x is None else machine.decode(np.asarray(x, np.int32)))

    return tokens.withColumn("decoded", text_of(F.col(ids_col)))


@query()
def op3_pieces(spark, d):
    return encoded(documents(spark, d)).select(
        "doc_id", "ids", "n_tokens", "n_byte_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"), "round_trip"
    )
