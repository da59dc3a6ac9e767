"""Language of text by a linear-chain conditional random field over words.

Each word has hashed affix, n-gram and lexicon features; learned transitions tie
neighbouring words together, and forward-backward gives each word a probability
for every language. So text that switches between languages is labelled word by
word, and a document's language is the one with the largest expected share.

Training uses a bounded sample of labelled rows (``per_label`` documents of each
label, ``SNIPPETS`` runs of words from each), cut and joined to sequences that
switch language, so that the transitions are learned too.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freshet.llm.common import documents, flushed, query, rows_of, small_batches, texts

WORD = re.compile(r"[^\W\d_]+")
BUCKETS = 1 << 15
PER_LABEL, SNIPPETS, SNIPPET_WORDS = 400, 3, 24
LEXICON_WORDS, EPOCHS, RATE, DECAY = 300, 30, 0.5, 1e-4
CHUNK = 32
BATCH_WORDS = 100_000
REMEMBER = 200_000
UNKNOWN = "und"


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # BUCKETS x labels
    transitions: np.ndarray  # labels x labels
    first: np.ndarray
    lexicon: dict[str, int]  # word -> bit set of the labels whose common words have it
    tagger: Tagger | None = None


def words_of(text: str | None) -> list[str]:
    found = WORD.findall(text.lower()) if text else []
    if found and not any(map(str.isalpha, found)) and not any(c.isalpha() for w in found for c in w):
        return []
    return found


class _Buckets(dict):
    """The bucket of a feature's name; a bounded number is remembered, as words share most of their affixes and n-grams."""

    def __missing__(self, name: str) -> int:
        if len(self) >= REMEMBER:
            self.clear()
        found = self[name] = crc32(name.encode()) % BUCKETS
        return found


_BUCKET = _Buckets()


def features(word: str, lexicon: dict[str, int]) -> list[int]:
    """Hashed affixes of one to four signs, n-grams of two and three, and the word's lexicons."""
    marked = f"^{word[:64]}$" if len(word) <= 64 else f"^{word[:32]}{word[-32:]}$"
    names = {f"p{word[:n]}" for n in (1, 2, 3, 4)} | {f"s{word[-n:]}" for n in (1, 2, 3, 4)}
    names.update([marked[i : i + 2] for i in range(len(marked) - 1)], [marked[i : i + 3] for i in range(len(marked) - 2)])
    bits, label = lexicon.get(word, 0), 0
    while bits:
        if bits & 1:
            names.add(f"l{label}")
        bits, label = bits >> 1, label + 1
    found = [_BUCKET[x] for x in names]
    found.append(crc32(f"w{marked}".encode()) % BUCKETS)  # of one word only, not worth remembering
    return found


def sample(docs: DataFrame, label_col: str, per_label: int = PER_LABEL) -> DataFrame:
    """``label`` and ``words``: runs of words from at most ``per_label`` different texts of each label, by their hash."""
    small_batches(docs.sparkSession)
    known = docs.select(F.col("text").cast("string").alias("text"), F.col(label_col).cast("string").alias("label")).where("text IS NOT NULL AND label IS NOT NULL")
    known = known.withColumn("_h", F.xxhash64("text"))
    order = Window.partitionBy("label").orderBy("_h")
    least = known.select("label", "_h").distinct().withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= per_label)
    # A row per label, as the model has; the texts need not be dealt by label for it.
    last = least.groupBy("label").agg(F.max("_h").alias("_last"))
    chosen = known.join(F.broadcast(last), "label").where("_h <= _last").groupBy("label", "_h").agg(F.min("text").alias("text")).select("label", "text")
    schema = pa.schema([("label", pa.string()), ("words", pa.list_(pa.string()))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def runs():
            for b in batches:
                for label, text in rows_of(b, "label", "text"):
                    words = words_of(text)
                    for k in range(SNIPPETS if words else 0):
                        at = max(0, len(words) - SNIPPET_WORDS) * k // max(1, SNIPPETS - 1)
                        yield label, words[at : at + SNIPPET_WORDS]

        yield from flushed(runs(), schema)

    return chosen.mapInArrow(cut, "label string, words array<string>")


def forward_backward(e: np.ndarray, a: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals (n, t, l) and pair marginals summed over time (l, l) for n sequences of one length.

    ``e`` (n, t, l), ``a`` (l, l) and ``first`` (l) are exponentials of scores.
    """
    n, steps, k = e.shape
    alpha = np.empty_like(e)
    alpha[:, 0] = first * e[:, 0]
    alpha[:, 0] /= alpha[:, 0].sum(1, keepdims=True)
    for t in range(1, steps):
        x = (alpha[:, t - 1] @ a) * e[:, t]
        alpha[:, t] = x / x.sum(1, keepdims=True)
    beta = np.ones((n, k), e.dtype)
    gamma, pairs = np.empty_like(e), np.zeros((k, k))
    for t in range(steps - 1, -1, -1):
        g = alpha[:, t] * beta
        gamma[:, t] = g / g.sum(1, keepdims=True)
        if t:
            right = e[:, t] * beta
            joint = alpha[:, t - 1][:, :, None] * a[None] * right[:, None, :]
            pairs += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
            beta = right @ a.T
            beta /= beta.sum(1, keepdims=True)
    return gamma, pairs


def train(snippets: list[tuple[str, list[str]]], seed: int = 7) -> Model | None:
    """Gradient ascent on the conditional likelihood; None without labelled words."""
    snippets = sorted((lab, list(w)) for lab, w in snippets if w)
    labels = sorted({lab for lab, _ in snippets})
    if not labels:
        return None
    number = {lab: i for i, lab in enumerate(labels)}
    counts: dict[str, Counter] = {lab: Counter() for lab in labels}
    for lab, words in snippets:
        counts[lab].update(words)
    lexicon: dict[str, int] = {}
    for lab in labels:
        for w, _ in sorted(counts[lab].items(), key=lambda x: (-x[1], x[0]))[:LEXICON_WORDS]:
            lexicon[w] = lexicon.get(w, 0) | 1 << number[lab]
    rng = np.random.default_rng(seed)
    length, k = 2 * SNIPPET_WORDS, len(labels)
    words: list[str] = []
    gold: list[int] = []
    for i in rng.permutation(len(snippets)):
        lab, run = snippets[i]
        run = run[: int(rng.integers(4, SNIPPET_WORDS + 1))]
        words += run
        gold += [number[lab]] * len(run)
    while len(words) < length:
        words, gold = words * 2, gold * 2
    n = len(words) // length
    words, y = words[: n * length], np.array(gold[: n * length]).reshape(n, length)
    vocabulary = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = [features(w, lexicon) for w in vocabulary]
    flat = np.concatenate([np.array(f) for f in ids])
    owner = np.repeat(np.arange(len(ids)), [len(f) for f in ids])
    at = np.array([vocabulary[w] for w in words]).reshape(n, length)
    starts = np.concatenate([[0], np.cumsum([len(f) for f in ids])[:-1]])
    model = Model(labels, np.zeros((BUCKETS, k)), np.zeros((k, k)), np.zeros(k), lexicon)
    one_hot = np.eye(k)[y]
    gold_pairs = np.zeros((k, k))
    np.add.at(gold_pairs, (y[:, :-1], y[:, 1:]), 1)
    squares = [np.full_like(x, 1e-6) for x in (model.weights, model.transitions, model.first)]
    for _ in range(EPOCHS):
        scores = np.add.reduceat(model.weights[flat], starts, axis=0)
        e = np.exp(np.clip(scores[at] - scores[at].max(2, keepdims=True), -50, 0))
        gamma, pairs = forward_backward(e, np.exp(model.transitions), np.exp(model.first))
        error = (one_hot - gamma).reshape(-1, k)
        by_word = np.stack([np.bincount(at.ravel(), error[:, c], len(vocabulary)) for c in range(k)], 1)
        by_feature = np.stack([np.bincount(flat, by_word[owner, c], BUCKETS) for c in range(k)], 1)
        for x, g, s in zip(
            (model.weights, model.transitions, model.first), (by_feature, gold_pairs - pairs, (one_hot - gamma)[:, 0].sum(0)), squares
        ):
            g = g - DECAY * n * x
            s += g * g
            x += RATE * g / np.sqrt(s)
    return model


class Tagger:
    """Posteriors of whole texts; words seen before are looked up."""

    def __init__(self, model: Model):
        self.m, self.k = model, len(model.labels)
        self.a = np.exp(model.transitions - model.transitions.max()).astype(np.float32)
        self.first = np.exp(model.first - model.first.max()).astype(np.float32)
        self.index: dict[str, int] = {}
        self.rows = np.empty((1024, self.k), np.float32)

    def look_up(self, words: list[str]) -> np.ndarray:
        new = set(words).difference(self.index)
        if len(self.index) + len(new) > REMEMBER:
            self.index.clear()
            new = set(words)
        need = len(self.index) + len(new)
        if need > len(self.rows):
            self.rows = np.resize(self.rows, (2 * need, self.k))
        if new:
            found = [features(w, self.m.lexicon) for w in new]
            ends = np.cumsum([len(f) for f in found])
            s = np.add.reduceat(self.m.weights[np.fromiter(chain.from_iterable(found), np.int64, ends[-1])], ends - [len(f) for f in found], axis=0)
            self.rows[len(self.index) : need] = np.exp(np.maximum(s - s.max(1, keepdims=True), -30))
            self.index.update(zip(new, range(len(self.index), need)))
        return self.rows[np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))]

    def posteriors(self, documents: list[list[str]]) -> list[np.ndarray]:
        """For each (non-empty) document an array (words, labels).

        Documents are cut into chunks. The product of the step matrices of each
        chunk links it to the next, so all chunks are worked on side by side and
        only one vector per chunk is carried along a document.
        """
        sizes = np.array([len(d) for d in documents])
        chunks = -(-sizes // CHUNK)
        total, k, a = int(chunks.sum()), self.k, self.a
        first_chunk = np.concatenate([[0], np.cumsum(chunks)[:-1]])
        e = np.ones((total * CHUNK, k), np.float32)
        live = np.zeros(total * CHUNK, bool)
        place = np.repeat(first_chunk * CHUNK - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        e[place] = self.look_up([w for d in documents for w in d])
        live[place] = True
        e, live = e.reshape(total, CHUNK, k), live.reshape(total, CHUNK)
        starts = np.zeros(total, bool)
        starts[first_chunk] = True
        # Product of the steps of each chunk; a document's first step has the same row for every label.
        product = np.broadcast_to(np.eye(k, dtype=np.float32), (total, k, k)).copy()
        for t in range(CHUNK):
            x = (product.reshape(-1, k) @ a).reshape(total, k, k) * e[:, t][:, None, :]
            if t == 0:
                x[starts] = (self.first * e[starts, 0])[:, None, :]
            x /= x.sum((1, 2), keepdims=True)
            product = np.where(live[:, t][:, None, None], x, product) if not live[:, t].all() else x
        enter = np.full((total, k), 1.0 / k, np.float32)
        leave = np.ones((total, k), np.float32)
        for c in range(int(chunks.max()) - 1):
            i = first_chunk[chunks > c + 1] + c
            v = np.einsum("ni,nij->nj", enter[i], product[i])
            enter[i + 1] = v / v.sum(1, keepdims=True)
        for c in range(int(chunks.max()) - 1, 0, -1):
            i = first_chunk[chunks > c] + c
            v = np.einsum("nij,nj->ni", product[i], leave[i])
            leave[i - 1] = v / v.sum(1, keepdims=True)
        alpha = np.empty_like(e)
        v = enter
        for t in range(CHUNK):
            x = (v @ a) * e[:, t]
            if t == 0:
                x[starts] = self.first * e[starts, 0]
            x /= x.sum(1, keepdims=True)
            v = np.where(live[:, t][:, None], x, v)
            alpha[:, t] = v
        beta = leave
        for t in range(CHUNK - 1, -1, -1):
            alpha[:, t] *= beta
            x = (e[:, t] * beta) @ a.T
            x /= x.sum(1, keepdims=True)
            beta = np.where(live[:, t][:, None], x, beta)
        alpha /= alpha.sum(2, keepdims=True)
        flat = alpha.reshape(-1, k)[place]
        return np.split(flat, np.cumsum(sizes)[:-1])


def runs(labels: np.ndarray) -> list[tuple[int, int, int]]:
    cut = np.flatnonzero(np.diff(labels)) + 1
    begin, end = np.concatenate([[0], cut]), np.concatenate([cut, [len(labels)]])
    return list(zip(begin.tolist(), end.tolist(), labels[begin].tolist()))


SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])
SCHEMA = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("spans", pa.list_(SPAN))])
DDL = "doc_id long, lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>"


def learn(docs: DataFrame, label_col: str = "lang", per_label: int = PER_LABEL) -> Model | None:
    """A model of ``docs`` (columns ``text`` and ``label_col``); rows without text or label are not learned from."""
    return train([(r[0], r[1]) for r in sample(docs, label_col, per_label).collect()])


def labelled(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, spans`` for every row, repeated rows too; null ids stay null.

    ``spans`` are runs of words (numbers of the first word and behind the last)
    that most likely are of one language; ``score`` is the expected share of the
    document's words in ``lang_pred``. Text that is null or has no letter, and any
    text without a model, is ``und`` with score 0 and no spans.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x labels numbers and the lexicon

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        if m and m.tagger is None:
            m.tagger = Tagger(m)  # kept with the broadcast value, where later tasks of the worker find it
        tagger = m.tagger if m else None

        def answer(part: list) -> Iterator[tuple]:
            with_words = [w for _, w in part if w]
            found = iter(tagger.posteriors(with_words) if tagger and with_words else [])
            for key, words in part:
                if not words or tagger is None:
                    yield key, UNKNOWN, 0.0, []
                    continue
                p = next(found)
                share = p.mean(0)
                best = int(share.argmax())
                spans = [{"start": b, "end": e, "lang": m.labels[c]} for b, e, c in runs(p.argmax(1))]
                yield key, m.labels[best], min(1.0, float(share[best])), spans

        def rows() -> Iterator[tuple]:
            for batch in batches:
                part, size = [], 0
                for key, text in rows_of(batch, "doc_id", "text"):
                    part.append((key, words_of(text)))
                    size += len(part[-1][1])
                    if size >= BATCH_WORDS:
                        yield from answer(part)
                        part, size = [], 0
                yield from answer(part)

        yield from flushed(rows(), SCHEMA)

    return texts(docs, id_col, text_col).mapInArrow(run, DDL)


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def learnable(docs: DataFrame) -> DataFrame:
    """Rows with an id whose hash does not hold them out."""
    return docs.where(F.col("doc_id").isNotNull() & ~held_out())


@query()
def op5_language(spark, d):
    docs = documents(spark, d)
    out = labelled(docs, learn(learnable(docs)))
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))
