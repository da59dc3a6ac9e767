"""Quality by weak labels: heuristic labellers, expectation-maximisation, a hashed linear scorer.

Every labeller says good, bad or nothing of a whole text. The counts of all vote
patterns over all documents are enough for expectation-maximisation, which
estimates how often each labeller is right in each class without any true label.
Its posteriors then are the targets of a linear scorer over hashed token features,
which generalises beyond the labellers. The scorer is fitted on a bounded sample
(``SAMPLE`` different texts by their hash); patterns are counted, and documents
scored, over everything.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.common import documents, flushed, query, rows_of, texts
from freshet.session import stored

SAMPLE = 4000
BUCKETS = 1 << 14
ROUNDS, LEAST_ODDS = 50, 20
EPOCHS, RATE, DECAY = 200, 0.5, 1e-4
REMEMBER = 200_000

# Common short words of the languages at hand, and words of abuse.
COMMON = frozenset(
    """the of and to in is was for that it with as on be by this are or an at from a
de la le les et des en un une du que qui dans pour pas sur est au par avec
der die das und ist von mit den zu nicht ein eine im auf sich für dem
el los las y que se del con una por su al es lo como no""".split()
)
ABUSE = frozenset("idiot moron stupid trash scum loser pathetic disgusting worthless clown imbecile".split())
WORD = re.compile(r"[^\W\d_]+")
DOUBLED = re.compile(r"[^\w\s]{2,}$")
SYMBOLS = re.compile(r"[^\w\s.,;:!?'\"()-]")
REPEATED = re.compile(r"(.)\1+")


class _Signs(dict):
    """What a sign becomes in a shape: a digit 0, a capital X, another letter x, all else itself."""

    def __missing__(self, code: int) -> str:
        sign = chr(code)
        if re.match(r"\d", sign):
            kind = "0"
        elif WORD.match(sign):
            kind = "X" if sign.isupper() else "x"
        else:
            kind = sign
        self[code] = kind
        return kind


_SIGNS = _Signs()


class Tokens:
    """Numbers of tokens between blanks, looked up once for each different token; a bounded number is kept.

    Most of what is asked of a token is told by its shape (``_SIGNS``), and there are
    far fewer shapes, beginnings and ends than tokens, so these are remembered too.
    """

    def __init__(self, features: bool = True):
        self.features = features
        self.row: dict[str, int] = {}
        self.facts = np.empty((1024, len(FACTS)))
        self.ids = np.empty((1024, 4), np.int64)
        self.shapes: dict[str, tuple] = {}
        self.hashes: dict[str, int] = {}

    def hashed(self, name: str) -> int:
        found = self.hashes.get(name)
        if found is None:
            found = self.hashes[name] = crc32(name.encode("utf-8", "surrogatepass")) % BUCKETS
        return found

    def shape(self, drawn: str) -> tuple:
        found = self.shapes.get(drawn)
        if found is None:
            letters = drawn.count("X") + drawn.count("x")
            found = letters, len(SYMBOLS.findall(drawn)), drawn.count("|"), DOUBLED.search(drawn) is not None
            found = self.shapes[drawn] = (*found, self.hashed("h" + REPEATED.sub(r"\1+", drawn)))
        return found

    def rows(self, tokens: list[str]) -> np.ndarray:
        new = set(tokens).difference(self.row)
        if len(self.row) + len(new) > REMEMBER:
            self.row.clear()
            new = set(tokens)
        for known in (self.shapes, self.hashes):
            if len(known) > REMEMBER:
                known.clear()
        begin = len(self.row)
        need = begin + len(new)
        if need > len(self.facts):
            self.facts, self.ids = np.resize(self.facts, (2 * need, len(FACTS))), np.resize(self.ids, (2 * need, 4))
        if new:
            facts, ids, shape, hashed = [], [], self.shape, self.hashed
            for t in new:
                low = t.lower()
                word = low.strip(".,;:!?")
                upper = len(t) > 1 and t.isupper()
                letters, symbols, bars, doubled, drawn = shape(t.translate(_SIGNS))
                plain = word.isalpha()
                abuse = word in ABUSE if plain else not ABUSE.isdisjoint(WORD.findall(low))
                facts.append((letters, symbols, bars, upper, plain and not upper, doubled, word in COMMON, abuse))
                if self.features:
                    if len(t) > 40:
                        ids.append(token_features(t) + [BUCKETS])
                    else:
                        ids.append((drawn, hashed("s" + t[-2:].lower()), hashed("p" + t[:2].lower()), hashed("t" + low) if len(t) <= 5 else BUCKETS))
            self.row.update(zip(new, range(begin, need)))
            self.facts[begin:need] = facts
            if self.features:
                self.ids[begin:need] = ids
        return np.fromiter(map(self.row.__getitem__, tokens), np.int64, len(tokens))


FACTS = ("letters", "symbols", "bars", "upper", "plain", "doubled", "common", "abuse")


def votes(text: str | None, rows: np.ndarray, table: Tokens) -> tuple[int, ...]:
    """What the labellers say: 1 good, -1 bad, 0 nothing. That one kind of junk is absent says nothing.

    ``rows`` are those of the text's tokens in ``table``.
    """
    n = len(rows)
    if not n:
        return (0,) * len(LABELLERS)
    letters, symbols, bars, upper, plain, doubled, common, _ = table.facts[rows].sum(0).tolist()
    same = int(np.count_nonzero(rows[1:] == rows[:-1]))
    different = len(set(rows.tolist()))
    ends = [x.rstrip()[-1] for x in text.split("\n") if x.strip()]
    ended = sum(x in ".!?:\"'" for x in ends)
    return (
        -1 if symbols >= 0.08 * max(letters, 1) else 0,
        -1 if upper >= 0.2 * n else 0,
        -1 if bars >= 0.1 * n else 0,
        -1 if same >= 0.1 * n else 0,
        -1 if n >= 20 and common < 0.05 * n else 1 if common > 0.12 * n else 0,
        -1 if plain < 0.6 * n else 1 if plain > 0.8 * n else 0,
        -1 if doubled >= 0.2 * n else 0,
        -1 if n >= 20 and different < 2 * n**0.5 else 0,
        -1 if n < 4 else 0,
        -1 if ended < 0.3 * len(ends) else 1 if ended > 0.8 * len(ends) else 0,
    )


LABELLERS = ("symbols", "capitals", "tables", "repeats", "common_words", "plain_words", "doubled_signs", "variety", "length", "line_ends")


def fit_labellers(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS) -> tuple[float, np.ndarray]:
    """The share of good documents, and P(vote | class) as (class, labeller, vote + 1).

    Classes are 0 bad and 1 good. Labellers are taken to be better than chance: a bad
    vote is at least ``LEAST_ODDS`` times as likely for a bad text, and texts with a bad
    vote start as bad, so the classes cannot change places and rare kinds of junk
    are not explained away as a kind of good text.
    """
    v = np.array([p for p, _ in patterns]).reshape(len(patterns), -1)
    n = np.array([c for _, c in patterns], float)
    one_hot = np.stack([v == x for x in (-1, 0, 1)], 2).astype(float)
    posterior = np.where((v < 0).any(1), 0.05, 0.95)
    prior, table = 0.5, np.full((2, v.shape[1], 3), 1 / 3)
    for _ in range(rounds):
        weight = np.stack([(1 - posterior) * n, posterior * n])
        table = np.einsum("cp,plx->clx", weight, one_hot) + 0.1
        table /= table.sum(2, keepdims=True)
        table[1, :, 0] = np.minimum(table[1, :, 0], table[0, :, 0] / LEAST_ODDS)
        table[1] /= table[1].sum(1, keepdims=True)
        prior = (weight[1].sum() + 1) / (n.sum() + 2)
        posterior = posterior_good(v, prior, table)
    return float(prior), table


def posterior_good(v: np.ndarray, prior: float, table: np.ndarray) -> np.ndarray:
    logs = np.log(table)
    at = np.arange(v.shape[1])
    odds = np.log(prior) - np.log(1 - prior) + (logs[1, at, v + 1] - logs[0, at, v + 1]).sum(1)
    return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def token_features(token: str) -> list[int]:
    """Hashed shape, first and last signs, and the token itself when short."""
    cut = token if len(token) <= 40 else token[:20] + token[-20:]
    shape = REPEATED.sub(r"\1+", re.sub(r"[^\W\d_]", lambda m: "X" if m[0].isupper() else "x", re.sub(r"\d", "0", cut)))
    names = ["h" + shape, "s" + cut[-2:].lower(), "p" + cut[:2].lower()] + (["t" + cut.lower()] if len(cut) <= 5 else [])
    return [crc32(x.encode("utf-8", "surrogatepass")) % BUCKETS for x in names]


SAME_AS_LAST = crc32(b"same as the last token") % BUCKETS


def feature_shares(rows: np.ndarray, table: Tokens) -> np.ndarray:
    """Mean count per token of each feature."""
    counts = np.bincount(table.ids[rows].ravel(), minlength=BUCKETS + 1)[:BUCKETS].astype(float)
    counts[SAME_AS_LAST] += np.count_nonzero(rows[1:] == rows[:-1])
    return counts / max(1, len(rows))


def fit_scorer(rows: list[tuple[dict[int, float], float]]) -> tuple[np.ndarray, float]:
    """Logistic regression on soft targets, both classes with equal weight."""
    weights, bias = np.zeros(BUCKETS), 0.0
    rows = [r for r in rows if r[0]]
    if not rows:
        return weights, bias
    owner = np.repeat(np.arange(len(rows)), [len(f) for f, _ in rows])
    ids = np.concatenate([np.fromiter(f.keys(), np.int64) for f, _ in rows])
    values = np.concatenate([np.sqrt(np.fromiter(f.values(), float)) for f, _ in rows])
    y = np.array([p for _, p in rows])
    balance = np.where(y > 0.5, 0.5 / max(y.mean(), 1e-3), 0.5 / max(1 - y.mean(), 1e-3))
    squares, bias_square = np.full(BUCKETS, 1e-6), 1e-6
    for _ in range(EPOCHS):
        z = np.bincount(owner, weights[ids] * values, len(rows)) + bias
        error = balance * (y - 1 / (1 + np.exp(-np.clip(z, -30, 30)))) / len(rows)
        g = np.bincount(ids, error[owner] * values, BUCKETS) - DECAY * weights
        squares += g * g
        weights += RATE * g / np.sqrt(squares)
        bias_square += error.sum() ** 2
        bias += RATE * error.sum() / np.sqrt(bias_square)
    return weights, float(bias)


def _voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = Tokens(features=False)
    for batch in batches:
        found = ["".join("-0+"[v + 1] for v in votes(t, table.rows((t or "").split()), table)) for t in batch.column("text").to_pylist()]
        yield pa.record_batch([batch.column("doc_id"), pa.array(found, pa.string())], names=["doc_id", "votes"])


def _numbers(pattern: str) -> tuple[int, ...]:
    return tuple("-0+".index(c) - 1 for c in pattern)


def quality(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, votes, posterior, score, good, abusive, keep`` for every row.

    ``votes`` has a sign (``+``, ``-``, ``0``) for each of ``LABELLERS``; ``posterior`` is
    the probability of a good text by the votes, ``score`` by the linear scorer.
    ``good`` is a score of one half or more, ``abusive`` an abusive word in the text,
    ``keep`` good and not abusive. Null and empty texts get no votes, score 0,
    and are not good. Repeated rows are scored each; null ids stay null.
    """
    docs = texts(docs, id_col, text_col)
    spark = docs.sparkSession
    voted = stored(docs.mapInArrow(_voted, "doc_id long, votes string"), "votes")
    # At most 3 ** labellers rows, whatever the number of documents.
    patterns = [(_numbers(r["votes"]), r["count"]) for r in voted.where("votes <> '" + "0" * len(LABELLERS) + "'").groupBy("votes").count().orderBy("votes").collect()]
    prior, table = fit_labellers(patterns) if patterns else (0.5, np.full((2, len(LABELLERS), 3), 1 / 3))
    hashed = docs.withColumn("_h", F.xxhash64("text"))
    last = hashed.where("text IS NOT NULL").select("_h").distinct().orderBy("_h").limit(sample).agg(F.max("_h")).first()[0]
    chosen = hashed.where(F.col("text").isNotNull() & (F.col("_h") <= F.lit(last))).groupBy("_h").agg(F.min("text").alias("text"))

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("posterior", pa.float64()), ("ids", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])

        known = Tokens()

        def rows() -> Iterator[tuple]:
            for b in batches:
                for text in b.column("text").to_pylist():
                    own = known.rows(text.split())
                    p = posterior_good(np.array([votes(text, own, known)]), prior, table)[0]
                    shares = feature_shares(own, known)
                    ids = np.flatnonzero(shares)
                    yield float(p), ids.tolist(), shares[ids].tolist()

        yield from flushed(rows(), schema, 256)

    features = chosen.select("text").mapInArrow(sampled, "posterior double, ids array<int>, values array<double>").collect()
    features = sorted(features, key=lambda r: (list(r[1]), list(r[2])))
    model = spark.sparkContext.broadcast((prior, table, *fit_scorer([(dict(zip(r[1], r[2])), r[0]) for r in features])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prior, table, weights, bias = model.value
        known, said = Tokens(), {}
        schema = pa.schema(
            [("doc_id", pa.int64()), ("votes", pa.string()), ("posterior", pa.float64()), ("score", pa.float64()), ("abusive", pa.bool_())]
        )

        def rows() -> Iterator[tuple]:
            for b in batches:
                for key, text in rows_of(b, "doc_id", "text"):
                    own = known.rows((text or "").split())
                    v = votes(text, own, known)
                    if v not in said:
                        said[v] = float(posterior_good(np.array([v]), prior, table)[0])
                    p, score, abusive = said[v], 0.0, False
                    if len(own):
                        shares = feature_shares(own, known)
                        at = np.flatnonzero(shares)
                        z = float((weights[at] * np.sqrt(shares[at])).sum() + bias)
                        score = 1 / (1 + np.exp(-max(-30.0, min(30.0, z))))
                        abusive = bool(known.facts[own, FACTS.index("abuse")].any())
                    yield key, "".join("-0+"[x + 1] for x in v), p, float(score), abusive

        yield from flushed(rows(), schema)

    out = docs.mapInArrow(run, "doc_id long, votes string, posterior double, score double, abusive boolean")
    good = F.col("score") >= 0.5
    return out.select("doc_id", "votes", "posterior", "score", good.alias("good"), "abusive", (good & ~F.col("abusive")).alias("keep"))


@query()
def op8_quality(spark, d):
    return quality(documents(spark, d))
