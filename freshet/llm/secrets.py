"""Secrets: fixed patterns, and values in a credential context scored by how hard they are to guess.

The guess cost of a value is the least sum of ``log10`` guesses over all cuttings
into words, dates, repeats, keyboard walks and brute-force signs, found by
dynamic programming over its positions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import log10

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.llm.common import documents, flushed, query, rows_of, texts

# The base patterns. A match of ASSIGN counts when its value has 8 signs or more.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
# Where a value is a credential: a name, then a separator; wider than ASSIGN in names and signs.
CONTEXT = re.compile(
    r"""(?i:password|passwd|passphrase|pwd|secret|token|api[_-]?key|credential|auth)s?["']?[\x20\t]*[:=][\x20\t]*["']?([^\s"'<>,;]+)""", re.ASCII
)
KINDS = ("assign", "access", "hex", "strong")
# A value of at least this log10 of guesses is reported as a strong secret.
STRONG = 8.0

# Words of common passwords, the most common first; the rank is the number of guesses.
WORDS = """password admin welcome letmein login master dragon monkey shadow sunshine princess football baseball
superman batman trustno hello secret freedom whatever charlie michael jordan hunter ranger buster soccer hockey killer
george andrew thomas robert daniel summer winter spring autumn computer internet service account access system server
default change changeme test guest root user demo example sample qwerty google token love money pass word the and key
""".split()
RANK = {w: i + 1 for i, w in enumerate(WORDS)}
LONGEST_WORD = max(map(len, WORDS))
# Rows along which a walk steps, forwards or backwards.
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz", "0123456789")
STEPS = {(a, b) for row in ROWS for a, b in [*zip(row, row[1:]), *zip(row[1:], row)]}
DATE = re.compile(
    r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d|(?:19|20)\d\d"
)
YEARS, DAYS = 200, 200 * 366


def brute(sign: str) -> float:
    return 1.0 if sign.isdigit() else log10(26) if sign.isalpha() and sign.islower() else log10(95)


def span_costs(value: str) -> Iterator[tuple[int, int, float]]:
    """Every span (start, end, cost) that a cutting may use. Repeats and walks of 3 signs or more reach to their end."""
    lower, n = value.lower(), len(value)
    if len(lower) != n:
        lower = value
    repeat, walk = [0] * n, [0] * n
    for i in range(n - 1, -1, -1):
        repeat[i] = repeat[i + 1] + 1 if i + 1 < n and value[i] == value[i + 1] else 1
        walk[i] = walk[i + 1] + 1 if i + 1 < n and (lower[i], lower[i + 1]) in STEPS else 1
    for i in range(n):
        yield i, i + 1, brute(value[i])
        for j in range(i + 2, min(n, i + LONGEST_WORD) + 1):
            if rank := RANK.get(lower[i:j]):
                upper = sum(a != b for a, b in zip(value[i:j], lower[i:j]))
                yield i, j, log10(rank) + (log10(2) * min(upper, 2))
        if date := DATE.match(value, i):
            yield i, date.end(), log10(YEARS if date.end() - i == 4 else DAYS)
        if repeat[i] >= 3:
            yield i, i + repeat[i], brute(value[i]) + log10(repeat[i])
        if walk[i] >= 3:
            yield i, i + walk[i], log10(40) + log10(walk[i])


def guess_cost(value: str) -> float:
    """The least log10 of guesses over all cuttings; 0 for an empty value."""
    best = [0.0] + [float("inf")] * len(value)
    for start, end, cost in span_costs(value):
        if best[start] + cost < best[end]:
            best[end] = best[start] + cost
    return best[-1]


def find_secrets(text: str) -> list[tuple[int, int, int, float | None]]:
    """(start, kind number, end, cost) by start and kind. Positions are code points."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end(), None) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
        for m in CONTEXT.finditer(text):
            if (cost := guess_cost(m[1])) >= STRONG:
                found.append((m.start(1), 3, m.end(1), round(cost, 2)))
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), None) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), None) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: s[:3])


SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("cost", pa.float64())])
SCHEMA = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(SPAN))])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = (
            (key, [{"start": s, "end": e, "kind": KINDS[k], "cost": c} for s, k, e, c in find_secrets(text or "")])
            for key, text in rows_of(batch, "doc_id", "text")
        )
        yield from flushed(rows, SCHEMA)


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``spans``, an array of (start, end, kind, cost) by start and kind.

    ``cost`` is the guess cost of ``strong`` spans, null for the base kinds. A null
    text counts as empty and has no spans; every input row gives one row, repeated
    rows too; a null id stays null.
    """
    schema = "doc_id long, spans array<struct<start:int,end:int,kind:string,cost:double>>"
    return texts(docs, id_col, text_col).mapInArrow(_scan, schema)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query()
def op2_secrets(spark, d):
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return secret_spans(documents(spark, d)).select(
        "doc_id", *[n(k) for k in KINDS[:3]],
        F.sha2(_joined(F.filter("spans", lambda s: s["kind"] != "strong")), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"), F.array_max(F.transform("spans", lambda s: s["cost"])).alias("most_guesses_log10"),
    )
