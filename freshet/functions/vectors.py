"""Vector arithmetic on ``ARRAY<FLOAT|DOUBLE>`` columns, computed in double."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from freshet.functions.text import _col, strip_blanks

# Distances are rounded to this many digits before ranking, so that ties do
# not depend on the order in which a sum was taken.
RANK_DIGITS = 9


def as_double(c: Column | str) -> Column:
    return _col(c).cast("array<double>")


def _total(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column | str, b: Column | str) -> Column:
    return _total(F.zip_with(as_double(a), as_double(b), lambda x, y: x * y))


def norm(a: Column | str) -> Column:
    return F.sqrt(F.aggregate(as_double(a), F.lit(0.0), lambda acc, x: acc + x * x))


def cosine_distance(a: Column | str, b: Column | str) -> Column:
    """1 - cosine; a vector of length zero is at distance 1 from everything."""
    scale = norm(a) * norm(b)
    return F.when(scale > 0, 1 - dot(a, b) / F.nullif(scale, F.lit(0.0))).otherwise(F.lit(1.0))


def l2_distance(a: Column | str, b: Column | str) -> Column:
    apart = F.zip_with(as_double(a), as_double(b), lambda x, y: x - y)
    return F.sqrt(F.aggregate(apart, F.lit(0.0), lambda acc, x: acc + x * x))


def distance(a: Column | str, b: Column | str, metric: str) -> Column:
    if metric not in ("cosine", "l2"):
        raise ValueError(f"unknown metric {metric!r}")
    return cosine_distance(a, b) if metric == "cosine" else l2_distance(a, b)


def similarity(dist: Column | str) -> Column:
    return 1 - _col(dist)


def vector_lit(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def fixed(c: Column | str, digits: int) -> Column:
    """A double with ``digits`` decimals as C's ``printf`` writes it: its exact binary value is rounded, halves to even.

    ``format_string`` rounds the shortest decimal text instead, halves up. Right while value and decimals need no more
    than 15 digits.
    """
    c = _col(c)
    text = F.call_function("format_number", c, F.lit("0." + "0" * digits))
    endless = F.when(c > 0, F.lit("inf")).otherwise(F.lit("-inf"))
    return F.when(F.isnan(c), F.lit("nan")).when(F.abs(c) == float("inf"), endless).otherwise(text)


def to_literal(c: Column | str, rounded: bool = True) -> Column:
    """``[x,y,...]`` text with eight decimals (or in full); null for an empty or missing vector."""
    values = as_double(c)
    texts = F.transform(values, (lambda x: fixed(x, 8)) if rounded else (lambda x: x.cast("string")))
    return F.when(F.size(values) > 0, F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]")))


def from_literal(c: Column | str) -> Column:
    """Bracketed text to doubles; no content gives an empty array."""
    inner = F.regexp_replace(strip_blanks(c), r"^[\[\]]+|[\[\]]+$", "")
    parsed = F.transform(F.split(inner, ","), lambda x: F.trim(x).try_cast("double"))
    return F.when(inner == "", F.array().cast("array<double>")).otherwise(parsed)


def has_width(c: Column | str, width: int) -> Column:
    return F.coalesce(F.size(_col(c)) == width, F.lit(False))
