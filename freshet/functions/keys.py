"""Deterministic content keys and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from freshet.functions.text import _col, strip_blanks


def _part(c: Column | str) -> Column:
    return strip_blanks(F.coalesce(_col(c), F.lit("")))


def doc_key(source: Column | str, title: Column | str, url: Column | str, content: Column | str) -> Column:
    """Replay-safe document key: stripped source, url and title plus the content's own hash."""
    return F.sha1(
        F.concat(
            F.lit("v1|src="), _part(source),
            F.lit("|url="), _part(url),
            F.lit("|title="), _part(title),
            F.lit("|content_sha1="), F.sha1(_col(content)),
        )
    )


def text_sha256(c: Column | str) -> Column:
    return F.sha2(_col(c), 256)


def cache_key(model: str, c: Column | str) -> Column:
    return F.concat(F.lit(model + ":"), F.sha1(_col(c)))


def position_key(topic: Column | str, partition: Column | str, offset: Column | str) -> Column:
    return F.concat_ws("/", _col(topic), _col(partition).cast("string"), _col(offset).cast("string"))


def surrogate(*parts: Column | str) -> Column:
    """A 60-bit id taken from the hash of the natural key.

    Needs no counter and no sort, so every task computes the same id for the
    same key. Missing parts are marked apart from empty ones.
    """
    tagged = [F.coalesce(F.concat(F.lit("="), _col(p).cast("string")), F.lit("~")) for p in parts]
    return F.conv(F.left(F.sha1(F.concat_ws("|", *tagged)), F.lit(15)), 16, 10).cast("bigint")
