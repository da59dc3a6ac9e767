"""Text cleaning, previews and the word-list sentiment score."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The code points that count as blank when text is stripped or
# squeezed, as the inside of a regular-expression class.
BLANK_CLASS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# The same code points as a string.
BLANKS = "".join(
    chr(c)
    for c in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)

# The sentiment word lists, matched as substrings.
POSITIVE_WORDS = (
    "good", "great", "excellent", "positive", "win", "success", "improve", "improved",
    "improvement", "fix", "fixed", "clean", "stable",
)
NEGATIVE_WORDS = (
    "bad", "terrible", "awful", "negative", "fail", "failure", "break", "broken",
    "error", "crash", "revert", "reverted", "vandal", "spam",
)

# Entities that are resolved inside the JVM. The ampersand comes
# last so that an escaped entity name is resolved only once.
CORE_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))

ELLIPSIS = "…"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def upper_each(c: Column | str) -> Column:
    """Upper case sign by sign: a sign whose capital is written with several, like ``ß``, stays as it is."""
    big = lambda x: F.when(F.char_length(F.upper(x)) == 1, F.upper(x)).otherwise(x)
    return F.array_join(F.transform(F.regexp_extract_all(_col(c), F.lit("(?s)."), F.lit(0)), big), "")


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def first_useful(*cols: Column | str) -> Column:
    """The first column that is neither null nor empty, else the empty string."""
    return F.coalesce(*[blank_to_null(c) for c in cols], F.lit(""))


def strip_blanks(c: Column | str) -> Column:
    return F.btrim(_col(c), F.lit(BLANKS))


def strip_right(c: Column | str) -> Column:
    return F.rtrim(_col(c), F.lit(BLANKS))


def has_text(c: Column | str) -> Column:
    """Is there anything but blanks and direction marks? Stops at the first such character."""
    return F.coalesce(_col(c).rlike(f"[^{BLANK_CLASS}‎‏]"), F.lit(False))


def drop_tags(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), "<[^>]+>", " ")


def unescape_core(c: Column | str) -> Column:
    return reduce(lambda x, pair: F.replace(x, F.lit(pair[0]), F.lit(pair[1])), CORE_ENTITIES, _col(c))


@F.pandas_udf(StringType())
def _unescape_all(texts: pd.Series) -> pd.Series:
    from html import unescape

    return texts.map(unescape, na_action="ignore")


@F.pandas_udf(StringType())
def _unescape_closed(texts: pd.Series) -> pd.Series:
    import re
    from html import unescape
    from html.entities import html5

    closed = re.compile(r"&(#[0-9]+;|#[xX][0-9a-fA-F]+;|[0-9A-Za-z]{1,32};)")
    # A name that is not in the table may begin with one that needs no semicolon: it stays whole.
    known = lambda m: unescape(m[0]) if m[1][0] == "#" else html5.get(m[1], m[0])
    return texts.map(lambda t: closed.sub(known, t), na_action="ignore")


def strip_html(c: Column | str, full: bool = False, closed: bool = False) -> Column:
    """Tags become a space, then entities are resolved.

    ``full=True`` knows every named and numeric entity; that table exists only
    in Python, so it runs as an Arrow batch function. The default stays in the JVM.
    Like a browser it also resolves old names without their semicolon (``&amp``); with ``closed`` those stay.
    """
    bare = drop_tags(c)
    if not full:
        return unescape_core(bare)
    return _unescape_closed(bare) if closed else _unescape_all(bare)


def normalize_text(c: Column | str) -> Column:
    """Direction marks become blanks, runs of blanks become one, ends are stripped."""
    plain = F.translate(_col(c), "‎‏", "  ")
    # A single plain blank between words is right already and is left alone.
    other = BLANK_CLASS.replace(r"\x1c-\x20", r"\x1c-\x1f")
    return F.trim(F.regexp_replace(plain, f"[{BLANK_CLASS}]{{2,}}|[{other}]", " "))


def clean_comment(parsed: Column | str, raw: Column | str, full: bool = False) -> Column:
    """The parsed comment without markup when there is one, else the raw comment."""
    base = F.coalesce(strip_html(blank_to_null(parsed), full), blank_to_null(raw), F.lit(""))
    return normalize_text(base)


def truncate(c: Column | str, limit: int) -> Column:
    c = _col(c)
    if limit <= 0:
        return c
    cut = F.concat(strip_right(F.left(c, F.lit(limit - 1))), F.lit(ELLIPSIS))
    return F.when(F.char_length(c) > limit, cut).otherwise(c)


def preview(c: Column | str, limit: int = 240) -> Column:
    return F.left(F.coalesce(_col(c), F.lit("")), F.lit(limit))


def shown(c: Column | str) -> Column:
    """Text of a value inside a template, where a missing one prints ``None``."""
    return F.coalesce(_col(c).cast("string"), F.lit("None"))


def shown_bool(c: Column | str) -> Column:
    c = _col(c)
    return F.when(c, "True").when(~c, "False").otherwise("None")


def lenient_bool(c: Column | str) -> Column:
    word = F.lower(strip_blanks(c))
    return F.when(word.isin("true", "1", "yes"), True).when(word.isin("false", "0", "no"), False)


def sentiment(c: Column | str) -> Column:
    """(positive - negative) / max(1, positive + negative) over distinct list words contained."""
    low = F.lower(F.coalesce(_col(c), F.lit("")))

    def hits(words):
        return reduce(lambda a, b: a + b, [F.contains(low, F.lit(w)).cast("int") for w in words])

    pos, neg = hits(POSITIVE_WORDS), hits(NEGATIVE_WORDS)
    return (pos - neg) / F.greatest(F.lit(1), pos + neg)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def parse_kv(c: Column | str) -> Column:
    """``word=value`` pairs separated by ``|`` as a map; a later key wins."""
    pair = r"(?s)([\p{L}\p{N}_]+)=(.+)"
    entries = F.transform(
        F.split(_col(c), r"\|"),
        lambda part: F.struct(
            F.regexp_extract(part, pair, 1).alias("key"), strip_blanks(F.regexp_extract(part, pair, 2)).alias("value")
        ),
    )

    def as_map(e: Column) -> Column:
        # Duplicate keys may not enter a map: each key asks for its last entry.
        keys = F.array_distinct(F.filter(F.transform(e, lambda x: x["key"]), lambda k: k != ""))
        return F.map_from_arrays(
            keys, F.transform(keys, lambda k: F.element_at(F.filter(e, lambda x: x["key"] == k), -1)["value"])
        )

    return let(entries, as_map)


def kv_field(c: Column | str, key: str) -> Column:
    """One field of a `parse_kv` text without building the map; null when absent or blank."""
    word = r"[\p{L}\p{N}_]"
    # The greedy start finds the last part whose first pair has this key.
    last = rf"(?s)^(?:.*\|)?(?:(?!{word}=[^|])[^|])*?(?<!{word}){key}=([^|]+)"
    return blank_to_null(strip_blanks(F.regexp_extract(_col(c), last, 1)))


def tokens(c: Column | str) -> Column:
    """Lower-cased words: runs of letters, digits and underscores."""
    return F.regexp_extract_all(F.lower(F.coalesce(_col(c), F.lit(""))), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
