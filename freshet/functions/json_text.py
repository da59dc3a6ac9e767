"""Checks and unwrapping of JSON held in text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from freshet.functions.text import _col, let, strip_blanks


def parse_whole(c: Column | str) -> Column:
    """A variant when all of the text is one JSON value, else null.

    ``try_parse_json`` reads the first value and passes over whatever follows it. Here the text stands in an
    array before its own hash, which is only reached, as the second entry, when the text is one value.
    """
    c = _col(c)
    mark = F.xxhash64(c)

    def first(both: Column) -> Column:
        alone = F.try_variant_get(both, "$[1]", "bigint").eqNullSafe(mark) & F.try_variant_get(both, "$[2]", "variant").isNull()
        return F.when(alone, F.try_variant_get(both, "$[0]", "variant"))

    return let(F.try_parse_json(F.concat(F.lit("["), c, F.lit(","), mark.cast("string"), F.lit("]"))), first)


def is_json(c: Column | str) -> Column:
    return parse_whole(c).isNotNull()


def json_kind(c: Column | str) -> Column:
    """Variant type name of the text (``OBJECT<...>``, ``STRING``, ``BIGINT`` ...), null when malformed."""
    return F.schema_of_variant(parse_whole(c))


def is_object(c: Column | str) -> Column:
    return F.coalesce(F.startswith(json_kind(c), F.lit("OBJECT")), F.lit(False))


def unwrap_once(c: Column | str) -> Column:
    """Strip blanks; when the text is a JSON string, return the text inside it."""
    body = strip_blanks(c)
    return F.when(F.startswith(body, F.lit('"')) & is_json(body), F.get_json_object(body, "$")).otherwise(body)


def lenient_object(c: Column | str) -> Column:
    """Nothing becomes ``{}``, text that is not JSON becomes ``{"raw": text}``, JSON stays."""
    c = _col(c)
    return (
        F.when(c.isNull() | (c == ""), F.lit("{}"))
        .when(is_json(c), c)
        .otherwise(F.to_json(F.struct(c.alias("raw"))))
    )


def repair_utf8(binary: Column | str, errors: str = "replace") -> Column:
    """Bytes to text. Broken sequences become U+FFFD, or vanish with ``errors='ignore'``."""
    fixed = F.make_valid_utf8(_col(binary).cast("string"))
    return fixed if errors == "replace" else F.replace(fixed, F.lit("�"), F.lit(""))


def drop_byte_order_mark(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), "^﻿", "")
