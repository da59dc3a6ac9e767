"""Document text, links and ids built from an event."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from freshet.functions.text import (
    _col,
    blank_to_null,
    clean_comment,
    shown,
    shown_bool,
    strip_blanks,
    truncate,
)

MAX_CONTENT_CHARS = 700


def _truthy_number(c: Column) -> Column:
    return F.coalesce(c != 0, F.lit(False))


def domain(meta_domain: Column | str, server_name: Column | str) -> Column:
    return strip_blanks(F.coalesce(blank_to_null(meta_domain), _col(server_name), F.lit("")))


def link(title_url: Column | str, uri: Column | str) -> Column:
    return strip_blanks(F.coalesce(blank_to_null(title_url), _col(uri), F.lit("")))


def build_lines(
    title: Column | str,
    type_: Column | str,
    wiki: Column | str,
    domain_: Column | str,
    comment: Column | str,
    diff_url: Column | str,
    rev_old: Column | str,
    rev_new: Column | str,
    bytes_old: Column | str,
    bytes_new: Column | str,
    max_chars: int = MAX_CONTENT_CHARS,
) -> Column:
    """Labelled lines; the optional ones appear only where there is something to say.

    ``comment`` is expected clean (see `clean_comment`); missing title and wiki count as empty.
    """
    rev_old, rev_new, bytes_old, bytes_new = map(_col, (rev_old, rev_new, bytes_old, bytes_new))
    wiki = strip_blanks(F.coalesce(_col(wiki), F.lit("")))
    title = strip_blanks(F.coalesce(_col(title), F.lit("")))
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("Title: "), title),
        F.concat(F.lit("Type: "), shown(type_)),
        F.concat(F.lit("Wiki: "), wiki, F.coalesce(F.concat(F.lit(" ("), blank_to_null(domain_), F.lit(")")), F.lit(""))),
        F.concat(F.lit("Comment: "), blank_to_null(comment)),
        F.concat(F.lit("Diff: "), blank_to_null(diff_url)),
        F.when(
            _truthy_number(rev_old) | _truthy_number(rev_new),
            F.concat(F.lit("Revision: "), shown(rev_old), F.lit(" -> "), shown(rev_new)),
        ),
        F.when(
            bytes_old.isNotNull() & bytes_new.isNotNull(),
            F.concat(F.lit("Bytes: "), bytes_old.cast("string"), F.lit(" -> "), bytes_new.cast("string")),
        ),
    )
    return truncate(text, max_chars)


def build_kv(
    type_: Column | str,
    wiki: Column | str,
    title: Column | str,
    user: Column | str,
    bot: Column | str,
    comment: Column | str,
    server: Column | str,
    timestamp: Column | str,
) -> Column:
    """``name=value`` pairs on one line; comment, server and timestamp only when present."""
    stamp = _col(timestamp)
    return F.concat_ws(
        " | ",
        F.concat(F.lit("type="), shown(type_)),
        F.concat(F.lit("wiki="), shown(wiki)),
        F.concat(F.lit("title="), shown(title)),
        F.concat(F.lit("user="), shown(user)),
        F.concat(F.lit("bot="), shown_bool(bot)),
        F.concat(F.lit("comment="), blank_to_null(comment)),
        F.concat(F.lit("server="), blank_to_null(server)),
        F.when(_truthy_number(stamp), F.concat(F.lit("timestamp="), stamp.cast("string"))),
    )


def page_url(server_url: Column | str, title: Column | str, url: Column | str) -> Column:
    address = F.concat(
        blank_to_null(server_url), F.lit("/wiki/"), F.replace(blank_to_null(title), F.lit(" "), F.lit("_"))
    )
    return F.coalesce(address, _col(url), F.lit(""))


def event_id(meta_id: Column | str, id_: Column | str, wiki: Column | str, title: Column | str, stamp: Column | str) -> Column:
    """The feed's own id, else the numeric id, else ``wiki:title:timestamp``."""
    made = F.concat_ws(
        ":",
        strip_blanks(F.coalesce(_col(wiki), F.lit(""))),
        strip_blanks(F.coalesce(_col(title), F.lit(""))),
        shown(stamp),
    )
    numeric = F.when(_truthy_number(_col(id_).cast("bigint")), _col(id_).cast("string"))
    return F.coalesce(blank_to_null(meta_id), numeric, made)


def with_content(df, max_chars: int = MAX_CONTENT_CHARS):
    """Adds ``comment`` and ``content`` to rows of the common event shape."""
    return df.withColumn("comment", clean_comment("parsedcomment", "raw_comment")).withColumn(
        "content",
        build_lines(
            "title", "type", "wiki", domain(F.lit(None).cast("string"), "server_name"), "comment", "notify_url",
            "rev_old", "rev_new", "bytes_old", "bytes_new", max_chars,
        ),
    )
