"""Star schemas: dimensions and edit facts, by surrogate and by natural keys.

Events come in the common shape (see `freshet.sources.events`); ``ord`` is
their total arrival order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.functions.keys import position_key, surrogate
from freshet.functions.text import blank_to_null, kv_field, lenient_bool
from freshet.functions.times import epoch_time
from freshet.operators.joins import lookup
from freshet.operators.merge import merge

POSITION = ["kafka_topic", "kafka_partition", "kafka_offset"]
ORDER = ["ord"]


# --- by surrogate keys -------------------------------------------------------


def _surrogate_input(events: DataFrame) -> DataFrame:
    """Blank strings count as missing."""
    return events.select(
        *POSITION,
        "ord",
        blank_to_null("wiki").alias("wiki_code"),
        blank_to_null("server_name").alias("domain"),
        "namespace",
        blank_to_null("title").alias("title"),
        blank_to_null("title_url").alias("url"),
        blank_to_null("user_name").alias("username"),
        F.col("bot").alias("is_bot"),
        F.col("minor").alias("is_minor"),
        blank_to_null("raw_comment").alias("comment"),
        blank_to_null("notify_url").alias("notify_url"),
        blank_to_null("type").alias("event_type"),
        epoch_time("ts_epoch", positive_only=True).alias("occurred_at"),
        "rev_old",
        "rev_new",
        "bytes_old",
        "bytes_new",
    )


def dim_wiki(events: DataFrame) -> DataFrame:
    rows = _surrogate_input(events).where(F.col("wiki_code").isNotNull())
    merged = merge(rows, ["wiki_code"], ORDER, {"domain": "last"})
    return merged.select(surrogate("wiki_code").alias("wiki_id"), "wiki_code", "domain")


def dim_page(events: DataFrame) -> DataFrame:
    rows = _surrogate_input(events).where(F.col("wiki_code").isNotNull() & F.col("title").isNotNull())
    merged = merge(rows, ["wiki_code", "namespace", "title"], ORDER, {"url": "last_non_null"})
    return merged.select(
        surrogate("wiki_code", "namespace", "title").alias("page_id"),
        surrogate("wiki_code").alias("wiki_id"),
        "wiki_code",
        "namespace",
        "title",
        "url",
    )


def dim_user(events: DataFrame) -> DataFrame:
    rows = _surrogate_input(events).where(F.col("username").isNotNull())
    merged = merge(rows, ["username"], ORDER, {"is_bot": "last_non_null"})
    return merged.select(surrogate("username").alias("user_id"), "username", "is_bot")


def fact_edit(events: DataFrame) -> DataFrame:
    """The first event at each position, with its dimension ids.

    Ids are hashes of the natural keys, so no lookup join is needed to fill
    them: an id is there exactly when its dimension row is.
    """
    rows = _surrogate_input(events)
    payload = [c for c in rows.columns if c not in (*POSITION, "ord")]
    first = merge(rows, POSITION, ORDER, {c: "first" for c in payload})
    wiki = F.col("wiki_code").isNotNull()
    return first.select(
        *POSITION,
        position_key(*POSITION).alias("doc_key"),
        "occurred_at",
        F.when(wiki, surrogate("wiki_code")).alias("wiki_id"),
        F.when(wiki & F.col("title").isNotNull(), surrogate("wiki_code", "namespace", "title")).alias("page_id"),
        F.when(F.col("username").isNotNull(), surrogate("username")).alias("user_id"),
        "event_type",
        "comment",
        "is_bot",
        "is_minor",
        "rev_old",
        "rev_new",
        "bytes_old",
        "bytes_new",
        "notify_url",
        F.col("domain").alias("server"),
    )


def build_star(events: DataFrame) -> dict[str, DataFrame]:
    return {
        "dim_wiki": dim_wiki(events),
        "dim_page": dim_page(events),
        "dim_user": dim_user(events),
        "fact_edit": fact_edit(events),
    }


def star_view(star: dict[str, DataFrame]) -> DataFrame:
    """Facts with the attributes of their dimensions."""
    fact = star["fact_edit"]
    wiki = star["dim_wiki"].select("wiki_id", "wiki_code", "domain")
    page = star["dim_page"].select("page_id", "namespace", "title", "url")
    user = star["dim_user"].select("user_id", "username", F.col("is_bot").alias("user_is_bot"))
    return lookup(lookup(lookup(fact, wiki, ["wiki_id"]), page, ["page_id"]), user, ["user_id"])


# --- by natural keys, from stored key=value content --------------------------


def edits_from_content(chunks: DataFrame) -> DataFrame:
    """Typed edit columns read back from ``content``.

    Needs ``kafka_*``, ``ord``, ``id`` (of the stored row), ``title``, ``url``, ``content``, ``created_at``.
    Rows without content or without a full position are left out.
    """
    usable = chunks.where(
        blank_to_null("content").isNotNull()
        & F.col("kafka_topic").isNotNull()
        & F.col("kafka_partition").isNotNull()
        & F.col("kafka_offset").isNotNull()
    )

    def field(name: str):
        return kv_field("content", name)

    return usable.select(
        *POSITION,
        "ord",
        F.col("id").alias("chunk_id"),
        F.coalesce(field("type"), F.lit("edit")).alias("event_type"),
        field("wiki").alias("wiki"),
        "title",
        "url",
        F.coalesce(field("user"), field("user_name")).alias("user_name"),
        lenient_bool(field("bot")).alias("is_bot"),
        field("comment").alias("comment"),
        field("server").alias("server"),
        F.coalesce(epoch_time(field("timestamp")), F.col("created_at")).alias("edited_at"),
        F.col("created_at").alias("ingested_at"),
    )


def _wiki_rows(edits: DataFrame) -> DataFrame:
    return edits.where(F.col("wiki").isNotNull()).withColumn("first_seen_at", F.col("edited_at"))


def _user_rows(edits: DataFrame) -> DataFrame:
    return edits.where(F.col("user_name").isNotNull()).withColumn("first_seen_at", F.col("edited_at"))


def _page_rows(edits: DataFrame) -> DataFrame:
    rows = edits.where(F.col("wiki").isNotNull() & blank_to_null("url").isNotNull())
    return rows.withColumn("first_seen_at", F.col("edited_at"))


_FACT = ("chunk_id", "event_type", "wiki", "title", "url", "user_name", "is_bot", "comment", "server", "edited_at", "ingested_at")
# The tables of the star: the rows each takes from the edits, its keys and its rules.
SEEN = {
    "dim_wiki": (_wiki_rows, ["wiki"], {"server": "last_non_null", "first_seen_at": "first"}),
    "dim_user": (_user_rows, ["user_name"], {"first_seen_at": "first"}),
    "dim_page": (_page_rows, ["wiki", "url"], {"title": "last", "first_seen_at": "first"}),
    "fact_edit": (lambda edits: edits, POSITION, {c: "first" for c in _FACT}),
}


def _seen(edits: DataFrame, name: str) -> DataFrame:
    rows, keys, rules = SEEN[name]
    return merge(rows(edits), keys, ORDER, rules)


def dim_wiki_seen(edits: DataFrame) -> DataFrame:
    return _seen(edits, "dim_wiki")


def dim_user_seen(edits: DataFrame) -> DataFrame:
    return _seen(edits, "dim_user")


def dim_page_seen(edits: DataFrame) -> DataFrame:
    return _seen(edits, "dim_page")


def fact_edit_seen(edits: DataFrame) -> DataFrame:
    return _seen(edits, "fact_edit")


def inserted_counts(edits: DataFrame) -> DataFrame:
    """Rows offered, facts kept and replays ignored.

    Counting per position combines on the map side before the shuffle.
    """
    per_position = edits.groupBy(*POSITION).agg(F.count(F.lit(1)).alias("n"))
    return per_position.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("offered"),
        F.count(F.lit(1)).alias("inserted"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("ignored"),
    )
