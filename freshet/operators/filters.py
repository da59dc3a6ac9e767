"""Noise filters, recency and the per-minute quota."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions.text import _col, blank_to_null, strip_blanks

# The default filter settings.
KEPT_TYPES = ("edit", "new")
KEPT_NAMESPACES = (0,)
SKIPPED_USERS = ("MediaWiki message delivery", "InternetArchiveBot", "JJMC89 bot III")


def keep_condition(
    wikis: Sequence[str] = (),
    namespaces: Sequence[int] = KEPT_NAMESPACES,
    drop_bots: bool = True,
    skip_users: Sequence[str] = SKIPPED_USERS,
    types: Sequence[str] = KEPT_TYPES,
    user: str = "user_name",
) -> Column:
    """True for the events worth indexing. A namespace that is missing passes; a missing type does not."""
    keep = F.coalesce(F.col("type").isin(*types), F.lit(False))
    keep &= F.coalesce(F.col("namespace").isin(*namespaces), F.lit(True))
    if wikis:
        keep &= strip_blanks(F.coalesce(F.col("wiki"), F.lit(""))).isin(*wikis)
    if drop_bots:
        keep &= ~F.coalesce(F.col("bot"), F.lit(False))
    if skip_users:
        keep &= ~strip_blanks(F.coalesce(F.col(user), F.lit(""))).isin(*skip_users)
    return keep


def keep(df: DataFrame, **settings) -> DataFrame:
    return df.where(keep_condition(**settings))


def one_wiki(df: DataFrame, wiki: str | None) -> DataFrame:
    return df.where(F.col("wiki") == wiki) if wiki else df


def title_and_url(df: DataFrame, title: str = "title", url: str = "title_url", fallback: str | None = None) -> DataFrame:
    """Rows with a title and a link; the link may come from the fallback column."""
    link = F.coalesce(blank_to_null(url), blank_to_null(fallback)) if fallback else blank_to_null(url)
    return df.where(blank_to_null(title).isNotNull() & link.isNotNull())


def metadata_equals(metadata: Column | str, key: str, value: str) -> Column:
    """Does a field of the JSON metadata hold exactly this text?"""
    return F.coalesce(F.get_json_object(_col(metadata), f"$.{key}") == value, F.lit(False))


def recent(df: DataFrame, ts: Column | str, minutes: int, as_of: Column | datetime | str) -> DataFrame:
    """Rows not older than ``minutes`` before ``as_of``; rows without a time drop."""
    now = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    return df.where(_col(ts) >= now - F.make_dt_interval(mins=F.lit(minutes)))


def minute_quota(df: DataFrame, ts: str, order: Sequence[str], limit: int = 60) -> DataFrame:
    """The first ``limit`` rows of each minute, by arrival.

    The rank filter is applied before the shuffle as well, so a minute that
    holds most of the rows sends at most ``limit`` rows from each task.
    """
    w = Window.partitionBy("_minute").orderBy(*order)
    return (
        df.withColumn("_minute", F.date_trunc("minute", F.col(ts)))
        .withColumn("_rank", F.row_number().over(w))
        .where(F.col("_rank") <= limit)
        .drop("_minute", "_rank")
    )
