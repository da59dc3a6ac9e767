"""Key joins that hold up when one key has a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key counts as hot when it holds at least this share of the left rows. By
# counting, at most 1 / HOT_SHARE keys can be hot, which bounds what is broadcast.
HOT_SHARE = 0.002
SALTS = 64


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> DataFrame:
    """Keys that hold at least ``share`` of the rows: never more than ``1 / share`` of them."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    return counts.where(F.col("_n") >= total * F.lit(share)).select(*keys)


def lookup(df: DataFrame, table: DataFrame, keys: Sequence[str], split_hot: bool = False, hot: DataFrame | None = None) -> DataFrame:
    """Left join to a table with unique keys, such as a dimension or a cache.

    By default the adaptive planner splits skewed partitions and broadcasts a
    table that turns out small. With ``split_hot`` the work is made even by
    construction: rows of hot keys are answered from a broadcast of those few
    table rows, and (like rows with a null key) spread over ``SALTS`` keys
    that match nothing in the shuffled join. ``hot`` names these keys where they are
    known (few, see ``hot_keys``); otherwise ``df`` is counted first.
    """
    keys = list(keys)
    if not split_hot:
        return df.join(table, keys, "left")
    added = [c for c in table.columns if c not in keys]
    hot = hot_keys(df.select(*keys), keys) if hot is None else hot
    hot_rows = table.join(F.broadcast(hot), keys, "left_semi").select(*keys, F.struct(*added).alias("_warm"))
    any_null = F.lit(False)
    for k in keys:
        any_null |= F.col(k).isNull()
    # By the place of the row, so that equal rows are spread too.
    spread = F.lit(1) + F.monotonically_increasing_id() % SALTS
    salted = df.join(F.broadcast(hot_rows), keys, "left").withColumn(
        "_salt", F.when(F.col("_warm").isNotNull() | any_null, spread).otherwise(F.lit(0).cast("bigint"))
    )
    cold = table.select(*keys, F.lit(0).cast("bigint").alias("_salt"), F.struct(*added).alias("_cold"))
    found = F.coalesce("_warm", "_cold")
    return salted.join(cold, [*keys, "_salt"], "left").select(
        *df.columns, *[found[c].alias(c) for c in added]
    )


# Rows of a key that stay together; a key with more is dealt out in parts of about this many.
TOGETHER = 100_000
# At most this many keys are dealt out; with more rows, the parts grow instead.
DEALT_KEYS = 1 << 16


def spread_join(many: DataFrame, few: DataFrame, key: str, sizes: DataFrame, by: str, together: int = TOGETHER) -> DataFrame:
    """Inner join on ``key`` where keys may hold any part of the rows of ``many``.

    ``sizes`` has ``key`` and ``n``, how many rows of ``many`` have it. Rows of a large key are dealt out by
    the column ``by``, the matching rows of ``few`` copied for each part. The list of large keys is broadcast: it has at
    most ``DEALT_KEYS`` rows, as each of its keys holds more than that share of all rows.     """
    total = sizes.agg(F.sum("n")).scalar()
    limit = F.greatest(F.lit(together), F.floor(F.coalesce(total, F.lit(0)) / DEALT_KEYS))
    large = F.broadcast(sizes.where(F.col("n") > limit).select(key, F.ceil(F.col("n") / limit).cast("long").alias("_parts")))
    parts = F.coalesce("_parts", F.lit(1).cast("long"))
    left = many.join(large, key, "left").withColumn("_part", F.pmod(F.xxhash64(by), parts)).drop("_parts")
    right = few.join(large, key, "left").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("_parts")
    return left.join(right, [key, "_part"]).drop("_part")


def violations(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Fact rows whose non-null key is missing in the dimension."""
    known = dim.select(F.col(dim_key).alias(fact_key)).distinct()
    return fact.where(F.col(fact_key).isNotNull()).join(known, fact_key, "left_anti")


def only_new(batch: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the batch whose key is not stored yet."""
    return batch.join(existing.select(*keys), list(keys), "left_anti")


def only_known(batch: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    return batch.join(existing.select(*keys), list(keys), "left_semi")
