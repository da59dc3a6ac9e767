"""Replay-safe merge: one row per key, with a rule per column.

A merge is an ordinary ``groupBy().agg()``: maxima and minima of structs that
start with the arrival order. They combine on the map side, so a key that holds
a large part of all rows costs no more than any other, and the partial form
(`merge_state`) of an old snapshot and of a new batch can be combined in any
grouping. Applying the same rows twice changes nothing.

Rules: ``first``, ``last`` (a null may overwrite), ``last_non_null``,
``min``, ``max``, ``count``, ``sum``. The last two are not replay-safe by
themselves; give them input whose replays are gone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES = ("first", "last", "last_non_null", "min", "max", "count", "sum")


def _by_rule(rules: Mapping[str, str], wanted: str) -> list[str]:
    return [name for name, rule in rules.items() if rule == wanted]


def _check(rules: Mapping[str, str]) -> None:
    unknown = {r for r in rules.values()} - set(RULES)
    if unknown:
        raise ValueError(f"unknown merge rules {sorted(unknown)}")


def _ord(order: Sequence[str]) -> list[Column]:
    return [F.col(o).alias(f"o{i}") for i, o in enumerate(order)]


def merge_state(df: DataFrame, keys: Sequence[str], order: Sequence[str], rules: Mapping[str, str]) -> DataFrame:
    """One row per key that still holds the order of what it kept."""
    _check(rules)
    aggs: list[Column] = []
    for rule, pick in (("first", F.min), ("last", F.max)):
        names = _by_rule(rules, rule)
        if names:
            aggs.append(pick(F.struct(*_ord(order), *[F.col(n) for n in names])).alias(f"_{rule}"))
    for n in _by_rule(rules, "last_non_null"):
        aggs.append(F.max(F.when(F.col(n).isNotNull(), F.struct(*_ord(order), F.col(n)))).alias(f"_nn_{n}"))
    for rule, fn in (("min", F.min), ("max", F.max), ("sum", F.sum)):
        aggs += [fn(n).alias(f"_{rule}_{n}") for n in _by_rule(rules, rule)]
    aggs += [F.count(F.lit(1)).alias(f"_count_{n}") for n in _by_rule(rules, "count")]
    return df.groupBy(*keys).agg(*aggs) if aggs else df.select(*keys).distinct()


def combine_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fold several states of one merge (say, snapshot and batch) into one."""
    aggs = []
    for name in states.columns:
        if name in keys:
            continue
        if name.startswith(("_first", "_min_")):
            fn = F.min
        elif name.startswith(("_sum_", "_count_")):
            fn = F.sum
        else:
            fn = F.max
        aggs.append(fn(name).alias(name))
    return states.groupBy(*keys).agg(*aggs) if aggs else states.distinct()


def finish(state: DataFrame, keys: Sequence[str], rules: Mapping[str, str]) -> DataFrame:
    """The merged table: keys and one column per rule."""

    def value(name: str, rule: str) -> Column:
        if rule in ("first", "last"):
            return F.col(f"_{rule}")[name]
        if rule == "last_non_null":
            return F.col(f"_nn_{name}")[name]
        return F.col(f"_{rule}_{name}")

    return state.select(*keys, *[value(n, r).alias(n) for n, r in rules.items()])


def merge(df: DataFrame, keys: Sequence[str], order: Sequence[str], rules: Mapping[str, str]) -> DataFrame:
    return finish(merge_state(df, keys, order, rules), keys, rules)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Insert-if-absent: the earliest row of each key, whole."""
    rest = [c for c in df.columns if c not in keys]
    return merge(df, keys, order, {c: "first" for c in rest}).select(*df.columns)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return merge(df, keys, order, {c: "last" for c in rest}).select(*df.columns)


def evolve(*frames: DataFrame) -> DataFrame:
    """Union by name in which a column missing on one side is null there."""
    out = frames[0]
    for nxt in frames[1:]:
        out = out.unionByName(nxt, allowMissingColumns=True)
    return out
