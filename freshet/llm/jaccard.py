"""Set join of documents by shared shingles: prefixes, groups of equal prefixes, verification, components.

Two sets that are close enough share a shingle among the first ones of each, in any
one order of all shingles. Here the rarest come first, by the number of different
sets that have them; a shingle of one set alone stands before all and links nothing.
So a set whose own shingles fill its prefix has no partner, and a common line is
last in every order.

Sets of equal size and prefix are one group. Groups meet by the shingles of their prefix;
sizes and the number of shingles that anyone shares rule out pairs of groups
before members are looked at. Only connections count, so each member is verified with
its group's leader first, and each leader with the leader that has the fewest shingles of its own among
those that share a shingle. Where a shingle still joins several components, members of
different ones go on in rounds, by a growing share of them, until every pair was
verified, ruled out by its sizes, or connected.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.llm.common import documents, kept, flushed, query, rows_of, texts
from freshet.llm.components import components
from freshet.llm.near import WordHasher, shingle_set
from freshet.llm.repeats import in_filter, shared_names
from freshet.session import stored

FEW = 8  # members of a list that meet all others in its first round, about; the share grows by as much
PARTS = 1 << 17  # a key with more than this share of all rows is looked up in a broadcast table: at most so many keys
SEEN = 1 << 20  # digests of sets a task remembers, so as to send the shingles of copies once


def _needed(n: Column, percent: int) -> Column:
    """The least number of shingles that a set of ``n`` shares with any partner."""
    return ((percent * n + 99) / 100).cast("long")


def _share_limit(total: int) -> int:
    return max(1024, total // PARTS)


def looked_up(rows: DataFrame, known: DataFrame, key: str, limit: int) -> DataFrame:
    """``rows`` with the columns of ``known``, which has one row per key and in ``size`` how many of ``rows`` have it.

    Keys of more than ``limit`` rows go by broadcast: with ``limit`` from ``_share_limit`` at most ``PARTS`` of them.
    """
    hot = known.where(F.col("size") > limit)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(known.where(F.col("size") <= limit), key)
    return rows.join(F.broadcast(hot), key).unionByName(rest)


def sets_of(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """``doc_id, n, cls, shingles``: size and digest of each set; the digest only where enough shingles may be in another set.

    ``shingles`` (64-bit hashes, packed) come once per task and digest. Both are null for a row without a doc_id.
    """
    expected = (docs.agg(F.sum(F.length("text"))).first()[0] or 0) / 6

    def names() -> object:
        hasher = WordHasher()
        return lambda text: shingle_set(text, k, hasher)

    parts = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("text").alias("part"))
    known = docs.sparkSession.sparkContext.broadcast(shared_names(parts, names, expected))
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("cls", pa.binary()), ("shingles", pa.binary())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        hasher, seen = WordHasher(), set()
        for batch in batches:
            for key, text in rows_of(batch, "doc_id", "text"):
                s = shingle_set(text, k, hasher)
                n = len(s)
                if key is None or not n or int(in_filter(known.value, s).sum()) * 100 < percent * n:
                    yield key, n, None, None
                    continue
                cls = blake2b(s.tobytes(), digest_size=16).digest()
                yield key, n, cls, None if cls in seen else s.tobytes()
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(cls)

    found = docs.mapInArrow(lambda batches: flushed(rows(batches), schema, 256), "doc_id long, n long, cls binary, shingles binary")
    found = kept(found, "sets")
    known.destroy()
    return found


def _tokens(sets: DataFrame) -> DataFrame:
    """``token, key`` for every shingle of every set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, raw in rows_of(batch, "key", "shingles"):
                token = np.frombuffer(raw, np.int64)
                yield pa.record_batch([pa.array(token), pa.array(np.full(len(token), key, np.int64))], names=["token", "key"])

    return sets.select("key", "shingles").mapInArrow(run, "token long, key long")


def prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """``key, n, own, head`` of the sets that can have a partner at all.

    ``own``: shingles of no other set. ``head``: the shared shingles of the prefix, rarest first.
    """
    tokens = _tokens(sets)
    total = (sets.agg(F.sum(F.length("shingles"))).first()[0] or 0) // 8
    counts = kept(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "shared_shingles")
    shared = looked_up(tokens, counts, "token", _share_limit(total)).groupBy("key")
    shared = shared.agg(F.count(F.lit(1)).alias("c"), F.sort_array(F.collect_list(F.struct("size", "token"))).alias("order"))
    out = sets.select("key", "n").join(shared, "key").where(F.col("c") >= _needed(F.col("n"), percent))
    own = F.col("n") - F.col("c")
    length = F.col("n") - _needed(F.col("n"), percent) + 1 - own
    head = F.transform(F.slice("order", F.lit(1), length.cast("int")), lambda x: x["token"])
    return out.select("key", "n", own.alias("own"), head.alias("head"))


def _possible(x: str, y: str, percent: int) -> str:
    """Whether two sets that meet at a shingle can be linked, were it the first one that they share.

    ``n`` is the size of a set, ``left`` the number of its shared shingles from that one on. At the first
    shingle that two sets share the bound holds, so no link is lost, and at later ones fewer pairs pass it.
    """
    sizes = f"100 * least({x}.n, {y}.n) >= {percent} * greatest({x}.n, {y}.n)"
    return f"{sizes} AND {100 + percent} * least({x}.left, {y}.left) >= {percent} * ({x}.n + {y}.n)"


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of distinct pairs of keys (a, b) those whose whole sets are close enough.

    The sets of keys that many pairs share as ``b`` are copied, a copy for each thousand pairs or so.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in rows_of(batch, "set_a", "set_b"):
                n = (len(x) + len(y)) // 8
                shared = len(np.intersect1d(np.frombuffer(x, np.int64), np.frombuffer(y, np.int64), assume_unique=True))
                keep.append(100 * shared >= percent * (n - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    pairs = kept(pairs, "pairs")
    total = pairs.count()
    if not total:
        return pairs
    sizes = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("size"))
    limit = _share_limit(total)
    hot = stored(sizes.where(F.col("size") > limit).withColumn("copies", F.expr(f"1 + size div {limit}")).select("b", "copies"), "hot")
    salted = pairs.join(F.broadcast(hot), "b", "left").withColumn("salt", F.pmod(F.xxhash64("a"), F.coalesce("copies", F.lit(1))))
    right = sets.select(F.col("key").alias("b"), F.col("shingles").alias("set_b")).join(sizes.select("b"), "b", "left_semi")
    right = right.join(F.broadcast(hot), "b", "left").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("copies", F.lit(1)) - 1)))
    left = sets.select(F.col("key").alias("a"), F.col("shingles").alias("set_a"))
    both = salted.select("a", "b", "salt").join(right.select("b", "salt", "set_b"), ["b", "salt"]).join(left, "a")
    return both.select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def _ordered(pairs: DataFrame, x: str, y: str) -> DataFrame:
    """The distinct pairs of two keys, the larger one as ``a``."""
    return pairs.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct()


def links(sets: DataFrame, percent: int) -> DataFrame:
    """``id, component`` over the keys of ``sets``: what connects by links, and no link between components."""
    heads = kept(prefixes(sets, percent), "prefixes")
    same = F.md5(F.concat_ws(",", F.col("n").cast("string"), F.col("head").cast("array<string>")))
    # Members of a group have the same number of own shingles as well, as the rest of the prefix is as long.
    groups = heads.withColumn("same", same).groupBy("same").agg(
        F.min("key").alias("rep"), F.any_value("n").alias("n"), F.any_value("own").alias("own"), F.count(F.lit(1)).alias("size"), F.any_value("head").alias("head")
    )
    groups = kept(groups, "groups")
    limit = _share_limit(heads.count())
    members = looked_up(heads.select("key", same.alias("same")), groups.select("same", "rep", "size"), "same", limit)
    members = kept(members.select("key", "rep"), "members")

    # Members with the leader of their group; leaders with the best leader of each shingle.
    postings = groups.select("rep", "n", "own", F.posexplode("head").alias("at", "token"))
    postings = kept(postings.select("token", "rep", "n", "own", (F.col("n") - F.col("own") - F.col("at")).alias("left")), "postings")
    best = postings.groupBy("token").agg(F.min(F.struct("own", "rep", "n", "left")).alias("p"), F.count(F.lit(1)).alias("size")).where("size > 1")
    star = looked_up(postings, best, "token", _share_limit(postings.count()))
    star = star.alias("x").where(F.expr("rep <> p.rep AND " + _possible("x", "p", percent)))
    inner = members.where("key <> rep")
    pairs = _ordered(star, "rep", "p.rep").union(inner.select(F.greatest("key", "rep").alias("a"), F.least("key", "rep").alias("b")))
    found = kept(verified(pairs, sets, percent), "links")
    group = components(found)

    begin, end, open_ = 0, 1, None
    while True:
        if open_ is None:
            open_ = kept(_open(members, postings, group, begin, percent), "open")
        rest = open_.where(F.col("turn") >= begin)
        limit = rest.agg(F.max("turn")).first()[0]
        if limit is None:
            return group
        met = F.expr(f"x.token = y.token AND x.component <> y.component AND (y.turn >= {end} OR x.key < y.key) AND {_possible('x', 'y', percent)}")
        pairs = rest.where(F.col("turn") < end).alias("x").join(rest.alias("y"), met)
        more = kept(verified(_ordered(pairs, "x.key", "y.key"), sets, percent), "links")
        if not more.isEmpty():
            group = components(group.select(F.col("id").alias("a"), F.col("component").alias("b")).union(more))
            open_ = None  # without new links the same rows stay open
        if limit < end:
            return group
        begin, end = end, end * FEW


def _open(members: DataFrame, postings: DataFrame, group: DataFrame, begin: int, percent: int) -> DataFrame:
    """``token, key, n, left, component, turn``: members with a turn from ``begin`` on that share a shingle with another component."""
    now = members.join(group.withColumnRenamed("id", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    now = kept(now, "now")
    by_group = now.groupBy("rep").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi"), F.count(F.lit(1)).alias("members"))
    lists = postings.select("token", "rep", "n").join(by_group, "rep")
    lists = lists.groupBy("token").agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"), F.sum("members").alias("size"), F.min("n").alias("_n"))
    lists = lists.where("_lo < _hi")
    # Groups that cannot be linked even with the smallest set of the list stay out of it.
    reach = F.expr(f"{100 + percent} * left >= {percent} * (n + _n)")
    inside = postings.select("token", "rep", "n", "left").join(lists, "token").where(reach).join(now, "rep")
    spread = F.xxhash64("key").bitwiseAND(F.lit((1 << 30) - 1)) / F.lit(float(1 << 30)) * F.ceil(F.col("size") / FEW)
    inside = inside.select("token", "key", "n", "left", "component", spread.cast("long").alias("turn")).where(F.col("turn") >= begin)
    mixed = inside.groupBy("token").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi")).where("_lo < _hi")
    return inside.join(mixed.select("token"), "token", "left_semi")


def jaccard_join(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row.

    Documents are linked when their sets of ``k``-word shingles have
    ``100 * intersection >= percent * union``; ``component_id`` is the smallest doc_id reachable, its own included.
    With fewer words the whole sequence is the one shingle; a null, empty or blank text has
    none and no link. Rows with one doc_id are one document: the links of their texts are
    joined. A row without a doc_id takes no part; its component is null.
    """
    docs = texts(docs, id_col, text_col)
    found = sets_of(docs, k, percent)
    some = found.where("cls IS NOT NULL")
    named = some.groupBy("cls").agg(F.min("doc_id").alias("id"), F.any_value("n").alias("n"), F.count(F.lit(1)).alias("size"))
    whole = some.where("shingles IS NOT NULL").groupBy("cls").agg(F.any_value("shingles").alias("shingles"))
    sets = kept(named.join(whole, "cls").withColumn("key", F.monotonically_increasing_id()), "classes")
    group = links(sets, percent)

    # From classes to documents: what connects is known by the smallest doc_id of its classes.
    ends = sets.select("key", "cls", "id", F.col("size").alias("rows")).join(group.withColumnRenamed("id", "key"), "key", "left")
    ends = ends.select("cls", "id", "rows", F.coalesce("component", "key").alias("to"))
    first = ends.groupBy("to").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("size"))
    ends = looked_up(ends, first, "to", _share_limit(sets.count())).select("cls", F.col("rows").alias("size"), "first")
    known = kept(looked_up(some.select("doc_id", "cls"), ends, "cls", _share_limit(some.count())).select("doc_id", "first").distinct(), "known")
    # Only documents of several texts connect further.
    again = known.groupBy("doc_id").agg(F.min("first").alias("_a"), F.max("first").alias("_b")).where("_a < _b").select("doc_id")
    joined = kept(known.join(again, "doc_id").select(F.col("doc_id").alias("a"), F.col("first").alias("b")), "links")
    known = known.withColumnRenamed("first", "component")
    if not joined.isEmpty():
        more = components(joined).select(F.col("id").alias("component"), F.col("component").alias("_to"))
        known = known.join(more, "component", "left").select("doc_id", F.coalesce("_to", "component").alias("component")).distinct()
    out = found.select("doc_id", F.col("n").alias("n_shingles")).join(known, "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i+4], ' ') AS k FROM (SELECT *, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS m FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * m >= 80 * (nx.n + ny.n - m)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, e.y FROM reach JOIN e ON e.x = reach.y)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) c USING (doc_id)
"""


@query(SQL)
def op13_jaccard(spark, d):
    return jaccard_join(documents(spark, d), k=5, percent=80)
