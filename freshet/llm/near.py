"""Near-duplicates: universal-hash minima, bands, signature check, exact check, components.

Texts with equal shingle sets are one class from the start. Classes that share a
band are candidates. Shingles that no other candidate has cannot be shared, so a
pair is passed over when those that are left could not reach the threshold. In a
band each member is first compared with the one that has the fewest shingles of
its own, which joins the common groups at once. Bands that still hold several
components go on in rounds: a growing share of the members, by a hash of the id,
is compared with the members of other components, until every pair of a band
was compared, passed over by that bound, or is connected. These pairs are also
passed over when the places of their first common shingle, the rarest first, rule them out.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.common import documents, flushed, kept, query, rows_of, texts
from freshet.llm.components import components
from freshet.llm.repeats import filter_bits, in_filter, shared_names
from freshet.session import stored

ROWS = 4  # minima of a band
MISS = 1e-8  # chance that a pair just at the threshold shares no band
MARGIN = 0.2  # a pair whose signatures agree this much less than the threshold is not looked at further
FEW = 8  # members of a band compared with all others in its first round; bands under FEW**4 members have two rounds

_MIX1, _MIX2, _MIX3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX2
    x = (x ^ (x >> np.uint64(27))) * _MIX3
    return x ^ (x >> np.uint64(31))


_SIGN = mix(np.arange(1, 257, dtype=np.uint64) * _MIX1)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


class WordHasher:
    """64-bit hashes of words: sums of random numbers of the signs times powers of their place in the word."""

    def __init__(self):
        self.power = self.inverse = np.ones(1, np.uint64)

    def __call__(self, raw: bytes) -> np.ndarray:
        """The hashes of the words of ``raw`` between blanks."""
        n = len(raw)
        if not n:
            return np.empty(0, np.uint64)
        if n > len(self.power):
            room = 1 << max(16, n.bit_length())
            back = np.uint64(pow(int(_STEP), -1, 1 << 64))
            self.power, self.inverse = (np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(room, x)])) for x in (_STEP, back))
        signs = np.frombuffer(raw, np.uint8)
        blank = np.empty(n + 2, bool)
        blank[0] = blank[-1] = True
        _BLANK.take(signs, out=blank[1:-1])
        edge = np.flatnonzero(blank[1:] != blank[:-1])
        if not len(edge):
            return np.empty(0, np.uint64)
        total = np.zeros(n + 1, np.uint64)
        value = _SIGN.take(signs)
        value *= self.power[:n]
        np.cumsum(value, out=total[1:])
        start, end = edge[::2], edge[1::2]
        return mix((total[end] - total[start]) * self.inverse[start] + (end - start).astype(np.uint64))


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of a pair of hashes."""
    x = a * _MIX1
    x += b
    x ^= x >> np.uint64(32)
    x *= _MIX2
    x ^= x >> np.uint64(29)
    return x


def shingle_set(text: str | None, k: int, hasher: WordHasher) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles, A-Z in lower case; with fewer than ``k`` words, of the whole sequence."""
    w = hasher(text.encode("utf-8", "surrogatepass").lower()) if text else np.empty(0, np.uint64)
    n = len(w)
    if not n:
        return w
    width = min(n, k)
    h = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        h = pair(h, w[i : n - width + 1 + i])
    h.sort()
    return h[np.concatenate([[True], h[1:] != h[:-1]])]


def bands_for(percent: int) -> int:
    return ceil(log(MISS) / log(1 - (percent / 100) ** ROWS))


def _factors(minima: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    a = rng.integers(0, 2**31, minima, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return a[:, None], rng.integers(0, 2**32, minima, dtype=np.uint32)[:, None]


def signature(shingles: np.ndarray, factors: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Least value of each universal hash a * x + b (mod 2**32) over the set."""
    a, b = factors
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(a), np.uint32(0xFFFFFFFF))
    for i in range(0, len(x), 2048):
        np.minimum(least, (a * x[i : i + 2048] + b).min(1), out=least)
    return least


def signatures(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """``doc_id, n, cls, sig``: set size, 16-byte key of the set, minima. Both null for an empty set."""
    minima = ROWS * bands_for(percent)
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("cls", pa.binary()), ("sig", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, hasher = _factors(minima), WordHasher()

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for key, text in rows_of(batch, "doc_id", "text"):
                    s = shingle_set(text, k, hasher)
                    if len(s):
                        yield key, len(s), blake2b(s.tobytes(), digest_size=16).digest(), signature(s, factors).tobytes()
                    else:
                        yield key, 0, None, None

        yield from flushed(rows(), schema)

    return docs.mapInArrow(run, "doc_id long, n long, cls binary, sig binary")


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row (band key, id) for every band of every signature."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sig = np.stack([np.frombuffer(s, np.uint32) for s in batch.column("sig").to_pylist()]).astype(np.uint64)
        key = np.broadcast_to(np.arange(sig.shape[1] // ROWS, dtype=np.uint64), (len(sig), sig.shape[1] // ROWS)).copy()
        for i in range(ROWS):
            key = mix(key * _MIX1 + sig[:, i::ROWS])
        ids = np.repeat(batch.column("id").to_numpy(), key.shape[1])
        yield pa.record_batch([pa.array(key.ravel().view(np.int64)), pa.array(ids)], names=["band", "id"])


def _agreeing(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (
                np.stack([np.frombuffer(s, np.uint32) for s in batch.column(batch.schema.get_field_index(c)).to_pylist()]) for c in ("sig_a", "sig_b")
            )
            keep = pa.array((a == b).mean(1) >= least)
            yield batch.select(["a", "b"]).filter(keep)

    return run


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in rows_of(batch, "set_a", "set_b"):
                both = np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)])
                both.sort(kind="stable")
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * shared >= percent * (len(both) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _sets(docs: DataFrame, k: int) -> DataFrame:
    schema = pa.schema([("id", pa.int64()), ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        rows = ((key, shingle_set(text, k, hasher).tobytes()) for b in batches for key, text in rows_of(b, "doc_id", "text"))
        yield from flushed((r for r in rows if r[1]), schema, 256)

    return docs.mapInArrow(run, "id long, shingles binary")


def _with_common(sets: DataFrame) -> DataFrame:
    """``id, n, c``, stored: the size of each set, and how many of its shingles another set has too (or a few more)."""
    size = (sets.agg(F.sum(F.length("shingles"))).first()[0] or 0) / 8
    read = lambda: lambda raw: np.frombuffer(raw, np.uint64)
    known = sets.sparkSession.sparkContext.broadcast(shared_names(sets.select(F.col("shingles").alias("part")), read, size, filter_bits(size)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(x, np.uint64) for x in batch.column("shingles").to_pylist()]
            yield pa.record_batch(
                [batch.column("id"), pa.array([len(x) for x in found], pa.int64()), pa.array([int(in_filter(known.value, x).sum()) for x in found], pa.int64())],
                names=["id", "n", "c"],
            )

    out = kept(sets.mapInArrow(run, "id long, n long, c long"), "counts")
    known.destroy()
    return out


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row (id, n, shingle) for every shingle of every set of n."""
    for batch in batches:
        for key, raw in rows_of(batch, "id", "shingles"):
            found = np.frombuffer(raw, np.int64)
            for at in range(0, len(found), 1 << 16):
                part = found[at : at + (1 << 16)]
                yield pa.record_batch([pa.array(np.full(len(part), x, np.int64)) for x in (key, len(found))] + [pa.array(part)], names=["id", "n", "shingle"])


def earliest(sets: DataFrame, percent: int) -> DataFrame:
    """``id, early``: of each set (``id, shingles``) as many of its rarest shingles, in order, as a close enough set must share one of.

    The order, by the number of sets and then by the hash, is the same for all sets. An id with several sets is left out.
    """
    each = sets.mapInArrow(_each, "id long, n long, shingle long")
    counted = each.join(each.groupBy("shingle").agg(F.count(F.lit(1)).alias("often")), "shingle")
    # At most a set's shingles are gathered; several sets of one id have more than the largest of them.
    ordered = counted.groupBy("id").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("often", "shingle"))).alias("all")).where("n = size(all)")
    return ordered.select("id", F.expr(f"slice(all.shingle, 1, size(all) - cast(ceil({percent} * size(all) / 100) as int) + 1)").alias("early"))


def _possible(x: str, y: str, percent: int) -> str:
    """Whether sets of n signs, c of which others have too, can reach the threshold."""
    most = f"least({x}.c, {y}.c)"
    return f"100 * {most} >= {percent} * ({x}.n + {y}.n - {most})"


def crossing(open_: DataFrame, early: DataFrame, end: int, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of a band with different components that may be close enough; one of each has a turn before ``end``.

    Nothing before the first shingle that two sets share in the common order is in both. So its place in either
    tells how many they can share at most, and sets without such a shingle in their ``early`` parts are too far apart.
    """
    rows = open_.join(early, "id", "left")
    first = "get(array_intersect(x.early, y.early), 0)"
    most = f"1 + least(x.n - array_position(x.early, {first}), y.n - array_position(y.early, {first}))"
    met_by = f"x.band = y.band AND x.component <> y.component AND (y.turn >= {end} OR x.id < y.id) AND {_possible('x', 'y', percent)}"
    met_by = F.expr(f"{met_by} AND (x.early IS NULL OR y.early IS NULL OR {100 + percent} * ({most}) >= {percent} * (x.n + y.n))")
    pairs = rows.where(f"turn < {end}").alias("x").join(rows.alias("y"), met_by)
    return pairs.select(F.greatest("x.id", "y.id").alias("a"), F.least("x.id", "y.id").alias("b")).distinct()


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row.

    Documents are linked when their sets of ``k``-word shingles have
    ``100 * intersection >= percent * union``. ``component_id`` is the smallest
    doc_id reachable. A null, empty or blank text has an empty set and no link. Rows
    with one doc_id are one document: their texts' links are joined. A row without a
    doc_id takes no part: its ``component_id`` is null and it is kept.
    """
    docs = texts(docs, id_col, text_col)
    rows = kept(signatures(docs, k, percent), "signatures")
    known = rows.where("doc_id IS NOT NULL AND cls IS NOT NULL")
    classes = stored(known.groupBy("cls").agg(F.min("doc_id").alias("id"), F.any_value("sig").alias("sig")), "classes")
    named = known.select("doc_id", "cls").join(classes.select("cls", "id"), "cls")
    again = named.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    links = named.join(again, "doc_id", "left_semi").where("doc_id <> id").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    found = stored(links.distinct(), "links")

    bands = classes.select("id", "sig").mapInArrow(_banded, "band long, id long")
    shared = bands.groupBy("band").agg(F.min("id").alias("_a"), F.max("id").alias("_b"), F.count(F.lit(1)).alias("size")).where("_a < _b").select("band", "size")
    met = kept(bands.join(shared, "band"), "met")
    involved = met.select(F.col("id").alias("doc_id")).distinct()
    sets = kept(_sets(docs.join(involved, "doc_id", "left_semi"), k), "sets")
    counts = _with_common(sets)
    spread = (F.xxhash64("id").bitwiseAND(F.lit((1 << 30) - 1)) / F.lit(float(1 << 30)) * F.ceil(F.col("size") / FEW)).cast("long")
    members = kept(met.join(counts, "id").withColumn("turn", spread).drop("size"), "members")
    brief = classes.join(involved.withColumnRenamed("doc_id", "id"), "id", "left_semi").select("id", "sig")

    def linked(pairs: DataFrame) -> DataFrame:
        """Of distinct pairs (a, b) those whose sets are close enough."""
        a, b = (brief.select(F.col("id").alias(x), F.col("sig").alias(f"sig_{x}")) for x in "ab")
        close = pairs.join(a, "a").join(b, "b").select("a", "b", "sig_a", "sig_b").mapInArrow(_agreeing(percent / 100 - MARGIN), "a long, b long").distinct()
        left, right = (sets.select(F.col("id").alias(x), F.col("shingles").alias(f"set_{x}")) for x in "ab")
        return close.join(left, "a").join(right, "b").mapInArrow(_confirmed(percent), "a long, b long")

    pivots = members.groupBy("band").agg(F.min(F.struct((F.col("n") - F.col("c")).alias("own"), "id", "n", "c")).alias("p"))
    pivots = pivots.select("band", F.col("p.id").alias("id"), F.col("p.n").alias("n"), F.col("p.c").alias("c"))
    star = members.alias("x").join(pivots.alias("p"), F.expr(f"x.band = p.band AND x.id <> p.id AND {_possible('x', 'p', percent)}"))
    star = star.select(F.greatest("x.id", "p.id").alias("a"), F.least("x.id", "p.id").alias("b")).distinct()
    group = components(found.union(linked(star)))
    limit = members.agg(F.max("turn")).first()[0]
    begin, end, early = 0, 1, None
    while limit is not None and begin <= limit:
        now = members.join(group, "id", "left").withColumn("component", F.coalesce("component", "id"))
        mixed = now.groupBy("band").agg(F.min("component").alias("_c"), F.max("component").alias("_d"), F.max("turn").alias("_t"))
        mixed = mixed.where(f"_c < _d AND _t >= {begin}").select("band")
        open_ = stored(now.where(f"turn >= {begin}").join(mixed, "band", "left_semi").select("band", "id", "component", "turn", "n", "c"), "open")
        if open_.isEmpty():
            break
        if early is None:  # components only grow together, so later rounds have no other ids
            ids = open_.select("id").distinct()
            early = kept(earliest(sets.join(ids, "id", "left_semi"), percent), "early")
        pairs = crossing(open_, early, end, percent)
        more = stored(linked(pairs), "links")
        if not more.isEmpty():
            group = components(group.select(F.col("id").alias("a"), F.col("component").alias("b")).union(more))
        begin, end = end, end * FEW if limit >= FEW**3 else limit + 1
    named = classes.select("cls", "id").join(group, "id", "left").select("cls", F.coalesce("component", "id").alias("_c"))
    out = rows.select("doc_id", "n", "cls").join(named, "cls", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_c", "doc_id"))
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i+2], ' ') AS k FROM (SELECT *, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS m FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * m >= 85 * (nx.n + ny.n - m)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, e.y FROM reach JOIN e ON e.x = reach.y),
c AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""


@query(SQL)
def op10_near(spark, d):
    return near_duplicates(documents(spark, d), k=3, percent=85)
