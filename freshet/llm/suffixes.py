"""Repeated byte strings, found by difference-cover suffix sorting.

Texts are first reduced to what can repeat at all: windows whose anchor (the least
hash of the 24-byte strings inside) is in another document, folded where whole units
are equal (see ``repeats``). What is left is dealt out so that equal windows
meet, and each part is suffix-sorted with the difference cover {1, 2} modulo 3:
sampled triples are sorted and named, the names are sorted by recursion, and the
remaining suffixes are merged in. Neighbours in that order are then compared byte
by byte. Names need not be unique: the recursion ends when they tell 50 bytes apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.common import documents, dropped, flushed, kept, query, rows_of, texts
from freshet.llm.near import mix
from freshet.llm.repeats import contested, covered, in_filter, key_filter, removals, removed_of, shared_filter, split, spread, unit_minima, units_of

WINDOW = 50
GRAM = 24
LONGEST_UNIT = 64
NAMES_PER_SIGN = 2 / (WINDOW - GRAM + 2)
PART_BYTES = 100_000  # of one suffix sort, about
HOT_UNITS = 8000  # from so many units of one name on (half a megabyte, about), its windows are dealt out one by one
BLOCK_BYTES = 1 << 15  # of texts whose windows are named at once, about
BASE = 0x9FB21C651E98DF25
_K = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def raw_of(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def _gram_hashes(raw: bytes) -> np.ndarray:
    """Hashes of the ``GRAM``-byte strings from each place on."""
    grams = max(0, len(raw) - GRAM + 1)
    h = np.zeros(grams, np.uint64)
    if not grams:
        return h
    eight = np.array(np.ndarray((len(raw) - 7,), "<u8", raw, 0, (1,)))
    eight ^= eight >> np.uint64(32)
    for i, k in enumerate(_K):
        x = eight[8 * i : 8 * i + grams] * k
        x ^= x >> np.uint64(29)
        x *= _K[i - 1]
        h += x
    return mix(h)


def _least(hashes: np.ndarray) -> np.ndarray:
    """For each window the least hash in it."""
    least, width, span = hashes, 1, WINDOW - GRAM + 1
    if len(hashes) < span:
        return np.empty(0, np.uint64)
    while 2 * width <= span:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    return np.minimum(least[: len(least) - (span - width)], least[span - width :])


class _Powers:
    """Powers of an odd number and of its inverse, as far as they were asked for."""

    def __init__(self):
        self.up = self.down = np.empty(0, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(2 * n, b, np.uint64)]), dtype=np.uint64) for b in (BASE, pow(BASE, -1, 1 << 64)))
        return self.up[:n], self.down[:n]


class _Block:
    """Some texts one behind the other, and the runs of windows with one anchor in each."""

    def __init__(self, raws: list[bytes], longest: int):
        sizes = np.array([len(r) for r in raws], np.int64)
        self.raw, self.start = b"".join(raws), np.cumsum(sizes) - sizes
        self.hashes = _gram_hashes(self.raw)
        names = _least(self.hashes)
        # No run goes on in the next text; windows that would reach into it are left out.
        windows = np.maximum(sizes - WINDOW + 1, 0)
        new = np.empty(len(names) + 1, bool)
        new[:1] = True
        new[1:-1] = names[1:] != names[:-1]
        ends = np.concatenate([self.start, self.start + windows])
        new[ends[ends < len(names)]] = True
        begin = np.flatnonzero(new[:-1])
        size = np.diff(begin, append=len(names))
        text = np.searchsorted(self.start, begin, "right") - 1
        some = begin < (self.start + windows)[text]
        self.lo, self.n, nth = split(begin[some], size[some], longest)
        self.text, self.name = text[some][nth], names[self.lo]

    def keep(self, some: np.ndarray) -> None:
        self.lo, self.n, self.text, self.name = self.lo[some], self.n[some], self.text[some], self.name[some]

    def units(self, powers: _Powers) -> np.ndarray:
        """64 bits of the content of each run: the sum of its hashes times powers of their place."""
        up, down = powers(len(self.hashes) + 1)
        total = np.concatenate([[np.uint64(0)], np.cumsum(self.hashes * up[:-1], dtype=np.uint64)])
        size = self.n + (WINDOW - GRAM)
        own = (total[self.lo + size] - total[self.lo]) * down[self.lo]
        return mix(own ^ (size.astype(np.uint64) * _K[0]))


def _blocks(texts: list[str], longest: int) -> Iterator[tuple[int, _Block]]:
    """Texts of about ``BLOCK_BYTES`` at once, with the number of the first."""
    held, size, first = [], 0, 0
    for i, text in enumerate(texts):
        held.append(raw_of(text))
        size += len(held[-1])
        if size >= BLOCK_BYTES or i + 1 == len(texts):
            yield first, _Block(held, longest)
            held, size, first = [], 0, i + 1


def _names_maker():
    def many(texts: list[str]) -> Iterator[np.ndarray]:
        for _, block in _blocks(texts, 1 << 62):
            order = np.argsort(block.name)
            name = block.name[order]
            same = name[1:] == name[:-1]
            # Only names that come again have to be told apart by their texts.
            again = np.concatenate([same, [False]])[: len(name)] | np.concatenate([[False], same])[: len(name)]
            few = order[again]
            few = few[np.lexsort((block.text[few], block.name[few]))]
            own, text = block.name[few], block.text[few]
            new = np.concatenate([[True], (own[1:] != own[:-1]) | (text[1:] != text[:-1])])[: len(own)]
            yield np.concatenate([name[~again], own[new]])

    def names(text: str) -> np.ndarray:
        return next(many([text]))

    names.many = many
    return names


def _unit_maker():
    powers = _Powers()

    def units(texts: list[str], bitmap: np.ndarray) -> Iterator[tuple]:
        for first, block in _blocks(texts, LONGEST_UNIT):
            block.keep(in_filter(bitmap, spread(block.name)))
            yield block.text + first, block.name, block.units(powers), block.lo - block.start[block.text], block.n, []

    return units


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.record_batch([pa.array(mix(b.column("name").to_numpy().view(np.uint64)).view(np.int64))], names=["key"])


def _slices(raw: bytes, begin: np.ndarray, size: np.ndarray) -> pa.Array:
    """The bytes from each place on."""
    end = np.cumsum(size)
    at = np.arange(int(size.sum())) + np.repeat(begin - end + size, size)
    offsets = np.concatenate([[0], end]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(np.frombuffer(raw, np.uint8)[at])])


def _bodies(docs: DataFrame, keys) -> DataFrame:
    """``name, unit, doc_id, body`` of the units whose name's key is in the filter, once for each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _Powers()
        for b in batches:
            ids = b.column("doc_id").to_numpy()
            for first, block in _blocks(b.column("text").to_pylist(), LONGEST_UNIT):
                block.keep(in_filter(keys.value, mix(block.name)))
                unit = block.units(powers)
                order = np.lexsort((unit, block.name, block.text))
                same = np.all([x[order][1:] == x[order][:-1] for x in (unit, block.name, block.text)], axis=0)
                one = order[np.concatenate([[True], ~same])[: len(order)]]
                body = _slices(block.raw, block.lo[one], block.n[one] + WINDOW - 1)
                held = [block.name[one].view(np.int64), unit[one].view(np.int64), ids[block.text[one] + first]]
                yield pa.record_batch([*map(pa.array, held), body], names=["name", "unit", "doc_id", "body"])

    known = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text")
    return known.mapInArrow(run, "name long, unit long, doc_id long, body binary")


def _packed(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """One number for each triple that sorts like the triple."""
    m = int(max(a.max(initial=0), b.max(initial=0), c.max(initial=0))) + 1
    first = a * m + b
    if m**3 >= 2**62:
        first = _dense(first)
    return first * m + c


def _dense(x: np.ndarray) -> np.ndarray:
    """Ranks from 1 on; equal numbers have equal ranks."""
    if not len(x):
        return x
    order, own = _sorted(x)
    out = np.empty(len(x), np.int64)
    out[order] = np.cumsum(np.concatenate([[True], own[1:] != own[:-1]]))
    return out


def _sorted(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(x)
    return order, x[order]


def _less(own: tuple[np.ndarray, np.ndarray], others: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """For each of some ``_sorted`` numbers how many others are smaller; sorted numbers are looked up side by side."""
    out = np.empty(len(own[0]), np.int64)
    out[own[0]] = np.searchsorted(others[1], own[1])
    return out


def suffix_ranks(s: np.ndarray, depth: int) -> np.ndarray:
    """For each position the number of suffixes that are smaller.

    Suffixes that differ in their first ``depth`` symbols (positive numbers) are ordered as these;
    those with the same first ``depth`` symbols have neighbouring ranks in any order or the same one.
    """
    n = len(s)
    if n < 3:
        return _tiny(s, depth)
    p = np.concatenate([s, np.zeros(3, np.int64)])
    one, two, zero = np.arange(1, n, 3), np.arange(2, n, 3), np.arange(0, n, 3)
    sampled = np.concatenate([one, two])
    names = _dense(_packed(p[sampled], p[sampled + 1], p[sampled + 2]))
    if depth > 3 and names.max() < len(names):
        joined = np.concatenate([names[: len(one)], [0], names[len(one) :]])
        below = suffix_ranks(joined, -(-depth // 3)) + 1
        names = np.concatenate([below[: len(one)], below[len(one) + 1 :]])
    rank = np.zeros(n + 3, np.int64)
    rank[sampled] = names

    big = int(rank.max()) + 1
    key_zero, key_one = (_sorted(p[x] * big + rank[x + 1]) for x in (zero, one))
    triples = _packed(*(np.concatenate([f(zero), f(two)]) for f in (lambda x: p[x], lambda x: p[x + 1], lambda x: rank[x + 2])))
    zero_two, two_two = _sorted(triples[: len(zero)]), _sorted(triples[len(zero) :])
    out = np.empty(n, np.int64)
    out[zero] = _less(key_zero, key_zero) + _less(key_zero, key_one) + _less(zero_two, two_two)
    names = _sorted(names)
    before = _less(names, names)
    out[one] = before[: len(one)] + _less(key_one, key_zero)
    out[two] = before[len(one) :] + _less(two_two, zero_two)
    return out


def _tiny(s: np.ndarray, depth: int) -> np.ndarray:
    cut = [tuple(s[i : i + depth].tolist()) for i in range(len(s))]
    return np.array([sum(x < y for x in cut) for y in cut], np.int64)


def late_windows(names: np.ndarray, units: np.ndarray, least: np.ndarray, first: np.ndarray, bodies: list[bytes]) -> tuple:
    """(name, unit, number in the unit, how many) of the runs of windows that a unit with a smaller ``least`` has too.

    ``first`` is the number in its unit of each body's first window.
    """
    raw = np.frombuffer(b"".join(bodies), np.uint8)
    sizes = np.array([len(b) for b in bodies], np.int64)
    n = sizes - WINDOW + 1
    each = np.repeat(np.arange(len(bodies)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start = np.repeat(np.cumsum(sizes) - sizes, n) + at
    rank = suffix_ranks(raw.astype(np.int64) + 1, WINDOW)
    order = np.argsort(rank[start], kind="stable")
    seen = np.lib.stride_tricks.sliding_window_view(raw, WINDOW)[start[order]]
    new = np.concatenate([[True], (seen[1:] != seen[:-1]).any(1)])
    own = least[each[order]]
    smallest = np.minimum.reduceat(own, np.flatnonzero(new))[np.cumsum(new) - 1]
    late = np.sort(order[smallest < own])
    begin = np.flatnonzero(np.concatenate([[True], (np.diff(late) != 1) | (np.diff(each[late]) != 0)])[: len(late)])
    run, size = late[begin], np.diff(np.concatenate([begin, [len(late)]]))
    return names[each[run]], units[each[run]], first[each[run]] + at[run], size


def _late(group: pa.Table) -> pa.Table:
    get = lambda c: group.column(c).to_numpy()
    found = late_windows(get("name"), get("unit"), get("least"), get("first"), group.column("body").to_pylist())
    return pa.table([pa.array(x.astype(t)) for x, t in zip(found, (np.int64, np.int64, np.int32, np.int32))], names=["name", "unit", "at", "n"])


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` for every row; ``kept`` is the remaining bytes.

    A byte goes when it is in a string of ``WINDOW`` bytes that also starts in a document with a
    smaller doc_id; strings are judged on the input. A null text is empty, a shorter
    text stays whole. Rows with one doc_id do not remove bytes of each other; a row
    without a doc_id neither loses bytes nor takes any.
    """
    docs = texts(docs, id_col, text_col)
    context = docs.sparkSession.sparkContext
    names = context.broadcast(shared_filter(docs, _names_maker, NAMES_PER_SIGN))
    units = units_of(docs, names, _unit_maker, bodies=False)
    minima = kept(unit_minima(units), "unit_minima")
    open_ = kept(contested(minima), "contested")
    names.destroy()
    keys = context.broadcast(key_filter(open_.select("name").distinct().mapInArrow(_keys, "key long")))
    # A body comes from the document of the least id, so that units in many documents are neither sorted nor meet in one task.
    bodies = _bodies(docs, keys).withColumnRenamed("doc_id", "least")
    open_bodies = kept(bodies.join(open_.hint("shuffle_hash"), ["name", "unit", "least"]).select("name", "unit", "least", "body"), "bodies")
    dropped(open_)
    size = open_bodies.agg(F.sum(F.length("body"))).first()[0] or 0
    parts = max(1, -(-size // PART_BYTES))
    hot = open_bodies.groupBy("name").agg(F.count(F.lit(1)).alias("_n")).where(f"_n >= {HOT_UNITS}").select("name", F.lit(True).alias("_hot"))
    marked = open_bodies.join(hot, "name", "left")
    part_of = lambda c: F.pmod(F.xxhash64(c), F.lit(parts)).cast("int").alias("part")
    whole = marked.where("_hot IS NULL").select(part_of("name"), "name", "unit", "least", F.lit(0).alias("first"), "body")
    each = F.transform(F.sequence(F.lit(1), F.length("body") - WINDOW + 1), lambda i: F.substring("body", i, F.lit(WINDOW)))
    single = marked.where("_hot").select("name", "unit", "least", F.posexplode(each).alias("first", "body"))
    single = single.select(part_of("body"), "name", "unit", "least", "first", "body")
    late = kept(whole.union(single).groupBy("part").applyInArrow(_late, "name long, unit long, at int, n int"), "late")
    dropped(open_bodies)
    gone = removals(units, minima, late)
    dropped(units, minima, late)
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for (key, text), removed in zip(rows_of(batch, "doc_id", "text"), removed_of(batch)):
                    raw = raw_of(text)
                    if removed is None:
                        yield key, len(raw), 0, 0, raw
                        continue
                    out = covered(removed, WINDOW, len(raw))
                    spans = int(np.count_nonzero(out[1:] & ~out[:-1])) + int(out[0])
                    yield key, len(raw), int(out.sum()), spans, np.frombuffer(raw, np.uint8)[~out].tobytes()

        yield from flushed(rows(), schema, 256)

    keyed = docs.withColumn("_k", F.xxhash64("text"))
    gone = gone.select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_t"), "removed")
    found = keyed.join(gone.hint("shuffle_hash"), (F.col("doc_id") == F.col("_d")) & (F.col("_k") == F.col("_t")), "left").select("doc_id", "text", "removed")
    return found.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


SQL = """
WITH w AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (SELECT r, doc_id, i, substr(h, 2 * i + 1, 100) AS k FROM (SELECT *, unnest(range(0, length(h) // 2 - 49)) AS i FROM w)),
f AS (SELECT k, min(doc_id) AS least FROM win GROUP BY k),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 50)) AS j FROM win JOIN f USING (k) WHERE least < doc_id),
bytes AS (SELECT r, substr(h, 2 * j + 1, 2) AS b, j FROM (SELECT *, unnest(range(0, length(h) // 2)) AS j FROM w)),
kept AS (SELECT r, string_agg(b, '' ORDER BY j) AS kept, count(*) AS n FROM bytes ANTI JOIN gone USING (r, j) GROUP BY r),
spans AS (SELECT g.r, count(*) AS n_spans FROM gone g LEFT JOIN gone b ON b.r = g.r AND b.j = g.j - 1 WHERE b.r IS NULL GROUP BY g.r)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(length(h) // 2 - coalesce(n, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM w LEFT JOIN kept USING (r) LEFT JOIN spans USING (r)
"""


@query(SQL)
def op6_suffixes(spark, d):
    return deduplicated(documents(spark, d)).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
