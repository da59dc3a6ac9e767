"""What the two substring operators share: from places that may repeat to windows to remove.

A window is a fixed number of consecutive symbols of one text. Each window picks
an *anchor* by its own content only, so equal windows pick anchors of equal names,
and a window whose anchor's name is in no other document repeats in none. Runs
of windows with one anchor form a *unit*. Units with equal symbols are folded
into one; only where different units share an anchor's name are their windows
compared one by one. So long copies cost one row per unit, not one per window.

Names that two documents share are put in a bitmap of fixed size, which keeps most
other units from being shuffled. It decides nothing: when it is too small for
the data, more rows travel and the result is the same.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.common import dropped, kept

FILTER_BITS = 28  # 32 MB
NAME_BITS = 48  # the exchange for the filter uses the upper bits of a name
PART_NAMES = 1_000_000  # names of a part, about
FLUSH_NAMES = 1_500_000  # names a task holds before it sends them
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
SLICES = 4  # parts of the names whose units are joined one after the other


def _packed(names: np.ndarray) -> bytes:
    """Sorted numbers as differences, of four bytes where they fit."""
    gaps = np.diff(names, prepend=np.uint64(0))
    if len(gaps) > 1 and int(gaps[1:].max()) < 1 << 32:
        return b"4" + names[:1].tobytes() + gaps[1:].astype(np.uint32).tobytes()
    return b"8" + names.tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    if raw[:1] == b"8":
        return np.frombuffer(raw, np.uint64, offset=1)
    gaps = np.frombuffer(raw, np.uint32, offset=9).astype(np.uint64)
    return np.cumsum(np.concatenate([np.frombuffer(raw, np.uint64, 1, 1), gaps]), dtype=np.uint64)


def _twice(names: np.ndarray) -> np.ndarray:
    """Of sorted numbers those that appear more than once, repeated as often as after the first time."""
    return names[1:][names[1:] == names[:-1]]


def spread(names: np.ndarray) -> np.ndarray:
    """One to one, and even in the upper bits: anchors are the least of many hashes, so that their names lie close to zero."""
    return names * _SPREAD


def shared_filter(docs: DataFrame, names_of: Callable[[], Callable[[str], np.ndarray]], per_sign: float) -> np.ndarray:
    """A bitmap of fixed size with the anchor names, ``spread``, that two or more documents have.

    ``docs`` has ``doc_id`` and ``text``; ``names_of()`` makes, in a task, the function
    from a text to its distinct names (64 bits). ``per_sign`` is about how many names a sign
    of text gives; it sets the number of parts the names are dealt to, by the upper bits of ``spread``,
    which are also the place in the bitmap. Each task sends a name once, however
    many of its documents have it, and says which it has seen twice.
    """
    docs = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    expected = (docs.agg(F.sum(F.length("text"))).first()[0] or 0) * per_sign

    def even() -> Callable[[str], np.ndarray]:
        names = names_of()
        out = lambda text: spread(names(text))
        if many := getattr(names, "many", None):
            out.many = lambda texts: map(spread, many(texts))
        return out

    return shared_names(docs.select(F.col("text").alias("part")), even, expected)


def filter_bits(expected: float) -> int:
    """The size of a bitmap for about ``expected`` names: 16 bits or more for each, up to ``FILTER_BITS``."""
    return min(FILTER_BITS, max(16, int(np.ceil(np.log2(16 * max(1.0, expected))))))


def shared_names(parts: DataFrame, names_of: Callable[[], Callable], expected: float, log_bits: int = FILTER_BITS) -> np.ndarray:
    """The bitmap of names that two or more rows of ``parts`` (column ``part``) have; about ``expected`` names in all.

    A function with an attribute ``many`` takes a list of values at once and gives the names of some values after the other.
    """
    part_bits = min(log_bits - 6, max(4, int(np.ceil(np.log2(max(1.0, expected / PART_NAMES))))))
    shift = np.uint64(NAME_BITS - part_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held, size = names_of(), [], 0

        def flush() -> pa.RecordBatch:
            flat = np.sort(np.concatenate(held)) >> np.uint64(64 - NAME_BITS)
            again = _twice(flat)
            rows: dict[str, list] = {"part": [], "names": [], "twice": []}
            for kind, x in (("names", flat), ("twice", again)):
                x = x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x
                cut = np.flatnonzero(np.diff(x >> shift)) + 1
                for y in np.split(x, cut) if len(x) else []:
                    rows["part"].append(int(y[0] >> shift))
                    rows[kind].append(_packed(y))
                    rows["twice" if kind == "names" else "names"].append(None)
            return pa.record_batch([pa.array(rows["part"], pa.int32()), pa.array(rows["names"], pa.binary()), pa.array(rows["twice"], pa.binary())], names=list(rows))

        for batch in batches:
            values = batch.column("part").to_pylist()
            for n in names.many(values) if hasattr(names, "many") else map(names, values):
                if len(n):
                    held.append(n)
                    size += len(n)
                if size >= FLUSH_NAMES:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    def met(group: pa.Table) -> pa.Table:
        part = group.column("part")[0].as_py()
        flat = np.sort(np.concatenate([np.empty(0, np.uint64)] + [_unpacked(x) for x in group.column("names").to_pylist() if x]))
        twice = [_unpacked(x) for x in group.column("twice").to_pylist() if x]
        place = np.concatenate([_twice(flat), *twice]) >> np.uint64(NAME_BITS - log_bits)
        width = log_bits - part_bits
        bits = np.zeros(1 << width, bool)
        bits[(place & np.uint64((1 << width) - 1)).astype(np.int64)] = True
        return pa.table({"part": pa.array([part], pa.int32()), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    sent = parts.select("part").mapInArrow(run, "part int, names binary, twice binary")
    # 2 ** log_bits bits come to the driver, whatever the number of names.
    slices = sent.groupBy("part").applyInArrow(met, "part int, bits binary").toArrow()
    out = np.zeros((1 << part_bits, 1 << (log_bits - part_bits - 6)), np.uint64)
    for part, bits in zip(slices.column("part"), slices.column("bits")):
        out[part.as_py()] = np.frombuffer(bits.as_buffer(), np.uint64)
    return out.ravel()


def key_filter(keys: DataFrame) -> np.ndarray:
    """The same kind of bitmap of a column ``key`` of well-mixed numbers."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column("key").to_numpy().view(np.uint64) >> np.uint64(64 - FILTER_BITS)
            word = (place >> np.uint64(6)).astype(np.int32)
            yield pa.record_batch([pa.array(word), pa.array((np.uint64(1) << (place & np.uint64(63))).view(np.int64))], names=["word", "bits"])

    # At most 2 ** (FILTER_BITS - 6) rows come to the driver, whatever the number of keys.
    words = keys.select("key").mapInArrow(mark, "word int, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def in_filter(bitmap: np.ndarray, names: np.ndarray) -> np.ndarray:
    place = names >> np.uint64(64 - (int(len(bitmap)).bit_length() + 5))  # 64 bits in each of 2 ** n entries
    return ((bitmap[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1)).astype(bool)


def runs_of(names: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and length of the runs of equal values, cut after ``longest``."""
    if not len(names):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    begin = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
    size = np.diff(np.concatenate([begin, [len(names)]]))
    return split(begin, size, longest)[:2]


def split(begin: np.ndarray, size: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs cut after ``longest``, and which run each part is of."""
    if not len(size) or size.max() <= longest:
        return begin, size, np.arange(len(size))
    parts = -(-size // longest)
    of = np.repeat(np.arange(len(size)), parts)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
    return begin[of] + nth * longest, np.minimum(size[of] - nth * longest, longest), of


def unit_minima(units: DataFrame) -> DataFrame:
    """``name, unit, least``, and ``body`` where units have one: each different unit with the smallest doc_id that has it."""
    body = [F.any_value("body").alias("body")] if "body" in units.columns else []
    return units.groupBy("name", "unit").agg(F.min("doc_id").alias("least"), *body)


def contested(minima: DataFrame) -> DataFrame:
    """The different units of names that have more than one."""
    names = minima.groupBy("name").agg(F.min("unit").alias("_a"), F.max("unit").alias("_b")).where("_a <> _b").select("name")
    return minima.join(names, "name", "left_semi")


def removals(units: DataFrame, minima: DataFrame, late: DataFrame) -> DataFrame:
    """``doc_id, text_key, removed``: a stored array of (first window, number of windows) for each text with any.

    ``late`` has ``name, unit, at, n`` for runs of windows (first number in the unit, how many) of contested
    units that a document smaller than the unit's least one has. The names go through in ``SLICES`` parts, one
    after the other, so that only one part of the units is on the executors' disks as shuffle files. Store ``late`` first.
    """
    own = F.pmod(F.xxhash64("name"), F.lit(SLICES))
    parts = [kept(_removals(*(t.where(own == i) for t in (units, minima, late))), "removals") for i in range(SLICES)]
    gone = reduce(DataFrame.unionAll, parts).groupBy("doc_id", "text_key").agg(F.flatten(F.collect_list("removed")).alias("removed"))
    gone = kept(gone, "gone")
    dropped(*parts)
    return gone


def _removals(units: DataFrame, minima: DataFrame, late: DataFrame) -> DataFrame:
    by_unit = late.groupBy("name", "unit").agg(F.collect_list(F.struct("at", "n")).alias("runs"))  # at most the windows of a unit
    known = minima.select("name", "unit", "least").join(by_unit, ["name", "unit"], "left")
    # A unit is once in ``known``: the units are streamed along it and need no sort.
    whole = units.select("name", "unit", "doc_id", "text_key", "lo", "n").join(known.hint("shuffle_hash"), ["name", "unit"])
    single = F.transform("runs", lambda run: F.struct((F.col("lo") + run["at"]).alias("lo"), run["n"].alias("n")))
    gone = whole.withColumn("removed", F.when(F.col("doc_id") > F.col("least"), F.array(F.struct("lo", "n"))).otherwise(single))
    gone = gone.where("removed IS NOT NULL").select("doc_id", "text_key", "removed")
    return gone.groupBy("doc_id", "text_key").agg(F.flatten(F.collect_list("removed")).alias("removed"))


def removed_of(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
    """For each row the first windows and numbers of windows in its column ``removed``, None without any."""
    column = batch.column("removed")
    lo, n = (x.to_numpy() for x in column.flatten().flatten())
    end = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy()).tolist()
    for a, b in zip([0, *end], end):
        yield (lo[a:b], n[a:b]) if b > a else None


def covered(removed: tuple[np.ndarray, np.ndarray], width: int, size: int) -> np.ndarray:
    """Which of ``size`` symbols a removed window of ``width`` covers."""
    lo, n = removed
    begin, end = (np.bincount(x, minlength=size + 1) for x in (lo, lo + n + width - 1))
    return np.cumsum(begin - end)[:-1] > 0


UNITS = "name long, unit long, doc_id long, text_key long, lo int, n int"


def units_of(docs: DataFrame, bitmap, cut: Callable[[], Callable], bodies: bool) -> DataFrame:
    """The stored units (``UNITS``, and ``body binary`` on demand) whose name is in the filter.

    ``cut()`` makes, in a task, the function from (texts, filter) to arrays
    (number of the text, name, unit, lo, n) and a list of bodies, for some texts after the other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, known = cut(), bitmap.value
        for batch in batches:
            held: list[list] = [[] for _ in range(6)]
            found_bodies: list[bytes] = []
            ids, text_keys = (batch.column(c).to_numpy() for c in ("doc_id", "text_key"))
            for at, name, unit, lo, n, body in units(batch.column("text").to_pylist(), known):
                for to, x in zip(held, (name.view(np.int64), unit.view(np.int64), ids[at], text_keys[at], lo, n)):
                    to.append(x)
                found_bodies += body if bodies else []
            if held[0]:
                columns = [np.concatenate(x) for x in held]
                arrays = [pa.array(x) for x in columns[:4]] + [pa.array(x.astype(np.int32)) for x in columns[4:]]
                out = pa.record_batch(arrays + ([pa.array(found_bodies, pa.binary())] if bodies else []), names=[f.split()[0] for f in ddl.split(", ")])
                for at in range(0, out.num_rows, 1 << 16):
                    yield out.slice(at, 1 << 16)

    ddl = UNITS + (", body binary" if bodies else "")
    known = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return kept(known.mapInArrow(run, ddl), "units")
