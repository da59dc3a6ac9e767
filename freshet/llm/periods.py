"""Periodic runs of words, found by tiles of every scale.

A run of period q and length l is a longest stretch in which words q apart are equal,
q being the smallest such distance and l at least ``max(LEAST, POWER * q)``.

Periods are treated by octave. For B <= q < 2B a text has an anchor at every B-th word,
and the tile of an anchor reaches one B back and four ahead. A run always holds
tiles in a row whose first B words come again between B and 2B later, so
only such tiles are solved. Tiles that follow each other travel in one strip
of bounded size and are dealt out over the cluster, those of one long text as well. In a tile the Z-function
from the anchor on gives how far each period holds ahead, and the
Z-function of the reversed words how far back; a period whose words are a
repetition themselves is left to its own octave. Tiles know runs in
fragments only; the fragments of a document and a period meet by a shuffle
and are stitched where they touch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.llm.common import documents, flushed, kept, query, rows_of, texts

LEAST = 6  # words of the shortest run
POWER = 4  # periods of the shortest run
STRIP_WORDS = 4096  # words of a strip, but STRIP_TILES tiles at least
STRIP_TILES = 16


SHORT = 8  # octaves below are looked through period by period


def _short_tiles(ids: np.ndarray, step: int) -> np.ndarray:
    """Numbers of the tiles whose first words lie in a long enough stretch of some period of this octave."""
    live = np.zeros(len(ids) // step + 1, bool)
    for q in range(step, min(2 * step, len(ids))):
        same = ids[:-q] == ids[q:]
        least = max(LEAST - q, (POWER - 1) * q)
        if np.count_nonzero(same) < least:
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).view(np.int8)))
        for begin, end in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if end - begin >= least:
                live[-(-begin // step) : (end - step) // step + 1] = True
    return np.flatnonzero(live)


def _gram_again(gram: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Numbers of the tiles whose first gram comes again ``step`` to ``2 * step - 1`` places later.

    And which of them have it once more before four steps; None if no gram comes again at all.
    """
    name, back = np.unique(gram, return_inverse=True)
    n = len(gram)
    if len(name) == n:
        return None
    place = np.sort(back * n + np.arange(n))
    anchors = np.arange(0, n, step)
    base = back[anchors] * n

    def between(lo: int, hi: int) -> np.ndarray:
        at = np.searchsorted(place, base + np.minimum(anchors + lo, n))
        return (at < n) & (place[np.minimum(at, n - 1)] < base + np.minimum(anchors + hi, n))

    again = between(step, 2 * step)
    return np.flatnonzero(again), between(2 * step, 4 * step)[again]


def live_tiles(ids: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(B, first anchor, tiles) for stretches of tiles that may hold a part of a run; ``ids`` numbers the words.

    A run holds two tiles in a row at least whose first gram comes again within the octave, and one whose gram comes a third time.
    """
    gram, step, n = ids.astype(np.uint64), 1, len(ids)
    mult = 0x9E3779B97F4A7C15
    while n >= max(LEAST, POWER * step):
        if step < SHORT:
            stretches = [(k, True) for k in _stretches(_short_tiles(ids, step))]
        else:
            found = _gram_again(gram, step)
            if found is None:
                return  # no longer gram comes again either
            third = dict(zip(found[0].tolist(), found[1].tolist()))
            stretches = [(k, len(k) > 1 and any(third[i] for i in k.tolist())) for k in _stretches(found[0])]
        most = max(STRIP_TILES, STRIP_WORDS // step)
        for stretch, possible in stretches:
            for at in range(0, len(stretch) if possible else 0, most):
                part = stretch[at : at + most]
                yield step, int(part[0]) * step, len(part)
        if len(gram) <= step:
            return
        # gram[i] stands for twice as many words from i on; equal words give equal grams.
        gram = (gram[:-step] * np.uint64(mult) + gram[step:]) ^ (gram[:-step] >> np.uint64(29))
        mult = (mult * 0xBF58476D1CE4E5B9 + 2) % (1 << 64)
        step *= 2


def _stretches(numbers: np.ndarray) -> list[np.ndarray]:
    return np.split(numbers, np.flatnonzero(np.diff(numbers) != 1) + 1) if len(numbers) else []


def z_values(s: list, upto: int, step: int = 0) -> list[int] | None:
    """How many first elements of ``s`` come again from each place below ``upto`` on (0 for the first).

    None as soon as the first ``3 * step`` elements prove to have a period below ``step``: by the theorem
    of Fine and Wilf every period from ``step`` on is then a repetition of a shorter one.
    """
    n, z = len(s), [0] * upto
    enough = min(3 * step, n)
    left = right = 0
    i = 1
    while i < upto:
        if i >= right:
            try:
                i = s.index(s[0], i, upto)
            except ValueError:
                break
            k = 1
        else:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                i += 1
                continue
            k = right - i
        while s[i + k : i + k + 32] == s[k : k + 32] and i + k + 32 <= n:
            k += 32
        while i + k < n and s[i + k] == s[k]:
            k += 1
        if i < step and i + k >= enough:
            return None
        z[i] = k
        left, right = i, i + k
        i += 1
    return z


def _prime_factors(q: int) -> list[int]:
    found, p = [], 2
    while p * p <= q:
        if q % p == 0:
            found.append(p)
            while q % p == 0:
                q //= p
        p += 1
    return found + [q] if q > 1 else found


def solve(words: list[int], lo: int, step: int, first: int, tiles: int) -> list[tuple[int, int, int]]:
    """Fragments (period, begin, end): stretches of places whose word comes again a period later.

    ``words`` are those of the strip, the first of which is word ``lo`` of its text.
    """
    out, open_ = [], {}
    for c in range(first - lo, first - lo + tiles * step, step):
        ahead = words[c : c + 4 * step]
        if len(ahead) <= step:
            break
        z = z_values(ahead, min(2 * step, len(ahead)), step)
        periods = [q for q in range(step, len(z)) if z[q] >= step and not any(z[q // p] >= q - q // p for p in _prime_factors(q))] if z else []
        if not periods:
            continue
        back = words[max(0, c - step) : c][::-1]
        far = periods[-1]
        zb = z_values(back + [-1] + words[max(0, c - step) : c + far][::-1], len(back) + 2 + far) if back else None
        for q in periods:
            f = min(z[q], 2 * step)
            b = min(zb[len(back) + 1 + far - q], step) if back else 0
            if b < step and f < 2 * step:
                continue  # ends on both sides within the tile: too short
            begin, end = lo + c - b, lo + c + f
            if q in open_ and begin <= open_[q][1]:
                open_[q] = (open_[q][0], end)
            else:
                if q in open_:
                    out.append((q, *open_[q]))
                open_[q] = (begin, end)
    return out + [(q, *x) for q, x in open_.items()]


TILES = "row long, doc_id long, n_words long, collapsed string, words string, step long, first long, tiles long, lo long, ids binary"


def tiled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of documents, each followed by rows of its strips.

    A document without a strip has its words, joined by blanks, in ``collapsed``, another one in ``words``.
    """
    schema = pa.schema([(n, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[t]) for n, t in (f.split() for f in TILES.split(", "))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for row, key, text in rows_of(batch, "row", "doc_id", "text"):
                words = text.encode().split() if text else []
                known: dict[bytes, int] = {}
                ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.uint32, len(words))
                strips = list(live_tiles(ids))
                plain = b" ".join(words).decode()
                yield (row, key, len(words), None if strips else plain, plain if strips else None) + (None,) * 5
                width = "<u2" if len(known) < 1 << 16 else "<u4"
                for step, first, tiles in strips:
                    lo = max(0, first - step)
                    part = ids[lo : first + (tiles + 3) * step].astype(width)
                    yield (row, None, None, None, None, step, first, tiles, lo, width[2:].encode() + part.tobytes())

    known = texts(docs, id_col, text_col).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return known.mapInArrow(lambda batches: flushed(rows(batches), schema, 256), TILES)


def fragments(strips: DataFrame) -> DataFrame:
    """``row, period, begin, end`` of every tile of the strips, which are dealt out anew."""
    schema = pa.schema([(c, pa.int64()) for c in ("row", "period", "begin", "end")])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for row, step, first, tiles, lo, ids in rows_of(batch, "row", "step", "first", "tiles", "lo", "ids"):
                for found in solve(np.frombuffer(ids, f"<u{ids[:1].decode()}", offset=1).tolist(), lo, step, first, tiles):
                    yield (row, *found)

    # Little data and much work: as many parts as the session has, not as few as would hold it.
    parts = int(strips.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = strips.select("row", "step", "first", "tiles", "lo", "ids").repartition(parts, "row", "step", "first")
    return dealt.mapInArrow(lambda batches: flushed(rows(batches), schema), "row long, period long, begin long, end long")


def stitched(found: DataFrame) -> DataFrame:
    """``row, start, length, period`` of the runs: fragments of a document and period that touch are one."""
    key = Window.partitionBy("row", "period").orderBy("begin", "end")
    before = F.max("end").over(key.rowsBetween(Window.unboundedPreceding, -1))
    islands = found.withColumn("_new", F.coalesce(F.col("begin") > before, F.lit(False)).cast("long"))
    islands = islands.withColumn("_island", F.sum("_new").over(key.rowsBetween(Window.unboundedPreceding, 0)))
    whole = islands.groupBy("row", "period", "_island").agg(F.min("begin").alias("start"), F.max("end").alias("_end"))
    whole = whole.select("row", "start", (F.col("_end") - F.col("start") + F.col("period")).alias("length"), "period")
    return whole.where(F.col("length") >= F.greatest(F.lit(LEAST), POWER * F.col("period")))


def _collapsed(docs: DataFrame) -> DataFrame:
    """``collapsed`` from ``words`` and ``runs``: without all words after the first period of a run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, runs in rows_of(batch, "words", "runs"):
                if runs:
                    words = text.split(" ")
                    change = np.zeros(len(words) + 1, np.int64)
                    for r in runs:
                        change[r["start"] + r["period"]] += 1
                        change[r["start"] + r["length"]] -= 1
                    keep = (np.cumsum(change[:-1]) == 0).tolist()
                    text = " ".join(w for w, k in zip(words, keep) if k)
                out.append(text)
            at = batch.schema.get_field_index("words")
            yield batch.set_column(at, pa.field("words", pa.string()), pa.array(out, pa.string()))

    return docs.mapInArrow(run, docs.schema).withColumnRenamed("words", "collapsed")


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shown: Callable[[Column], Column] | None = None
) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row.

    Words are what stands between the blanks of ASCII. ``runs``: array of (start, period, length) in this
    order, empty without a run. ``collapsed``: the words joined by one blank, without those that any run contains after its
    first period; ``shown`` may turn that text into something shorter, such as a digest, before it is stored.
    A null or empty text has no words. Repeated rows and rows without a doc_id are documents of their own.
    """
    shown = shown or (lambda c: c)
    found = kept(tiled(docs, id_col, text_col).withColumn("collapsed", shown(F.col("collapsed"))), "tiles")
    runs = stitched(fragments(found.where("step IS NOT NULL")))
    # The runs of one document: not more than it has words.
    runs = runs.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    none = F.array().cast("array<struct<start:bigint,period:bigint,length:bigint>>")
    heads = found.where("step IS NULL")
    plain = heads.where("words IS NULL").select("doc_id", "n_words", none.alias("runs"), "collapsed")
    tiled_ = heads.where("words IS NOT NULL").select("row", "doc_id", "n_words", "words").join(runs, "row", "left")
    tiled_ = _collapsed(tiled_.select("doc_id", "n_words", F.coalesce("runs", none).alias("runs"), "words"))
    return plain.union(tiled_.withColumn("collapsed", shown(F.col("collapsed"))))


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; every tenth document, by its id, goes on periodically from some word.

    With h the CRC-32 of the id in decimal and g = floor(h / 10): if h % 10 = 0, each word i from a = g % n on
    becomes word a + (i - a) % p, where p = 1 + floor((n - a) / (3 + g % 8)).
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    out = texts(docs).withColumn("_g", F.floor(h / 10)).withColumn("_w", F.when(h % 10 == 0, words)).withColumn("_n", F.coalesce(F.size("_w"), F.lit(0)))
    out = out.withColumn("_a", F.when(F.col("_n") > 0, (F.col("_g") % F.col("_n")).cast("int")))
    left = F.col("_n") - F.col("_a")
    out = out.withColumn("_p", (1 + F.floor(left / (3 + F.col("_g") % 8))).cast("int"))
    times = F.ceil(left / F.col("_p")).cast("int")
    again = F.slice(F.flatten(F.array_repeat(F.expr("slice(_w, _a + 1, _p)"), times)), F.lit(1), left)
    changed = F.array_join(F.concat(F.expr("slice(_w, 1, _a)"), again), " ")
    return out.select("doc_id", F.when(F.col("_n") > 0, changed).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """Number of runs, the one of the greatest exponent, and digests, of ``periodic_runs`` whose ``collapsed`` is a digest."""
    none = F.lit(None).cast("struct<start:bigint,period:bigint,length:bigint>")

    def better(best: Column, r: Column) -> Column:
        # length / period, exactly; runs come by start, then period, so the first of equal ones stays.
        return F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)

    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
    out = found.withColumn("_b", F.aggregate("runs", none, better))
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_b.start").alias("start"), F.col("_b.length").alias("length"),
        F.col("_b.period").alias("period"), F.expr("(1000 * _b.length) div _b.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.col("collapsed").alias("collapsed_sha256"),
    )


@query()
def op12_periods(spark, d):
    return digests(periodic_runs(planted(documents(spark, d)), shown=lambda c: F.sha2(c, 256)))
