"""Exact vector top-k: for one query, for a batch of queries, and between two large tables."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions.vectors import RANK_DIGITS, distance, vector_lit
from freshet.session import stored

# A query batch up to this size travels to every task; a larger one is met block by block.
BROADCAST_BYTES = 32 << 20
PROBE_ROWS = 1024
# Rows of either side that meet in one task of the block join.
BLOCK_ROWS = 20_000
# Distances held at once inside a task.
CELL_VALUES = 4_000_000
# Rows of a block, and pairs that leave a task at once, where all pairs may be in the result.
PAIR_ROWS = 20_000
PAIR_BATCH = 100_000
# Parts of a class of equal vectors.
CLASS_SALTS = 32

MIN_K, MAX_K = 1, 20


def clamp_k(k: int | None, default: int = 3, top: int = MAX_K) -> int:
    return max(MIN_K, min(int(k or default), top))


def vector_topk(
    chunks: DataFrame,
    query: Sequence[float] | Column,
    k: int,
    metric: str = "cosine",
    key: str = "id",
    embedding: str = "embedding",
    where: Column | None = None,
) -> DataFrame:
    """The ``k`` nearest rows to one query vector, nearest first, ties by key.

    Rows of another width than the query's are no candidates. Each task keeps its
    own ``k`` best, so the last step sorts ``k`` rows per task. Conditions apply
    before any distance is computed.
    """
    if not isinstance(query, Column) and metric == "cosine":
        # Cosine ignores the query's length; one of length one saves work per row.
        length = math.sqrt(sum(float(x) ** 2 for x in query)) or 1.0
        query = [float(x) / length for x in query]
    vector = query if isinstance(query, Column) else vector_lit(query)
    rows = chunks.where(F.col(embedding).isNotNull() & (F.size(embedding) == F.size(vector)))
    if where is not None:
        rows = rows.where(where)
    ranked = rows.withColumn("distance", F.round(distance(embedding, vector, metric), RANK_DIGITS))
    return ranked.orderBy("distance", key).limit(k)


def any_usable(chunks: DataFrame, embedding: str = "embedding") -> bool:
    """Does any row carry a vector? Reads no further than the first one. (An action.)"""
    return not chunks.where(F.col(embedding).isNotNull()).limit(1).isEmpty()


# --- many queries -------------------------------------------------------------


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column of equal widths as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 1))
    widths = pc.min_max(pc.list_value_length(column)).as_py()
    if widths["min"] != widths["max"]:
        raise ValueError(f"vectors of different width: {widths['min']} to {widths['max']}")
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def _unit(m: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, length, out=np.zeros_like(m), where=length > 0)


def _distances(queries: np.ndarray, rows: np.ndarray, metric: str) -> np.ndarray:
    if metric == "cosine":
        return 1.0 - _unit(queries) @ _unit(rows).T
    squared = (queries**2).sum(1)[:, None] + (rows**2).sum(1)[None, :] - 2.0 * (queries @ rows.T)
    return np.sqrt(np.maximum(squared, 0.0))


def _rough(unit: np.ndarray) -> np.ndarray:
    """Unit vectors in single precision, in which products take half the time."""
    return unit.astype(np.float32)


def _slack(width: int) -> float:
    """No product of two unit vectors in single precision is wrong by more."""
    return (width + 8) * 1.2e-7


def _exact_cosine(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Rounded cosine distances of the rows ``i`` of ``a`` and ``j`` of ``b``, both of length one, in double precision."""
    out, step = np.empty(len(i)), max(1, CELL_VALUES // max(1, a.shape[1]))
    for lo in range(0, len(i), step):
        part = slice(lo, lo + step)
        out[part] = 1.0 - np.einsum("nw,nw->n", a[i[part]], b[j[part]])
    return np.round(out, RANK_DIGITS)


class _Best:
    """The k best rows so far for each query of a block.

    Cosine distances are first worked out in single precision; those that may enter a list, by the bound of that
    precision, once more in double.
    """

    def __init__(self, query_ids: np.ndarray, k: int, limit: float | None, skip_same: bool):
        self.query_ids, self.k, self.skip_same = query_ids, k, skip_same
        # The largest distance that may still enter the list of a query.
        self.bar = np.full(len(query_ids), np.inf if limit is None else limit)
        self.at, self.dist = np.empty(0, np.int64), np.empty(0)
        self.ids: np.ndarray | None = None
        self.unit: np.ndarray | None = None

    def meet(self, queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, metric: str) -> None:
        """Compare with more rows, in slices that keep the distance matrix small."""
        width = max(1, CELL_VALUES // max(1, len(queries)))
        if metric == "cosine":
            if self.unit is None:
                self.unit = _unit(queries)
                self.rough = -_rough(self.unit)
            unit = _unit(rows)
            rough = _rough(unit)
            for lo in range(0, len(ids), width):
                part = slice(lo, lo + width)
                exact = lambda i, j: _exact_cosine(self.unit, unit[part], i, j)  # noqa: B023, E731
                self._add(self.rough @ rough[part].T, 1.0, _slack(unit.shape[1]), exact, ids[part])
        else:
            for lo in range(0, len(ids), width):
                part = slice(lo, lo + width)
                dist = np.round(_distances(queries, rows[part], metric), RANK_DIGITS)
                self._add(dist, 0.0, 0.0, lambda i, j: dist[i, j], ids[part])  # noqa: B023

    def _add(self, rough: np.ndarray, base: float, slack: float, exact, ids: np.ndarray) -> None:
        """More rows: ``base + rough`` is within ``slack`` of their distances, ``exact`` gives these for some."""
        slack += 10.0**-RANK_DIGITS
        within = lambda bar: rough <= (bar - base + slack).astype(rough.dtype)[:, None]
        near, most = within(self.bar), self.k + self.skip_same
        if rough.shape[1] > most and np.count_nonzero(near) > 4 * most * len(rough):
            near = within(np.fmin(self.bar, np.partition(rough, most - 1, axis=1)[:, most - 1].astype(np.float64) + base + slack))
        i, j = np.nonzero(near)
        if self.skip_same:
            other = self.query_ids[i] != ids[j]
            i, j = i[other], j[other]
        dist = exact(i, j)
        # Equal distances stay in, the id decides.
        useful = (dist <= self.bar[i]) & np.isfinite(dist)
        if not useful.any():
            return
        i, j, dist = i[useful], j[useful], dist[useful]
        if self.ids is None:
            self.ids = ids[:0]
        met = np.zeros(len(self.bar), bool)
        met[i] = True
        old = met[self.at]
        at, dist, found = np.concatenate([self.at[old], i]), np.concatenate([self.dist[old], dist]), np.concatenate([self.ids[old], ids[j]])
        order = np.lexsort((found, dist, at))
        at, dist, found = at[order], dist[order], found[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        last, top = place == self.k - 1, place < self.k
        self.bar[at[last]] = dist[last]
        self.at = np.concatenate([self.at[~old], at[top]])
        self.dist = np.concatenate([self.dist[~old], dist[top]])
        self.ids = np.concatenate([self.ids[~old], found[top]])

    def frame(self) -> pd.DataFrame:
        """The hits; a block that met no row has none."""
        ids = self.ids if self.ids is not None else np.empty(0, np.int64)
        return pd.DataFrame({"query_id": self.query_ids[self.at], "id": ids, "distance": self.dist})

    def batch(self, schema: pa.Schema) -> pa.RecordBatch:
        frame = self.frame()
        return pa.record_batch([pa.array(frame[f.name].tolist(), f.type) for f in schema], schema=schema)


def _ranked(partial: DataFrame, k: int) -> DataFrame:
    """The overall best of each query. Partial lists hold at most k rows per query and task."""
    w = Window.partitionBy("query_id").orderBy("distance", "id")
    return partial.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def hit_schema(chunks: DataFrame, queries: DataFrame) -> str:
    """The columns of partial hits; ids keep the types they have."""
    return f"query_id {queries.schema['id'].dataType.simpleString()}, id {chunks.schema['id'].dataType.simpleString()}, distance double"


def arrow_schema(ddl: str) -> pa.Schema:
    types = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64()}
    return pa.schema([(name, types[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


def id_array(values) -> np.ndarray:
    """Ids as an array that sorts as Spark does: whole numbers, or texts by code point."""
    values = values.to_pylist() if hasattr(values, "to_pylist") else list(values)
    return np.array(values) if values else np.empty(0, np.int64)


def plain_ids(df: DataFrame) -> DataFrame:
    """``id, embedding`` of rows that have a vector; ids are bigint, or string where they are texts."""
    kind = "string" if df.schema["id"].dataType.simpleString() == "string" else "bigint"
    return df.where(F.col("embedding").isNotNull()).select(F.col("id").cast(kind).alias("id"), "embedding")


def _topk_small(chunks: DataFrame, ids: np.ndarray, queries: np.ndarray, hit: str, k, metric, limit, skip_same) -> DataFrame:
    schema = arrow_schema(hit)
    shared = chunks.sparkSession.sparkContext.broadcast((ids, queries))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, matrix = shared.value
        best = _Best(query_ids, k, limit, skip_same)
        for batch in batches:
            if batch.num_rows and len(query_ids):
                rows = _matrix(batch.column("embedding"))
                best.meet(matrix, rows, id_array(batch.column("id")), metric)
        yield best.batch(schema)

    return _ranked(chunks.mapInArrow(scan, hit), k)


def _topk_blocks(chunks: DataFrame, queries: DataFrame, n_chunks, n_queries, k, metric, limit, skip_same) -> DataFrame:
    """Block join: each pair of a query block and a row block meets in one bounded task.

    Blocks are filled by a hash of the unique id, so they are even whatever the
    vectors are. Every cell emits at most k rows per query, never its pairs.
    """
    row_blocks = max(1, math.ceil(n_chunks / BLOCK_ROWS))
    query_blocks = max(1, math.ceil(n_queries / BLOCK_ROWS))

    def cells(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(n_own)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))
        )

    left = cells(queries, "qb", query_blocks, "rb", row_blocks)
    right = cells(chunks, "rb", row_blocks, "qb", query_blocks)

    return _ranked(met_in_cells(left, right, ["qb", "rb"], k, metric, limit, skip_same), k)


def met_in_cells(queries: DataFrame, rows: DataFrame, cell: Sequence[str], k, metric, limit=None, skip_same=False) -> DataFrame:
    """Partial hits of queries and rows (``id, embedding``) that share a cell; a cell's rows and queries fit in a task."""
    hit = hit_schema(rows, queries)

    def meet(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        best = _Best(id_array(q["id"]), k, limit, skip_same)
        if len(q) and len(c):
            matrix = np.stack(q["embedding"].to_numpy()).astype(np.float64)
            best.meet(matrix, np.stack(c["embedding"].to_numpy()).astype(np.float64), id_array(c["id"]), metric)
        return best.frame()

    return queries.groupBy(*cell).cogroup(rows.groupBy(*cell)).applyInPandas(meet, hit)


def batch_topk(
    chunks: DataFrame,
    queries: DataFrame,
    k: int,
    metric: str = "cosine",
    max_distance: float | None = None,
    skip_same: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``query_id, id, distance, rank`` of the k nearest rows for every query.

    Both sides have ``id`` (a whole number or a text, unique) and ``embedding`` of one width.
    The query side is measured first: a batch within ``broadcast_bytes`` is
    sent to the tasks, which read the rows once; a larger one is joined block
    by block. Both ways give the same rows. ``skip_same`` leaves out the row
    with the query's own id, for a table compared with itself.
    """
    chunks, queries = plain_ids(chunks), plain_ids(queries)
    limit = None if max_distance is None else round(max_distance, RANK_DIGITS)
    small = _fetch_small(queries, broadcast_bytes)
    if small is not None:
        ids, matrix = id_array(small.column("id")), _matrix(small.column("embedding"))
        return _topk_small(chunks, ids, matrix, hit_schema(chunks, queries), k, metric, limit, skip_same)
    return _topk_blocks(chunks, queries, chunks.count(), queries.count(), k, metric, limit, skip_same)


def _fetch_small(queries: DataFrame, broadcast_bytes: int) -> pa.Table | None:
    """The query batch when it is within the size bound, else None. (An action.)"""
    if broadcast_bytes <= 0:
        return None
    # One job answers for the usual short batch; a longer one is measured before it is fetched.
    head = queries.limit(PROBE_ROWS).toArrow()
    if head.num_rows < PROBE_ROWS:
        return head if head.nbytes <= broadcast_bytes else None
    n, width = queries.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    return queries.toArrow() if n * (8 * width + 8) <= broadcast_bytes else None


PAIR = "query_id bigint, match_id bigint, distance double"


def _usable(rows: DataFrame) -> DataFrame:
    """``id, embedding`` as doubles, without vectors that have no direction: null, zero, or with a part that is null or not finite."""
    rows = rows.select(F.col("id").cast("bigint").alias("id"), F.col("embedding").cast("array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("embedding").isNotNull() & ~bad & F.exists("embedding", lambda x: x != 0))


def equal_classes(rows: DataFrame) -> DataFrame:
    """``class_id, id``: the rows (``id, embedding``) by equal vectors; a class is named by its smallest id.

    Only the pairs of class and id are made, whatever the size of a class. Rows
    without a direction (null, zero or not finite) are in no class.
    """
    rows = _usable(rows)
    # A class may be most of the table, so its rows are dealt over salts to meet its name.
    spread = rows.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(CLASS_SALTS)).cast("int"))
    named = spread.groupBy("embedding", "_salt").agg(F.min("id").alias("_least"))
    names = named.groupBy("embedding").agg(F.min("_least").alias("class_id"), F.collect_list("_salt").alias("_salts"))
    names = names.select("embedding", "class_id", F.explode("_salts").alias("_salt"))
    return spread.join(names, ["embedding", "_salt"]).select("class_id", "id")


def similar_pairs(rows: DataFrame, min_similarity: float) -> DataFrame:
    """``query_id, match_id, distance``: every pair of classes of equal vectors at or above the cosine similarity.

    ``rows`` has ``id`` (bigint, unique) and ``embedding`` of one width. A class
    stands as its smallest id (see ``equal_classes``, whose rows tell which ids it
    stands for), so copies do not multiply the pairs. Each pair is given once,
    with ``query_id < match_id``. Two rows of one class have similarity 1.
    """
    if not 0 < min_similarity <= 1:
        raise ValueError("min_similarity must be over 0 and at most 1")
    limit = round(1.0 - min_similarity, RANK_DIGITS)
    first = stored(_usable(rows).groupBy("embedding").agg(F.min("id").alias("id")), "vectors")
    n = max(1, math.ceil(first.count() / PAIR_ROWS))
    block = F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    # Each cell (low, high) of two blocks is met once.
    low = first.select("id", "embedding", block.alias("low")).withColumn("high", F.explode(F.sequence("low", F.lit(n - 1))))
    high = first.select("id", "embedding", block.alias("high")).withColumn("low", F.explode(F.sequence(F.lit(0), "high")))

    def meet(cell: tuple[pa.Scalar, ...], both: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # All pairs of a cell may be in the result, so they leave it slice by slice.
        sides: list[list] = [[], []]
        for batch in both:
            side = batch.column("side").to_numpy()
            ids, unit = batch.column("id").to_numpy(), _unit(_matrix(batch.column("embedding")))
            for s in (0, 1):
                if (side == s).any():
                    sides[s].append((ids[side == s], unit[side == s]))
        if not (sides[0] and sides[1]):
            return
        (x, a), (y, b) = ((np.concatenate([p[0] for p in side]), np.concatenate([p[1] for p in side])) for side in sides)
        least, rough_a, rough_b = 1.0 - limit - _slack(a.shape[1]), _rough(a), _rough(b)
        same = cell[0].as_py() == cell[1].as_py()
        width = max(1, CELL_VALUES // len(x))
        for lo in range(0, len(y), width):
            near = rough_a @ rough_b[lo : lo + width].T >= np.float32(least)
            if same:
                near &= x[:, None] < y[None, lo : lo + width]
            i, j = np.nonzero(near)
            dist = _exact_cosine(a, b[lo : lo + width], i, j)
            i, j, dist = i[dist <= limit], j[dist <= limit], dist[dist <= limit]
            left, right = x[i], y[lo + j]
            for at in range(0, len(i), PAIR_BATCH):
                part = slice(at, at + PAIR_BATCH)
                pair = [np.minimum(left[part], right[part]), np.maximum(left[part], right[part]), dist[part]]
                yield pa.record_batch([pa.array(p) for p in pair], names=["query_id", "match_id", "distance"])

    sides = [df.select("low", "high", "id", "embedding", F.lit(n).alias("side")) for n, df in enumerate((low, high))]
    return sides[0].union(sides[1]).groupBy("low", "high").applyInArrow(meet, PAIR)


def best_match(chunks: DataFrame, queries: DataFrame, min_similarity: float, skip_same: bool = False, **kw) -> DataFrame:
    """For each query the most similar row, when its cosine similarity reaches the threshold."""
    hits = batch_topk(chunks, queries, 1, "cosine", 1.0 - min_similarity, skip_same, **kw)
    return hits.select("query_id", F.col("id").alias("match_id"), (1 - F.col("distance")).alias("similarity"))
