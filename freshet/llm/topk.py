"""Exact top-k by inner product, by distributed histogram selection.

Vectors are packed into blocks, and every block of queries meets every block of
vectors. No score is shuffled: in each round a cell counts its scores in the bins
of each query's open range, the counts are added up over all cells, and the range
is narrowed to the bin that holds the k-th score, until that bin is one value.
The last round keeps what lies above it, and of the scores equal to it the
smallest ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freshet.llm.common import query, rows_of
from freshet.session import stored
from freshet.sources.tables import table

VECTORS, QUERIES = 4096, 512  # in a block
BINS = 4096
LIMIT = 2**61


def scaled(components: list | None) -> np.ndarray | None:
    """floor(256 * x) of every component as a double; None for a vector that takes no part."""
    if components is None:
        return None
    x = np.array([np.nan if c is None else c for c in components], np.float64)
    x = np.floor(x * 256)
    return x if np.isfinite(x).all() else None


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact integer inner products; those beyond ``LIMIT`` count as that far."""
    if not queries.size or not vectors.size:
        return np.zeros((len(queries), len(vectors)), np.int64)
    size = np.abs(queries).max() * np.abs(vectors).max() * queries.shape[1]
    if size < 2**53:
        return (queries @ vectors.T).astype(np.int64)
    exact = lambda m: np.array([[int(v) for v in r] for r in m], object).reshape(m.shape)
    return np.clip(exact(queries) @ exact(vectors).T, -LIMIT, LIMIT).astype(np.int64)


BLOCK = "width int, block long, ids array<long>, matrix binary"


def blocks(vectors: DataFrame, size: int) -> DataFrame:
    """Rows (width, block, ids, matrix): at most ``size`` vectors of one width each."""
    schema = pa.schema([("width", pa.int32()), ("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("matrix", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        done = 0

        def packed(part: int, rows: list) -> pa.RecordBatch:
            block = {"width": len(rows[0][1]), "block": (part << 32) + done, "ids": [i for i, _ in rows]}
            return pa.RecordBatch.from_pylist([block | {"matrix": np.stack([x for _, x in rows]).tobytes()}], schema)

        part = 0
        for batch in batches:
            for part, key, components in rows_of(batch, "part", "id", "components"):
                x = scaled(components)
                if x is None or not len(x) or key is None:
                    continue
                rows = held.setdefault(len(x), [])
                rows.append((key, x))
                if len(rows) == size:
                    yield packed(part, held.pop(len(x)))
                    done += 1
        for rows in held.values():
            yield packed(part, rows)
            done += 1

    parts = max(1, -(-vectors.count() // size))
    dealt = vectors.select("id", "components").repartition(parts)
    return dealt.withColumn("part", F.spark_partition_id().cast("long")).mapInArrow(run, BLOCK)


def _cells(asking: DataFrame, ranges: DataFrame, data: DataFrame) -> DataFrame:
    """Every block of queries, with its queries' ranges, with every block of vectors of its width."""
    by_block = ranges.groupBy("q_block").agg(F.sort_array(F.collect_list(F.struct("i", "low", "high", "wanted"))).alias("ranges"))
    met = asking.select("q_block", "width").join(data.select("block", "width"), "width").select("q_block", "block")
    whole = met.join(data.select("block", "ids", "matrix"), "block").join(asking.join(by_block, "q_block"), "q_block")
    return whole.select("q_block", "width", "q_ids", "q_matrix", "ranges", "ids", "matrix")


def _per_query(cells: DataFrame, ddl: str, schema: pa.Schema, answer) -> DataFrame:
    """``answer(query id, range, scores, ids)`` for each query of each cell; it gives columns after (q_block, i)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q_block, width, q_ids, q_matrix, ranges, ids, matrix in rows_of(batch, *cells_columns):
                ids = np.array(ids)
                scores = products(np.frombuffer(q_matrix).reshape(-1, width), np.frombuffer(matrix).reshape(-1, width))
                found: list[list] = [[] for _ in schema]
                for r in ranges:
                    other = ids != q_ids[r["i"]]
                    columns = answer(q_ids[r["i"]], r, scores[r["i"]][other], ids[other])
                    for to, c in zip(found, ([q_block] * len(columns[0]), [r["i"]] * len(columns[0]), *columns)):
                        to.append(c)
                yield pa.record_batch([pa.array(np.concatenate(c).astype(np.int64)) for c in found], schema=schema)

    cells_columns = ("q_block", "width", "q_ids", "q_matrix", "ranges", "ids", "matrix")
    return cells.mapInArrow(run, ddl)


def _bin_width(low: int, high: int) -> int:
    return -(-(high - low + 1) // BINS)


def _histogram(_, r: dict, scores: np.ndarray, ids: np.ndarray) -> tuple:
    """Counts of the bins of the open range from the top down to the bin with the cell's own k-th score.

    The k-th of all cells cannot lie in a lower bin, so lower ones are not sent.
    """
    if r["low"] == r["high"]:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    held = scores[(scores >= r["low"]) & (scores <= r["high"])]
    counts = np.bincount((held - r["low"]) // _bin_width(r["low"], r["high"]), minlength=BINS)
    above = np.cumsum(counts[::-1])[::-1]
    bins = np.flatnonzero(counts)
    bins = bins[(above[bins] - counts[bins]) < r["wanted"]]
    return bins, counts[bins]


def _best(_, r: dict, scores: np.ndarray, ids: np.ndarray) -> tuple:
    """Scores above the k-th, and of those equal to it the smallest ids, as many as are wanted."""
    equal = np.flatnonzero(scores == r["low"])
    equal = equal[np.argsort(ids[equal], kind="stable")[: r["wanted"]]]
    chosen = np.concatenate([np.flatnonzero(scores > r["low"]), equal])
    return ids[chosen], scores[chosen]


def top_k(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best candidates of each query.

    Queries are the rows for which the column expression ``is_query`` holds, candidates all
    rows but those of the query's own id; ties go to the smaller id. A vector that is
    null, empty, or has null or non-finite components, or no id, takes no part. Vectors of
    another width than the query's are no candidates. Repeated rows are repeated candidates;
    a repeated query id is answered once. Scores beyond 2**61 count as that far.
    """
    own = vectors.withColumn("_asks", is_query).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("components"), "_asks")
    data = stored(blocks(own, VECTORS), "vector_blocks")
    asking = blocks(own.where("_asks").dropDuplicates(["id"]), QUERIES)
    asking = stored(asking.select(F.col("block").alias("q_block"), "width", F.col("ids").alias("q_ids"), F.col("matrix").alias("q_matrix")), "query_blocks")

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            longest = [float(np.sqrt((np.frombuffer(m).reshape(-1, w) ** 2).sum(1).max())) for w, m in rows_of(batch, "width", "matrix")]
            yield pa.record_batch([pa.array(longest, pa.float64())], names=["longest"])

    longest = data.select("width", "matrix").mapInArrow(bounds, "longest double").agg(F.max("longest")).first()[0] or 0.0

    def first_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q_block, width, matrix in rows_of(batch, "q_block", "width", "q_matrix"):
                size = np.sqrt((np.frombuffer(matrix).reshape(-1, width) ** 2).sum(1)) * longest
                top = np.minimum(size * (1 + 1e-9) + 1, float(LIMIT)).astype(np.int64)
                yield pa.record_batch(
                    [pa.array(x) for x in (np.full(len(top), q_block), np.arange(len(top)), -top, top, np.full(len(top), k))],
                    names=["q_block", "i", "low", "high", "wanted"],
                )

    columns = "q_block long, i long, low long, high long, wanted long"
    ranges = stored(asking.mapInArrow(first_ranges, columns), "ranges")
    counted = pa.schema([(n, pa.int64()) for n in ("q_block", "i", "bin", "n")])
    while not ranges.where("low < high").isEmpty():
        counts = _per_query(_cells(asking, ranges, data), "q_block long, i long, bin long, n long", counted, _histogram)
        counts = counts.groupBy("q_block", "i", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("q_block", "i").orderBy(F.desc("bin"))
        picked = counts.withColumn("_to", F.sum("n").over(down)).join(ranges, ["q_block", "i"])
        picked = picked.where("_to >= wanted AND _to - n < wanted").select("q_block", "i", "bin", (F.col("_to") - F.col("n")).alias("_above"))
        width = F.expr(f"(high - low + {BINS}) div {BINS}")
        open_ = F.col("low") < F.col("high")
        low = F.when(open_ & F.col("bin").isNotNull(), F.col("low") + F.col("bin") * width).otherwise(F.col("low"))
        # Without a bin there are fewer candidates than wanted: everything from ``low`` on is an answer.
        high = F.when(open_ & F.col("bin").isNotNull(), F.least("high", low + width - 1)).otherwise(F.col("low"))
        wanted = F.col("wanted") - F.coalesce(F.when(open_, F.col("_above")), F.lit(0))
        ranges = stored(ranges.join(picked, ["q_block", "i"], "left").select("q_block", "i", low.alias("low"), high.alias("high"), wanted.alias("wanted")), "ranges")
    answers = pa.schema([(n, pa.int64()) for n in ("q_block", "i", "vec_id", "score")])
    found = _per_query(_cells(asking, ranges, data), "q_block long, i long, vec_id long, score long", answers, _best)
    order = Window.partitionBy("q_block", "i").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = asking.select("q_block", F.posexplode("q_ids").alias("i", "query_id"))
    return best.join(names, ["q_block", "i"]).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


@query(SQL)
def op4_topk(spark, d):
    return top_k(table(spark, d, "embeddings"), F.col("vec_id") % 50 == 0)
