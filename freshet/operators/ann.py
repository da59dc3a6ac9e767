"""Approximate top-k over inverted lists (k-means cells), with whole vectors or with product-quantised codes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.functions.vectors import RANK_DIGITS, as_double, cosine_distance
from freshet.operators import vector_search as V
from freshet.session import stored

# Fixed value: the number of lists of the cosine index.
LISTS = 100
MAX_RECORDS_PER_FILE = 1_000_000
# Product quantisation: parts of a vector, codes of a part, rounds of learning.
PARTS, CODES, ROUNDS = 8, 64, 8


def _with_features(df: DataFrame) -> DataFrame:
    """Unit vectors: on them nearest by Euclid is nearest by cosine."""
    raw = df.withColumn("raw", array_to_vector(as_double("embedding")))
    return Normalizer(inputCol="raw", outputCol="features").transform(raw)


def ivf_build(df: DataFrame, path: str, lists: int = LISTS, seed: int = 7) -> KMeansModel:
    """Learn ``lists`` centres and write every row of ``df`` (``id, embedding``) under its list.

    The centres come from all rows. A list may hold a large part of the rows, so
    each is spread over as many writers as its files need. Ids are whole numbers or texts. (An action.)
    """
    model, assigned = _assigned(df, lists, seed)
    _write_lists(assigned, f"{path}/rows")
    model.write().overwrite().save(f"{path}/centres")
    return model


def _assigned(df: DataFrame, lists: int, seed: int) -> tuple[KMeansModel, DataFrame]:
    features = _with_features(V.plain_ids(df))
    model = KMeans(k=lists, seed=seed, maxIter=10, featuresCol="features", predictionCol="list").fit(features)
    return model, model.transform(features).select("id", "embedding", "list")


def _write_lists(assigned: DataFrame, path: str) -> None:
    # One row per list: as many as there are centres.
    writers = assigned.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / F.lit(MAX_RECORDS_PER_FILE)).alias("_writers"))
    spread = assigned.join(F.broadcast(writers), "list").withColumn("_writer", F.pmod(F.xxhash64("id"), F.col("_writers")))
    spread = spread.repartition("list", "_writer").drop("_writers", "_writer")
    spread.write.mode("overwrite").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).partitionBy("list").parquet(path)


def probes(spark: SparkSession, path: str, queries: DataFrame, nprobe: int) -> DataFrame:
    """``query_id, list``: the ``nprobe`` nearest lists of every query."""
    model = KMeansModel.load(f"{path}/centres")
    centres = spark.createDataFrame(
        [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], "id bigint, embedding array<double>"
    )
    return V.batch_topk(centres, queries, nprobe).select("query_id", F.col("id").alias("list"))


def _in_lists(rows: DataFrame, probed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of probed lists, and queries by list, both dealt to cells ``list, rb, qb`` of bounded size.

    Of a list with many rows or many queries there are several cells; its number of either comes from counts by
    list, a table of as many rows as the index has lists. The columns of a cell have one type on both sides: cells are met
    by hash, and a whole number of another width has another hash.
    """
    rows, probed = (df.withColumn("list", F.col("list").cast("int")) for df in (rows, probed))
    many = probed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / V.BLOCK_ROWS).cast("int").alias("_qs"))
    held = rows.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / V.BLOCK_ROWS).cast("int").alias("_rs"))
    sizes = F.broadcast(stored(many.join(held, "list"), "list_sizes"))
    place = lambda count: F.pmod(F.xxhash64("id"), F.col(count)).cast("int")
    each = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    right = rows.join(sizes, "list").withColumn("rb", place("_rs")).withColumn("qb", each("_qs")).drop("_rs", "_qs")
    left = probed.join(sizes, "list").withColumn("qb", place("_qs")).withColumn("rb", each("_rs")).drop("_rs", "_qs")
    return left, right


def ivf_topk(spark: SparkSession, path: str, queries: DataFrame, k: int, nprobe: int = 10) -> DataFrame:
    """Top-k among the rows of the nearest lists of each query: ``query_id, id, distance, rank``.

    Only the folders of probed lists are read. Queries and rows meet by list, in cells of bounded size.
    """
    queries = V.plain_ids(queries)
    probed = queries.join(probes(spark, path, queries, nprobe).withColumnRenamed("query_id", "id"), "id")
    left, right = _in_lists(spark.read.parquet(f"{path}/rows"), stored(probed.select("id", "list", "embedding"), "probed"))
    return V._ranked(V.met_in_cells(left, right, ["list", "rb", "qb"], k, "cosine"), k)


# --- product quantisation ---------------------------------------------------------------


def _units(column: pa.Array) -> np.ndarray:
    return V._unit(V._matrix(column))


def _nearest(unit: np.ndarray, books: np.ndarray) -> np.ndarray:
    """The code of each part of each vector."""
    parts = unit.reshape(len(unit), len(books), -1)
    return np.stack([((books[s] ** 2).sum(1)[None, :] - 2 * parts[:, s] @ books[s].T).argmin(1) for s in range(len(books))], axis=1)


def codebooks(rows: DataFrame, parts: int = PARTS, codes: int = CODES, rounds: int = ROUNDS) -> np.ndarray:
    """Centres of k-means in each part of the unit vectors: an array (part, code, width of a part).

    Every round is one pass over all rows; tasks send sums by part and code only. It starts from the rows
    whose ids have the smallest hashes. A code that nothing is nearest to keeps its place.
    """
    first = rows.orderBy(F.xxhash64("id"), "id").limit(codes).select("embedding").toArrow()  # ``codes`` rows
    if not first.num_rows:
        raise ValueError("no vectors to learn codes from")
    unit = _units(first.column("embedding"))
    if unit.shape[1] % parts:
        raise ValueError(f"vectors of width {unit.shape[1]} do not fall into {parts} equal parts")
    books = np.ascontiguousarray(unit.reshape(len(unit), parts, -1).transpose(1, 0, 2))

    def sums(known):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now = known.value
            total = np.zeros((*now.shape[:2], now.shape[2] + 1))
            for batch in batches:
                if batch.num_rows:
                    unit = _units(batch.column("embedding"))
                    found = _nearest(unit, now)
                    for s in range(len(now)):
                        part = np.hstack([unit.reshape(len(unit), len(now), -1)[:, s], np.ones((len(unit), 1))])
                        np.add.at(total[s], found[:, s], part)
            flat = total.reshape(-1, total.shape[2])
            yield pa.record_batch([pa.array(np.arange(len(flat))), pa.array(list(flat))], names=["code", "total"])

        return run

    for _ in range(rounds):
        known = rows.sparkSession.sparkContext.broadcast(books)
        each = rows.select("embedding").mapInArrow(sums(known), "code bigint, total array<double>")
        width = books.shape[2] + 1
        found = each.groupBy("code").agg(*[F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(width)]).toArrow()  # parts x codes rows
        total = np.zeros((books.shape[0] * books.shape[1], width))
        total[found.column("code").to_numpy()] = np.stack([found.column(f"t{i}").to_numpy() for i in range(width)], axis=1)
        total = total.reshape(*books.shape[:2], width)
        books = np.where(total[..., -1:] > 0, total[..., :-1] / np.maximum(total[..., -1:], 1), books)
        known.destroy()
    return books


def pq_build(df: DataFrame, path: str, lists: int = LISTS, parts: int = PARTS, codes: int = CODES, seed: int = 7) -> None:
    """Write the codes of every row of ``df`` (``id, embedding``) by list, and the vectors beside them. (An action.)

    With the codes goes ``miss``, the distance of the unit vector from what its codes stand for. No score by codes is
    wrong by more than that.
    """
    model, assigned = _assigned(df, lists, seed)
    assigned = stored(assigned, "assigned")
    books = codebooks(assigned, parts, codes)
    spark = df.sparkSession
    known = spark.sparkContext.broadcast(books)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _units(batch.column("embedding"))
            found = _nearest(unit, known.value)
            back = np.concatenate([known.value[s][found[:, s]] for s in range(len(known.value))], axis=1)
            miss = np.linalg.norm(unit - back, axis=1)
            yield pa.record_batch(
                [batch.column("id"), batch.column("list"), pa.array(list(found.astype(np.int32))), pa.array(miss)], names=["id", "list", "codes", "miss"]
            )

    kind = assigned.schema["id"].dataType.simpleString()
    _write_lists(assigned.mapInArrow(encode, f"id {kind}, list int, codes array<int>, miss double"), f"{path}/codes")
    assigned.select("id", "embedding").write.mode("overwrite").parquet(f"{path}/vectors")
    rows = [(s, [[float(x) for x in c] for c in book]) for s, book in enumerate(books)]
    spark.createDataFrame(rows, "part int, centres array<array<double>>").coalesce(1).write.mode("overwrite").parquet(f"{path}/books")
    model.write().overwrite().save(f"{path}/centres")
    known.destroy()


def pq_topk(spark: SparkSession, path: str, queries: DataFrame, k: int, nprobe: int = 10, rerank: int | None = None) -> DataFrame:
    """Top-k among the rows of the nearest lists by their codes, then by their vectors: ``query_id, id, distance, rank``.

    The distance by codes is a sum of table look-ups. With ``rerank`` the exact distances of that many best rows per
    query decide; without, those of all rows that the bound ``miss`` leaves in the running, so that the result is exact
    within the probed lists.
    """
    queries = V.plain_ids(queries)
    books = np.array([r["centres"] for r in spark.read.parquet(f"{path}/books").orderBy("part").collect()])  # parts x codes rows
    known = spark.sparkContext.broadcast(books)
    qkind = queries.schema["id"].dataType.simpleString()

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How much each code of each part adds to the similarity with the query."""
        for batch in batches:
            if batch.num_rows:
                unit = _units(batch.column("embedding")).reshape(batch.num_rows, len(known.value), -1)
                adds = np.einsum("nsw,scw->nsc", unit, known.value)
                yield pa.record_batch([batch.column("id"), pa.array(adds.tolist(), pa.list_(pa.list_(pa.float64())))], names=["id", "adds"])

    adds = queries.mapInArrow(tables, f"id {qkind}, adds array<array<double>>")
    probed = adds.join(probes(spark, path, queries, nprobe).withColumnRenamed("query_id", "id"), "id")
    left, right = _in_lists(spark.read.parquet(f"{path}/codes"), stored(probed.select("id", "list", "adds"), "probed"))
    met = left.withColumnRenamed("id", "query_id").join(right, ["list", "rb", "qb"])
    near = 1 - sum((F.get(F.col("adds")[s], F.col("codes")[s]) for s in range(len(books))), F.lit(0.0))
    scored = met.select("query_id", "id", near.alias("near"), "miss")
    if rerank is not None:
        best = Window.partitionBy("query_id").orderBy("near", "id")
        picked = scored.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= max(k, rerank))
    else:
        worst = F.col("near") + F.col("miss")
        place = Window.partitionBy("query_id").orderBy(worst, "id")
        bar = scored.withColumn("_n", F.row_number().over(place)).where(F.col("_n") <= k).groupBy("query_id").agg(F.max(worst).alias("_bar"))
        picked = scored.join(bar, "query_id").where(F.col("near") - F.col("miss") <= F.col("_bar") + 2 * 10.0**-RANK_DIGITS)
    picked = picked.select("query_id", "id").join(spark.read.parquet(f"{path}/vectors"), "id")
    exact = picked.join(queries.select(F.col("id").alias("query_id"), F.col("embedding").alias("_q")), "query_id")
    exact = exact.select("query_id", "id", F.round(cosine_distance("embedding", "_q"), RANK_DIGITS).alias("distance"))
    return V._ranked(exact, k)
