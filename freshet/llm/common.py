"""What several operators of this folder share."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.plans import Registry
from freshet.session import stored
from freshet.sources.tables import table

registry = Registry()
query = registry.query

# Rows of one Arrow batch: texts of 100 KB each keep a batch of this many near 25 MB.
BATCH_ROWS = 256


def small_batches(spark: SparkSession) -> SparkSession:
    """Arrow batches short enough that whole long texts fit a worker's memory, and shuffle files that go with their query.

    Intermediate tables are written to the shared folder, so a finished query's
    shuffle files are not needed again.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored in the shared folder and read back; what its query left on the executors' disks goes."""
    out = stored(df, name)
    _released(df.sparkSession)
    return out


def _released(spark: SparkSession) -> None:
    """Spark's cleaner removes shuffle files once the driver no longer holds the plan that wrote them."""
    gc.collect()
    spark._jvm.System.gc()


def dropped(*tables: DataFrame) -> None:
    """Remove the folders of stored tables that nothing reads any more.

    What was made from them must be stored itself, so that a lost executor does not ask for them again.
    """
    spark = tables[0].sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    for folder in {f.rsplit("/", 1)[0] for t in tables for f in t.inputFiles()}:
        path = hadoop.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``doc_id`` (long) and ``text`` (string); other columns, whatever their names, stay out."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def rows_of(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names))


def flushed(rows: Iterator[tuple], schema: pa.Schema, size: int = 2048) -> Iterator[pa.RecordBatch]:
    """Tuples as record batches of at most ``size`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
