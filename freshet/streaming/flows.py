"""Streams: cleaned events, deduplication, windowed rates, the per-minute quota."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from freshet.operators.content import with_content
from freshet.operators.filters import keep_condition
from freshet.operators.metrics import LATENCY_BOUNDS, bucket_quantile, error_ratio
from freshet.sources.events import from_envelopes

TRIGGER = "10 seconds"
LATENESS = "10 minutes"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def start(
    df: DataFrame,
    checkpoint: str,
    each: Callable[[DataFrame, int, str], None] | None = None,
    path: str | None = None,
    mode: str = "append",
    once: bool = False,
    trigger: str = TRIGGER,
) -> StreamingQuery:
    """Start a stream into a batch function or a Parquet folder. ``once`` drains what is there.

    ``each`` gets the batch, its number and the id of the run, which the checkpoint keeps:
    it is the same after a restart from this checkpoint, and another under a new one.
    """
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=trigger)
    if each is not None:
        spark = df.sparkSession
        return writer.foreachBatch(lambda batch, number: each(batch, number, run_of(spark, checkpoint))).start()
    return writer.format("parquet").option("path", path).start()


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The id that a started stream has written into its checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()["value"])["id"]


def drain(df: DataFrame, checkpoint: str, **kw) -> None:
    query = start(df, checkpoint, once=True, **kw)
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def cleaned(messages: DataFrame, **filters) -> DataFrame:
    """Envelopes to kept events with their text. No state, no shuffle."""
    return with_content(from_envelopes(messages).where(keep_condition(**filters)))


def dedup(events: DataFrame, keys: list[str], ts: str, lateness: str = LATENESS) -> DataFrame:
    """Drops repeats that arrive within the lateness; state older than that is let go."""
    return events.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(keys)


def windowed_counts(events: DataFrame, ts: str, width: str, slide: str | None = None, by: list[str] = [], lateness: str = LATENESS) -> DataFrame:
    window = F.window(F.col(ts), width, slide) if slide else F.window(F.col(ts), width)
    return (
        events.withWatermark(ts, lateness)
        .groupBy(*by, window.alias("w"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n")
    )


def windowed_latency(
    events: DataFrame, ts: str, latency: Column, failed: Column, width: str, slide: str | None = None, by: Sequence[str] = (), q: float = 0.95, lateness: str = LATENESS
) -> DataFrame:
    """``window_start, n, quantile, error_ratio`` of each window that a batch changed.

    The state of a window is its bucket counts, whatever its traffic; the quantile and the failures per hundred successes are
    taken from them at output. Rows behind the watermark no longer count.
    """
    window = F.window(F.col(ts), width, slide) if slide else F.window(F.col(ts), width)
    rows = events.withWatermark(ts, lateness).withColumn("_v", latency).withColumn("_failed", F.coalesce(failed, F.lit(False)))
    counts = [F.count_if(F.col("_v") <= b).alias(f"le_{i}") for i, b in enumerate(LATENCY_BOUNDS)]
    found = rows.groupBy(*by, window.alias("w")).agg(
        *counts, F.count("_v").alias("le_inf"), F.count(F.lit(1)).alias("n"), F.count_if("_failed").alias("failures")
    )
    ratio = error_ratio(F.col("failures"), F.col("n") - F.col("failures"))
    return found.select(*by, F.col("w.start").alias("window_start"), "n", bucket_quantile(q).alias("quantile"), ratio.alias("error_ratio"))


def late_rows(batch: DataFrame, ts: str, watermark) -> DataFrame:
    """Rows of a micro-batch behind the watermark, for a side table."""
    return batch.where(F.col(ts) < F.lit(watermark).cast("timestamp"))


def quota(events: DataFrame, ts: str, order: Sequence[str], limit: int = 60, lateness: str = LATENESS) -> DataFrame:
    """Admits at most ``limit`` events of each minute, in arrival order: a stream of the admitted ones.

    The state is one counter per minute. A timer lets it go when the watermark has passed the minute, so the state
    is bounded by the lateness; events behind the watermark are not admitted. Each task sends at most ``limit`` events
    of a minute per batch, so a minute with most of the traffic stays small. A restart goes on with the counters of the
    checkpoint.
    """
    spark, schema, order = events.sparkSession, events.schema, list(order)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    first = events.mapInPandas(_first_of_each_minute(ts, order, limit), schema).withWatermark(ts, lateness)
    keyed = first.withColumn("_minute", F.floor(F.unix_seconds(F.col(ts)) / 60).cast("bigint"))
    return keyed.groupBy("_minute").transformWithStateInPandas(
        statefulProcessor=MinuteCounter(events.columns, order, limit), outputStructType=schema, outputMode="Append", timeMode="EventTime"
    )


def _first_of_each_minute(ts: str, order: list[str], limit: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ranked = frame.sort_values(order, kind="stable")
            yield ranked[ranked.groupby(ranked[ts].dt.floor("min"), sort=False).cumcount() < limit]

    return run


class MinuteCounter(StatefulProcessor):
    """How many events of its minute were admitted."""

    def __init__(self, columns: list[str], order: list[str], limit: int):
        self.columns, self.order, self.limit = columns, order, limit

    def init(self, handle) -> None:
        self.handle = handle
        self.taken = handle.getValueState("taken", "n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        before = self.taken.get()[0] if self.taken.exists() else 0
        # Of each task at most ``limit`` events.
        batch = pd.concat(list(rows), ignore_index=True).sort_values(self.order, kind="stable").head(self.limit - before)
        if not before:
            self.handle.registerTimer((key[0] + 1) * 60_000)
        if len(batch):
            self.taken.update((before + len(batch),))
        yield batch[self.columns]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.taken.clear()
        yield from ()

    def close(self) -> None:
        pass


def watermark_of(spark: SparkSession, checkpoint: str, batch_id: int) -> datetime | None:
    """The watermark that a batch of a stream runs under, as its checkpoint notes it before the batch begins; None for the first."""
    noted = spark.read.text(f"{checkpoint.rstrip('/')}/offsets/{batch_id}", wholetext=True).first()["value"]
    # The second line holds what the batch runs with.
    millis = json.loads(noted.split("\n")[1])["batchWatermarkMs"]
    return datetime.fromtimestamp(millis / 1000, timezone.utc) if millis else None


def split_late(checkpoint: str, ts: str, on_time: Callable[[DataFrame, int, str], None], late: Callable[[DataFrame, int, str], None]):
    """A batch function that gives rows behind the stream's watermark to ``late`` and the others to ``on_time``.

    The stream declares the watermark (``withWatermark``); each batch is split by the one that it runs under, the same when
    it runs again. Rows without a time are on time. Together both sides get every row once.
    """

    def write(batch: DataFrame, batch_id: int, run: str = "") -> None:
        mark = watermark_of(batch.sparkSession, checkpoint, batch_id)
        behind = F.lit(False) if mark is None else F.coalesce(F.col(ts) < F.lit(mark), F.lit(False))
        on_time(batch.where(~behind), batch_id, run)
        late(batch.where(behind), batch_id, run)

    return write
