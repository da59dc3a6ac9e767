"""Flow metrics over event rows.

A counter is a set of rows, so ``increase`` is the number of rows in a window
and ``rate`` that number per second. Everything that needs an order works on
counts that were combined first, in pieces that are bounded by time or by the
number of distinct values, so no label is too large.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions.text import _col
from freshet.session import stored

# Latency bucket bounds in seconds.
LATENCY_BOUNDS = (0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.0, 5.0, 10.0, 30.0)

# Fixed value: request paths that are not counted.
INTERNAL_PATHS = ("/metrics", "/health", "/docs", "/openapi.json", "/favicon.ico")


def flow_counts(df: DataFrame, ok: Column, failed: Column, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("received"),
        F.count_if(ok).alias("processed"),
        F.count_if(failed).alias("failed"),
    )


def labelled_counts(df: DataFrame, by: Sequence[str], path: str | None = None) -> DataFrame:
    rows = df if path is None else df.where(~F.col(path).isin(*INTERNAL_PATHS))
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


# --- histograms ----------------------------------------------------------------


def _bucket_name(i: int) -> str:
    return f"le_{i}"


def buckets(df: DataFrame, value: str, by: Sequence[str] = (), bounds: Sequence[float] = LATENCY_BOUNDS) -> DataFrame:
    """Cumulative counts ``le_0 .. le_n`` and ``le_inf``, with ``value_sum``: one pass, one row per label."""
    v = F.col(value)
    counts = [F.count_if(v <= b).alias(_bucket_name(i)) for i, b in enumerate(bounds)]
    return df.groupBy(*by).agg(*counts, F.count(v).alias("le_inf"), F.sum(v).alias("value_sum"))


def buckets_long(df: DataFrame, value: str, by: Sequence[str] = (), bounds: Sequence[float] = LATENCY_BOUNDS) -> DataFrame:
    """The same counts as one row per label and bound (``le``, ``n``); the last bound is ``+Inf``."""
    wide = buckets(df, value, by, bounds)
    pairs = [F.struct(F.lit(_bound_text(b)).alias("le"), F.col(_bucket_name(i)).alias("n")) for i, b in enumerate(bounds)]
    pairs.append(F.struct(F.lit("+Inf").alias("le"), F.col("le_inf").alias("n")))
    return wide.select(*by, F.inline(F.array(*pairs)))


def _bound_text(b: float) -> str:
    return f"{b:g}"


def bucket_quantile(q: float, bounds: Sequence[float] = LATENCY_BOUNDS) -> Column:
    """The quantile of a `buckets` row by linear interpolation inside its bucket.

    The lowest bucket starts at zero; a rank in the last bucket gives the last
    finite bound; no observations give null.
    """
    rank = F.col("le_inf") * q
    out = F.when(F.col("le_inf") == 0, F.lit(None).cast("double"))
    lower, before = 0.0, F.lit(0).cast("bigint")
    for i, bound in enumerate(bounds):
        here = F.col(_bucket_name(i))
        inside = here - before
        out = out.when(
            here >= rank,
            F.when(inside > 0, F.lit(lower) + (bound - lower) * (rank - before) / F.nullif(inside, F.lit(0))).otherwise(F.lit(bound)),
        )
        lower, before = bound, here
    return out.otherwise(F.lit(float(bounds[-1])))


# --- rates ---------------------------------------------------------------------


def increase(df: DataFrame, ts: str, width: str, slide: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Rows per window: ``window_start, window_end, n``. Sliding windows are added up from their slides."""
    if slide is None or slide == width:
        w = F.window(_col(ts).cast("timestamp"), width)
        return df.groupBy(*by, w.alias("w")).agg(F.count(F.lit(1)).alias("n")).select(
            *by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n"
        )
    # One row per label and slide first; only those small rows enter several windows.
    panes = df.groupBy(*by, F.window(_col(ts).cast("timestamp"), slide).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    w = F.window(F.col("p.start"), width, slide)
    return panes.groupBy(*by, w.alias("w")).agg(F.sum("n").alias("n")).select(
        *by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n"
    )


def rate(df: DataFrame, ts: str, width: str, slide: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    seconds = F.unix_seconds("window_end") - F.unix_seconds("window_start")
    return increase(df, ts, width, slide, by).withColumn("per_second", F.col("n") / seconds)


def windowed_quantile(df: DataFrame, ts: str, value: str, q: float, width: str, by: Sequence[str] = ()) -> DataFrame:
    rows = df.withColumn("_w", F.window(_col(ts).cast("timestamp"), width))
    return buckets(rows, value, [*by, "_w"]).select(
        *by,
        F.col("_w.start").alias("window_start"),
        F.col("le_inf").alias("n"),
        bucket_quantile(q).alias("quantile"),
    )


def error_ratio(errors: Column, processed: Column) -> Column:
    return 100 * errors / F.greatest(processed.cast("double"), F.lit(1e-9))


def throughput(df: DataFrame, ts: str, by: Sequence[str] = ()) -> DataFrame:
    span = F.unix_micros(F.max(_col(ts).cast("timestamp"))) - F.unix_micros(F.min(_col(ts).cast("timestamp")))
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), (span / 1e6).alias("span_seconds")).withColumn(
        "per_second", F.col("n") / F.nullif("span_seconds", F.lit(0.0))
    )


# --- progress ------------------------------------------------------------------


def last_success(df: DataFrame, ts: str, ok: Column, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.max(F.when(ok, F.col(ts))).alias("last_success"))


def staleness(last: DataFrame, as_of: Column, limit_seconds: int = 300) -> DataFrame:
    """Age of the last success; a label that never had one is stale."""
    age = F.unix_seconds(as_of.cast("timestamp")) - F.unix_seconds(F.col("last_success").cast("timestamp"))
    return last.withColumn("age_seconds", age).withColumn(
        "stale", F.coalesce(F.col("age_seconds") > limit_seconds, F.lit(True))
    )


def consumer_lag(head: DataFrame, committed: DataFrame, keys=("kafka_topic", "kafka_partition"), offset: str = "kafka_offset") -> DataFrame:
    """Newest minus committed offset per partition. A partition without a commit lags by all its offsets."""
    newest = head.groupBy(*keys).agg(F.max(offset).alias("head"))
    done = committed.groupBy(*keys).agg(F.max(offset).alias("committed"))
    return newest.join(done, list(keys), "left").withColumn("lag", F.col("head") - F.coalesce("committed", F.lit(-1)))


def stalled(df: DataFrame, ts: str, minutes: int = 10) -> DataFrame:
    """Windows between the first and the last event in which nothing arrived."""
    width = f"{minutes} minutes"
    seen = increase(df, ts, width).select("window_start")
    ends = seen.agg(F.min("window_start").alias("a"), F.max("window_start").alias("b"))
    spine = ends.where(F.col("a").isNotNull()).select(
        F.explode(F.sequence("a", "b", F.make_dt_interval(mins=F.lit(minutes)))).alias("window_start")
    )
    return spine.join(seen, "window_start", "left_anti")


def inflight_peak(df: DataFrame, start: str, end: str, by: Sequence[str]) -> DataFrame:
    """The largest number of rows open at one moment, per label.

    Starts count before ends of the same moment. Every moment is summed first,
    then a running total is taken inside each minute and over the minutes of
    each day and over the days, so no window holds more than a minute's
    moments, a day's minutes or a label's days.
    """
    start, end = _col(start).cast("timestamp"), _col(end).cast("timestamp")
    marks = df.select(
        *by,
        F.inline(
            F.array(
                F.struct(start.alias("at"), F.lit(1).alias("opened"), F.lit(0).alias("closed")),
                F.struct(end.alias("at"), F.lit(0).alias("opened"), F.lit(1).alias("closed")),
            )
        ),
    ).where(F.col("at").isNotNull())
    moments = marks.groupBy(*by, "at").agg(F.sum("opened").alias("opened"), F.sum("closed").alias("closed"))

    def before(df: DataFrame, cell: list[str], order: str, total: str) -> Column:
        w = Window.partitionBy(*by, *cell).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(total).over(w), F.lit(0))

    moments = moments.withColumn("minute", F.date_trunc("minute", F.col("at"))).withColumn(
        "net", F.col("opened") - F.col("closed")
    )
    minutes = (
        moments.withColumn("open", before(moments, ["minute"], "at", "net") + F.col("opened"))
        .groupBy(*by, "minute")
        .agg(F.max("open").alias("open"), F.sum("net").alias("net"))
        .withColumn("day", F.date_trunc("day", F.col("minute")))
    )
    days = (
        minutes.withColumn("open", before(minutes, ["day"], "minute", "net") + F.col("open"))
        .groupBy(*by, "day")
        .agg(F.max("open").alias("open"), F.sum("net").alias("net"))
    )
    return (
        days.withColumn("open", before(days, [], "day", "net") + F.col("open"))
        .groupBy(*by)
        .agg(F.max("open").alias("peak"))
    )


# --- exact quantiles -------------------------------------------------------------


def exact_quantiles(df: DataFrame, value: str, qs: Sequence[float], by: Sequence[str] = (), method: str = "cont") -> DataFrame:
    """Exact quantiles ``q, value`` per label: ``cont`` interpolates, ``index`` takes element ``int(q * (n - 1))``."""
    return _selected(df, value, [(q, method) for q in qs], by).drop("method")


# Different values that are put in order in one task, at least; and of how many cells there may be at most.
CELL_VALUES = 10_000
MOST_CELLS = 1 << 16
# Parts that a cell is cut into in a round.
SPLITS = 64


def _refined(counts: DataFrame, open_: DataFrame) -> DataFrame:
    """The parts of open cells that hold a wanted rank: ``_l, lo, hi, below, size, ranks``.

    A cell is cut at about equal numbers of different values, so a round makes it smaller by the same factor however close
    its values lie. The cells are few (see ``_selected``), their values spread over all tasks.
    """

    def inside(cells: DataFrame) -> DataFrame:
        return counts.join(F.broadcast(cells.withColumnRenamed("_l", "_k")), F.expr("_l = _k AND v >= lo AND v <= hi")).drop("_k")

    shares = [i / SPLITS for i in range(1, SPLITS)]
    cuts = inside(open_.select("_l", "lo", "hi")).groupBy("_l", "lo").agg(F.percentile_approx("v", shares, 20 * SPLITS).alias("cuts"))
    cells = stored(open_.join(cuts, ["_l", "lo"]), "cells")
    part = F.size(F.filter("cuts", lambda c: c < F.col("v"))).alias("part")
    parts = inside(cells.select("_l", "lo", "hi", "cuts")).groupBy("_l", "lo", part)
    parts = parts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("size"), F.min("v").alias("_lo"), F.max("v").alias("_hi"))
    up_to = Window.partitionBy("_l", "lo").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = parts.withColumn("_upto", F.sum("n").over(up_to)).join(cells.select("_l", "lo", "below", "ranks"), ["_l", "lo"])
    parts = parts.withColumn("_first", F.col("below") + F.col("_upto") - F.col("n"))
    parts = parts.withColumn("_held", F.filter("ranks", lambda r: (r >= F.col("_first")) & (r < F.col("_first") + F.col("n"))))
    out = parts.select("_l", F.col("_lo").alias("lo"), F.col("_hi").alias("hi"), F.col("_first").alias("below"), "size", F.col("_held").alias("ranks"))
    return out.where(F.size("ranks") > 0)


def _selected(df: DataFrame, value: str, wanted: Sequence[tuple[float, str]], by: Sequence[str]) -> DataFrame:
    """``q, method, value`` for every wanted quantile and label; a null label is a label.

    Equal values are counted first. A label with more than ``CELL_VALUES`` different values is searched in rounds: its values are
    cut into parts, and the parts that hold a wanted rank are cut again, until each has few enough to be put in
    order. So neither a heavy value nor a heavy label nor values close to each other end in one task. At most
    ``MOST_CELLS`` labels are searched at a time, as each holds more than that share of all counts. (Some small actions.)
    """
    unknown = {m for _, m in wanted} - {"cont", "index"}
    if unknown:
        raise ValueError(f"unknown methods {sorted(unknown)}")
    label = F.struct(*by) if by else F.struct(F.lit(0).alias("_all"))
    values = df.where(F.col(value).isNotNull()).select(label.alias("_l"), F.col(value).cast("double").alias("v"))
    counts = stored(values.groupBy("_l", "v").agg(F.count(F.lit(1)).alias("n")), "counted")
    limit = max(CELL_VALUES, counts.count() // MOST_CELLS)
    totals = counts.groupBy("_l").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("size"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    asked = F.array(*[F.struct(F.lit(float(q)).alias("q"), F.lit(m).alias("method")) for q, m in wanted])
    ranks = F.when(F.col("method") == "cont", F.array(F.floor("position"), F.ceil("position"))).otherwise(
        F.array(F.floor(F.col("position") + F.lit(1e-9)))
    )
    targets = totals.select("*", F.inline(asked)).withColumn("position", F.col("q") * (F.col("total") - 1))
    targets = stored(targets.withColumn("rank", F.explode(F.array_distinct(ranks))), "targets")

    large = targets.where(F.col("size") > limit)
    open_ = large.groupBy("_l", "lo", "hi", "size").agg(F.collect_set("rank").alias("ranks"))
    open_ = open_.select("_l", "lo", "hi", F.lit(0).cast("bigint").alias("below"), "size", "ranks")
    rows = counts.join(F.broadcast(large.select("_l").distinct()), "_l", "left_anti")
    rows = rows.select("_l", F.lit(None).cast("double").alias("lo"), F.lit(0).cast("bigint").alias("below"), "v", "n")
    while not open_.isEmpty():
        parts = stored(_refined(counts, open_), "parts")
        few = F.broadcast(parts.where(F.col("size") <= limit).select(F.col("_l").alias("_k"), "lo", "hi", "below"))
        rows = rows.union(counts.join(few, F.expr("_l = _k AND v >= lo AND v <= hi")).select("_l", "lo", "below", "v", "n"))
        open_ = parts.where(F.col("size") > limit)

    order = Window.partitionBy("_l", "lo").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ordered = rows.withColumn("_upto", F.col("below") + F.sum("n").over(order)).select("_l", "v", "n", "_upto")
    hit = ordered.join(targets.select("_l", "q", "method", "position", "rank"), "_l").where("rank < _upto AND rank >= _upto - n")
    share = F.col("position") - F.floor("position")
    weight = (
        F.when(F.col("method") == "index", F.lit(1.0))
        .when(F.col("rank") == F.floor("position"), 1 - share)
        .otherwise(share)
    )
    return hit.groupBy(*[F.col(f"_l.{c}").alias(c) for c in by], "q", "method").agg(F.sum(F.col("v") * weight).alias("value"))


def freshness(df: DataFrame, earlier: str, later: str, qs: Sequence[float] = (0.5, 0.95, 0.99), by: Sequence[str] = ()) -> DataFrame:
    """Quantiles of the seconds between two times."""
    seconds = (F.unix_micros(_col(later).cast("timestamp")) - F.unix_micros(_col(earlier).cast("timestamp"))) / 1e6
    return exact_quantiles(df.withColumn("_seconds", seconds), "_seconds", qs, by)


def consistency_report(df: DataFrame, value: str, ok: Column, share: float = 0.9, by: Sequence[str] = ()) -> DataFrame:
    """Successes, median, p95 by index, maximum, and whether enough calls succeeded."""
    label = list(by) or ["_all"]
    rows = df if by else df.withColumn("_all", F.lit(1))
    base = rows.groupBy(*label).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("ok"), F.max(value).alias("max_value")
    )
    found = _selected(rows, value, [(0.5, "cont"), (0.95, "index")], label)
    quantiles = found.groupBy(*label).agg(
        F.max(F.when(F.col("q") == 0.5, F.col("value"))).alias("p50"),
        F.max(F.when(F.col("q") == 0.95, F.col("value"))).alias("p95"),
    )
    out = base.join(quantiles, label, "left").withColumn("passed", F.col("ok") >= F.floor(F.lit(share) * F.col("n")))
    return out if by else out.drop("_all")
