"""Alerts that fire when a condition has held long enough."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.operators.metrics import LATENCY_BOUNDS, bucket_quantile


class Rule(NamedTuple):
    metric: str
    test: str
    limit: float
    hold_seconds: int


# The shipped rules. Metrics are columns of `evaluations`.
RULES = {
    "down": Rule("up", "==", 0.0, 30),
    "down_2m": Rule("up", "==", 0.0, 120),
    "no_progress": Rule("seconds_since_success", ">", 300.0, 60),
    "failures": Rule("failures_5m", ">", 0.0, 60),
    "failure_rate": Rule("failure_rate_5m", ">", 0.1 / 60, 120),
    "latency_p95": Rule("p95_5m", ">", 0.5, 180),
    "stalled": Rule("processed_10m", "==", 0.0, 600),
}
_TESTS = {"==": operator.eq, ">": operator.gt, "<": operator.lt, ">=": operator.ge, "<=": operator.le}
STEP = 60  # seconds between evaluations


def alert_islands(
    series: DataFrame,
    condition: Column,
    hold_seconds: int | Column,
    step_seconds: int,
    by: Sequence[str] = (),
    at: str = "window_start",
) -> DataFrame:
    """Unbroken runs of evaluations where the condition holds: ``started, ended, fires``.

    ``series`` has one row per label and evaluation time, so a label's rows are
    bounded by time, not by traffic. A missing evaluation breaks a run. The
    alert fires once the run lasts at least ``hold_seconds``.
    """
    when = F.unix_seconds(F.col(at).cast("timestamp"))
    w = Window.partitionBy(*by).orderBy("_t")
    true_rows = series.where(F.coalesce(condition, F.lit(False))).withColumn("_t", when)
    starts = F.when(F.col("_t") - F.lag("_t").over(w) <= step_seconds, 0).otherwise(1)
    runs = true_rows.withColumn("_start", starts).withColumn("_run", F.sum("_start").over(w))
    return (
        runs.groupBy(*by, "_run")
        .agg(F.min(at).alias("started"), F.max(at).alias("ended"), F.count(F.lit(1)).alias("evaluations"))
        .withColumn(
            "fires",
            F.unix_seconds(F.col("ended").cast("timestamp")) - F.unix_seconds(F.col("started").cast("timestamp"))
            >= hold_seconds,
        )
        .drop("_run")
    )


def evaluations(
    df: DataFrame, ts: str, ok: Column, failed: Column, latency: Column, by: Sequence[str] = (), step: int = STEP
) -> DataFrame:
    """The metrics of the rules for every label at every ``step`` seconds from the first row to the last: ``at`` and a column each.

    At a time t a window of w seconds holds the rows after t - w up to t. Rows are first counted by label and step, so a
    series has as many rows as there are steps, whatever its traffic. ``up``: a row came in the last step. Rows without a time
    do not count; a null label is a label. ``seconds_since_success`` is null before the first success, ``p95_5m`` without rows.
    """
    label = F.struct(*by) if by else F.struct(F.lit(0).alias("_all"))
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    rows = df.where(F.col(ts).isNotNull()).select(
        label.alias("_l"), (F.ceil(micros / (step * 1_000_000)) * step).cast("bigint").alias("t"), micros.alias("_at"),
        F.coalesce(ok, F.lit(False)).alias("_ok"), F.coalesce(failed, F.lit(False)).alias("_failed"), latency.cast("double").alias("_v"),
    )
    names = [f"le_{i}" for i in range(len(LATENCY_BOUNDS))]
    panes = rows.groupBy("_l", "t").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("_ok").alias("processed"), F.count_if("_failed").alias("failures"),
        F.max(F.when(F.col("_ok"), F.col("_at"))).alias("last_ok"), F.count("_v").alias("le_inf"),
        *[F.count_if(F.col("_v") <= b).alias(name) for name, b in zip(names, LATENCY_BOUNDS)],
    )
    steps = F.sequence(panes.agg(F.min("t")).scalar(), panes.agg(F.max("t")).scalar(), F.lit(step).cast("bigint"))
    series = panes.select("_l").distinct().select("_l", F.explode(steps).alias("t")).join(panes, ["_l", "t"], "left")
    place = Window.partitionBy("_l").orderBy("t")

    def over(column: str, seconds: int) -> Column:
        return F.coalesce(F.sum(column).over(place.rangeBetween(step - seconds, 0)), F.lit(0))

    so_far = place.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = series.select(
        "_l", "t", F.when(F.col("n") > 0, 1.0).otherwise(0.0).alias("up"), F.last("last_ok", True).over(so_far).alias("last_ok"),
        over("failures", 300).alias("failures_5m"), over("processed", 600).alias("processed_10m"),
        *[over(c, 300).alias(c) for c in [*names, "le_inf"]],
    )
    return out.select(
        *[F.col(f"_l.{c}").alias(c) for c in by], F.timestamp_seconds("t").alias("at"), "up",
        (F.col("t") - F.col("last_ok") / 1e6).alias("seconds_since_success"), "failures_5m", (F.col("failures_5m") / 300).alias("failure_rate_5m"),
        "processed_10m", bucket_quantile(0.95).alias("p95_5m"),
    )


def rule_alerts(evaluated: DataFrame, rules: Mapping[str, Rule] = RULES, by: Sequence[str] = (), step: int = STEP) -> DataFrame:
    """For every rule and label the stretches in which its condition held: ``rule, started, ended, evaluations, fires``."""
    each = [
        F.struct(F.lit(name).alias("rule"), F.lit(r.hold_seconds).alias("hold"), _TESTS[r.test](F.col(r.metric), F.lit(r.limit)).alias("met"))
        for name, r in rules.items()
    ]
    series = evaluated.select(*by, "at", F.inline(F.array(*each)))
    return alert_islands(series, F.col("met"), F.col("hold"), step, [*by, "rule", "hold"], "at").drop("hold")
