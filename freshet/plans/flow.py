"""Queries over flow: counters, rates, histograms, lag, alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.functions.times import as_zoned, plain_time
from freshet.operators import metrics as M
from freshet.operators.alerts import RULES, evaluations, rule_alerts
from freshet.operators.alerts import alert_islands as islands
from freshet.plans import Registry
from freshet.plans import shared_sql as S
from freshet.sources.events import common_events
from freshet.sources.tables import table

registry = Registry()
query = registry.query


def _ok():
    return F.col("event_type") != "error"


def _failed():
    return F.col("event_type") == "error"


def _events(spark, d):
    return table(spark, d, "events")


@query("SELECT count(*) AS received, count(*) FILTER (event_type <> 'error') AS processed, count(*) FILTER (event_type = 'error') AS failed FROM events")
def flow_counts(spark, d):
    return M.flow_counts(_events(spark, d), _ok(), _failed())


@query(
    """SELECT event_type, CASE WHEN user_id % 2 = 0 THEN 'GET' ELSE 'POST' END AS method, count(*) AS n FROM events
WHERE user_id % 10 <> 0 GROUP BY 1, 2"""
)
def flow_by_label(spark, d):
    rows = _events(spark, d).select(
        "event_type",
        F.when(F.col("user_id") % 2 == 0, "GET").otherwise("POST").alias("method"),
        F.when(F.col("user_id") % 10 == 0, "/metrics").otherwise("/query").alias("path"),
    )
    return M.labelled_counts(rows, ["event_type", "method"], "path")


_LE = " UNION ALL ".join(
    f"SELECT event_type, '{b:g}' AS le, count(*) FILTER (value / 10 <= {b}) AS n FROM events GROUP BY event_type" for b in M.LATENCY_BOUNDS
)


@query(f"{_LE} UNION ALL SELECT event_type, '+Inf', count(value) FROM events GROUP BY event_type")
def latency_buckets(spark, d):
    rows = _events(spark, d).select("event_type", (F.col("value") / 10).alias("seconds"))
    return M.buckets_long(rows, "seconds", ["event_type"])


_INF = len(M.LATENCY_BOUNDS)


def _quantile_sql(source: str, labels: str) -> str:
    """Interpolated 0.95 quantile from cumulative buckets, per label."""
    bounds = ", ".join(str(float(b)) for b in M.LATENCY_BOUNDS)
    counts = ", ".join(f"count(*) FILTER (v <= {b})" for b in M.LATENCY_BOUNDS)
    return f"""
w AS (SELECT {labels}, count(*) AS total, [{counts}] AS c, [{bounds}] AS b FROM {source} GROUP BY {labels}),
p AS (SELECT *, list_position(list_transform(c, lambda x: x >= 0.95 * total), true) AS i FROM w),
quant AS (SELECT {labels}, total AS n, CASE WHEN i IS NULL OR i = 0 THEN b[{_INF}]
    ELSE (CASE WHEN i = 1 THEN 0.0 ELSE b[i - 1] END) + (b[i] - (CASE WHEN i = 1 THEN 0.0 ELSE b[i - 1] END))
      * (0.95 * total - (CASE WHEN i = 1 THEN 0 ELSE c[i - 1] END)) / (c[i] - (CASE WHEN i = 1 THEN 0 ELSE c[i - 1] END)) END AS q FROM p)"""


@query(
    f"""WITH s AS (SELECT event_type, time_bucket(INTERVAL 5 HOUR, ts, TIMESTAMP '1970-01-01') AS window_start, value / 20 AS v FROM events),
{_quantile_sql('s', 'event_type, window_start')}
SELECT event_type, window_start, n, round(q, 6) AS p95 FROM quant"""
)
def p95_buckets(spark, d):
    rows = _events(spark, d).withColumn("seconds", F.col("value") / 20)
    out = M.windowed_quantile(rows, "ts", "seconds", 0.95, "5 hours", ["event_type"])
    return out.select("event_type", plain_time("window_start").alias("window_start"), "n", F.round("quantile", 6).alias("p95"))


@query("SELECT event_type, max(ts) FILTER (event_type <> 'error') AS last_success FROM events GROUP BY event_type")
def last_success(spark, d):
    return M.last_success(_events(spark, d), "ts", _ok(), ["event_type"])


@query(
    """WITH l AS (SELECT user_id, max(ts) FILTER (event_type <> 'error') AS t FROM events GROUP BY user_id),
a AS (SELECT user_id, CAST(floor(epoch((SELECT max(ts) FROM events))) - floor(epoch(t)) AS BIGINT) AS age FROM l)
SELECT user_id, age AS age_seconds, coalesce(age > 3600, true) AS stale FROM a"""
)
def staleness(spark, d):
    events = _events(spark, d)
    newest = events.agg(F.max(as_zoned("ts"))).scalar()
    last = M.last_success(events, "ts", _ok(), ["user_id"])
    return M.staleness(last, newest, 3600).select("user_id", "age_seconds", "stale")


@query(
    """WITH s AS (SELECT event_type, ts, ts + to_microseconds(CAST(round(value * 60000000) AS BIGINT)) AS te FROM events),
m AS (SELECT event_type, ts AS moment, 1 AS o, 0 AS c FROM s UNION ALL SELECT event_type, te, 0, 1 FROM s),
g AS (SELECT event_type, moment, sum(o) AS o, sum(c) AS c FROM m GROUP BY event_type, moment),
r AS (SELECT event_type, o + coalesce(sum(o - c) OVER (PARTITION BY event_type ORDER BY moment ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open FROM g)
SELECT event_type, CAST(max(open) AS BIGINT) AS peak FROM r GROUP BY event_type"""
)
def inflight_peak(spark, d):
    """Each event is open for ``value`` minutes."""
    end = F.timestamp_micros(F.unix_micros(as_zoned("ts")) + F.round(F.col("value") * 60000000).cast("bigint"))
    return M.inflight_peak(_events(spark, d).select("event_type", "ts", end.alias("te")), "ts", "te", ["event_type"])


@query(
    """WITH p AS (SELECT event_type, time_bucket(INTERVAL 1 MINUTE, ts, TIMESTAMP '1970-01-01') AS m, count(*) AS n FROM events GROUP BY 1, 2),
w AS (SELECT event_type, m - to_minutes(CAST(unnest(range(0, 5)) AS INTEGER)) AS window_start, n FROM p)
SELECT event_type, window_start, CAST(sum(n) AS BIGINT) AS n, round(sum(n) / 300.0, 6) AS per_second FROM w GROUP BY 1, 2"""
)
def rate_5m(spark, d):
    out = M.rate(_events(spark, d), "ts", "5 minutes", "1 minute", ["event_type"])
    return out.select("event_type", plain_time("window_start").alias("window_start"), "n", F.round("per_second", 6).alias("per_second"))


@query(
    """SELECT event_type, time_bucket(INTERVAL 10 MINUTE, ts, TIMESTAMP '1970-01-01') AS window_start, count(*) AS n FROM events GROUP BY 1, 2"""
)
def increase_10m(spark, d):
    out = M.increase(_events(spark, d), "ts", "10 minutes", by=["event_type"])
    return out.select("event_type", plain_time("window_start").alias("window_start"), "n")


@query(
    """SELECT user_id, count(*) FILTER (event_type = 'error') AS failed,
    round(100.0 * count(*) FILTER (event_type = 'error') / greatest(CAST(count(*) FILTER (event_type <> 'error') AS DOUBLE), 1e-9), 6) AS ratio
FROM events GROUP BY user_id"""
)
def error_ratio(spark, d):
    counts = M.flow_counts(_events(spark, d), _ok(), _failed(), ["user_id"])
    return counts.select("user_id", "failed", F.round(M.error_ratio(F.col("failed"), F.col("processed")), 6).alias("ratio"))


@query(
    f"""WITH {S.EV}, h AS (SELECT kafka_topic, kafka_partition, max(kafka_offset) AS head FROM ev GROUP BY 1, 2),
c AS (SELECT kafka_topic, kafka_partition, max(kafka_offset) AS committed FROM ev WHERE type = 'edit' AND kafka_partition <> 2 GROUP BY 1, 2)
SELECT kafka_topic, kafka_partition, head, committed, head - coalesce(committed, -1) AS lag FROM h LEFT JOIN c USING (kafka_topic, kafka_partition)"""
)
def consumer_lag(spark, d):
    head = common_events(_events(spark, d))
    committed = head.where((F.col("type") == "edit") & (F.col("kafka_partition") != 2))
    return M.consumer_lag(head, committed)


@query(
    """WITH s AS (SELECT DISTINCT time_bucket(INTERVAL 10 MINUTE, ts, TIMESTAMP '1970-01-01') AS window_start FROM events),
g AS (SELECT unnest(generate_series((SELECT min(window_start) FROM s), (SELECT max(window_start) FROM s), INTERVAL 10 MINUTE)) AS window_start)
SELECT window_start FROM g ANTI JOIN s USING (window_start)"""
)
def stalled_windows(spark, d):
    return M.stalled(_events(spark, d), "ts").select(plain_time("window_start").alias("window_start"))


@query(
    """WITH s AS (SELECT event_type, time_bucket(INTERVAL 60 MINUTE, ts, TIMESTAMP '1970-01-01') AS w, count(*) AS n FROM events GROUP BY 1, 2),
t AS (SELECT *, CASE WHEN epoch(w) - lag(epoch(w)) OVER (PARTITION BY event_type ORDER BY w) <= 3600 THEN 0 ELSE 1 END AS st FROM s WHERE n > 1),
r AS (SELECT *, sum(st) OVER (PARTITION BY event_type ORDER BY w) AS run FROM t)
SELECT event_type, min(w) AS started, max(w) AS ended, count(*) AS evaluations, epoch(max(w)) - epoch(min(w)) >= 7200 AS fires
FROM r GROUP BY event_type, run"""
)
def alert_islands(spark, d):
    series = M.increase(_events(spark, d), "ts", "60 minutes", by=["event_type"])
    runs = islands(series, F.col("n") > 1, 7200, 3600, ["event_type"])
    return runs.select("event_type", plain_time("started").alias("started"), plain_time("ended").alias("ended"), "evaluations", "fires")


@query(
    """WITH s AS (SELECT o_orderpriority, epoch(l_shipdate) - epoch(o_orderdate) AS sec FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
SELECT o_orderpriority, q, round(CASE q WHEN 0.5 THEN quantile_cont(sec, 0.5) WHEN 0.95 THEN quantile_cont(sec, 0.95) ELSE quantile_cont(sec, 0.99) END, 3) AS seconds
FROM s CROSS JOIN (SELECT unnest([0.5::DOUBLE, 0.95::DOUBLE, 0.99::DOUBLE]) AS q) GROUP BY o_orderpriority, q"""
)
def freshness(spark, d):
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate")
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    out = M.freshness(lines.join(orders, "o_orderkey"), "o_orderdate", "l_shipdate", by=["o_orderpriority"])
    return out.select("o_orderpriority", "q", F.round("value", 3).alias("seconds"))


@query(
    """SELECT event_type, count(*) AS n, round(epoch(max(ts) - min(ts)), 3) AS span_seconds,
    round(count(*) / epoch(max(ts) - min(ts)), 6) AS per_second FROM events GROUP BY event_type"""
)
def throughput(spark, d):
    out = M.throughput(_events(spark, d), "ts", ["event_type"])
    return out.select("event_type", "n", F.round("span_seconds", 3).alias("span_seconds"), F.round("per_second", 6).alias("per_second"))


@query(
    """WITH g AS (SELECT user_id, count(*) AS n, count(*) FILTER (event_type <> 'error') AS ok, max(value) AS max_value,
    quantile_cont(value, 0.5) AS p50, list(value ORDER BY value) AS vs FROM events GROUP BY user_id)
SELECT user_id, n, ok, max_value, round(p50, 6) AS p50, vs[CAST(floor(0.95 * (n - 1) + 1e-9) AS BIGINT) + 1] AS p95,
    ok >= CAST(floor(0.9 * n) AS BIGINT) AS passed FROM g"""
)
def consistency_report(spark, d):
    out = M.consistency_report(_events(spark, d), "value", _ok(), by=["user_id"])
    return out.select("user_id", "n", "ok", "max_value", F.round("p50", 6).alias("p50"), "p95", "passed")


def _cumulative_quantile(q: float) -> str:
    """The bucket quantile of running counts ``le_0 ..`` and ``le_inf``."""
    cases, lower, before = [], "0.0", "0"
    for i, bound in enumerate(M.LATENCY_BOUNDS):
        cases.append(
            f"WHEN le_{i} >= {q} * le_inf THEN CASE WHEN le_{i} > {before} THEN {lower} + ({bound} - {lower}) * ({q} * le_inf - {before}) / (le_{i} - {before}) ELSE {bound} END"
        )
        lower, before = str(bound), f"le_{i}"
    return f"CASE WHEN le_inf = 0 THEN NULL {' '.join(cases)} ELSE {M.LATENCY_BOUNDS[-1]} END"


_LE = [*[f"le_{i}" for i in range(len(M.LATENCY_BOUNDS))], "le_inf"]
_RULE_ROWS = " UNION ALL ".join(
    f"SELECT part, t, '{name}' AS rule, {r.hold_seconds} AS hold FROM m WHERE {r.metric} {'=' if r.test == '==' else r.test} CAST({r.limit!r} AS DOUBLE)"
    for name, r in RULES.items()
)


@query(
    f"""WITH r AS (SELECT user_id % 3 AS part, CAST(ceil(epoch_us(ts) / 60000000.0) AS BIGINT) * 60 AS t, epoch_us(ts) AS us, event_type, value / 20 AS v FROM events),
p AS (SELECT part, t, count(*) AS n, count(*) FILTER (event_type <> 'error') AS processed, count(*) FILTER (event_type = 'error') AS failures,
    max(us) FILTER (event_type <> 'error') AS last_ok, count(v) AS le_inf, {', '.join(f'count(*) FILTER (v <= {b}) AS le_{i}' for i, b in enumerate(M.LATENCY_BOUNDS))}
    FROM r GROUP BY 1, 2),
g AS (SELECT part, unnest(range((SELECT min(t) FROM p), (SELECT max(t) FROM p) + 1, 60)) AS t FROM (SELECT DISTINCT part FROM p)),
s AS (SELECT g.part, g.t, CASE WHEN n > 0 THEN 1.0 ELSE 0.0 END AS up, last_value(last_ok IGNORE NULLS) OVER (PARTITION BY g.part ORDER BY g.t) AS last_ok,
    coalesce(sum(failures) OVER w5, 0) AS failures_5m, coalesce(sum(processed) OVER w10, 0) AS processed_10m,
    {', '.join(f'CAST(coalesce(sum({c}) OVER w5, 0) AS BIGINT) AS {c}' for c in _LE)}
    FROM g LEFT JOIN p ON p.part = g.part AND p.t = g.t
    WINDOW w5 AS (PARTITION BY g.part ORDER BY g.t RANGE BETWEEN 240 PRECEDING AND CURRENT ROW), w10 AS (PARTITION BY g.part ORDER BY g.t RANGE BETWEEN 540 PRECEDING AND CURRENT ROW)),
m AS (SELECT part, t, up, t - last_ok / 1e6 AS seconds_since_success, failures_5m, failures_5m / 300.0 AS failure_rate_5m, processed_10m, {_cumulative_quantile(0.95)} AS p95_5m FROM s),
h AS ({_RULE_ROWS}),
i AS (SELECT *, t - 60 * row_number() OVER (PARTITION BY part, rule ORDER BY t) AS run FROM h)
SELECT part, rule, make_timestamp(min(t) * 1000000) AS started, make_timestamp(max(t) * 1000000) AS ended, count(*) AS evaluations,
    max(t) - min(t) >= any_value(hold) AS fires FROM i GROUP BY part, rule, run"""
)
def alert_rules(spark, d):
    """The shipped rules over the events of three parts, evaluated every minute."""
    rows = _events(spark, d).withColumn("part", F.col("user_id") % 3)
    found = rule_alerts(evaluations(rows, "ts", _ok(), _failed(), F.col("value") / 20, ["part"]), by=["part"])
    return found.select("part", "rule", plain_time("started").alias("started"), plain_time("ended").alias("ended"), "evaluations", "fires")
