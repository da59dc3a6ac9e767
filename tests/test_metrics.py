import numpy as np
import pytest
from pyspark.sql import functions as F

from freshet.operators import metrics as M
from freshet.operators import alerts as A
from freshet.operators.alerts import alert_islands


def _values(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "v double")


def test_bucket_edges(spark):
    row = M.buckets(_values(spark, [0.01, 0.010001, 31, 5]), "v").first()
    assert (row["le_0"], row["le_1"], row["le_7"], row["le_9"], row["le_inf"]) == (1, 2, 3, 3, 4)


@pytest.mark.parametrize(
    "values,want",
    [([], None), ([40, 50], 30.0), ([0.005] * 4, 0.0095), ([0.2] * 100, 0.1 + 0.15 * 0.95), ([0.005] * 10 + [0.4] * 10, 0.25 + 0.25 * (19 - 10) / 10)],
)
def test_bucket_quantile(spark, values, want):
    got = M.buckets(_values(spark, values), "v").select(M.bucket_quantile(0.95).alias("q")).first()["q"]
    assert got is None if want is None else got == pytest.approx(want)


def test_exact_quantiles_with_one_heavy_value(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([np.full(400, 7.25), rng.lognormal(1, 2, 500), -rng.random(100), [0.0]])
    df = spark.createDataFrame([(("a", "b")[i % 2], float(v)) for i, v in enumerate(values)], "k string, v double")
    qs = [0.0, 0.25, 0.5, 0.95, 1.0]
    cont = {(r["k"], r["q"]): r["value"] for r in M.exact_quantiles(df, "v", qs, ["k"]).collect()}
    index = {(r["k"], r["q"]): r["value"] for r in M.exact_quantiles(df, "v", qs, ["k"], "index").collect()}
    for j, k in enumerate("ab"):
        own = np.sort(values[j::2])
        for q in qs:
            assert cont[k, q] == pytest.approx(np.quantile(own, q))
            assert index[k, q] == own[int(q * (len(own) - 1) + 1e-9)]


def test_error_ratio_without_processed(spark):
    df = spark.createDataFrame([(0, 0), (2, 8)], "e long, p long")
    assert [r[0] for r in df.select(M.error_ratio(F.col("e"), F.col("p"))).collect()] == [0.0, 25.0]


def _at(spark, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return df.withColumns({c: F.col(c).cast("timestamp") for c in df.columns if c in ("at", "te", "window_start")})


def test_inflight_peak_spans_days(spark):
    rows = [("a", "2024-01-01 23:59:59", "2024-01-03 00:00:00"), ("a", "2024-01-02 10:00:00", "2024-01-02 10:00:00"),
            ("a", "2024-01-02 10:00:00", "2024-01-02 11:00:00"), ("a", "2024-01-02 11:00:00", "2024-01-02 12:00:00"), ("b", "2024-01-01 00:00:00", "2024-01-01 00:00:01")]
    got = {r["k"]: r["peak"] for r in M.inflight_peak(_at(spark, rows, "k string, at string, te string"), "at", "te", ["k"]).collect()}
    assert got == {"a": 3, "b": 1}


def test_sliding_windows_add_up(spark):
    rows = [("2024-01-01 00:00:30",), ("2024-01-01 00:01:10",), ("2024-01-01 00:07:00",)]
    df = _at(spark, rows, "at string")
    slid = {r["window_start"].strftime("%H:%M"): r["n"] for r in M.increase(df, "at", "5 minutes", "1 minute").collect()}
    want = {}
    for minute in (0, 1, 7):
        for back in range(5):
            start = minute - back
            label = f"{(start // 60) % 24:02d}:{start % 60:02d}"
            want[label] = want.get(label, 0) + 1
    assert slid == want
    assert M.rate(df, "at", "5 minutes").where("n = 2").first()["per_second"] == pytest.approx(2 / 300)


def test_stalled_windows(spark):
    df = _at(spark, [("2024-01-01 00:05:00",), ("2024-01-01 00:35:00",)], "at string")
    assert sorted(r[0].minute for r in M.stalled(df, "at").collect()) == [10, 20]
    assert M.stalled(df.where("false"), "at").count() == 0


def test_lag_without_commit(spark):
    head = spark.createDataFrame([("t", 0, 9), ("t", 1, 4)], "kafka_topic string, kafka_partition int, kafka_offset long")
    got = {r["kafka_partition"]: r["lag"] for r in M.consumer_lag(head, head.where("kafka_partition = 0").withColumn("kafka_offset", F.lit(7))).collect()}
    assert got == {0: 2, 1: 5}


def test_alert_holds(spark):
    rows = [(f"2024-01-01 00:{m:02d}:00", v) for m, v in enumerate([1, 1, 1, 0, 1, 0, 1, 1])]
    runs = alert_islands(_at(spark, rows, "window_start string, v int"), F.col("v") > 0, 120, 60).orderBy("started").collect()
    assert [(r["started"].minute, r["ended"].minute, r["fires"]) for r in runs] == [(0, 2, True), (4, 4, False), (6, 7, False)]


def test_consistency_passes_at_the_share(spark):
    df = spark.createDataFrame([(float(i), i >= 3) for i in range(30)], "v double, ok boolean")
    row = M.consistency_report(df, "v", F.col("ok")).first()
    assert (row["n"], row["ok"], row["passed"], row["p95"], row["p50"], row["max_value"]) == (30, 27, True, 27.0, 14.5, 29.0)


def test_staleness_of_a_label_without_success(spark):
    last = spark.sql("SELECT 1 AS k, timestamp'2024-01-01 00:00:00' AS last_success UNION ALL SELECT 2, NULL")
    got = {r["k"]: (r["age_seconds"], r["stale"]) for r in M.staleness(last, F.lit("2024-01-01 00:05:00"), 300).collect()}
    assert got == {1: (300, False), 2: (None, True)}


def test_internal_paths_are_not_counted(spark):
    df = spark.createDataFrame([("/query",), ("/metrics",), ("/query",)], "path string")
    assert [tuple(r) for r in M.labelled_counts(df, ["path"], "path").collect()] == [("/query", 2)]


def test_quantiles_of_values_close_to_each_other(spark, monkeypatch):
    """100,000 values between 0.5 and 0.501 of one label, a heavy value, and a label that is null, in cells of few values."""
    monkeypatch.setattr(M, "CELL_VALUES", 200)
    rng = np.random.default_rng(5)
    close = 0.5 + 0.001 * rng.random(100_000)
    rows = spark.createDataFrame([("close", float(v)) for v in close] + [(None, float(v)) for v in close[:999]], "k string, v double")
    heavy = spark.range(70_000).select(F.lit("heavy").alias("k"), F.when(F.col("id") % 7 < 5, 1.5).otherwise(F.col("id") * 1e-9).alias("v"))
    df = rows.union(heavy).repartition(8)
    qs = [0.0, 0.31, 0.5, 0.95, 0.99, 1.0]
    found = {(r["k"], r["q"]): r["value"] for r in M.exact_quantiles(df, "v", qs, ["k"]).collect()}
    own = {"close": close, None: close[:999], "heavy": np.where(np.arange(70_000) % 7 < 5, 1.5, np.arange(70_000) * 1e-9)}
    assert found.keys() == {(k, q) for k in own for q in qs}
    for (k, q), v in found.items():
        assert v == pytest.approx(np.quantile(own[k], q), rel=1e-12, abs=1e-15)


def test_no_task_orders_more_than_a_cell(spark, monkeypatch):
    monkeypatch.setattr(M, "CELL_VALUES", 200)
    sizes = []
    refined = M._refined
    monkeypatch.setattr(M, "_refined", lambda counts, open_: (sizes.append([r["size"] for r in open_.collect()]), refined(counts, open_))[1])
    df = spark.range(40_000).select((F.lit(0.5) + F.col("id") * 1e-12).alias("v"))
    assert M.exact_quantiles(df, "v", [0.25], method="index").first()["value"] == 0.5 + 9999 * 1e-12
    assert sizes[0] == [40_000] and all(len(s) == 1 and s[0] < 1000 for s in sizes[1:]) and len(sizes) <= 3


def test_rules_on_a_grid(spark):
    """Every rule against windows counted one by one at every minute; a null label, rows without a time, a quiet hour."""
    rng = np.random.default_rng(8)
    moments = np.concatenate([rng.integers(0, 2400, 90), rng.integers(6000, 7200, 60), [0, 60, 6060]])
    rows = [(None if i % 2 else "a", int(t), ["view", "error"][int(rng.random() < 0.3)], float(rng.random())) for i, t in enumerate(moments)]
    df = spark.createDataFrame(rows + [("a", None, "view", 0.1)], "k string, s long, kind string, v double").withColumn("at_", F.timestamp_seconds(F.col("s") + 1_700_000_040))
    found = A.evaluations(df, "at_", F.col("kind") == "view", F.col("kind") == "error", F.col("v"), ["k"]).collect()
    grid = range(0, max(-(-t // 60) * 60 for _, t, *_ in rows) + 1, 60)
    assert len(found) == 2 * len(grid)
    for r in found:
        t = int(r["at"].timestamp()) - 1_700_000_040
        own = [x for x in rows if x[0] == r["k"]]

        def within(w):
            return [x for x in own if t - w < x[1] <= t]

        done = [x[1] for x in own if x[1] <= t and x[2] == "view"]
        assert r["up"] == float(bool(within(60)))
        assert r["failures_5m"] == sum(x[2] == "error" for x in within(300)) == round(300 * r["failure_rate_5m"])
        assert r["processed_10m"] == sum(x[2] == "view" for x in within(600))
        assert r["seconds_since_success"] == (pytest.approx(t - max(done)) if done else None)
        assert (r["p95_5m"] is None) == (not within(300))
    evaluated = spark.createDataFrame(found, "k string, at timestamp, up double, seconds_since_success double, failures_5m long, failure_rate_5m double, processed_10m long, p95_5m double")
    alerts = A.rule_alerts(evaluated, by=["k"]).collect()
    assert {r["rule"] for r in alerts} == set(A.RULES)
    for name, rule in A.RULES.items():
        for k in (None, "a"):
            met = [{"==": lambda x, y: x == y, ">": lambda x, y: x > y}[rule.test](r[rule.metric], rule.limit) if r[rule.metric] is not None else False
                   for r in sorted((r for r in found if r["k"] == k), key=lambda r: r["at"])]
            runs = [len(x) for x in "".join("x" if m else " " for m in met).split()]
            own = sorted((r["started"], r["evaluations"], r["fires"]) for r in alerts if r["k"] == k and r["rule"] == name)
            assert [n for _, n, _ in own] == runs
            assert [f for *_, f in own] == [60 * (n - 1) >= rule.hold_seconds for n in runs]
