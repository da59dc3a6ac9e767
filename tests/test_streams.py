"""Streams give what the batch operators give, also after a replay."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from freshet.operators.decode import MESSAGE_SCHEMA, decode
from freshet.operators.merge import merge
from freshet.operators.star import SEEN, edits_from_content
from freshet.sources.events import common_events, envelopes, from_envelopes, stored_content
from freshet.sources.sinks import batch_writer
from freshet.streaming import flows
from freshet.streaming.reader import ENVELOPE, read_stream, topic_options
from freshet.streaming.snapshots import SnapshotTable, idempotent_writer
from freshet.streaming.star import advance, star_tables

RULES = {"bot": "last_non_null", "title": "last", "ord": "max"}


def _files(spark, small, path, parts=3):
    sent = envelopes(common_events(spark.read.parquet(f"{small}/events.parquet")))
    sent.repartition(parts, "offset").write.parquet(path)
    return sent


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_envelopes_round_trip(spark, small):
    events = common_events(spark.read.parquet(f"{small}/events.parquet"))
    back = from_envelopes(envelopes(events)).select(*events.columns)
    assert back.exceptAll(events).count() == 0 and back.count() == events.count()


def test_upsert_stream_equals_batch_and_survives_replay(spark, small, tmp_path):
    path = str(tmp_path / "in")
    _files(spark, small, path)
    target = SnapshotTable(spark, str(tmp_path / "out"), ["user_name"], ["ord"], RULES)
    stream = from_envelopes(read_stream(spark, "parquet", path, maxFilesPerTrigger="1"))
    flows.drain(stream, str(tmp_path / "cp"), each=target.writer())
    want = _rows(merge(common_events(spark.read.parquet(f"{small}/events.parquet")), ["user_name"], ["ord"], RULES))
    assert _rows(target.read()) == want
    versions = target.versions("delta")
    assert len(versions) >= 3
    # Everything again under the last batch's id, as after a crash before its commit.
    run, number = versions[-1].rsplit("-", 1)
    target.apply(from_envelopes(spark.read.parquet(path)), int(number), run)
    assert _rows(target.read()) == want
    # A full replay from the start under a new checkpoint.
    flows.drain(stream, str(tmp_path / "cp2"), each=target.writer())
    assert _rows(target.read()) == want


def test_new_rows_after_a_fold_and_a_restart_are_kept(spark, tmp_path):
    """A stream is drained and folded; another checkpoint then counts from 0 again, with new rows."""
    target = SnapshotTable(spark, str(tmp_path / "out"), ["k"], ["o"], {"v": "last", "n": "sum"}, fold_every=2)
    seen, sink = [], str(tmp_path / "sink")
    for run in range(3):
        rows = [(10 * run + i, run * 100 + i, f"r{run}", 1) for i in range(5)] + [(0, 1000 + run, f"r{run}", 1)]
        path = str(tmp_path / f"in{run}")
        spark.createDataFrame(rows, "k int, o int, v string, n int").repartition(3).write.parquet(path)
        stream = spark.readStream.schema("k int, o int, v string, n int").option("maxFilesPerTrigger", 1).parquet(path)
        flows.drain(stream, str(tmp_path / f"cp{run}"), each=target.writer())
        flows.drain(stream, str(tmp_path / f"cq{run}"), each=idempotent_writer(sink))
        seen += rows
    assert len(target.versions("base")) >= 2
    want = _rows(merge(spark.createDataFrame(seen, "k int, o int, v string, n int"), ["k"], ["o"], {"v": "last", "n": "sum"}))
    assert _rows(target.read()) == want
    assert _rows(spark.read.parquet(sink).select("k", "o", "v", "n")) == sorted(seen, key=str)
    target.vacuum()
    assert _rows(target.read()) == want


def test_unfinished_snapshot_is_not_read(spark, tmp_path):
    target = SnapshotTable(spark, str(tmp_path), ["k"], ["o"], {"v": "last"})
    assert target.read() is None
    target.apply(spark.createDataFrame([(1, 1, "a")], "k int, o int, v string"), 0)
    target.apply(spark.createDataFrame([(1, 2, "b")], "k int, o int, v string"), 1)
    (tmp_path / "delta" / "v=000000000001" / "_SUCCESS").unlink()
    assert _rows(target.read()) == [(1, "a")]


def test_folding_and_vacuum_keep_the_table(spark, tmp_path):
    target = SnapshotTable(spark, str(tmp_path), ["k"], ["o"], {"v": "last", "n": "count"}, fold_every=2)

    def batch(i):
        return spark.createDataFrame([(1, i, f"x{i}"), (10 + i, i, "y")], "k int, o int, v string").withColumn("n", F.lit(1))

    for i in range(7):
        target.apply(batch(i), i)
    target.apply(batch(5), 5)  # folded already, runs again
    want = sorted([(1, "x6", 7), *[(10 + i, "y", 1) for i in range(7)]], key=str)
    assert _rows(target.read()) == want
    assert sorted(r["n"] for r in target.read(before=3).collect()) == [1, 1, 1, 3]
    target.vacuum()
    assert [int(v) for v in target.versions("base")] == [1, 2] and [int(v) for v in target.versions("delta")] == [4, 5, 6]
    assert _rows(target.read()) == want


def test_cleaned_stream_writes_each_batch_once(spark, small, tmp_path):
    path, sink = str(tmp_path / "in"), str(tmp_path / "out")
    sent = _files(spark, small, path)
    write = idempotent_writer(sink, lambda df: df.select("ord", "content"))
    flows.drain(flows.cleaned(read_stream(spark, "parquet", path, maxFilesPerTrigger="1")), str(tmp_path / "cp"), each=write)
    want = _rows(flows.cleaned(sent).select("ord", "content"))
    assert _rows(spark.read.parquet(sink).select("ord", "content")) == want
    last = spark.read.parquet(f"{sink}/{sorted(p.name for p in Path(sink).iterdir() if p.name.startswith('batch='))[1]}").collect()
    run = next(p.name for p in Path(sink).iterdir() if p.name.startswith("batch=")).removeprefix("batch=").rsplit("-", 1)[0]
    idempotent_writer(sink)(spark.createDataFrame(last), 1, run)
    assert _rows(spark.read.parquet(sink).select("ord", "content")) == want


def _timed(spark, path, rows):
    """Rows (id, seconds) as one more file of a stream."""
    df = spark.createDataFrame(rows, "id int, s long").select("id", F.timestamp_seconds(F.lit(1700000040) + F.col("s")).alias("at"))
    df.coalesce(1).write.mode("append").parquet(path)
    time.sleep(1.1)  # files are taken by their time


def test_quota_goes_on_after_a_restart_and_lets_old_minutes_go(spark, tmp_path):
    path, cp, sink = (str(tmp_path / n) for n in ("in", "cp", "out"))

    def drain():
        stream = spark.readStream.schema("id int, at timestamp").option("maxFilesPerTrigger", 1).parquet(path)
        flows.drain(flows.quota(stream, "at", ["at", "id"], 3, lateness="2 minutes"), cp, path=sink)
        return sorted(r["id"] for r in spark.read.parquet(sink).collect())

    _timed(spark, path, [(1, 0), (2, 5)])
    _timed(spark, path, [(i, 10 + i) for i in range(3, 9)] + [(i, 60 + i - 20) for i in range(20, 26)])
    assert drain() == [1, 2, 3, 20, 21, 22]
    # The counters come from the checkpoint: minute 0 is full, minute 1 as well, minute 2 is new.
    _timed(spark, path, [(9, 30), (26, 100), (40, 130), (41, 131)])
    assert drain() == [1, 2, 3, 20, 21, 22, 40, 41]
    # Far behind the watermark: not admitted, and the counters of those minutes are gone from the state.
    _timed(spark, path, [(60, 3600)])
    _timed(spark, path, [(10, 40), (61, 3601)])
    assert drain() == [1, 2, 3, 20, 21, 22, 40, 41, 60, 61]


def test_late_rows_are_told_by_the_streams_own_watermark(spark, tmp_path):
    path, cp = str(tmp_path / "in"), str(tmp_path / "cp")
    on_time, late = idempotent_writer(str(tmp_path / "on")), idempotent_writer(str(tmp_path / "late"))

    def drain():
        stream = spark.readStream.schema("id int, at timestamp").option("maxFilesPerTrigger", 1).parquet(path)
        flows.drain(stream.withWatermark("at", "1 minute"), cp, each=flows.split_late(cp, "at", on_time, late))
        return [sorted(r["id"] for r in spark.read.schema("id int").parquet(str(tmp_path / n)).collect()) for n in ("on", "late")]

    _timed(spark, path, [(1, 0), (2, 600), (3, -900)])
    assert drain() == [[1, 2, 3], []]
    _timed(spark, path, [(4, 539), (5, 540), (6, 541), (7, None), (8, 2000)])
    _timed(spark, path, [(9, 1000)])
    assert drain() == [[1, 2, 3, 5, 6, 7, 8], [4, 9]]
    # A batch that runs again is split by the same watermark.
    run = flows.run_of(spark, cp)
    again = spark.createDataFrame([(4, 539), (5, 540)], "id int, s long").select("id", F.timestamp_seconds(F.lit(1700000040) + F.col("s")).alias("at"))
    flows.split_late(cp, "at", on_time, late)(again, 1, run)
    assert [sorted(r["id"] for r in spark.read.parquet(str(tmp_path / n)).collect()) for n in ("on", "late")] == [[1, 2, 3, 5], [4, 9]]


def test_dedup_and_windows(spark, small, tmp_path):
    path = str(tmp_path / "in")
    sent = _files(spark, small, path)
    timed = from_envelopes(read_stream(spark, "parquet", path)).withColumn("at", F.timestamp_seconds("ts_epoch"))
    flows.drain(flows.dedup(timed, ["kafka_offset"], "at", "60 days").select("kafka_offset"), str(tmp_path / "cp1"), path=str(tmp_path / "o1"))
    assert spark.read.parquet(str(tmp_path / "o1")).count() == sent.select("offset").distinct().count()
    counts = flows.windowed_counts(timed, "at", "1 hour", lateness="60 days")
    flows.drain(counts, str(tmp_path / "cp2"), each=idempotent_writer(str(tmp_path / "o2")), mode="update")
    assert spark.read.parquet(str(tmp_path / "o2")).agg(F.sum("n")).first()[0] == sent.count()


def test_late_rows_go_aside(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 00:00:00' AS at UNION ALL SELECT timestamp'2024-01-02 00:00:00'")
    assert flows.late_rows(df, "at", "2024-01-01 12:00:00").count() == 1


def test_table_sink_skips_empty_batches(spark, tmp_path):
    write = batch_writer("parquet", path=str(tmp_path / "out"))
    messages = spark.createDataFrame([('{"doc_id":"1","text":"t","meta":{"user":"u"}}',)], "value string")
    decoded = decode(messages, MESSAGE_SCHEMA)
    write(decoded.where("false"), 0)
    assert not (tmp_path / "out").exists()
    write(decoded, 1)
    assert spark.read.parquet(str(tmp_path / "out")).columns == ["doc_id", "source", "text", "project", "username", "event_ts", "raw_json"]


def test_topic_options():
    options = topic_options("b:9092", "t", "earliest", 100)
    assert options["startingOffsets"] == "earliest" and options["maxOffsetsPerTrigger"] == "100" and options["failOnDataLoss"] == "false"
    assert "offset bigint" in ENVELOPE


def _star(spark, small, upto=None):
    rows = stored_content(common_events(spark.read.parquet(f"{small}/events.parquet")))
    return rows if upto is None else rows.where(F.col("ord") <= upto)


def _star_rows(star):
    return {name: sorted((tuple(r[c] for c in sorted(r.asDict())) for r in star.read(name).collect()), key=str) for name in SEEN}


def _batch_star(rows):
    edits = edits_from_content(rows)
    return {
        name: sorted((tuple(r[c] for c in sorted(r.asDict())) for r in merge(take(edits), keys, ["ord"], rules).collect()), key=str)
        for name, (take, keys, rules) in SEEN.items()
    }


def test_star_cut_off_between_two_tables(spark, small, tmp_path, monkeypatch):
    star = star_tables(spark, str(tmp_path), fold_every=2)
    assert star.cursor() is None and star.read("fact_edit") is None
    assert advance(star, _star(spark, small, 500), 300) == 2
    assert star.cursor() == 500 and _star_rows(star) == _batch_star(_star(spark, small, 500))
    # Two of four tables of the third batch are written, then the job dies.
    write, calls = SnapshotTable.write, []

    def dying(self, *args):
        calls.append(self.path)
        if len(calls) == 3:
            raise RuntimeError("killed")
        write(self, *args)

    monkeypatch.setattr(SnapshotTable, "write", dying)
    with pytest.raises(RuntimeError):
        advance(star, _star(spark, small), 300)
    monkeypatch.setattr(SnapshotTable, "write", write)
    assert len(set(calls)) == 3
    assert star.cursor() == 500 and _star_rows(star) == _batch_star(_star(spark, small, 500))
    # The next run covers other ids in its first batch, and ends at the same star.
    assert advance(star, _star(spark, small), 700) >= 2
    assert _star_rows(star) == _batch_star(_star(spark, small))
    assert advance(star, _star(spark, small), 700) == 0
