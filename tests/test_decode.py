import json

import pytest
from pyspark.sql import functions as F

from freshet.functions.json_text import is_json, json_kind, lenient_object, repair_utf8
from freshet.operators import decode as D
from freshet.operators import filters as L
from freshet.sources import frames as R
from freshet.sources.increments import keyset_page, read_cursor, write_cursor

MESSAGES = [
    (None, "skipped", "tombstone"),
    ("", "error", "empty"),
    ("  ", "error", "empty"),
    ("{bad", "error", "malformed"),
    ('"{\\"content\\":\\"x\\"}"', "ok", None),
    ("[1]", "error", "not_an_object"),
    ('"text"', "error", "malformed"),
    ('{"content":"x"}', "ok", None),
    ('  {"content":"x"}  ', "ok", None),
    ('{"content":""}', "error", "content_empty"),
    ('{"content":5}', "error", "content_not_text"),
    ('{"content":null}', "error", "content_missing"),
    ('{"other":1}', "error", "content_missing"),
]


def _messages(spark):
    return spark.createDataFrame([(i, m[0]) for i, m in enumerate(MESSAGES)], "id int, value string")


def test_classify(spark):
    got = {r["id"]: (r["result"], r["reason"]) for r in D.classify(_messages(spark)).collect()}
    assert got == {i: m[1:] for i, m in enumerate(MESSAGES)}


def test_split_valid_is_whole(spark):
    valid, quarantine = D.split_valid(_messages(spark))
    ok = {r["id"]: r["body"] for r in valid.collect()}
    bad = {r["id"] for r in quarantine.collect()}
    assert ok.keys() == {i for i, m in enumerate(MESSAGES) if m[1] == "ok"}
    assert bad == {i for i, m in enumerate(MESSAGES) if m[1] == "error"}
    assert all(json.loads(b)["content"] == "x" for b in ok.values())


def test_lenient(spark):
    df = spark.createDataFrame([(None,), ("",), ('{"a":1}',), ("oops",)], "v string")
    assert [r[0] for r in df.select(lenient_object("v")).collect()] == ["{}", "{}", '{"a":1}', '{"raw":"oops"}']


def test_decode_keeps_raw_text(spark):
    df = spark.createDataFrame([('{"doc_id":"1","meta":{"user":"u"}}',), ("nope",)], "value string")
    rows = D.flatten_message(D.decode(df, D.MESSAGE_SCHEMA)).collect()
    assert rows[0]["doc_id"] == "1" and rows[0]["username"] == "u" and rows[0]["project"] is None
    assert rows[1]["doc_id"] is None and rows[1]["raw_json"] == "nope"


@pytest.mark.parametrize(
    "text,kind",
    [
        ('4703 is no "number"', None), ('{"content":"x"} and more', None), ('{"content":"x"}{}', None), ('"{\\"content\\":\\"x\\"}" more', None),
        ("1,2", None), ("1],[2", None), ("1,0],[2", None), ("null x", None), ("null", "VOID"), (" 7 ", "BIGINT"), ("[1,2]", "ARRAY<BIGINT>"), ('"a]"', "STRING"),
    ],
)
def test_text_after_a_value_is_not_json(spark, text, kind):
    df = spark.createDataFrame([(1, text)], "id int, value string")
    assert df.select(json_kind("value"), is_json("value")).first() == (kind, kind is not None)
    assert D.classify(df).first()["reason"] == ("malformed" if kind is None or kind == "STRING" else "not_an_object")
    if kind is None:
        assert df.select(lenient_object("value")).first()[0] == json.dumps({"raw": text}, separators=(",", ":"))
        assert D.type_violations(df, fields={"content": "integer"}).first()["violations"] == []


def test_utf8_repair(spark):
    df = spark.createDataFrame([(bytearray(b"a\xffb"),)], "v binary")
    assert df.select(repair_utf8("v"), repair_utf8("v", "ignore")).first() == ("a�b", "ab")


def test_type_violations(spark):
    df = spark.createDataFrame([('{"type":1,"title":null,"timestamp":"5","more":[1]}',), ('{"timestamp":5}',)], "value string")
    assert [r["violations"] for r in D.type_violations(df).collect()] == [["type", "timestamp"], []]


KEEP_CASES = [
    (dict(), True),
    (dict(namespace=None), True),
    (dict(namespace=1), False),
    (dict(bot=True), False),
    (dict(bot=None), True),
    (dict(user_name=" InternetArchiveBot "), False),
    (dict(user_name=None), True),
    (dict(type=None), False),
    (dict(type="log"), False),
]


@pytest.mark.parametrize("change,kept", KEEP_CASES)
def test_keep(spark, change, kept):
    row = dict(type="edit", namespace=0, bot=False, user_name="u", wiki=" enwiki ") | change
    df = spark.createDataFrame([row], "type string, namespace int, bot boolean, user_name string, wiki string")
    assert (L.keep(df).count() == 1) is kept
    assert (L.keep(df, wikis=["enwiki"]).count() == 1) is kept
    assert L.keep(df, wikis=["dewiki"]).count() == 0


def test_quota_keeps_whole_minutes_apart(spark):
    rows = [(i, f"2024-01-01 00:{i // 50:02d}:{i % 50:02d}") for i in range(120)]
    df = spark.createDataFrame(rows, "id int, at string").withColumn("at", F.col("at").cast("timestamp"))
    got = L.minute_quota(df, "at", ["at", "id"], 3).select("id").collect()
    assert sorted(r[0] for r in got) == [0, 1, 2, 50, 51, 52, 100, 101, 102]


CAPTURE = ': hello\nevent: message\nid: 7\ndata: {"a":\ndata: 1}\n\n: only a comment\n\ndata:  {"b":2}\n\ndata: [DONE]\n\ndata: x\nid: 9'


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_frames(spark, tmp_path, ending):
    (tmp_path / "capture.txt").write_bytes(CAPTURE.replace("\n", ending).encode())
    for named in ("\n", ending):
        rows = [tuple(r) for r in R.read_frames(spark, str(tmp_path), named).collect()]
        assert rows == [("message", "7", '{"a":\n1}'), (None, None, '{"b":2}'), (None, None, "[DONE]"), (None, "9", "x")]


def test_lines(spark, tmp_path):
    (tmp_path / "capture.txt").write_text('data: {"a":1}\nid: 3\ndata: [DONE]\ndata:\ndata: oops{\n:data: 5\ndata:{"b":2}\n')
    assert [r[0] for r in R.read_lines(spark, str(tmp_path)).collect()] == ['{"a":1}', '{"b":2}']


def test_objects_with_byte_order_mark(spark, tmp_path):
    (tmp_path / "m.json").write_bytes(b'\xef\xbb\xbf{"query":"q","top_k":3}\n')
    assert tuple(R.read_objects(spark, str(tmp_path), "query string, top_k int").first()) == ("q", 3)


def test_cursor_walks_all_pages(spark, tmp_path):
    path = str(tmp_path / "cursor")
    df = spark.range(1, 26).toDF("id")
    seen = []
    for _ in range(4):
        page = [r[0] for r in keyset_page(df, "id", read_cursor(spark, path), 10).collect()]
        seen.append(len(page))
        if page:
            write_cursor(spark, path, page[-1])
    assert seen == [10, 10, 5, 0] and read_cursor(spark, path) == 25 and read_cursor(spark, path, "other") == 0
