import html
import re

import pytest
from pyspark.sql import functions as F

from freshet.functions import keys, text
from freshet.functions.times import epoch_time, event_time
from freshet.operators import content as C

NBSP, EM, LRM = " ", " ", "‎"


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr.alias("y")).first()["y"]


@pytest.mark.parametrize("s", ["", "  a ", f"{NBSP}a{EM}b{LRM}", "\x1ca\x1f b\t\n c", "x y", "a​b", "\x85q"])
def test_normalize_and_strip_follow_unicode_blanks(spark, s):
    plain = re.sub(r"\s+", " ", s.replace("‎", " ").replace("‏", " ")).strip()
    assert one(spark, s, text.normalize_text("x")) == plain
    assert one(spark, s, text.strip_blanks("x")) == s.strip()
    assert one(spark, s, text.has_text("x")) == (plain != "")


@pytest.mark.parametrize("s", ["<b>caf&eacute;</b>&#39;&amp;", "a<i x='1'>b</i>", "&amp;lt; <", "plain"])
def test_strip_html_full(spark, s):
    assert one(spark, s, text.strip_html("x", full=True)) == html.unescape(re.sub("<[^>]+>", " ", s))


@pytest.mark.parametrize(
    "s,want", [("<b>a</b>&amp", " a &amp"), ("&copy;&ampx;&copy", "©&ampx;&copy"), ("&&amp;lt;&#233;&#xe9;&eacute;", "&&lt;ééé"), ("&semi;&nosuch;", ";&nosuch;")]
)
def test_strip_html_closed_keeps_names_without_semicolon(spark, s, want):
    assert one(spark, s, text.strip_html("x", full=True, closed=True)) == want


def test_upper_each_keeps_the_number_of_signs(spark):
    assert one(spark, "Erßie\nŉ é%", text.upper_each("x")) == "ERßIE\nŉ É%"
    assert one(spark, None, text.upper_each("x")) is None


def test_core_entities_resolve_once(spark):
    assert one(spark, "&amp;lt;&quot;&#39;", text.strip_html("x")) == "&lt;\"'"


@pytest.mark.parametrize("s", ["abcde", "abcdef", "abc  ef", "ab\U0001f600\U0001f601cd", "abcd"])
@pytest.mark.parametrize("n", [5, 0, -1, 3])
def test_truncate(spark, s, n):
    want = s if n <= 0 or len(s) <= n else s[: n - 1].rstrip() + "…"
    assert one(spark, s, text.truncate("x", n)) == want


def test_clean_comment_prefers_parsed(spark):
    df = spark.createDataFrame([("<b>p</b> ", "raw"), ("", " <r> "), (None, None)], "p string, r string")
    assert [r[0] for r in df.select(text.clean_comment("p", "r")).collect()] == ["p", "<r>", ""]


def _parse(content):
    return {m.group(1).strip(): m.group(2).strip() for m in re.finditer(r"(\w+)=([^|]+)", content)}


@pytest.mark.parametrize(
    "s",
    ["type=edit | wiki=x | a=b=c", "k=1 | k=2", "no pairs", "été=1 | =x | y= | z=  ", "== a=b | c", "title=p q=r | user=u", "a=|b=2"],
)
def test_parse_kv(spark, s):
    want = _parse(s)
    assert (one(spark, s, text.parse_kv("x")) or {}) == want
    for key in ("k", "type", "a", "b", "q", "title", "user", "z"):
        assert one(spark, s, text.kv_field("x", key)) == (want.get(key) or None), key


@pytest.mark.parametrize("s,want", [(" TRUE ", True), ("1", True), ("no", False), ("0", False), ("maybe", None), (None, None)])
def test_lenient_bool(spark, s, want):
    assert one(spark, s, text.lenient_bool("x")) is want


def test_sentiment_counts_list_words_once(spark):
    # "improved" holds "improve"; "reverted" holds "revert"; "failure" holds "fail".
    assert one(spark, "Improved improved", text.sentiment("x")) == 1.0
    assert one(spark, "improved reverted failure", text.sentiment("x")) == pytest.approx((2 - 4) / 6)
    assert one(spark, "", text.sentiment("x")) == 0.0
    assert one(spark, None, text.sentiment("x")) == 0.0


@pytest.mark.parametrize(
    "s,want", [("1700000000", 1700000000), ("0", 0), ("-1", None), ("", None), ("abc", None), ("2024-01-02T03:04:05.1234567Z", 1704164645)]
)
def test_event_time(spark, s, want):
    got = one(spark, s, F.unix_seconds(event_time("x")))
    assert got == want


def test_epoch_time_positive_only(spark):
    df = spark.createDataFrame([("5",), ("0",), ("-1",), ("x",), (None,)], "x string")
    got = [r[0] for r in df.select(F.unix_seconds(epoch_time("x", positive_only=True))).collect()]
    assert got == [5, None, None, None, None]


def test_doc_key_matches_its_definition(spark):
    import hashlib

    content = " kept blanks "
    stable = "v1|src=s|url=|title=t|content_sha1=" + hashlib.sha1(content.encode()).hexdigest()
    df = spark.createDataFrame([(" s ", "t\n", None, content)], "s string, t string, u string, c string")
    assert df.select(keys.doc_key("s", "t", "u", "c")).first()[0] == hashlib.sha1(stable.encode()).hexdigest()


def test_surrogate_keeps_null_and_blank_apart(spark):
    df = spark.createDataFrame([(None,), ("",), ("~",)], "x string")
    assert len({r[0] for r in df.select(keys.surrogate("x")).collect()}) == 3


def test_content_lines(spark):
    df = spark.createDataFrame(
        [("T", None, "w", "", "", "", 0, None, 1, 2), ("T", "edit", "w", "d", "c", "u", None, 7, None, 2)],
        "title string, type string, wiki string, domain string, comment string, diff string, ro long, rn long, bo int, bn int",
    )
    got = [r[0] for r in df.select(C.build_lines("title", "type", "wiki", "domain", "comment", "diff", "ro", "rn", "bo", "bn")).collect()]
    assert got == [
        "Title: T\nType: None\nWiki: w\nBytes: 1 -> 2",
        "Title: T\nType: edit\nWiki: w (d)\nComment: c\nDiff: u\nRevision: None -> 7",
    ]


def test_event_id_falls_through(spark):
    df = spark.createDataFrame([("m", 1), ("", 1), (None, 0), (None, None)], "m string, i long")
    expr = C.event_id("m", "i", F.lit("w"), F.lit("t"), F.lit(None).cast("long"))
    assert [r[0] for r in df.select(expr).collect()] == ["m", "1", "w:t:None", "w:t:None"]


def test_page_url(spark):
    df = spark.createDataFrame([("s", "a b", "u"), ("", "a", "u"), ("s", None, None)], "s string, t string, u string")
    assert [r[0] for r in df.select(C.page_url("s", "t", "u")).collect()] == ["s/wiki/a_b", "u", ""]
