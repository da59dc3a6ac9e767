"""Word index, sequences of signs and coded vectors against plain Python."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from freshet.functions import stems
from freshet.functions.stems import with_stems
from freshet.operators import ann, grams, joins, keyword, word_index
from freshet.operators import vector_search as V

# Words with their known stems.
STEMS = """
consistency consist, conspicuously conspicu, knightly knight, generously generous, generate generat, communication communic, hopping hop,
hoping hope, caresses caress, ponies poni, ties tie, gas gas, kiwis kiwi, agreed agre, feed feed, plastered plaster, bled bled, conflated conflat,
sized size, falling fall, hissing hiss, filing file, happy happi, sky sky, by by, say say, relational relat, rational ration, digitizer digit,
vietnamization vietnam, callousness callous, sensibility sensibl, triplicate triplic, formalize formal, electricity electr, goodness good,
allowance allow, replacement replac, adoption adopt, effective effect, probate probat, rate rate, controlling control, dying die, early earli,
news news, inning inning, exceeding exceed, skies sky, boys boy, apology apolog, nationally nation, bed bed, luxuriated luxuri, added ad, x x,
déjà déjà, abc9ing abc9ing, 東京 東京
"""


def test_stems(spark):
    want = [tuple(p.split()) for p in STEMS.replace("\n", " ").split(",")]
    got = with_stems(spark.createDataFrame([(w,) for w, _ in want], "token string")).collect()
    assert {r.token: r.stem for r in got} == dict(want)


PAGES = [
    (1, "Quick foxes", "The quick brown fox jumped over the lazy dogs. Quick foxes jump!"),
    (2, None, "brown dogs and a quick fox"),
    (3, "Fox", None),
    (4, "", ""),
    (5, "the of and", "the of and"),
    (6, "", "jumping the quick brown foxes, quickly"),
]


def _words(text):
    return re.findall(r"[^\W]+", (text or "").lower())


@pytest.fixture(scope="module")
def stem_of(spark):
    words = sorted({w for _, t, c in PAGES for w in _words(t) + _words(c)} | {"fox", "dog", "jumps", "missing"})
    rows = with_stems(spark.createDataFrame([(w,) for w in words], "token string")).collect()
    return {r.token: r.stem for r in rows}


def _places(title, text, stem_of):
    out = {}
    for i, w in enumerate(_words(title) + _words(text)):
        if w not in keyword.STOP_WORDS:
            out.setdefault(stem_of[w], []).append(i + 1)
    return out


def test_word_index_holds_every_place(spark, stem_of):
    pages = spark.createDataFrame(PAGES, "id long, title string, content string")
    got = {(r.id, r.stem): (list(r.positions), r.in_title, round(r.score, 9)) for r in word_index.word_index(pages).collect()}
    want = {}
    for key, title, text in PAGES:
        for stem, places in _places(title, text, stem_of).items():
            n = sum(p <= len(_words(title)) for p in places)
            score = sum((1.0 if i < n else 0.1) / (i + 1) ** 2 for i in range(len(places))) / 1.64493406685
            want[key, stem] = (places, n, round(score, 9))
    assert got == want


def test_ranked_search_and_phrases(spark, stem_of, tmp_path):
    pages = spark.createDataFrame(PAGES, "id long, title string, content string")
    word_index.write_index(word_index.word_index(pages), str(tmp_path))
    asked = {1: "quick brown fox", 2: "brown fox quick", 3: "jumps the quick", 4: "fox missing", 5: "the of", 6: "", 7: "FOX", 8: "quick quick", 9: None}
    queries = spark.createDataFrame(list(asked.items()), "query_id int, query string")
    got = {(r.query_id, r.id): (r.phrase, round(r.rank, 9)) for r in word_index.ranked_search(*word_index.read_index(spark, str(tmp_path)), queries, 10).collect()}
    want = {}
    for q, text in asked.items():
        terms = [(i, stem_of[w]) for i, w in enumerate(_words(text)) if w not in keyword.STOP_WORDS]
        for key, title, content in PAGES:
            places = _places(title, content, stem_of)
            if terms and all(s in places for _, s in terms):
                phrase = any(all(b + i in places[s] for i, s in terms) for b in range(-9, 40))
                n = {s: sum(p <= len(_words(title)) for p in places[s]) for _, s in terms}
                score = {s: sum((1.0 if i < n[s] else 0.1) / (i + 1) ** 2 for i in range(len(places[s]))) / 1.64493406685 for s in n}
                want[q, key] = (phrase, round(sum(score.values()) / len(score), 9))
    assert got == want
    assert any(p for p, _ in want.values()) and not all(p for p, _ in want.values())


def test_only_the_best_are_ranked(spark, tmp_path):
    pages = spark.createDataFrame([(i, None, "cat " * (1 + i % 3)) for i in range(20)], "id long, title string, content string")
    word_index.write_index(word_index.word_index(pages), str(tmp_path))
    queries = spark.createDataFrame([("a", "cats")], "query_id string, query string")
    got = word_index.ranked_search(*word_index.read_index(spark, str(tmp_path)), queries, 3).orderBy("place").collect()
    assert [(r.query_id, r.id, r.place) for r in got] == [("a", 2, 1), ("a", 5, 2), ("a", 8, 3)]


TEXTS = ["Alpha 100% beta", "alpha  beta", "x_y", "xzy", None, "", "a", "ab", "ÀÉ 東京😀z", "back\\slash", "100", "%", "_", "aXb\nc", "İstanbul"]
PATTERNS = ["alpha", "A%b", "x_y", "x\\_y", "0\\%", "%", "_", "__", "a", "AB", "東京", "京😀", "é", "nothing", "\\\\", "x%y%", "%%a%%", "b\nc", "00% b", "a__a", " ", None, "ta"]


def _hit(text, pattern, literal):
    if text is None:
        return False
    if literal:
        return pattern.lower() in text.lower()
    out = "".join(
        re.escape(t[1]) if len(t) == 2 else ".*" if t == "%" else "." if t == "_" else re.escape(t) for t in re.findall(r"(?s)\\[%_\\]|.", pattern)
    )
    return re.search(out, text, re.S | re.I) is not None


@pytest.mark.parametrize("literal", [False, True])
def test_batches_of_patterns(spark, literal):
    rows = [(f"t{i:02d}", t, None if i % 2 else TEXTS[-1 - i]) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "id string, content string, title string").repartition(3)
    queries = spark.createDataFrame(list(enumerate(PATTERNS)), "id long, query string")
    want = {
        (i, key) for i, p in enumerate(PATTERNS) for key, a, b in rows if p and p.strip() and (_hit(a, p.strip(), literal) or _hit(b, p.strip(), literal))
    }
    for index in (None, grams.gram_index(docs, ["content", "title"])):
        got = [tuple(r) for r in grams.batch_match(docs, queries, ["content", "title"], literal=literal, index=index).collect()]
        assert sorted(got) == sorted(want)
    best = keyword.batch_keyword_topk(docs, queries, 2, literal=literal).collect()
    assert {(r.query_id, r.id) for r in best} == {
        (i, k) for i, g in itertools.groupby(sorted(want), lambda x: x[0]) for k in sorted((x[1] for x in g), reverse=True)[:2]
    }


def test_entries_of_rows_are_not_stored(spark, monkeypatch):
    """A batch without an index counts sequences and meets the rarest; what it stores grows with the queries, not with the rows."""
    sizes, real = {}, grams.stored

    def stored(df, name):
        out = real(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(grams, "stored", stored)
    docs = spark.createDataFrame([(i, "the common words of all rows " * 3 + str(i)) for i in range(200)], "id long, content string")
    queries = spark.createDataFrame([(1, "common words of all rows"), (2, "rows 17")], "id long, query string")
    got = [tuple(r) for r in grams.batch_match(docs, queries, ["content"]).collect()]
    assert sorted(got) == [(1, i) for i in range(200)] + [(2, i) for i in (17, *range(170, 180))]
    assert max(sizes.values()) < 40


def test_sequences_are_numbers(spark):
    """Spark's number of a sequence is the task's, and no two sequences share one."""
    found = sorted({t[i : i + n] for t in TEXTS + ["\0a\0", "\U0010ffff\ud7ff"] if t for n in (1, 2, 3) for i in range(len(t) - n + 1)} | {""})
    rows = spark.createDataFrame([(g,) for g in found], "g string").select("g", grams._code(F.col("g")).alias("code")).collect()
    codes = {r.g: r.code for r in rows}
    assert len(set(codes.values())) == len(found) and codes[""] == 0
    assert all(codes[g] in grams._row_codes([g], [len(g)]).tolist() for g in found)
    assert grams._row_codes(["abab", None, "b"], [0, 1, 2]).tolist() == sorted(codes[g] for g in ("", "a", "b", "ab")) + [(98 << 21 | 97) + (1 << 21) + 1]


def test_no_rows_and_no_queries(spark):
    docs = spark.createDataFrame([], "id long, content string, title string")
    queries = spark.createDataFrame([(1, "a")], "id long, query string")
    assert keyword.batch_keyword_topk(docs, queries, 2).collect() == []
    assert keyword.batch_keyword_topk(docs.union(spark.createDataFrame([(1, "a", None)], docs.schema)), queries.where("false"), 2).collect() == []


def test_rows_of_a_large_key_are_dealt_out(spark):
    rng = random.Random(1)
    many = spark.createDataFrame([("hot", i) for i in range(3000)] + [(rng.choice("abc"), i) for i in range(50)], "k string, id int")
    few = spark.createDataFrame([("hot", 1), ("hot", 2), ("a", 3), ("none", 4)], "k string, x int")
    sizes = many.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    out = joins.spread_join(many, few, "k", sizes, by="id", together=100)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, many.join(few, "k").collect()))
    plain = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in plain}
    try:
        for k, v in plain.items():
            spark.conf.set(k, v)
        largest = out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert largest < 0.3 * 6000


def _clouds(n, dims=16, seed=1):
    """Vectors around a few centres, a third of them equal."""
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(12, dims))[rng.integers(0, 12, n)] + 0.4 * rng.normal(size=(n, dims))
    m[: n // 3] = m[0]
    return m


def _table(spark, m, name="v{:04d}"):
    return spark.createDataFrame([(name.format(i), [float(x) for x in v]) for i, v in enumerate(m)], "id string, embedding array<double>")


def _hits(df):
    return {(r.query_id, r.id, r["rank"]) for r in df.collect()}


def test_vectors_with_text_ids(spark, tmp_path, monkeypatch):
    m = _clouds(200)
    rows, queries = _table(spark, m), _table(spark, m[60:75] + 0.1, "q#{}")
    exact = _hits(V.batch_topk(rows, queries, 4))
    assert len(exact) == 60 and exact == _hits(V.batch_topk(rows, queries, 4, broadcast_bytes=0))
    monkeypatch.setattr(V, "BLOCK_ROWS", 20)
    ann.ivf_build(rows, str(tmp_path / "ivf"), lists=6)
    assert _hits(ann.ivf_topk(spark, str(tmp_path / "ivf"), queries, 4, nprobe=6)) == exact
    ann.pq_build(rows, str(tmp_path / "pq"), lists=6, parts=4, codes=8)
    assert _hits(ann.pq_topk(spark, str(tmp_path / "pq"), queries, 4, nprobe=6)) == exact


def test_recall_of_codes_with_fewer_lists(spark, tmp_path):
    m = _clouds(900, 32, seed=4)
    rows = _table(spark, m)
    queries = rows.where("id >= 'v0300' AND id LIKE '%0'")
    ann.pq_build(rows, str(tmp_path), lists=8, parts=8, codes=16)
    exact = {(q, i) for q, i, _ in _hits(V.batch_topk(rows, queries, 5))}
    found = {(q, i) for q, i, _ in _hits(ann.pq_topk(spark, str(tmp_path), queries, 5, nprobe=5, rerank=60))}
    assert len(found & exact) / len(exact) >= 0.9
    # Without the second look the codes alone order the rows worse, so the exact distances do decide.
    poor = {(q, i) for q, i, _ in _hits(ann.pq_topk(spark, str(tmp_path), queries, 5, nprobe=5, rerank=5))}
    assert len(poor & exact) < len(found & exact)


def test_codes_come_from_all_rows_and_bound_the_miss(spark, tmp_path):
    m = _clouds(300, 16, seed=6)
    rows = _table(spark, m)
    books = ann.codebooks(rows, parts=4, codes=8, rounds=6)
    unit = (m / np.linalg.norm(m, axis=1, keepdims=True)).reshape(300, 4, 4)
    for s in range(4):
        near = ((unit[:, s, None] - books[s][None]) ** 2).sum(2).argmin(1)
        again = np.stack([unit[near == c, s].mean(0) if (near == c).any() else books[s][c] for c in range(8)])
        assert np.abs(again - books[s]).max() < 0.2
    ann.pq_build(rows, str(tmp_path), lists=4, parts=4, codes=8)
    held = spark.read.parquet(f"{tmp_path}/codes").collect()
    assert len(held) == 300 and {len(r.codes) for r in held} == {4}
    with pytest.raises(ValueError, match="equal parts"):
        ann.codebooks(rows, parts=5, codes=8)


def test_index_without_usable_queries(spark, tmp_path):
    rows = _table(spark, _clouds(60))
    ann.ivf_build(rows, str(tmp_path), lists=3)
    none = spark.createDataFrame([("q", None)], rows.schema)
    assert ann.ivf_topk(spark, str(tmp_path), none, 3, 3).collect() == []


def test_patterns_keep_signs_without_a_single_capital(spark, tmp_path):
    from freshet.plans.lookup import _patterns

    rows = [(1, "Erßie entech und noch mehr, hzu chte.")]
    spark.createDataFrame(rows, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r["id"]: r["query"] for r in _patterns(spark, str(tmp_path)).collect()}
    assert got[6] == "ERßIE ENTECH%hzu chte."


def test_places_are_gathered_by_one_aggregation(spark):
    from freshet.operators.word_index import word_index

    docs = spark.createDataFrame([(1, "t", "Runs run, running"), (2, None, "a run")], "id bigint, title string, content string")
    index = word_index(docs)
    got = {(r["stem"], r["id"]): (r["positions"], r["in_title"]) for r in index.collect()}
    assert got == {("t", 1): ([1], 1), ("run", 1): ([2, 3, 4], 0), ("run", 2): ([2], 0)}
    plan = index._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate ") == 1


@pytest.mark.parametrize("sent", [1 << 20, 0])
def test_patterns_meet_the_rows_in_their_tasks(spark, monkeypatch, sent):
    """A batch of bounded size needs no entries of the rows; sent or joined, a match is found by its parts, not by a pattern over the whole text."""
    if sent:
        monkeypatch.setattr(grams, "spread_join", lambda *a, **b: pytest.fail("entries of the rows are joined"))
    monkeypatch.setattr(grams, "SENT_SIGNS", sent)
    monkeypatch.setattr(grams, "LOOK_SIGNS", 40)
    rng = random.Random(7)
    texts = ["".join(rng.choice("ab😀%_\\\n") for _ in range(rng.randrange(14))) for _ in range(120)] + [None]
    asked = sorted({"".join(rng.choice("ab😀%_\\") for _ in range(rng.randrange(1, 6))) for _ in range(150)})
    rows = [(i, t, texts[-1 - i] if i % 3 == 0 else None) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, (None, "ab", "ab")], "id long, content string, title string").repartition(2)
    queries = spark.createDataFrame([*enumerate(asked), (None, "a")], "id long, query string")
    out = grams.batch_match(docs, queries, ["content", "title"])
    assert not re.search(r"\bLIKE\b", out._jdf.queryExecution().optimizedPlan().toString())

    def expression(pattern):
        # Between wildcards, with the closing one; a backslash that escapes nothing is dropped.
        signs = re.findall(r"(?s)\\[%_\\]|\\\Z|.", pattern)
        text = "".join(s for i, s in enumerate(signs, 1) if s != "\\" or i == len(signs)) + "%"
        return "".join(".*" if s == "%" else "." if s == "_" else re.escape(s[-1]) for s in re.findall(r"(?s)\\[%_\\]|.", text))

    want = {(q, i) for q, p in enumerate(asked) for i, *both in rows if any(t is not None and re.fullmatch(".*" + expression(p), t, re.S) for t in both)}
    assert len(want) > 1000 and sorted(map(tuple, out.collect())) == sorted(want)


def test_only_gathered_places_are_shuffled(spark, monkeypatch):
    """Words are gathered by stem in their tasks, so that few rows are stored and shuffled; rows of one id and of none count together."""
    sizes, real = {}, word_index.stored

    def stored(df, name):
        out = real(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(word_index, "stored", stored)
    monkeypatch.setattr(word_index, "FLUSH_WORDS", 3000)
    monkeypatch.setattr(word_index, "KNOWN_WORDS", 4)
    monkeypatch.setattr(word_index, "ENTRY_WORDS", 500)
    monkeypatch.setattr(word_index, "PART_SIGNS", 20_000)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    rows = [(f"k{i // 2 if i % 50 == 1 else i}", "Run of runs" if i % 3 else None, "the runs are running 東京 run " * (1 + i % 4)) for i in range(900)] + [(None, "cat", "a cat"), (None, None, "cats")]
    try:
        got = word_index.word_index(spark.createDataFrame(rows, "id string, title string, content string").coalesce(3)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    stem = {"run": "run", "runs": "run", "running": "run", "東京": "東京", "cat": "cat", "cats": "cat"}
    places, in_title = {}, {}
    for key, title, text in rows:
        words = _words(title) + _words(text)
        for i, w in enumerate(words, 1):
            if w in stem:
                places.setdefault((stem[w], key), []).append(i)
                in_title[stem[w], key] = in_title.get((stem[w], key), 0) + (i <= len(_words(title)))
    assert {(r.stem, r.id): (list(r.positions), r.in_title) for r in got} == {k: (sorted(v), in_title[k]) for k, v in places.items()}
    assert len(got) == len(places) > 1700 and sizes["gathered"] < 200


def test_stems_of_tasks_are_those_of_the_expressions(spark):
    rng = random.Random(3)
    ends = ["", "ing", "ed", "edly", "ingly", "eed", "eedly", "s", "ies", "ied", "sses", "us", "logi", "ogi", "li", "ion", "tion", "e", "ll", "y", "ative"]
    ends += [*stems.STEP_2, *stems.STEP_3, *stems.STEP_4]
    begins = ["gener", "commun", "arsen", "hop", "fil", "a", "e", "y", "ay", "yy", "b", "tt", "con", "str", "ab", "iz", "bl", "at", "u", "x", "oy", "é"]
    words = {"".join(rng.choice(begins) for _ in range(rng.randrange(4))) + rng.choice(ends) + rng.choice(ends) for _ in range(6000)}
    words |= {*stems.IRREGULAR, *stems.IRREGULAR.values(), *stems.INVARIANT, *stems.INVARIANT_AFTER_PLURAL}
    rows = with_stems(spark.createDataFrame([(w,) for w in sorted(words) if w], "token string")).collect()
    assert {r.token: stems.stem_of(r.token) for r in rows} == {r.token: r.stem for r in rows}


@pytest.mark.parametrize("sent", [1 << 20, 0])
def test_repeated_keys_of_rows_and_queries(spark, monkeypatch, sent):
    """Sent or joined: copies of a query are one, an id of which two rows hold a query is left out."""
    monkeypatch.setattr(grams, "SENT_SIGNS", sent)
    docs = spark.createDataFrame([(1, "one red fox"), (2, "red hen"), (2, "red hen"), (3, "a red cow"), (3, "zzz")], "id long, content string")
    queries = spark.createDataFrame([(1, "red"), (1, "red"), (2, "fox"), (3, "hen")], "id long, query string")
    got = [tuple(r) for r in grams.batch_match(docs, queries, ["content"]).collect()]
    assert sorted(got) == [(1, 1), (1, 3), (2, 1)]
