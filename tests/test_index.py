import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from freshet.functions import vectors as VF
from freshet.operators import answer_cache, ann, context, gates, grams, keyword
from freshet.operators import embedding as E
from freshet.operators import vector_search as V
from freshet.operators.chunking import chunk, windows


def _windows(text, size, overlap):
    """An independent statement of the window rule."""
    body = text.strip()
    if not body:
        return []
    if size <= 0:
        return [body]
    overlap = max(0, min(overlap, size - 1))
    out, at = [], 0
    while True:
        piece = body[at : at + size].strip()
        out += [piece] if piece else []
        if at + size >= len(body):
            return out
        at += size - overlap


TEXTS = [
    "", "   \n", "x" * 1200, "x" * 1201, "ab " * 900, "a" * 1300 + " " * 2500 + "b" * 40,
    "\U0001f600é" * 900, "line\nline\r\n" * 300, "short",
]


@pytest.mark.parametrize("size,overlap", [(1200, 150), (1200, 200), (10, 9), (10, 30), (7, 0), (0, 5), (5, -2)])
def test_windows(spark, size, overlap):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, t string")
    got = {r["id"]: r["w"] for r in df.select("id", windows("t", size, overlap).alias("w")).collect()}
    assert got == {i: _windows(t, size, overlap) for i, t in enumerate(TEXTS)}


def test_chunk_ids(spark):
    df = spark.createDataFrame([(5, "abcdefgh"), (6, " ")], "doc_id int, text string")
    rows = [tuple(r) for r in chunk(df, max_chars=4, overlap=1).select("chunk_id", "chunk_text").collect()]
    assert rows == [("5#0", "abcd"), ("5#1", "defg"), ("5#2", "gh")]


def test_custom_model_sees_each_distinct_text_once(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["a", "bb", "a", " ", None, "a"])], "id int, text string")
    out = {r["id"]: r["embedding"] for r in E.embed(df, model=lambda texts: [[float(len(t)), float(len(texts))] for t in texts]).collect()}
    assert out[0] == out[2] == out[5] and out[0][0] == 1.0 and out[1][0] == 2.0 and out[3] is None and out[4] is None
    assert E.distinct_texts(df).count() == 2


def test_backfill_leaves_stored_vectors(spark):
    df = spark.createDataFrame([(1, "one two", [1.0, 0.0]), (2, "one two", None), (3, None, None)], "id int, text string, embedding array<double>")
    got = {r["id"]: r["embedding"] for r in E.backfill(df, dims=2).collect()}
    assert got[1] == [1.0, 0.0] and len(got[2]) == 2 and got[3] is None


def test_hash_vectors_have_length_one(spark):
    df = spark.createDataFrame([("a", "one two three"), ("b", "..."), ("c", "")], "text_hash string, text string")
    got = {r["text_hash"]: r["embedding"] for r in E.hash_embed(df, dims=16).collect()}
    assert math.isclose(sum(x * x for x in got["a"]), 1.0) and set(got["b"]) == set(got["c"]) == {0.0}


def test_words_are_summed_in_their_task(spark, monkeypatch):
    """One row of sums a text is shuffled, whatever its words; rows of one key count together."""
    monkeypatch.setattr(E, "SUM_ROWS", 2)
    texts = [(1, "One two  one_3 ÉTÉ 東京 " * 50), (2, None), (1, "two"), (None, "x"), (3, "..."), (4, "a " * 9000), (5, "x y")]
    df = spark.createDataFrame(texts, "id long, text string").coalesce(1)
    out = E.hash_embed(df, "id", dims=8)
    assert "Generate" not in out._jdf.queryExecution().toString()
    want = {}
    for key, text in texts:
        sums = want.setdefault(key, [0] * 8)
        for w in re.findall(r"\w+", (text or "").lower()):
            h = int(hashlib.sha1(w.encode()).hexdigest()[:8], 16)
            sums[h % 8] += 1 if h // 8 % 2 == 0 else -1
    length = {k: math.sqrt(sum(x * x for x in s)) for k, s in want.items()}
    assert {r["id"]: r["embedding"] for r in out.collect()} == {k: [x / length[k] if length[k] else 0.0 for x in s] for k, s in want.items()}


def test_copies_are_counted_once(spark, monkeypatch):
    """Which texts are frequent is known from the distinct texts; the rows are not counted again."""
    monkeypatch.setattr("freshet.operators.joins.hot_keys", lambda *a: pytest.fail("the rows are counted again"))
    df = spark.createDataFrame([(i, "copy" if i % 2 else f"text {i}") for i in range(40)] + [(40, None), (41, " ")], "id int, text string")
    got = {r["id"]: r["embedding"] for r in E.embed(df, dims=4).collect()}
    alone = {r["id"]: r["embedding"] for r in E.embed_by_id(df.where("trim(text) <> ''"), "id", dims=4).collect()}
    assert got == alone | {40: None, 41: None}


def test_width_check(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0]), (3, None)], "id int, embedding array<double>")
    assert [r["width_ok"] for r in E.check_width(df, 2).orderBy("id").collect()] == [False, True, False]
    with pytest.raises(Exception, match="width is not 2"):
        E.check_width(df, 2, strict=True).collect()


def test_vector_text(spark):
    df = spark.createDataFrame([([0.5, -1.0],), ([],), (None,)], "v array<float>")
    assert [r[0] for r in df.select(VF.to_literal("v")).collect()] == ["[0.50000000,-1.00000000]", None, None]
    back = spark.createDataFrame([("[0.5, 1]",), ("[]",), (" ",)], "v string").select(VF.from_literal("v")).collect()
    assert [r[0] for r in back] == [[0.5, 1.0], [], []]


def _data(spark, n, dims=8, seed=1):
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(n, dims))
    m[: n // 3] = m[0]  # a third of all rows are copies
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "id long, embedding array<double>"), m


def _brute(rows, queries, k, metric, limit=None, skip_same=False):
    out = set()
    for q, qv in enumerate(queries):
        if metric == "cosine":
            d = 1 - rows @ qv / (np.linalg.norm(rows, axis=1) * np.linalg.norm(qv))
        else:
            d = np.linalg.norm(rows - qv, axis=1)
        d = np.round(d, 9)
        order = [i for i in np.lexsort((np.arange(len(rows)), d)) if (limit is None or d[i] <= limit) and not (skip_same and i == q)]
        out |= {(q, int(i), rank) for rank, i in enumerate(order[:k], 1)}
    return out


@pytest.mark.parametrize("metric", ["cosine", "l2"])
@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_batch_topk_is_exact_both_ways(spark, monkeypatch, metric, broadcast_bytes):
    monkeypatch.setattr(V, "BLOCK_ROWS", 40)
    rows, m = _data(spark, 150)
    queries, q = _data(spark, 60, seed=2)
    hits = V.batch_topk(rows, queries, 5, metric, broadcast_bytes=broadcast_bytes)
    assert {(r["query_id"], r["id"], r["rank"]) for r in hits.collect()} == _brute(m, q, 5, metric)


def test_self_match_leaves_itself_out(spark, monkeypatch):
    monkeypatch.setattr(V, "BLOCK_ROWS", 40)
    rows, m = _data(spark, 120)
    hits = V.best_match(rows, rows, 0.7, skip_same=True, broadcast_bytes=0)
    want = {(q, i) for q, i, _ in _brute(m, m, 1, "cosine", 0.3, True)}
    assert {(r["query_id"], r["match_id"]) for r in hits.collect()} == want


def test_similar_pairs_are_all_there(spark, monkeypatch):
    monkeypatch.setattr(V, "PAIR_ROWS", 20)
    rng = np.random.default_rng(3)
    m = rng.normal(size=(90, 8))
    m[:30] = m[0]  # copies
    m[30:45] = m[30] + 0.05 * rng.normal(size=(15, 8))  # a group in which every two are close
    held = [(i, [float(x) for x in v]) for i, v in enumerate(m)]
    bad = [(90, None), (91, [0.0] * 8), (92, [float("nan")] * 8), (93, [None] * 8), (94, [0.0] * 8)]
    rows = spark.createDataFrame(held + bad, "id long, embedding array<double>")
    found = V.similar_pairs(rows, 0.7).collect()
    classes = {}
    for r in V.equal_classes(rows).collect():
        classes.setdefault(r["class_id"], []).append(r["id"])
    assert len(classes[0]) == 30 and sum(map(len, classes.values())) == 90
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    want = {(a, b) for a in range(90) for b in range(a + 1, 90) if 1 - round(1 - unit[a] @ unit[b], 9) >= 0.7 - 1e-12}
    got = [(min(a, b), max(a, b)) for r in found for a in classes[r["query_id"]] for b in classes[r["match_id"]]]
    got += [(a, b) for ids in classes.values() for a in ids for b in ids if a < b]
    assert len(got) == len(set(got)) and set(got) == want
    assert all(r["query_id"] < r["match_id"] for r in found)
    assert V.similar_pairs(rows.where("id > 89"), 0.7).count() == 0
    # The best match alone is less than that.
    assert V.best_match(rows.where("id < 90"), rows.where("id < 90"), 0.7, skip_same=True).count() < len(want)


def test_single_query_edges(spark):
    rows = spark.createDataFrame([(3, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (4, [0.0, 0.0])], "id int, embedding array<double>")
    got = [(r["id"], r["distance"]) for r in V.vector_topk(rows, [2.0, 0.0], 10).collect()]
    assert got == [(1, 0.0), (3, 0.0), (4, 1.0)]
    assert V.any_usable(rows) and not V.any_usable(rows.where("id = 2"))
    assert [V.clamp_k(k) for k in (None, 0, -4, 7, 99)] == [3, 3, 1, 7, 20]


def test_best_rows_are_exact_where_single_precision_is_not(monkeypatch):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 16))
    rows = np.concatenate([base + rng.normal(size=base.shape) * 1e-6 for _ in range(10)])
    ids = rng.permutation(len(rows))
    monkeypatch.setattr(V, "CELL_VALUES", 40 * 32)
    for limit, skip in ((None, False), (0.5, True)):
        best = V._Best(np.arange(40), 3, limit, skip)
        best.meet(base, rows, ids, "cosine")
        dist = np.round(V._distances(base, rows, "cosine"), 9)
        want = set()
        for q in range(40):
            near = sorted((d, int(i)) for d, i in zip(dist[q], ids) if (limit is None or d <= limit) and not (skip and i == q))
            want |= {(q, i, d) for d, i in near[:3]}
        assert {(int(a), int(b), float(c)) for a, b, c in best.frame().itertuples(index=False)} == want


def test_few_of_all_pairs_are_sorted(monkeypatch):
    m = np.random.default_rng(6).normal(size=(1500, 16))
    seen, sort = [], np.lexsort
    monkeypatch.setattr(V.np, "lexsort", lambda keys, **kw: (seen.append(np.size(keys[0])), sort(keys, **kw))[1])
    monkeypatch.setattr(V, "CELL_VALUES", 1500 * 50)
    best = V._Best(np.arange(len(m)), 1, 0.65, True)
    best.meet(m, m, np.arange(len(m)), "cosine")
    assert sum(seen) < 0.1 * len(m) ** 2


def test_decimals_are_those_of_printf(spark):
    rng = np.random.default_rng(3)
    values = [-0.103515625, 0.0703125, -0.0703125, 2.5e-8, 1e-10, -1e-10, -0.0, 0.0, *(float(x) for x in rng.integers(-(2**14), 2**14, 500) / 2**13)]
    values += [float(x) for x in np.round(rng.uniform(-1, 1, 500), 9)]
    df = spark.createDataFrame([(values,)], "v array<double>")
    for digits in (6, 8):
        got = df.select(F.transform("v", lambda x: VF.fixed(x, digits))).first()[0]
        assert got == [f"{x:.{digits}f}" for x in values]
    assert df.select(VF.to_literal("v")).first()[0] == "[" + ",".join(f"{x:.8f}" for x in values) + "]"
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),)], "x double")
    assert [r[0] for r in odd.select(VF.fixed("x", 8)).collect()] == ["nan", "inf", "-inf"]


@pytest.mark.parametrize("name", ["backfill_merge", "chunk_upsert", "rag_chunk_upsert"])
def test_queries_show_vectors_as_their_sql_does(spark, tmp_path, name):
    from __spark_entry__ import oracle_sql, queries
    from compare import difference, duck

    # Parts that lie halfway between two decimals, below zero and above.
    docs = [(1, "one", "en", "web", 3), (2, "two", "de", "web", 3), (3, "three", None, "news", 5)]
    vectors = [(1, [-0.103515625, 0.0703125, 0.001953125]), (2, [0.103515625, -0.0703125, -0.005859375])]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").toPandas().to_parquet(tmp_path / "documents.parquet")
    spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>").toPandas().to_parquet(tmp_path / "embeddings.parquet")
    for table in "region nation customer supplier part orders lineitem events pages benchmark labels conversations".split():
        (tmp_path / f"{table}.parquet").symlink_to(f"/root/testdata/sf0.001/{table}.parquet")
    assert difference(queries()[name](spark, str(tmp_path)), duck(str(tmp_path)), oracle_sql()[name]) is None


def test_mixed_widths_fail_loudly(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0, 0.0, 0.0])], "id long, embedding array<double>").coalesce(1)
    with pytest.raises(Exception, match="different width"):
        V.batch_topk(rows, rows.where("id = 1"), 2).collect()


def test_empty_query_batch(spark):
    rows, _ = _data(spark, 10)
    assert V.batch_topk(rows, rows.where("id < 0"), 3).count() == 0


def test_ivf_recall(spark, small, tmp_path):
    vectors = spark.read.parquet(f"{small}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding")
    queries = vectors.where("id % 10 = 0")
    exact = {(r[0], r[1]) for r in V.batch_topk(vectors, queries, 5).select("query_id", "id").collect()}
    ann.ivf_build(vectors, str(tmp_path), lists=10)
    found = {}
    for nprobe in (4, 10):
        hits = ann.ivf_topk(spark, str(tmp_path), queries, 5, nprobe).select("query_id", "id").collect()
        found[nprobe] = len(exact & {(r[0], r[1]) for r in hits}) / len(exact)
    assert found[10] == 1.0 and found[4] >= 0.6
    # Every row is in exactly one list.
    assert spark.read.parquet(f"{tmp_path}/rows").select("id").distinct().count() == vectors.count()


DOCS = [(1, "Alpha 100% beta"), (2, "alpha beta"), (3, "x_y"), (4, "xzy"), (5, None), (6, "ALPHA")]


def _docs(spark):
    return spark.createDataFrame(DOCS, "id long, content string").withColumn("title", F.lit(None).cast("string"))


@pytest.mark.parametrize("q,literal,want", [("alpha", False, [6, 2, 1]), ("x_y", False, [4, 3]), ("x_y", True, [3]), ("0%", True, [1]), ("nothing", False, [])])
def test_keyword(spark, q, literal, want):
    docs = _docs(spark)
    assert [r["id"] for r in keyword.keyword_topk(docs, q, 5, literal=literal).collect()] == want
    queries = spark.createDataFrame([(1, q), (2, " "), (3, "BETA")], "id long, query string")
    for index in (None, grams.gram_index(docs, ["content", "title"])):
        hits = keyword.batch_keyword_topk(docs, queries, 5, literal=literal, index=index).orderBy("query_id", "rank").collect()
        assert [r["id"] for r in hits if r["query_id"] == 1] == want
        assert [r["id"] for r in hits if r["query_id"] == 3] == [2, 1]


def test_fts_needs_every_word(spark):
    docs = spark.createDataFrame([(1, "red fox and red hen"), (2, "red hen"), (3, None)], "doc_id int, text string")
    queries = spark.createDataFrame([(1, "the RED fox"), (2, "hen"), (3, "cow hen")], "query_id int, query string")
    got = {tuple(r) for r in keyword.fts_search(keyword.token_index(docs), queries).collect()}
    assert got == {(1, 1, 3), (2, 1, 1), (2, 2, 1)}


def test_gates_at_their_bounds(spark):
    def unit(c):
        return [c, math.sqrt(1 - c * c)]

    chunks = spark.createDataFrame(
        [(1, "t", "cat one", unit(0.75)), (2, "t", "cat two", unit(0.65)), (3, "t", "dog", unit(0.1))],
        "id long, title string, content string, embedding array<double>",
    )
    queries = spark.createDataFrame(
        [(1, "cat", [1.0, 0.0]), (2, "cat", [0.0, -1.0]), (3, "cow", [0.0, -1.0]), (4, " ", [1.0, 0.0])],
        "id long, query string, embedding array<double>",
    )
    got = {(r["query_id"], r["mode"], r["id"]) for r in gates.gated_search(chunks, queries, 3).collect()}
    assert got == {(1, "vector_strict", 1), (2, "text_fallback", 2), (2, "text_fallback", 1), (3, "no_hit", None)}
    relaxed = gates.gated_search(chunks.where("id > 1"), queries.where("id = 1"), 3).collect()
    assert [(r["mode"], r["id"]) for r in relaxed] == [("vector_relaxed", 2)]
    words = gates.gated_search(chunks, queries.where("id IN (1, 3)"), 3, vectors=False).collect()
    assert {(r["query_id"], r["mode"]) for r in words} == {(1, "text"), (3, "no_hit")}


def test_context_and_budget(spark):
    hits = spark.createDataFrame(
        [(1, 1, 10, "s", None, None, "a" * 1500, 0.1), (1, 2, 11, "s", "T", "u", "b" * 600, 0.2)],
        "query_id long, rank int, id long, source string, title string, url string, content string, distance double",
    )
    text = context.source_blocks(hits).first()["sources"]
    assert text.startswith("[1] title: (no title)\nurl: \ncontent: aaa") and "\n\n[2] title: T\nurl: u\ncontent: bbb" in text
    # A budget below the allowed range counts as 2000 characters.
    assert [r["rank"] for r in context.within_budget(hits, budget=5).collect()] == [1]
    asked = spark.createDataFrame([(1,), (2,)], "query_id long")
    got = {r["query_id"]: r["context"] for r in context.context_text(asked, hits).collect()}
    assert got[1] == "a" * 1500 + "\n\n" + "b" * 600 and got[2] == context.NO_CONTEXT


def test_cache_touch_and_semantic(spark):
    cache = spark.createDataFrame([("h", 2, 10), ("g", 0, 5)], "query_hash string, use_count long, last_used_at long")
    hits = spark.createDataFrame([("h", 20), ("h", 7), ("z", 99)], "query_hash string, used_at long")
    assert {tuple(r) for r in answer_cache.touch(cache, hits).collect()} == {("h", 4, 20), ("g", 0, 5)}
    stored = spark.createDataFrame([(7, [1.0, 0.0]), (8, [0.0, 1.0])], "id long, embedding array<double>")
    asked = spark.createDataFrame([(1, [0.99, 0.1]), (2, [0.7, 0.7])], "id long, embedding array<double>")
    got = {r["query_id"]: r["match_id"] for r in answer_cache.semantic_lookup(asked, stored).collect()}
    assert got == {1: 7, 2: None}


def test_ivf_topk_meets_its_lists_in_any_number_of_partitions(spark, tmp_path):
    rng = np.random.default_rng(11)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(400, 8)))]
    chunks = spark.createDataFrame(rows, "id bigint, embedding array<double>")
    queries = chunks.where("id < 5")
    ann.ivf_build(chunks, str(tmp_path), lists=6)
    # Small shuffles are otherwise read as one partition, where every cell meets.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ann.ivf_topk(spark, str(tmp_path), queries, 7, nprobe=6).select("query_id", "id", "rank", "distance").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = V.batch_topk(chunks, queries, 7).select("query_id", "id", "rank", "distance").collect()
    assert sorted(got) == sorted(want)
