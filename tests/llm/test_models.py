"""Language and quality models on held-out rows; pieces against the library; top-k and leaks against brute force."""

import itertools
import re

import numpy as np
import pytest
import sentencepiece
from compare import difference
from pyspark.sql import functions as F

from freshet.llm import language, leaks, pieces, topk, weak
from freshet.llm.queries import oracle_sql, queries


def test_language_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    out = queries()["op5_language"](spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    held = out.join(docs, "doc_id").where("held_out AND lang_pred <> 'und'").collect()
    assert len(held) > 100 and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in held) and out.count() == 1000


def test_posteriors_are_those_of_plain_forward_backward():
    rng = np.random.default_rng(1)
    labels = ["a", "b", "c"]
    model = language.Model(labels, rng.normal(size=(language.BUCKETS, 3)) / 5, rng.normal(size=(3, 3)), rng.normal(size=3), {})
    documents = [[f"w{rng.integers(40)}" for _ in range(n)] for n in (1, 2, 31, 32, 33, 64, 200)]
    tagger = language.Tagger(model)
    for words, p in zip(documents, tagger.posteriors(documents)):
        e = tagger.look_up(words)[None].astype(float)
        want, _ = language.forward_backward(e, np.exp(model.transitions), np.exp(model.first))
        assert np.abs(want[0] - p).max() < 1e-4
    # And these are those of summing over all labellings.
    words = documents[1] + ["w1", "w2"]
    e, a, f = tagger.look_up(words).astype(float), np.exp(model.transitions), np.exp(model.first)
    total = np.zeros((len(words), 3))
    for path in itertools.product(range(3), repeat=len(words)):
        weight = f[path[0]] * np.prod([e[i, c] for i, c in enumerate(path)]) * np.prod([a[x, y] for x, y in itertools.pairwise(path)])
        for i, c in enumerate(path):
            total[i, c] += weight
    assert np.abs(total / total.sum(1, keepdims=True) - tagger.posteriors([words])[0]).max() < 1e-4


def test_language_edges(spark, docs):
    labelled = spark.createDataFrame([(i, t, g) for i in range(40) for t, g in (("the cat and the dog", "en"), ("le chat et le chien", "fr"), (None, "fr"), ("x", None))], "doc_id long, text string, lang string")
    model = language.learn(labelled)
    rows = [(1, "the dog and the cat le chien et le chat"), (2, None), (3, ""), (4, "123 !"), (None, "et le chat"), (1, "the dog and the cat le chien et le chat")]
    out = language.labelled(docs(rows), model).collect()
    assert len(out) == 6
    got = {r["doc_id"]: r for r in out}
    assert [s["lang"] for s in got[1]["spans"]] == ["en", "fr"] and got[None]["lang_pred"] == "fr"
    assert all(got[k]["lang_pred"] == "und" and got[k]["score"] == 0 and got[k]["spans"] == [] for k in (2, 3, 4))
    assert language.learn(labelled.where("false")) is None
    assert {r["lang_pred"] for r in language.labelled(docs(rows), None).collect()} == {"und"}


def test_quality_on_labelled_rows(spark):
    folder = "/root/testdata/sf0.01"
    out = queries()["op8_quality"](spark, folder)
    rows = out.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    good = [r for r in rows if r["quality"] == 1]
    bad = [r for r in rows if r["quality"] == 0]
    assert sum(r["good"] for r in good) >= 0.97 * len(good) and sum(not r["good"] for r in bad) >= 0.9 * len(bad)
    assert not any(r["abusive"] for r in rows if r["toxic"] == 0)


def test_quality_edges(docs, edges):
    out = weak.quality(docs(edges)).collect()
    assert len(out) == len(edges)
    assert all(r["score"] == 0 and not r["keep"] for r in out if r["doc_id"] in (3, 4, 5))
    assert weak.quality(docs([])).count() == 0


def test_labeller_accuracies_are_found():
    rng = np.random.default_rng(2)
    truth = rng.random(4000) < 0.8
    right = (0.995, 0.98, 0.96)
    votes = np.stack([np.where(rng.random(4000) < 0.3, 0, np.where((rng.random(4000) < a) == truth, 1, -1)) for a in right], 1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    prior, table = weak.fit_labellers(list(zip(map(tuple, patterns), counts)))
    assert abs(prior - 0.8) < 0.1
    assert table[1, 0, 2] > table[1, 2, 2] and table[0, 0, 0] > table[0, 2, 0]


MODEL = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def test_pieces_are_those_of_the_library(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    out = pieces.encoded(docs).collect()
    assert len(out) == len(text)
    for r in out:
        assert r["ids"] == MODEL.encode(text[r["doc_id"]]) and r["round_trip"] and r["decoded"] == text[r["doc_id"]]


def test_pieces_of_odd_texts(docs, edges):
    odd = ["  two  blanks ", "tab\tline\n\r\x00", "▁mark", "😀 漢字 ſ", "a" * 5000, "<s> <0x41> </s>", "x" * 19 + "y" * 19, "̈ä"]
    rows = edges + [(100 + i, t) for i, t in enumerate(odd)]
    back = {r["doc_id"]: r for r in pieces.encoded(docs(rows)).collect()}
    for key, text in rows:
        if key in (2, None):
            continue
        assert back[key]["ids"] == (None if text is None else MODEL.encode(text))
        assert back[key]["round_trip"] is (None if text is None else True)
    again = pieces.decoded(docs(rows).sparkSession.createDataFrame([([*MODEL.encode("Hello  wörld 😀")],), (None,), ([],)], "ids array<int>"), docs(rows).sparkSession)
    assert [r["decoded"] for r in again.collect()] == ["Hello  wörld 😀", None, ""]
    assert pieces.encoded(docs([])).count() == 0


def test_unigram_path_has_the_least_weight():
    vocabulary = {"kind": "unigram", "pieces": [None, "▁a", "b", "ab", "▁", "▁ab", "a"], "scores": [0, -2.0, -1.0, -1.5, -1.0, -4.0, -1.2], "bytes": {}, "unknown": 0}
    machine = pieces.Transducer(vocabulary)
    assert machine.shortest("▁abb") == ["▁", "ab", "b"]


def test_topk_against_sql(spark, small, duck_small):
    assert difference(queries()["op4_topk"](spark, small), duck_small, oracle_sql()["op4_topk"]) is None


def test_topk_edges(spark):
    rows = [(i, [float(i % 3), 1.0]) for i in range(40)] + [(40, None), (41, [None, 1.0]), (42, [float("nan"), 1.0]), (43, [float("inf"), 1.0]), (44, [1.0]), (None, [9.0, 9.0]), (10, [1.0, 1.0]), (45, []), (46, [1e30, -1e30])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, block int, score string")
    got = {}
    for r in topk.top_k(df, F.col("vec_id") % 10 == 0, 3).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    held = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    for q, e in {i: v for i, v in reversed(held) if i % 10 == 0}.items():
        scores = [(max(-topk.LIMIT, min(topk.LIMIT, sum(a * b for a, b in zip(e, v)))), i) for i, v in held if i != q and len(v) == len(e)]
        want = sorted(scores, key=lambda x: (-x[0], x[1]))[:3]
        if q != 10:  # two rows of one id with different vectors: either may ask
            assert sorted(got[q]) == [(n + 1, i, s) for n, (s, i) in enumerate(want)]
    assert 40 not in got
    assert topk.top_k(df.where("false"), F.lit(True), 3).count() == 0


def overlaps(docs_, items):
    words = lambda t: re.findall(r"\w+", (t or "").lower())
    for d, text in docs_:
        x = words(text)
        for i, item in items:
            y = words(item)
            best = 0
            for diagonal in range(-len(y) + 1, len(x)):
                same = [x[diagonal + j] == y[j] for j in range(len(y)) if 0 <= diagonal + j < len(x)]
                for a in range(len(same)):
                    for b in range(a + 1, len(same) + 1):
                        part = same[a:b]
                        if part[0] and part[-1] and part.count(False) <= 0.2 * len(part):
                            best = max(best, b - a)
            if best >= 13 or (5 <= len(y) < 13 and best == len(y) and f" {' '.join(y)} " in f" {' '.join(x)} "):
                yield d, i, best


def test_leaks(spark, docs):
    w = [f"word{i}" for i in range(60)]
    changed = [x if i % 6 else "other" for i, x in enumerate(w[:30])]
    rows = [(1, " ".join(w[5:25])), (2, " ".join(["a", "b", *changed])), (3, " ".join(w[:12])), (4, None), (5, ""), (6, "short item of six words here"), (7, "short item of six words"), (1, " ".join(w[5:25])), (8, "X " + " ".join(w).upper())]
    items = [(1, " ".join(w[:40])), (2, "Short item of six words here"), (3, None), (4, ""), (5, "tiny"), (6, " ".join(w[20:]))]
    tests = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["n_words"]) for r in leaks.leaks(docs(rows), tests).collect()}
    assert got == set(overlaps(rows, items))
    assert leaks.leaks(docs([]), tests).count() == 0 and leaks.leaks(docs(rows), tests.where("false")).count() == 0


def test_masks_meet_any_two_replacements():
    places = range(leaks.LEAST)
    for gone in itertools.combinations(places, 2):
        assert any(
            all(m[i] == "0" or at + i not in gone for i in range(len(m))) for m in leaks.MASKS for at in range(leaks.LEAST - len(m) + 1)
        ), gone


def seedless(masks, n, k):
    """The first choice of replaced places that leaves no seed."""
    held = [sum(1 << (at + i) for i, bit in enumerate(m) if bit == "1") for m in masks for at in range(n - len(m) + 1)]
    return next((gone for gone in itertools.combinations(range(n), k) if not any(h & sum(1 << g for g in gone) == 0 for h in held)), None)


@pytest.mark.parametrize("n", range(13, 26))
def test_masks_meet_every_allowed_replacement(n):
    assert seedless(leaks.MASKS, n, n // 5) is None


@pytest.mark.parametrize("n", range(5, 13))
def test_short_masks_meet_every_allowed_replacement(n):
    assert seedless(leaks.SHORT_MASKS, n, n // 5) is None


def test_leaks_with_replaced_words(spark, docs):
    w = [f"word{i}" for i in range(60)]
    put = lambda words, *gone: " ".join("other" if i in gone else x for i, x in enumerate(words))
    chinese = "北京是中华人民共和国的首都和政治中心"
    rows = [
        (1, put(w[:15], 2, 5, 6)), (2, "a b " + put(w[20:40], 2, 5, 6, 9)), (3, "x " + put(w[50:56], 3) + " y"), (4, put(w[50:56], 2, 3)),
        (5, put(w[50:56], 0)), (6, f"他说，{chinese}。"), (7, "first " + put(w[40:50], 0, 9) + " last"), (8, " ".join(w[50:55])),
    ]
    items = [(1, " ".join(w[:15])), (2, " ".join(w[20:40])), (3, " ".join(w[50:56])), (4, chinese), (5, " ".join(w[40:50]))]
    tests = spark.createDataFrame(items, "item_id long, text string")
    got = {tuple(r) for r in leaks.leaks(docs(rows), tests).select("doc_id", "item_id", "doc_start", "item_start", "n_words", "n_replaced").collect()}
    assert got == {(1, 1, 0, 0, 15, 3), (2, 2, 2, 0, 20, 4), (3, 3, 1, 0, 6, 1), (5, 3, 0, 0, 6, 1), (6, 4, 2, 0, 18, 0), (7, 5, 1, 0, 10, 2)}


@pytest.mark.parametrize("bits", ["1", "0", "1101", "11111011110", "1011111111", "000111110", "1" * 9 + "000" + "1" * 12, "10" * 12])
def test_longest_overlap(bits):
    same = np.array([b == "1" for b in bits])
    start, end = leaks.longest_overlap(same)
    fine = [(b - a, -a) for a in range(len(same)) for b in range(a + 1, len(same) + 1) if same[a] and same[b - 1] and (b - a - same[a:b].sum()) <= 0.2 * (b - a) + 1e-9]
    assert (end - start, -start if end else 0) == max(fine, default=(0, 0))


def test_tokens_by_shape_are_as_token_by_token():
    tokens = ["you", "TRASH!", "idiot2", "trash-idiot", "a" * 41, "A" * 45 + "_x", "x|y||", "9,99€", "ΣΑΣ", "中文", "--", "été...", "x_1", "Ⅷ"]
    known = weak.Tokens()
    at = known.rows(tokens)
    for i, t in zip(at, tokens):
        ids = weak.token_features(t)
        assert sorted(known.ids[i]) == sorted(ids + [weak.BUCKETS] * (4 - len(ids)))
        letters, symbols, bars, upper, plain, doubled, common, abuse = known.facts[i]
        word = t.lower().strip(".,;:!?")
        assert letters == sum(map(len, weak.WORD.findall(t))) and symbols == len(weak.SYMBOLS.findall(t)) and bars == t.count("|")
        assert upper == (len(t) > 1 and t.isupper()) and plain == (word.isalpha() and not upper) and common == (word in weak.COMMON)
        assert doubled == (weak.DOUBLED.search(t) is not None) and abuse == (not weak.ABUSE.isdisjoint(weak.WORD.findall(t.lower())))


def test_tokens_of_one_shape_are_drawn_once(monkeypatch):
    """Patterns are asked once a shape, not once a token."""
    asked = []
    monkeypatch.setattr(weak, "token_features", lambda t: asked.append(t) or [0])
    known = weak.Tokens()
    known.rows([f"{a}{b}{c}{d}est" for a in "bcdf" for b in "aeio" for c in "lmnr" for d in "stvw"])
    assert len(known.row) == 256 and len(known.shapes) == 1 and not asked


def test_features_are_hashed_once_for_all_words(monkeypatch):
    """The buckets are those of the names one by one; a word asks for no name that an earlier one had."""
    def plainly(word, bits):
        marked = f"^{word[:64]}$" if len(word) <= 64 else f"^{word[:32]}{word[-32:]}$"
        names = {f"p{word[:n]}" for n in (1, 2, 3, 4)} | {f"s{word[-n:]}" for n in (1, 2, 3, 4)} | {f"w{marked}"}
        names |= {marked[i : i + n] for n in (2, 3) for i in range(len(marked) - n + 1)} | {f"l{i}" for i in range(3) if bits >> i & 1}
        return sorted(language.crc32(x.encode()) % language.BUCKETS for x in names)

    lexicon = {"haus": 5}
    for word in ("a", "haus", "über", "日本語", "x" * 65, "ab" * 40):
        assert sorted(language.features(word, lexicon)) == plainly(word, lexicon.get(word, 0))
    asked = []
    monkeypatch.setattr(language, "crc32", lambda x: asked.append(x) or 1)
    language.features("haus", lexicon)
    assert len(asked) == 1
