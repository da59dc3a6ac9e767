"""Alignment of two tokenizers against all pairs of overlapping tokens, by other libraries' byte offsets."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from freshet.llm import alignment as module
from freshet.llm.alignment import A_VOCABULARY, B_VOCABULARY, ByteLevel, Pieces, aligned, alignment, lockstep, op11_alignment, packed, unpacked
from freshet.llm.common import documents


@pytest.fixture(scope="module")
def models():
    with open(A_VOCABULARY, "rb") as a, open(B_VOCABULARY, "rb") as b:
        return ByteLevel(a.read()), Pieces(b.read())


def spans(tokens):
    at, out = 0, []
    for t in tokens:
        out.append((at, at + len(t)))
        at += len(t)
    return out


def brute(rows, models):
    """Rows as ``alignment`` gives them, from every pair of tokens of a text."""
    known = []
    for key, text in rows:
        a, b = ([], []) if not text else (m([text])[0] for m in models)
        whole = b" " + (text or "").encode()
        if any(b"".join(m.tokens[i] for i in ids) != whole for m, ids in zip(models, (a, b))):
            a, b = [], []
        x, y = spans([models[0].tokens[i] for i in a]), spans([models[1].tokens[i] for i in b])
        links = [(a[i], b[j]) for i, (s, e) in enumerate(x) for j, (t, f) in enumerate(y) if s < f and t < e]
        cuts = sorted({e for _, e in x} & {e for _, e in y})
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, (s, _) in zip(ids, z) if low <= s < cut) for ids, z in ((a, x), (b, y))))
            low = cut
        known.append((key, len(a), len(b), len(cuts), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    count = Counter(p for r in known for p in set(r[4]))
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    return sorted(
        ((k, na, nb, g, len(links), h, sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links)) for k, na, nb, g, links, h in known), key=str
    )


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
MORE = [
    (30, "<|endoftext|> <s> </s> <unk> <0x41>"), (31, "  two  blanks \n\n\t lines  "), (32, "a▁b"), (33, "naïve façade — 東京 🏳️‍🌈 é"),
    (34, "x" * 3000), (35, "ab cd " * 900), (36, "  ​﻿"), (37, "0123456789 3.14 -7e10"), (38, "don't can't we'll"),
]


def got(df, **more):
    return sorted((tuple(r[c] for c in COLUMNS) for r in alignment(df, **more).collect()), key=str)


def test_edges(docs, edges, models):
    rows = [(k, t[:3000] if t else t) for k, t in edges] + MORE
    want = brute(rows, models)
    assert got(docs(rows)) == want
    # Links of pairs that are not sent to all tasks find their counts by a join.
    assert got(docs(rows), frequent=5) == want
    assert got(docs(rows), frequent=0) == want


def test_counts_sent_in_parts(docs, models, monkeypatch):
    monkeypatch.setattr(module, "HELD_PAIRS", 10)
    rows = MORE + [(k + 50, t) for k, t in MORE]
    assert got(docs(rows)) == brute(rows, models)


def test_texts_with_signs_that_pieces_change_have_no_tokens(docs):
    r = alignment(docs([(1, "a▁b"), (2, None), (3, "")])).collect()
    assert [tuple(x[c] for c in COLUMNS[1:]) for x in r] == [(0, 0, 0, 0, "", 0, 0)] * 3


def test_groups_text(docs, models):
    r = aligned(docs([(1, "hello world")])).where("row IS NOT NULL").first()
    a, b = (m(["hello world"])[0] for m in models)
    assert [i for g in r.groups.split(";") for i in map(int, g.split("|")[0].split(","))] == a
    assert [i for g in r.groups.split(";") for i in map(int, g.split("|")[1].split(","))] == b


def test_very_long_text_walked_by_many(docs, models):
    rng = random.Random(3)
    text = " ".join(rng.choice(["alpha", "βήτα", "gamma", "x", "東京", "12"]) for _ in range(60000))
    r = alignment(docs([(1, text)])).first()
    a, b = (m([text])[0] for m in models)
    ends = [set(np.cumsum([len(m.tokens[i]) for i in ids]).tolist()) for m, ids in zip(models, (a, b))]
    n = len(ends[0] & ends[1])
    assert (r.n_a, r.n_b, r.n_groups, r.n_links) == (len(a), len(b), n, len(a) + len(b) - n)


def test_empty_table(docs):
    assert got(docs([])) == []


def test_lockstep_from_any_byte():
    """Walkers that begin anywhere emit each link once."""
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randint(1, 60)
        cuts = [sorted(rng.sample(range(1, n), rng.randint(0, n - 1))) + [n] for _ in range(2)]
        x, y = (list(zip([0] + c[:-1], c)) for c in cuts)
        want = sorted((i, j) for i, (s, e) in enumerate(x) for j, (t, f) in enumerate(y) if s < f and t < e)
        begin = np.array(sorted({0, *rng.sample(range(n), rng.randint(0, min(n, 6)))}))
        i, j, cut_a, cut_b = lockstep(np.array(cuts[0]), np.array(cuts[1]), begin, np.append(begin[1:], n))
        assert sorted(zip(i.tolist(), j.tolist())) == want
        assert [c for c, k in zip(cuts[0], cut_a) if k] == sorted(set(cuts[0]) & set(cuts[1])) == [c for c, k in zip(cuts[1], cut_b) if k]


def test_packed():
    for x in ([], [0], [5, 1, 2**32 - 1], [2**40, 3]):
        assert unpacked(packed(np.array(x, np.int64))).tolist() == x


def test_vocabulary_must_be_there(spark):
    with pytest.raises(Exception):
        module.vocabulary(spark, "/nowhere/at-all.model")


def test_query_counts_over_all_documents(spark, small, models):
    rows = [(r.doc_id, r.text) for r in documents(spark, small).select("doc_id", "text").collect()]
    seen = sorted((tuple(r[c] for c in COLUMNS) for r in op11_alignment(spark, small).collect()), key=str)
    short = [(k, t) for k, t in rows if len(t or "") < 600]
    want = {r[0]: r for r in brute(short, models)}
    assert all(r[:6] == want[r[0]][:6] for r in seen if r[0] in want)
    assert len(seen) == len(rows)


def test_parts_give_the_tokens_of_the_whole_text(edges, monkeypatch):
    """Cut at blanks, remembered, forgotten again: the same tokens as of the text in one go."""
    monkeypatch.setattr(module, "KNOWN_PARTS", 7)
    monkeypatch.setattr(module, "TOGETHER", 3)
    with open(A_VOCABULARY, "rb") as a, open(B_VOCABULARY, "rb") as b:
        aligner = module.Aligner(a.read(), b.read())
    assert aligner.in_parts
    odd = ["a ", " a", "\n b", " \n b\n", "a  b", "a   b ", "x\x1c y", "a\x85 b", " ", "  ", "tab\t x", "a  b", "　 c", "a ́b", "▁ ▁a b▁c d"]
    for text in [t for _, t in edges + MORE if t] + odd:
        numbers = aligner._numbered(aligner.parts(text))
        for tokens, model in zip(aligner.tokens, (aligner.a, aligner.b)):
            if np.frombuffer(tokens.whole, np.uint8)[numbers].all():
                assert tokens.of(numbers)[0].tolist() == model([text])[0]
            else:
                assert b"".join(model.tokens[i] for i in model([text])[0]) != b" " + text.encode()
