"""The grouped prefix join against all pairs."""

import random
import re

from freshet.llm import jaccard
from freshet.llm.common import documents
from freshet.llm.jaccard import jaccard_join, op13_jaccard


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def brute(rows, k, percent):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    parent = {key: key for key, _ in rows if key is not None}
    for i, (a, _) in enumerate(rows):
        for j in range(i):
            b = rows[j][0]
            if a is not None and b is not None and sets[i] and sets[j]:
                shared = len(sets[i] & sets[j])
                if 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
                    x, y = find(parent, a), find(parent, b)
                    parent[max(x, y)] = min(x, y)
    return sorted(((key, len(s), None if key is None else find(parent, key)) for (key, _), s in zip(rows, sets)), key=str)


def got(df, k=5, percent=80):
    return sorted(map(tuple, jaccard_join(df, k, percent).collect()), key=str)


def changed(rng, words, edits):
    words = list(words)
    for i in rng.sample(range(len(words)), edits):
        words[i] = f"z{rng.random()}"
    return " ".join(words)


def family(seed, n, width, most):
    """Texts that differ from one by 0 to ``most`` words, around the threshold."""
    rng = random.Random(seed)
    base = [f"s{seed}w{i}" for i in range(width)]
    return [changed(rng, base, rng.randint(0, most)) for _ in range(n)]


def test_edges(docs, edges):
    assert got(docs(edges)) == brute(edges, 5, 80)


def test_near_copies_around_the_threshold(docs):
    rows = list(enumerate(t for f in range(4) for t in family(f, 40, 60 + 30 * f, 5)))
    want = brute(rows, 5, 80)
    assert 30 < len({r[2] for r in want}) < 150
    assert got(docs(rows)) == want
    assert got(docs(rows), 3, 70) == brute(rows, 3, 70)


def test_chains_and_sizes(docs):
    """Links to the next text only, parts of texts, and a line that all have."""
    line = "this work is licensed under the terms that everyone has agreed to long ago "
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[3 * i : 3 * i + 80])) for i in range(60)]
    rows += [(100 + i, line + " ".join(words[: 70 + i])) for i in range(0, 40, 2)]
    rows += [(200 + i, line + f"only here {i} " * (i % 4)) for i in range(40)]
    assert got(docs(rows)) == brute(rows, 5, 80)


def test_components_that_leaders_do_not_join(docs):
    """Two texts of each pair are close, pairs are not, and all share most of their prefix."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(100)]
    rows = []
    for i in range(30):
        one = changed(rng, base, 4).split()
        rows += [(2 * i, " ".join(one)), (2 * i + 1, changed(rng, one, 2))]
    want = brute(rows, 5, 80)
    assert len({r[2] for r in want}) > 5
    assert got(docs(rows)) == want


def test_hot_keys_go_by_broadcast(docs, monkeypatch):
    """The same rows when every key counts as hot."""
    monkeypatch.setattr(jaccard, "_share_limit", lambda total: 2)
    rows = list(enumerate(family(1, 30, 60, 3) + family(1, 30, 60, 3)[:20] + ["a b c d"] * 9))
    assert got(docs(rows)) == brute(rows, 5, 80)


def test_one_id_joins_the_groups_of_its_texts(docs):
    x, y = "alpha beta gamma delta " * 5, "some quite other text about nothing at all " * 3
    rows = [(1, x), (2, y), (3, x), (3, y), (3, "alone with these few words here"), (1, x)]
    assert {r[2] for r in got(docs(rows))} == {1}


def test_empty_table(docs):
    assert got(docs([])) == []


def test_no_task_reads_all_pairs_of_a_hot_group(docs, monkeypatch):
    """500 near copies are verified with their leaders, not with each other."""
    sizes = []
    real = jaccard.verified
    monkeypatch.setattr(jaccard, "verified", lambda pairs, *rest: (sizes.append(pairs.count()), real(pairs, *rest))[1])
    rows = list(enumerate(family(3, 500, 140, 2)))
    assert {r[2] for r in got(docs(rows))} == {0}
    assert sum(sizes) < 500 * 12


def test_rounds_without_links_make_few_jobs(spark, docs, monkeypatch):
    """Plans and jobs stay in the driver's memory: rounds that link nothing look at the same rows, and only ids of several texts connect further."""
    monkeypatch.setattr(jaccard, "FEW", 2)
    rng = random.Random(9)
    base = [f"b{i}" for i in range(100)]
    rows = []
    for i in range(60):
        one = changed(rng, base, 4).split()
        rows += [(2 * i, " ".join(one)), (2 * i + 1, changed(rng, one, 2))]
    want = brute(rows, 5, 80)
    df = docs(rows)
    spark.sparkContext.setJobGroup("rounds", "rounds")
    try:
        assert got(df) == want
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("rounds"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 100  # 104 when each round gathered the rows again and all documents went through the components


def test_query_against_brute(spark, small):
    rows = [(r.doc_id, r.text) for r in documents(spark, small).select("doc_id", "text").collect()]
    assert sorted(map(tuple, op13_jaccard(spark, small).collect()), key=str) == brute(rows, 5, 80)
