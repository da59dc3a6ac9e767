"""Near-duplicates and components against all pairs."""

import random
import re

import pytest

from freshet.llm.components import components
from freshet.llm.near import WordHasher, bands_for, crossing, earliest, near_duplicates, shingle_set
from freshet.llm.repeats import filter_bits, in_filter, shared_names


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def brute(rows, k, percent):
    sets = []
    for key, text in rows:
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
    return sorted(
        ((key, len(s), None if key is None else find(parent, key), key is None or find(parent, key) == key) for (key, _), s in zip(rows, sets)), key=str
    )


def got(df, k, percent):
    return sorted(map(tuple, near_duplicates(df, k, percent).collect()), key=str)


def test_edges(docs, edges):
    assert got(docs(edges), 3, 85) == brute(edges, 3, 85)


def test_one_id_joins_the_groups_of_its_texts(docs):
    x, y = "alpha beta gamma delta " * 5, "some quite other text about nothing at all " * 3
    rows = [(1, x), (2, y), (3, x), (3, y)]
    assert {r[2] for r in got(docs(rows), 3, 85)} == {1}


def test_bands_with_several_components(docs):
    """A chain of texts, each close to the next only, between copies and strangers."""
    words = [f"w{i}" for i in range(140)]
    rows = [(i, " ".join(words[3 * i : 3 * i + 60])) for i in range(25)] + [(100 + i, " ".join(words[i : i + 40] * 2)) for i in range(0, 100, 9)]
    rows += [(200 + i, r[1]) for i, r in enumerate(rows[:5])]
    assert got(docs(rows), 3, 85) == brute(rows, 3, 85)
    assert got(docs(rows), 5, 80) == brute(rows, 5, 80)


def edited(n, words=120, seed=5):
    """Copies of one text with some words replaced, by few words that others take too."""
    rng = random.Random(seed)
    base = [f"v{i}" for i in range(words)]
    rows = []
    for i in range(n):
        w = list(base)
        for at in rng.sample(range(words), rng.randrange(1, 9)):
            w[at] = f"u{rng.randrange(3)}"
        rows.append((i, " ".join(w)))
    return rows


def test_one_large_group_of_near_copies(docs):
    rows = edited(150)
    rows += [(40, "another text of an id that has one " * 9), (41, rows[3][1]), (41, rows[90][1])]
    assert got(docs(rows), 3, 85) == brute(rows, 3, 85)
    assert got(docs(rows), 5, 80) == brute(rows, 5, 80)


def test_few_pairs_of_a_large_group_cross(spark):
    """In one band of far copies little more than the pairs that are close enough leave the join."""
    sets = {i: set(shingle_set(text, 3, WordHasher()).tolist()) for i, text in edited(200)}
    close = {(a, b) for a in sets for b in range(a) if 100 * (m := len(sets[a] & sets[b])) >= 85 * (len(sets[a]) + len(sets[b]) - m)}
    rows = spark.createDataFrame([(1, i, i, 0, len(s), len(s)) for i, s in sets.items()], "band long, id long, component long, turn long, n long, c long")
    raw = spark.createDataFrame([(i, bytearray(shingle_set(text, 3, WordHasher()).tobytes())) for i, text in edited(200)], "id long, shingles binary")
    found = {tuple(r) for r in crossing(rows, earliest(raw, 85), 1, 85).collect()}
    assert close <= found and len(found) < len(close) + 0.2 * (200 * 199 // 2 - len(close))


def test_bitmaps_of_small_tables_are_small(spark):
    names = [bytes(8 * [i]) for i in range(1, 60)]
    read = lambda: lambda raw: __import__("numpy").frombuffer(raw, "u8")
    rows = spark.createDataFrame([(bytearray(x),) for x in names + names[::2]], "part binary")
    bitmap = shared_names(rows, read, 90, filter_bits(90))
    assert bitmap.nbytes <= 1 << 13 and filter_bits(1e9) == 28
    assert all(in_filter(bitmap, read()(x))[0] for x in names[::2]) and sum(in_filter(bitmap, read()(x))[0] for x in names) == 30


def test_empty_table(docs):
    assert got(docs([]), 3, 85) == []


def test_enough_bands():
    assert (1 - 0.85**4) ** bands_for(85) <= 1e-8


@pytest.mark.parametrize("edges_, want", [([(5, 4), (4, 3), (3, 2), (9, 8), (8, 8)], {5: 2, 4: 2, 3: 2, 9: 8}), ([], {}), ([(None, 1), (1, None)], {})])
def test_components(spark, edges_, want):
    out = components(spark.createDataFrame(edges_, "a long, b long")).collect()
    assert dict(map(tuple, out)) == want
