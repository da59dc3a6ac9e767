"""Periodic runs against every period of every text."""

import hashlib
import random
import re
import zlib

import pytest

from freshet.llm.common import documents
from freshet.llm.periods import digests, op12_periods, periodic_runs, planted, solve, z_values

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words):
    """(start, period, length) by comparing words at every distance."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, q, length) for (s, length), q in found.items())


def collapsed(words, runs):
    gone = {i for s, q, length in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def got(df):
    return sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(df).collect()), key=str)


def want(rows):
    out = []
    for key, text in rows:
        words = WORD.findall(text or "")
        out.append((key, len(words), brute(words), collapsed(words, brute(words))))
    return sorted(out, key=str)


def made(seed, n, letters):
    """Texts of few words with repetitions of repetitions in them."""
    rng = random.Random(seed)
    out = []
    while len(out) < n:
        part = [rng.choice(letters) for _ in range(rng.randint(1, 9))]
        if rng.random() < 0.3:
            part = (part * 6)[: rng.randint(1, 40)] + ["x"]
        part = part * rng.choice([1, 1, 2, 4, 5, 9])
        out += part[: rng.randint(1, len(part))]
        if rng.random() < 0.15 and out:
            out += out[-rng.randint(1, min(len(out), 40)) :] * rng.randint(2, 6)
    return out[:n]


def test_edges(docs, edges):
    assert got(docs(edges)) == want(edges)


def test_made_texts(docs):
    rows = [(i, " ".join(made(i, 20 + 13 * (i % 40), "ab" if i % 3 else "abcdefgh"))) for i in range(120)]
    assert any(len(brute(t.split())) > 3 for _, t in rows)
    assert got(docs(rows)) == want(rows)


@pytest.mark.parametrize("q", [1, 2, 3, 4, 7, 8, 9, 16, 31, 33, 64, 100])
def test_each_octave_and_place(docs, q):
    rng = random.Random(q)
    rows = []
    for before in range(0, 9):
        core = [f"w{rng.random()}" for _ in range(q)]
        for size in (4 * q - 1, 4 * q, 4 * q + 1, 5 * q + 2, 6):
            rows.append((len(rows), " ".join([f"b{i}" for i in range(before)] + (core * 7)[:size] + [f"e{i}" for i in range(before % 4)])))
    assert got(docs(rows)) == want(rows)


def test_long_texts(docs):
    """Runs that cross many strips, and one word over and over."""
    rng = random.Random(5)
    core = [f"w{i}" for i in range(777)]
    rows = [(1, "a " * 30000), (2, " ".join(core * 30)), (3, "a b " * 9000 + "c " * 9000), (4, " ".join(rng.choice("ab") for _ in range(3000)))]
    seen = {r.doc_id: r for r in periodic_runs(docs(rows)).collect()}
    assert [tuple(x) for x in seen[1].runs] == [(0, 1, 30000)] and seen[1].collapsed == "a"
    assert [tuple(x) for x in seen[2].runs] == [(0, 777, 777 * 30)] and seen[2].collapsed == " ".join(core)
    assert [tuple(x) for x in seen[3].runs] == [(0, 2, 18000), (18000, 1, 9000)]
    assert [tuple(x) for x in seen[4].runs] == brute(rows[3][1].split())


def test_empty_table(docs):
    assert got(docs([])) == []


def test_z_values():
    rng = random.Random(1)
    for _ in range(300):
        s = [rng.choice("ab") for _ in range(rng.randint(1, 30))]
        z = z_values(s, len(s))
        for i in range(1, len(s)):
            k = 0
            while i + k < len(s) and s[i + k] == s[k]:
                k += 1
            assert z[i] == k


def test_fragments_are_bounded_by_their_tiles():
    """A tile alone knows a fragment; only the stitching makes the run."""
    words = [1, 2, 3] * 20
    parts = [solve(words[max(0, c - 2) : c + 8], max(0, c - 2), 2, c, 1) for c in range(0, len(words), 2)]
    assert max(e - b for part in parts for q, b, e in part) <= 6


def test_query_against_brute(spark, small):
    rows = {r.doc_id: r for r in op12_periods(spark, small).collect()}
    texts = {r.doc_id: r.text for r in documents(spark, small).collect()}
    assert rows.keys() == texts.keys()
    some = 0
    for key, text in texts.items():
        words = WORD.findall(text or "")
        n, h = len(words), zlib.crc32(str(key).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        if n > 3000:
            continue
        runs = brute(words)
        best = max(runs, key=lambda r: (r[2] / r[1], -r[0], -r[1]), default=None)
        line = "".join(f"{s},{length},{q}\n" for s, q, length in runs)
        r = rows[key]
        some += len(runs)
        assert (r.n_runs, r.runs_sha256) == (len(runs), hashlib.sha256(line.encode()).hexdigest())
        assert (r.start, r.period, r.length) == (best or (None,) * 3)
        assert r.exponent_milli == (1000 * best[2] // best[1] if best else None)
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert some > 5


def test_planted_keeps_other_texts(docs):
    rows = [(1, " a  b c "), (None, "x y"), (2, None), (3, "")]
    assert not any(zlib.crc32(str(k).encode()) % 10 == 0 for k, _ in rows if k)
    assert sorted(map(tuple, planted(docs(rows)).collect()), key=str) == sorted(rows, key=str)


def test_digest_columns(docs):
    r = digests(periodic_runs(docs([(1, "a " * 6 + "b " * 6)]))).first()
    assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (2, 0, 6, 1, 6000)
    assert r.collapsed_sha256 == "a b"
