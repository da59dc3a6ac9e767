"""Suffix sorting and recompression against dictionaries of all windows."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from freshet.llm import recompress, repeats, suffixes


def removed(sequences, width):
    """For each (id, sequence) which symbols a window covers that also starts under a smaller id."""
    first = {}
    for key, s in sequences:
        if key is not None:
            for i in range(len(s) - width + 1):
                first[s[i : i + width]] = min(first.get(s[i : i + width], key), key)
    for key, s in sequences:
        gone = [False] * len(s)
        for i in range(len(s) - width + 1):
            if key is not None and first[s[i : i + width]] < key:
                gone[i : i + width] = [True] * width
        yield key, s, gone


def by_bytes(rows):
    for key, s, gone in removed([(k, (t or "").encode()) for k, t in rows], 50):
        kept = bytes(b for b, x in zip(s, gone) if not x)
        yield key, len(s), sum(gone), sum(b and not a for a, b in zip([False, *gone], gone)), hashlib.sha256(kept).hexdigest()


def by_words(rows):
    for key, s, gone in removed([(k, tuple(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for k, t in rows], 13):
        kept = " ".join(w for w, x in zip(s, gone) if not x)
        yield key, len(s), sum(gone), hashlib.sha256(kept.encode()).hexdigest()


def ordered(rows):
    return sorted(map(tuple, rows), key=str)


def bytes_of(df):
    return ordered(suffixes.deduplicated(df).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect())


def words_of(df):
    return ordered(recompress.deduplicated(df).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect())


@pytest.mark.parametrize("size, letters, depth", [(1, 2, 5), (2, 2, 5), (5, 2, 4), (300, 2, 50), (1000, 3, 7), (2500, 2, 10), (700, 1, 50)])
def test_suffix_ranks(size, letters, depth):
    s = np.random.default_rng(size).integers(1, letters + 1, size)
    order = np.argsort(suffixes.suffix_ranks(s, depth), kind="stable")
    cut = [tuple(s[i : i + depth]) for i in order]
    assert cut == sorted(cut)


def test_edges(docs, edges):
    assert bytes_of(docs(edges)) == ordered(by_bytes(edges))
    assert words_of(docs(edges)) == ordered(by_words(edges))


def test_windows_of_common_names_are_dealt_out_alone(docs, monkeypatch):
    monkeypatch.setattr(suffixes, "HOT_UNITS", 2)
    common = "a passage that very many documents share, whatever stands around it, to the last sign. "
    rows = [(i, f"{i * 7919} {common * (1 + i % 2)} {i * 104729}") for i in range(60)]
    assert bytes_of(docs(rows)) == ordered(by_bytes(rows))
    assert words_of(docs(rows)) == ordered(by_words(rows))


def test_late_windows_are_runs_and_names_of_many_units_meet_in_one_sort(docs):
    """Windows that an earlier unit has come as runs; thousands of units of one name are no reason to send a row for each window."""
    bodies = [b"a" * 3 + bytes(range(97, 123)) * 3 + b"b", bytes(range(97, 123)) * 3 + b"c", b"z" * 60]
    n = np.arange(3)
    got = suffixes.late_windows(n, n + 10, np.array([5, 7, 5]), np.array([0, 100, 0]), bodies)
    assert [x.tolist() for x in got] == [[1], [11], [100], [29]]
    assert [len(x) for x in suffixes.late_windows(n, n, np.array([5, 5, 5]), n, bodies)] == [0] * 4
    rng = np.random.default_rng(3)
    common = "a passage of the length of one window, it has a name. "
    letters = rng.integers(97, 123, (2500, 60)).astype(np.uint8)
    rows = [(i, f"{x[:30].tobytes().decode()}{common}{x[30:].tobytes().decode()}") for i, x in enumerate(letters)]
    assert bytes_of(docs(rows)) == ordered(by_bytes(rows))


def test_removed_runs_are_read_as_arrays():
    kind = pa.list_(pa.struct([("lo", pa.int32()), ("n", pa.int32())]))
    rows = [None, [{"lo": 2, "n": 1}, {"lo": 4, "n": 2}], [], [{"lo": 0, "n": 1}], None]
    batch = pa.record_batch([pa.array(rows, kind)], names=["removed"])
    got = [x and [y.tolist() for y in x] for x in repeats.removed_of(batch.slice(1))]
    assert got == [[[2, 4], [1, 2]], None, [[0], [1]], None]
    assert np.flatnonzero(repeats.covered((np.array([2, 4]), np.array([1, 2])), 3, 9)).tolist() == [2, 3, 4, 5, 6, 7]


def test_empty_table(docs):
    assert bytes_of(docs([])) == [] and words_of(docs([])) == []


def test_small_documents_table(spark, small):
    table = spark.read.parquet(f"{small}/documents.parquet")
    rows = [tuple(r) for r in table.select("doc_id", "text").collect()]
    assert bytes_of(table) == ordered(by_bytes(rows))
    assert words_of(table) == ordered(by_words(rows))


def test_a_full_filter_changes_nothing(docs, edges, monkeypatch):
    monkeypatch.setattr(suffixes, "in_filter", lambda bits, names: np.ones(len(names), bool))
    monkeypatch.setattr(recompress, "in_filter", lambda bits, names: np.ones(len(names), bool))
    assert bytes_of(docs(edges)) == ordered(by_bytes(edges))
    assert words_of(docs(edges)) == ordered(by_words(edges))


def test_names_are_packed_and_unpacked():
    for x in ([5], [0, 1, 2**40], [3, 2**47], list(range(0, 10**6, 7))):
        assert repeats._unpacked(repeats._packed(np.array(x, np.uint64))).tolist() == x


def test_every_window_of_words_has_a_name_of_its_content():
    rng = np.random.default_rng(5)
    h = rng.integers(0, 6, 4000).astype(np.uint64)
    names, seen = recompress.window_names(h)[0], {}
    for i in range(len(names)):
        key = tuple(h[i : i + recompress.WINDOW])
        assert seen.setdefault(key, names[i]) == names[i]


def test_units_are_joined_part_by_part(docs, edges, monkeypatch):
    """When a part of the names is joined, neither the other parts nor the bodies of units take disk."""
    parts, stages = [], []
    real, drop = repeats.kept, suffixes.dropped

    def kept(df, name):
        stages.append(name)
        out = real(df, name)
        if name == "removals":
            parts.append(out.select(F.sum(F.size("removed"))).first()[0] or 0)
        return out

    def dropped(*tables):
        stages.append("dropped")
        drop(*tables)

    for module in (suffixes, recompress, repeats):
        monkeypatch.setattr(module, "kept", kept)
        monkeypatch.setattr(module, "dropped", dropped)
    assert bytes_of(docs(edges)) == ordered(by_bytes(edges))
    assert stages[stages.index("late") : stages.index("gone")] == ["late", "dropped", *["removals"] * repeats.SLICES]
    assert len(parts) == repeats.SLICES and max(parts) < 0.7 * sum(parts)
    parts.clear()
    assert words_of(docs(edges)) == ordered(by_words(edges))
    assert len(parts) == repeats.SLICES and max(parts) < 0.7 * sum(parts)


@pytest.mark.parametrize("module", [suffixes, recompress])
def test_filter_is_filled_evenly(docs, module):
    """Anchors are least hashes; in the upper bits of the hashes alone most names would share the first part and the first places."""
    rng = np.random.default_rng(5)
    texts = [" ".join("".join(map(chr, rng.integers(97, 123, 6))) for _ in range(300)) for _ in range(30)]
    df = docs(list(enumerate(texts + texts)))
    bitmap = repeats.shared_filter(df.select("doc_id", "text"), module._names_maker, module.NAMES_PER_SIGN)
    filled = np.unpackbits(bitmap.view(np.uint8)).reshape(16, -1).sum(1)
    assert filled.sum() > 1000 and filled.max() < 2 * filled.mean()
    names = module._names_maker()(texts[7])
    assert repeats.in_filter(bitmap, repeats.spread(names)).all()


def test_texts_are_named_side_by_side(monkeypatch):
    """Many texts at once give what each gives alone; equal runs of windows have equal numbers, others not."""
    rng = np.random.default_rng(8)
    common = "".join(map(chr, rng.integers(97, 123, 400)))
    texts = ["", "x" * 49, "x" * 50, "y" * 700, common, "é" * 40 + common[:200], common[7:] + "z", "", common + common, "ab" * 300, ""]
    full = np.full(1 << 22, ~np.uint64(0))
    found = {}
    for size in (1, 1000, 1 << 20):
        monkeypatch.setattr(suffixes, "BLOCK_BYTES", size)
        parts = [x[:5] for x in suffixes._unit_maker()(texts, full)]
        found[size] = [np.concatenate(x).tolist() for x in zip(*parts)]
        assert len(parts) == {1: len([t for t in texts if t]) + 1, 1 << 20: 1}.get(size, len(parts))
        names = np.sort(np.concatenate([*suffixes._names_maker().many(texts)]))
        assert names.tolist() == sorted(x for t in texts for x in set(suffixes._names_maker()(t).tolist()))
    assert found[1] == found[1000] == found[1 << 20]
    bodies = {}
    for text, name, unit, lo, n in zip(*found[1]):
        raw = texts[text].encode()
        assert 0 <= lo <= len(raw) - n - suffixes.WINDOW + 1 and n <= suffixes.LONGEST_UNIT
        bodies.setdefault((name, unit), set()).add(raw[lo : lo + n + suffixes.WINDOW - 1])
    assert {len(b) for b in bodies.values()} == {1} and len(set.union(*bodies.values())) == len(bodies)
    assert sum(found[1][4]) == sum(max(0, len(t.encode()) - 49) for t in texts)


def test_units_and_bodies_are_not_sorted_to_be_joined(docs, edges, monkeypatch):
    """The side of which a key is unique is hashed; a body comes from the document of the least id, not from a sorted aggregation."""
    plans, real = {}, suffixes.kept

    def kept(df, name):
        plans.setdefault(name, df._jdf.queryExecution().sparkPlan().toString())
        return real(df, name)

    for module in (suffixes, repeats):
        monkeypatch.setattr(module, "kept", kept)
    assert bytes_of(docs(edges)) == ordered(by_bytes(edges))
    assert "SortAggregate" not in plans["bodies"] and "any_value" not in plans["bodies"]
    assert "ShuffledHashJoin" in plans["bodies"] and "ShuffledHashJoin" in plans["removals"]
