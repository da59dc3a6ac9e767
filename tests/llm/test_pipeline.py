"""The pipeline stage by stage on the smallest tables."""

import re

import corpus_pipeline
from freshet.llm import near
from freshet.llm.pieces import MODEL


def test_stages(spark, small):
    import sentencepiece

    docs = spark.read.parquet(f"{small}/documents.parquet")
    benchmark = [r["text"] for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    grams = {g for t in benchmark for g in _grams(t)}
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, now, small)
        assert after.columns == docs.columns, name
        rows, before = after.collect(), {r["doc_id"]: r for r in now.collect()}
        assert len({r["doc_id"] for r in rows}) == len(rows) and {r["doc_id"] for r in rows} <= before.keys()
        gone = [r for k, r in before.items() if k not in {x["doc_id"] for x in rows}]
        if name == "language":
            assert all(not re.search(r"[^\W\d_]", r["text"] or "") for r in gone)
        if name == "near_duplicates":
            assert all(r["kept"] for r in near.near_duplicates(after).collect())
        if name == "benchmark_leaks":
            assert gone and all(grams & _grams(r["text"]) for r in gone) and not any(grams & _grams(r["text"]) for r in rows)
        if name == "personal_data":
            assert not any(re.search(r"[\w.]+@[\w-]+\.[\w]", r["text"]) for r in rows) and any("<email>" in r["text"] for r in rows)
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
        now = spark.createDataFrame(rows, docs.schema)
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    text = {r["doc_id"]: r["text"] for r in now.collect()}
    last = corpus_pipeline.STAGES[-1][1](spark, now, small).collect()
    assert len(last) == len(text) and all(r["ids"] == model.encode(text[r["doc_id"]]) for r in last)
    assert corpus_pipeline.run(spark, small).count() == len(last)


def test_language_stage_without_anything_to_learn_from(spark):
    rows = [(1, "a clean text", None), (2, None, None), (3, "12 - 34!", None), (4, "", None), (5, "été 漢字", None), (None, "no id", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = corpus_pipeline.language_stage(spark, docs, "").collect()
    assert {r["doc_id"] for r in kept} == {1, 5, None} and len(kept) == 3


def _grams(text):
    w = re.findall(r"\w+", text.lower())
    return {tuple(w[i : i + 13]) for i in range(len(w) - 12)}


def test_a_table_without_rows(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, small).count() == 0
