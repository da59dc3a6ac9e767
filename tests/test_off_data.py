"""Cases outside the test tables: blanks around queries, repeated fields, models and vectors of the wrong size, equal hot rows."""

import pytest
from pyspark.sql import functions as F

from freshet.operators.decode import decode_double, drop_malformed, lenient
from freshet.operators.embedding import embed_with
from freshet.operators.joins import lookup
from freshet.operators.keyword import batch_keyword_topk, fts_search, token_index
from freshet.operators.vector_search import vector_topk
from freshet.session import shared_dir


def test_blanks_around_a_query_do_not_count(spark):
    chunks = spark.createDataFrame([(1, "a cat sat", None), (2, "a dog", None)], "id long, content string, title string")
    queries = spark.createDataFrame([(1, " cat "), (2, "\tcat"), (3, " cat\n"), (4, " \t "), (5, None)], "id long, query string")
    assert {r["query_id"] for r in batch_keyword_topk(chunks, queries, 3).collect()} == {1, 2, 3}


def test_the_last_of_repeated_fields_counts(spark):
    texts = ['{"a":1,"a":2,"content":"x"}', "{bad", '"{bad', '"', '""', " ", None, '"\\"x\\""']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string").coalesce(1)
    reasons = {r["i"]: r["reason"] for r in decode_double(df).collect()}
    assert reasons == {0: None, 1: "malformed", 2: "malformed", 3: "malformed", 4: "empty", 5: "empty", 6: "tombstone", 7: "not_an_object"}
    assert {r["i"] for r in drop_malformed(df).collect()} == {0, 4, 7}
    assert lenient(df.where("i = 0")).first()["body"] == texts[0]
    assert df.where("i = 0").select(F.try_variant_get(F.try_parse_json("value"), "$.a", "int")).first()[0] == 2


@pytest.mark.parametrize("model", [lambda texts: [[1.0]], lambda texts: [[1.0], [1.0, 2.0]]])
def test_a_model_must_answer_for_every_text_in_one_width(spark, model):
    texts = spark.createDataFrame([("a", "x"), ("b", "y")], "text_hash string, text string").coalesce(1)
    with pytest.raises(Exception, match="the model gave"):
        embed_with(texts, model).collect()


def test_rows_of_another_width_are_no_hits(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0]), (3, [0.0, 1.0]), (4, None)], "id long, embedding array<double>")
    assert [r["id"] for r in vector_topk(rows, [1.0, 0.0], 3).collect()] == [1, 3]


def test_equal_rows_of_a_hot_key_are_spread_and_found(spark):
    rows = spark.range(2000).select(F.lit("hot").alias("k"), F.lit(1).alias("x"))
    table = spark.createDataFrame([("hot", 5), ("cold", 6)], "k string, y int")
    out = lookup(rows.union(spark.createDataFrame([("cold", 1), (None, 1), ("none", 1)], "k string, x int")), table, ["k"], split_hot=True)
    assert sorted(map(tuple, out.groupBy("k", "y").count().collect()), key=str) == sorted([("hot", 5, 2000), ("cold", 6, 1), (None, None, 1), ("none", None, 1)], key=str)


def test_all_words_of_a_query_are_asked_for(spark):
    docs = spark.createDataFrame([(1, "red green blue red"), (2, "red green"), (3, "blue"), (4, None)], "doc_id long, text string")
    queries = spark.createDataFrame([(1, "red blue"), (2, "green red"), (3, "red missing"), (4, "the"), (5, None)], "query_id long, query string")
    got = sorted(map(tuple, fts_search(token_index(docs), queries).collect()))
    assert got == [(1, 1, 3), (2, 1, 3), (2, 2, 2)]


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master, applicationId = "spark://host:7077", "app"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session(), "x")
