from datetime import datetime

from pyspark.sql import functions as F

from freshet.operators import joins as J
from freshet.operators import merge as M
from freshet.operators import star as S
from freshet.operators import tables as T

RULES = {"a": "last", "b": "last_non_null", "c": "first", "d": "min", "e": "max"}
ROWS = [
    ("k", 1, "a1", None, "c1", 5, 5),
    ("k", 2, "a2", "b2", "c2", 3, 3),
    ("k", 3, None, None, "c3", 4, 9),
    ("j", 4, "x", None, None, None, 1),
]
SCHEMA = "key string, ord int, a string, b string, c string, d int, e int"
WANT = {("k", None, "b2", "c1", 3, 9), ("j", "x", None, None, None, 1)}


def _rows(df):
    return {tuple(r) for r in df.collect()}


def test_rules(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert _rows(M.merge(df, ["key"], ["ord"], RULES)) == WANT


def test_replay_and_any_split_give_the_same_table(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    twice = df.unionByName(df)
    assert _rows(M.merge(twice, ["key"], ["ord"], RULES)) == WANT
    for cut in (0, 1, 2, 3, 4):
        states = [M.merge_state(df.where(c), ["key"], ["ord"], RULES) for c in (F.col("ord") <= cut, F.col("ord") > cut)]
        for pair in (states, states[::-1]):
            both = M.combine_states(pair[0].unionByName(pair[1]), ["key"])
            assert _rows(M.finish(both, ["key"], RULES)) == WANT


def test_evolve(spark):
    a, b = spark.createDataFrame([(1, "x")], "id int, p string"), spark.createDataFrame([(2, "y")], "id int, q string")
    assert _rows(M.evolve(a, b)) == {(1, "x", None), (2, None, "y")}


def test_lookup_keeps_every_row_when_one_key_is_hot(spark):
    n = 30_000
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), (F.col("id") % 500).cast("string")))
    df = spark.range(n).select("id", key.alias("k"))
    table = df.select("k").distinct().where("k IS NOT NULL AND k <> 'k1'").withColumn("v", F.length("k")).withColumn("w", F.upper("k"))
    plain = df.join(table, ["k"], "left").select("id", "k", "v", "w")
    split = J.lookup(df, table, ["k"], split_hot=True).select("id", "k", "v", "w")
    assert split.count() == n
    assert split.exceptAll(plain).count() == 0
    assert {r[0] for r in J.hot_keys(df.where("k IS NOT NULL"), ["k"], 0.2).collect()} == {"hot"}


def test_violations_ignore_nulls(spark):
    fact = spark.createDataFrame([(1, 1), (2, 9), (3, None)], "id int, fk int")
    dim = spark.createDataFrame([(1,), (1,)], "pk int")
    assert [r["id"] for r in J.violations(fact, dim, "fk", "pk").collect()] == [2]


def test_star_ids_resolve(spark, small):
    from freshet.sources.events import common_events

    star = S.build_star(common_events(spark.read.parquet(f"{small}/events.parquet")))
    for dim, key in (("dim_wiki", "wiki_id"), ("dim_page", "page_id"), ("dim_user", "user_id")):
        assert star[dim].groupBy(key).count().where("count > 1").count() == 0
        assert J.violations(star["fact_edit"], star[dim], key, key).count() == 0


def test_retention_counts_what_it_drops(spark):
    df = spark.sql("SELECT id, timestamp'2024-01-10' - make_dt_interval(CAST(id AS INT)) AS ts FROM range(10)")
    assert T.retained(df, "ts", 4, "2024-01-10 00:00:00").count() == 5
    assert T.pruned_count(df, "ts", 4, "2024-01-10 00:00:00").first()[0] == 5


def test_write_by_date_prunes(spark, tmp_path):
    df = spark.sql("SELECT id, timestamp'2024-01-10' - make_dt_interval(CAST(id AS INT)) AS ts FROM range(3)")
    T.write_by_date(df, str(tmp_path), "ts")
    back = spark.read.parquet(str(tmp_path)).where("event_date = date'2024-01-09'")
    assert [r["id"] for r in back.collect()] == [1]
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_dates_are_replaced_and_expired_by_folder(spark, tmp_path):
    path = str(tmp_path / "t")

    def batch(rows):
        return spark.createDataFrame(rows, "k string, o int, ts string").withColumn("ts", F.col("ts").cast("timestamp"))

    def held():
        return sorted((tuple(r) for r in spark.read.parquet(path).select("k", "o").collect()), key=str)

    def files(day):
        return sorted(p.name for p in (tmp_path / "t" / f"event_date={day}").iterdir())

    T.upsert_dates(batch([("a", 5, "2024-01-01 10:00:00"), ("b", 1, "2024-01-02 01:00:00"), ("c", 1, "2024-01-02 09:00:00"), ("n", 1, None)]), path, "ts", ["k"], ["o"])
    before = files("2024-01-02")
    again = [("a", 3, "2024-01-01 10:00:00"), ("a", 9, "2024-01-01 10:00:00"), ("d", 1, "2024-01-03 00:00:00")]
    for _ in range(2):
        T.upsert_dates(batch(again), path, "ts", ["k"], ["o"])
        assert held() == [("a", 3), ("b", 1), ("c", 1), ("d", 1), ("n", 1)]
    # A date that the batch does not have is not written again.
    assert files("2024-01-02") == before
    plan = spark.read.parquet(path).where("event_date = date'2024-01-02'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert T.expire_dates(spark, path, "ts", 1, datetime(2024, 1, 3, 5)) == 1
    assert held() == [("c", 1), ("d", 1), ("n", 1)]
    # The whole edge date goes; without a time a row stays.
    assert T.expire_dates(spark, path, "ts", 0, datetime(2024, 1, 3, 0, 0, 1)) == 1
    assert held() == [("n", 1)]
