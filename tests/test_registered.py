"""Every registered query against its SQL, on the smallest tables."""

import re

import pytest
from compare import difference

from __spark_entry__ import entry, oracle_sql, queries

# The training-data operators have their own tests.
OWN = re.compile(r"op\d+_|pipeline$")
QUERIES = {k: v for k, v in queries().items() if not OWN.match(k)}
SQL = {k: v for k, v in oracle_sql().items() if not OWN.match(k)}
WITHOUT_SQL = set()


def test_only_known_queries_lack_sql():
    assert QUERIES.keys() - SQL.keys() == WITHOUT_SQL
    assert SQL.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, small, duck_small, name):
    assert difference(QUERIES[name](spark, small), duck_small, SQL[name]) is None


def test_entry(spark):
    rows = entry(spark).collect()
    assert 0 < len(rows) <= 10
    assert all("changed" in r["content"].lower() for r in rows)


def test_json_row_holds_every_field(spark, small):
    import json

    row = QUERIES["json_row"](spark, small).where("event_id = 3").first()
    assert json.loads(row["content"]).keys() == {"event_id", "ts", "user_id", "event_type", "value", "props"}
