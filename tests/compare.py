"""Run registered queries next to their SQL and compare the rows.

``python tests/compare.py SF_DIR [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((x is not None, str(x)) for x in r))


def difference(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    columns = spark_df.columns
    got = rows_of(columns, [tuple(r) for r in spark_df.collect()])
    rel = con.execute(sql)
    names = [c[0] for c in rel.description]
    want = rows_of(names, rel.fetchall())
    if sorted(columns) != sorted(names):
        return f"columns {sorted(columns)} vs {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}"
    for a, b in zip(got, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{sorted(columns)}\n  spark {str(a)[:600]}\n  duck  {str(b)[:600]}"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from freshet.session import local_session

    folder, names = sys.argv[1], sys.argv[2:]
    spark = local_session("8")
    con = duck(folder)
    all_queries, sql = queries(), oracle_sql()
    bad = 0
    for name in names or all_queries:
        t = time.time()
        try:
            df = all_queries[name](spark, folder)
            if name not in sql:
                diff, note = None, f"{df.count()} rows, no SQL"
            else:
                diff, note = difference(df, con, sql[name]), "ok"
        except Exception as e:  # noqa: BLE001
            diff, note = f"{type(e).__name__}: {str(e)[:700]}", ""
        bad += diff is not None
        print(f"{time.time() - t:6.2f}s {name}: {diff or note}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
