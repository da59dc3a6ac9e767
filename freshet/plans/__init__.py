"""The registered queries, each next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from freshet.session import prepare

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries and their SQL by name."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str | None = None, name: str | None = None):
        def add(fn: Query) -> Query:
            key = name or fn.__name__

            def run(spark: SparkSession, folder: str) -> DataFrame:
                return fn(prepare(spark), folder)

            self.queries[key] = run
            if sql is not None:
                self.sql[key] = sql.strip()
            return fn

        return add


def everything() -> Registry:
    from freshet.plans import cleaning, decoding, flow, indexing, ingest, lookup, modelling, retrieval, streams

    whole = Registry()
    for module in (decoding, ingest, cleaning, modelling, indexing, retrieval, lookup, flow, streams):
        repeated = whole.queries.keys() & module.registry.queries.keys()
        if repeated:
            raise ValueError(f"queries defined twice: {sorted(repeated)}")
        whole.queries.update(module.registry.queries)
        whole.sql.update(module.registry.sql)
    return whole
