"""The registered queries of this folder, by name."""

from __future__ import annotations

from freshet.llm import alignment, jaccard, language, leaks, near, periods, pieces, pii, recompress, secrets, suffixes, topk, weak  # noqa: F401
from freshet.llm.common import registry


def queries() -> dict:
    return dict(registry.queries)


def oracle_sql() -> dict:
    return dict(registry.sql)
