"""The natural-key star, kept up to date on a cursor over stored rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.operators.star import ORDER, SEEN, edits_from_content
from freshet.session import stored
from freshet.streaming.snapshots import TableGroup

PAGE = 1_000_000  # stored ids that one batch covers


def star_tables(spark: SparkSession, path: str, fold_every: int = 10) -> TableGroup:
    return TableGroup(spark, path, {name: (keys, ORDER, rules) for name, (_, keys, rules) in SEEN.items()}, fold_every)


def advance(star: TableGroup, stored_rows: DataFrame, page: int = PAGE, key: str = "ord") -> int:
    """Bring the star up to date with the stored rows after its cursor; how many batches that took.

    ``stored_rows`` are key=value rows (see ``edits_from_content``) with a rising id ``key``. Each batch covers ``page`` ids, read
    by their range, so its size does not hang on how far the star lags behind. All tables and the cursor of a batch become
    visible together; after a failure the next call goes on from the last batch that was complete.
    """
    batches = 0
    low, high = stored_rows.agg(F.min(key), F.max(key)).first()
    done = star.cursor()
    at = (low - 1 if low is not None else 0) if done is None else done
    while high is not None and at < high:
        upto = min(at + page, high)
        # Read back by four tables, worked out once.
        edits = stored(edits_from_content(stored_rows.where((F.col(key) > at) & (F.col(key) <= upto))), "edits")
        # A batch is named by where it begins: run again, it writes the same folders.
        star.apply({name: rows(edits) for name, (rows, _, _) in SEEN.items()}, upto, at + 1)
        at, batches = upto, batches + 1
    return batches
