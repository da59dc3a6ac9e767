"""Upserts without a table format: one small folder per micro-batch, folded now and then.

A batch is written as its own partial merge under ``delta/v=<run>-<number>``, so it
costs what the batch is worth, not what the table is. The run is the id that a
stream keeps in its checkpoint: a stream started anew under another checkpoint counts
its batches from 0 again, and its folders stand beside the older ones. When enough
deltas have gathered they are folded into the next ``base/v=<number>``, which names the
deltas it holds. Readers combine the newest base with the deltas it does not name,
and look only at folders whose success mark is there. A batch that is run again
rewrites its own folder, so replays change nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from freshet.operators.merge import combine_states, finish, merge_state


class SnapshotTable:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        order: Sequence[str],
        rules: Mapping[str, str],
        fold_every: int = 10,
    ):
        self.spark, self.path, self.fold_every = spark, path.rstrip("/"), fold_every
        self.keys, self.order, self.rules = list(keys), list(order), dict(rules)

    def _folder(self, kind: str, version: str) -> str:
        return f"{self.path}/{kind}/v={version}"

    def versions(self, kind: str) -> list[str]:
        """Complete folders of one kind, through the file system the path belongs to."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        root = hadoop.Path(f"{self.path}/{kind}")
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        return sorted(n[2:] for n in names if n.startswith("v=") and fs.exists(hadoop.Path(f"{self.path}/{kind}/{n}/_SUCCESS")))

    def folded(self, base: str) -> set[str]:
        """Names of the deltas that a base holds: one per batch since the table began or was vacuumed."""
        return {r["value"] for r in self.spark.read.text(self._folder("held", base)).collect()}

    def _parts(self, leave_out: Callable[[str], bool] = lambda name: False) -> tuple[str | None, set[str], list[str]]:
        """The newest base without any left-out delta, what it holds, and the deltas to add."""
        for base in reversed(self.versions("base")):
            held = self.folded(base)
            if not any(map(leave_out, held)):
                break
        else:
            base, held = None, set()
        return base, held, [v for v in self.versions("delta") if v not in held and not leave_out(v)]

    def _state(self, base: str | None, deltas: list[str]) -> DataFrame | None:
        paths = ([self._folder("base", base)] if base else []) + [self._folder("delta", v) for v in deltas]
        if not paths:
            return None
        state = self.spark.read.parquet(*paths)
        return combine_states(state, self.keys) if len(paths) > 1 else state

    def apply(self, batch: DataFrame, batch_id: int, run: str = "") -> None:
        """Merge one batch; calling it twice with the same run and id gives the same table."""
        self.write(batch, batch_id, run)
        self.fold()

    def write(self, batch: DataFrame, batch_id: int, run: str = "") -> None:
        """The batch's own partial merge, which readers see from now on."""
        state = merge_state(batch, self.keys, self.order, self.rules)
        state.write.mode("overwrite").parquet(self._folder("delta", batch_name(batch_id, run)))

    def fold(self, leave_out: Callable[[str], bool] = lambda name: False) -> None:
        """Combine the newest base with the deltas after it, when there are enough of them."""
        base, held, deltas = self._parts(leave_out)
        if len(deltas) >= self.fold_every:
            following = f"{int(base) + 1 if base else 0:012d}"
            names = self.spark.createDataFrame([(v,) for v in sorted(held.union(deltas))], "value string")
            names.coalesce(1).write.mode("overwrite").text(self._folder("held", following))
            self._state(base, deltas).write.mode("overwrite").parquet(self._folder("base", following))

    def read_only(self, names: set[str]) -> DataFrame | None:
        """The merged table of the batches named; None when none of them is there."""
        base, _, deltas = self._parts(lambda name: name not in names)
        state = self._state(base, deltas)
        return None if state is None else finish(state, self.keys, self.rules)

    def read(self, before: int | None = None, run: str = "") -> DataFrame | None:
        """The merged table, or what it was without batch ``before`` and later ones of that run; None when nothing is there."""
        first = None if before is None else batch_name(before, run)
        same_run = first[: -len(NUMBER.format(0))] if first else ""
        base, _, deltas = self._parts(
            lambda name: first is not None and len(name) == len(first) and name.startswith(same_run) and name >= first
        )
        state = self._state(base, deltas)
        return None if state is None else finish(state, self.keys, self.rules)

    def vacuum(self) -> None:
        """Remove all bases but the newest two, and the deltas that both of these hold."""
        bases = self.versions("base")
        if len(bases) < 2:
            return
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        held = self.folded(bases[-2])
        gone = [self._folder(kind, v) for kind in ("base", "held") for v in bases[:-2]]
        gone += [self._folder("delta", v) for v in self.versions("delta") if v in held]
        for path in gone:
            folder = hadoop.Path(path)
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def writer(self, shape: Callable[[DataFrame], DataFrame] = lambda df: df):
        """A batch function for `flows.start`, which names the run."""
        return lambda batch, batch_id, run="": self.apply(shape(batch), batch_id, run)


class TableGroup:
    """Several upsert tables and a cursor that move together.

    A batch first writes its part of every table, then one marker that holds the cursor. Readers follow the
    markers: a batch that was cut off between two tables has none, so nothing of it is seen, and when it is run again it
    writes the same folders once more. ``tables``: name to (keys, order, rules).
    """

    def __init__(self, spark: SparkSession, path: str, tables: Mapping[str, tuple], fold_every: int = 10):
        self.spark, self.path = spark, path.rstrip("/")
        self.tables = {n: SnapshotTable(spark, f"{self.path}/{n}", *spec, fold_every=fold_every) for n, spec in tables.items()}
        self.marks = SnapshotTable(spark, f"{self.path}/commits", [], [], {})

    def committed(self) -> set[str]:
        return set(self.marks.versions("mark"))

    def cursor(self) -> int | None:
        """The largest cursor that was committed."""
        names = self.committed()
        if not names:
            return None
        folders = [self.marks._folder("mark", n) for n in names]
        return self.spark.read.schema("cursor bigint").json(folders).agg({"cursor": "max"}).first()[0]

    def apply(self, parts: Mapping[str, DataFrame], cursor: int, batch_id: int, run: str = "") -> None:
        """Commit one batch of rows per table, and the cursor; a batch that is committed already is passed over."""
        name = batch_name(batch_id, run)
        if name in self.committed():
            return
        for table, rows in parts.items():
            self.tables[table].write(rows, batch_id, run)
        mark = self.spark.createDataFrame([(cursor,)], "cursor bigint").coalesce(1)
        mark.write.mode("overwrite").json(self.marks._folder("mark", name))
        done = self.committed()
        for table in self.tables.values():
            table.fold(lambda version: version not in done)

    def read(self, table: str) -> DataFrame | None:
        return self.tables[table].read_only(self.committed())


NUMBER = "{:012d}"


def batch_name(batch_id: int, run: str = "") -> str:
    """The name of a batch that no other batch of any run has."""
    return (f"{run}-" if run else "") + NUMBER.format(batch_id)


def idempotent_writer(path: str, shape: Callable[[DataFrame], DataFrame] = lambda df: df):
    """A batch function that appends each batch once: its folder is named by run and batch."""

    def write(batch: DataFrame, batch_id: int, run: str = "") -> None:
        shape(batch).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_name(batch_id, run)}")

    return write
