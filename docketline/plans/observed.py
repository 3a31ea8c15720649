"""Data tests counted in the pass that writes a table (Q1-Q5), by Spark's observed metrics.

``Watch`` counts a table's not_null and expression failures, and its relationships with parents whose keys are
small enough to broadcast, while the table is written: the tests then need no scan of it. ``run_tests`` takes
these counts as ``seen`` and runs only the other tests.

``BatchTests`` does the same for a table that grows by numbered merges. Each merge leaves its failures and its
distinct foreign keys. Rows of older merges may be replaced by later ones, so the sum over the live merges is an
upper bound: no failures and no orphan among the keys mean that the table has none; otherwise that one test is
counted on the table itself. A stage that Spark runs again can only raise a count, which costs a recount at most.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import BROADCAST_BYTES, frame_bytes
from ..operators.merge import NumberedFolders
from ..session import complete_children, delete_path, shuffles_dropped
from .checks import GOLD_TESTS, Test, run_tests

COUNTS_DDL = "column_name string, test string, failures bigint"
KEYS_DDL = "column_name string, key string"


def failure(t: Test) -> Column:
    """True where a row fails a not_null or expression test."""
    return F.col(t.column).isNull() if t.kind == "not_null" else ~F.expr(t.expression)


class Watch:
    """Counts the failures of ``model``'s tests in the rows that pass. ``parents``: tables of the relationships."""

    def __init__(self, model: str, parents: Mapping[str, DataFrame] | None = None, tests: list[Test] | None = None,
                 max_bytes: int = BROADCAST_BYTES):
        self.parents, self.metrics = {}, Observation()
        own = [t for t in (GOLD_TESTS if tests is None else tests) if t.model == model]
        for t in own:
            if t.kind == "relationships" and t.to in (parents or {}):
                keys = parents[t.to].where(F.col(t.field).isNotNull()).select(F.col(t.field)).distinct()
                if frame_bytes(keys) <= max_bytes:       # larger: the written key column is joined instead, not whole rows
                    self.parents[t] = keys
        self.tests = [t for t in own if t.kind in ("not_null", "expression") or t in self.parents]

    def over(self, df: DataFrame) -> DataFrame:
        """``df`` with its failures counted; to be written once."""
        cols, counts = df.columns, []
        for i, t in enumerate(self.tests):
            if t in self.parents:
                pk = f"__parent{i}"
                df = df.join(F.broadcast(self.parents[t].toDF(pk)), F.col(t.column) == F.col(pk), "left")
                fails = F.col(t.column).isNotNull() & F.col(pk).isNull()
            else:
                fails = failure(t)
            counts.append(F.count_if(fails).alias(f"f{i}"))
        return df.observe(self.metrics, *counts).select(*cols) if counts else df

    def seen(self) -> dict[Test, int]:
        """Failures by test, once the rows are written."""
        got = self.metrics.get if self.tests else {}
        return {t: got.get(f"f{i}", 0) for i, t in enumerate(self.tests)}


class BatchTests:
    """What the merges of ``table`` left about ``model``'s tests, under ``path``:

    ``counts/seq=<n>`` failures by test, ``keys/seq=<n>`` the distinct foreign keys (written first); ``upto=<n>`` instead
    of ``seq=<n>`` for a base.
    """

    def __init__(self, spark: SparkSession, path: str, model: str, table: NumberedFolders, tests: list[Test] | None = None):
        self.spark, self.path, self.model, self.table = spark, path, model, table
        self.tests = [t for t in (GOLD_TESTS if tests is None else tests) if t.model == model]
        self.links = [t for t in self.tests if t.kind == "relationships"]

    def watch(self) -> Watch:
        return Watch(self.model, tests=self.tests)

    def _keys_of(self, rows: DataFrame) -> DataFrame:
        pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("key"))
                 for c in sorted({t.column for t in self.links})]
        return rows.select(F.explode(F.array(*pairs)).alias("x")).select("x.*").where("key is not null").distinct()

    def _write(self, name: str, keys: DataFrame | None, counts: list[tuple[str, str, int]]) -> None:
        if keys is not None:
            with shuffles_dropped(self.spark):
                keys.write.mode("overwrite").parquet(f"{self.path}/keys/{name}")
        self.spark.createDataFrame(counts, COUNTS_DDL).coalesce(1).write.mode("overwrite").json(f"{self.path}/counts/{name}")

    def note(self, seq: int, watch: Watch) -> None:
        """Keep what ``watch`` counted while merge ``seq`` was written, and that merge's foreign keys."""
        self._write(f"seq={seq}", self._keys_of(self.table.delta(seq)) if self.links else None,
                    [(t.column, t.kind, n) for t, n in watch.seen().items()])

    def _count(self, name: str, rows: DataFrame) -> None:
        """The same for rows that are written already (a writer died before its note)."""
        got = run_tests({self.model: rows}, [t for t in self.tests if t.kind in ("not_null", "expression")])
        self._write(name, self._keys_of(rows) if self.links else None,
                    [(r["column_name"], r["test"], r["failures"]) for r in got.collect()])

    def _noted(self, kind: str) -> dict[int, str]:
        names = complete_children(self.spark, f"{self.path}/counts")
        return {int(n.split("=")[1]): n for n in names if n.startswith(f"{kind}=")}

    def fill(self) -> None:
        """Notes for merges that have none. Run it before the table's ``fold``."""
        have = self._noted("seq")
        for i in self.table.state(None)[1]:
            if i not in have:
                self._count(f"seq={i}", self.table.delta(i))

    def _live(self, upto: int | None) -> list[str]:
        """The notes that cover the table as of ``upto``: its base's, or those of the merges in it, and its deltas'."""
        self.fill()
        base, ids = self.table.state(upto)
        merges, bases = self._noted("seq"), self._noted("upto")
        out = [merges[i] for i in ids]
        if base and base[0] in bases:
            return [bases[base[0]], *out]
        if base:
            under = [n for notes in (merges, bases) for i, n in notes.items() if i <= base[0]]
            if not under:
                self._count(f"upto={base[0]}", self.table.read(base[0]))
                under = [f"upto={base[0]}"]
            out += under
        return out

    def _read(self, kind: str, names: list[str]) -> DataFrame:
        paths = [f"{self.path}/{kind}/{n}" for n in names]
        return (self.spark.read.schema(COUNTS_DDL).json(paths) if kind == "counts"
                else self.spark.read.schema(KEYS_DDL).parquet(*paths))

    def fold(self) -> None:
        """One note for the newest base in place of those of the merges in it. Run it after the table's ``fold``."""
        base, _ = self.table.state(None)
        if base is None or base[0] in self._noted("upto"):
            return
        old = self._live(base[0])
        sums = self._read("counts", old).groupBy("column_name", "test").agg(F.sum("failures").alias("failures")).collect()
        self._write(f"upto={base[0]}", self._read("keys", old).distinct() if self.links else None, [tuple(r) for r in sums])
        for n in set(old) - {f"upto={base[0]}"}:
            delete_path(self.spark, f"{self.path}/counts/{n}")
            delete_path(self.spark, f"{self.path}/keys/{n}")

    def seen(self, parents: Mapping[str, DataFrame], upto: int | None = None) -> dict[Test, int]:
        """The tests that no live merge fails, each with 0 failures. What is not in it is to be counted on the table."""
        ids = self._live(upto)
        if not ids:
            return {t: 0 for t in self.tests if t.kind != "unique"}
        sums = {(r[0], r[1]): r[2] for r in self._read("counts", ids).groupBy("column_name", "test").agg(F.sum("failures")).collect()}
        clean = [t for t in self.tests if t.kind in ("not_null", "expression") and sums.get((t.column, t.kind)) == 0]
        keys = self._read("keys", ids).distinct() if self.links else None
        for t in self.links:
            have = parents[t.to].select(F.col(t.field).cast("string").alias("key"))
            if keys.where(F.col("column_name") == t.column).join(have, "key", "left_anti").isEmpty():
                clean.append(t)
        return {t: 0 for t in clean}
