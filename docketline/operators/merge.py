"""Upserts without a table format.

``upsert`` is the reference's MERGE (matched -> replace, else insert) on
null-safe keys, expressed as anti-join + union. ``merge_cases`` is the
incremental unit we use instead: a batch *touches* cases, and every touched
case is recomputed whole from its old rows plus the batch, so gaps and the
latest flag stay right when events arrive late or out of order.

``CaseTable`` keeps a case-keyed table as a base and deltas in plain parquet
folders. A batch writes the touched cases, rebuilt, into its own folder and
nothing else, so a small batch writes little, and no reader ever sees half a
write. A folder's number is the table's own: it follows the order in which
batches were *merged*, each on top of the newest state, and the folder's name
says which source batch it holds. A source that finishes late, or is offered twice, is
therefore merged once, whatever its own number. ``fold`` writes a new base, bucketed
by the case, so that a merge reads the touched buckets only and joins without
moving the base. One writer at a time; readers need no care.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import complete_children, delete_path, folder_bytes, shuffles_dropped
from .joins import null_safe_condition, shuffle_join
from .windows import dedup_latest

# Bytes of parquet per bucket of a base: a bucket is written, sorted and read by one task.
BUCKET_BYTES = 32 << 20
# Up to so many touched cases are looked up as literals, which the scan prunes buckets and row groups by.
PRUNE_CASES = 10_000
KEY = "__chave"
# Marks the rows of a batch among stored ones.
NEW = "__novo"


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           order_by: Sequence[str] = ()) -> DataFrame:
    """Rows of ``source`` replace target rows with equal keys (``<=>``); others insert.

    The source is first reduced to one row per key (W4).
    """
    src = dedup_latest(source, keys, order_by).select(*target.columns)
    k = src.select(*keys)
    kept = shuffle_join(target, k, null_safe_condition(target, k, keys), "left_anti")
    return kept.unionByName(src)


def merge_cases(existing: DataFrame, batch: DataFrame, case: str,
                rebuild: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Touched-case incremental merge.

    ``existing`` holds derived rows; ``batch`` raw rows of the same flat shape
    plus whatever ``rebuild`` needs. Untouched cases pass through unchanged;
    touched cases are rebuilt from their old rows and the batch. ``rebuild``
    decides between copies of an event by the stored ingest time, so the
    result does not depend on the order of the batches.
    """
    cases, same = batch.select(F.col(case).alias("__case")).distinct(), F.col(case).eqNullSafe(F.col("__case"))
    keep = existing.join(cases, same, "left_anti")
    old = existing.join(cases, same, "left_semi")
    return keep.unionByName(rebuild(old.unionByName(batch, allowMissingColumns=True)).select(*keep.columns))


def bucket_of(case: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(case), F.lit(buckets)).cast("int")


def case_key(case: str | Column) -> Column:
    """A case as a text that is never null (a null case has a key of its own), for plain equality joins."""
    c = F.col(case) if isinstance(case, str) else case
    return F.coalesce(F.concat(F.lit("c"), c.cast("string")), F.lit("n"))


class Cases:
    """The cases of a batch: as literals while they are few, as distinct keys in any case."""

    def __init__(self, rows: DataFrame, case: str, most: int = PRUNE_CASES):
        keys = rows.select(case_key(case).alias(KEY))
        self.keys, self.few = keys.distinct(), None
        # counted roughly first, which moves no key: a batch of many cases deals its keys once, for the join
        with shuffles_dropped(rows.sparkSession):
            if keys.agg(F.approx_count_distinct(KEY)).first()[0] <= 2 * most:
                found = self.keys.limit(most + 1).collect()  # bounded by ``most``
                self.few = [r[0] for r in found] if len(found) <= most else None

    def of(self, df: DataFrame, buckets: int | None = None) -> DataFrame:
        """The rows of ``df`` (with its key column) that belong to these cases.

        Few cases: a literal filter, no join. Many: a merge join; ``df`` bucketed by the key stays where it
        is, the keys are dealt like its buckets.
        """
        if self.few is not None:
            return df.where(F.col(KEY).isin(self.few)) if self.few else df.limit(0)
        keys = self.keys.repartition(buckets, KEY) if buckets else self.keys
        return df.join(keys.hint("merge"), KEY, "left_semi")


class NumberedFolders:
    """A case-keyed parquet table as numbered deltas and bucketed bases.

    ``<path>/delta/seq=<n>~<source>``    what source batch ``source`` wrote, as the n-th merge
    ``<path>/base/upto=<n>~<buckets>``   the state as of merge n, bucketed and sorted by the case
    ``<path>/sources/upto=<n>``          the sources that a base holds, written before it

    Folders without a committed write are not seen.
    """

    def __init__(self, spark: SparkSession, path: str, case: str, schema: str | T.StructType,
                 partition_by: Sequence[str] = ()):
        self.spark, self.path, self.case, self.parts = spark, path, case, list(partition_by)
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.stored = T.StructType([T.StructField(KEY, T.StringType()), *self.schema.fields])

    # -- what there is
    def _deltas(self) -> dict[int, str]:
        names = complete_children(self.spark, f"{self.path}/delta")
        return {int(n.removeprefix("seq=").split("~")[0]): n for n in sorted(names)}

    def deltas(self) -> list[int]:
        return sorted(self._deltas())

    def bases(self) -> list[tuple[int, int]]:
        """(last merge, buckets) of each base, oldest first."""
        names = complete_children(self.spark, f"{self.path}/base")
        return sorted(tuple(int(x) for x in n.removeprefix("upto=").split("~")) for n in names)

    def newest(self) -> int:
        """The number of the newest merge, -1 if there is none."""
        return max([-1, *self._deltas(), *(b for b, _ in self.bases())])

    def sources(self) -> set[str]:
        """The source batches that the table holds."""
        bases, out = self.bases(), {n.split("~", 1)[1] for n in self._deltas().values()}
        if bases:
            out |= {r[0] for r in self.spark.read.schema("source string").json(f"{self.path}/sources/upto={bases[-1][0]}").collect()}
        return out

    def state(self, upto: int | None) -> tuple[tuple[int, int] | None, list[int]]:
        """The base to read, and the deltas on top of it."""
        base = max((b for b in self.bases() if upto is None or b[0] <= upto), default=None)
        low = -1 if base is None else base[0]
        return base, [d for d in self.deltas() if d > low and (upto is None or d <= upto)]

    # -- reading
    def read_base(self, base: tuple[int, int]) -> DataFrame:
        """A base as a bucketed table: the session's catalog gets its layout, the files stay where they are."""
        path = f"{self.path}/base/upto={base[0]}~{base[1]}"
        name = f"docketline_base_{hashlib.md5(path.encode()).hexdigest()}"
        if not self.spark.catalog.tableExists(name):
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.stored.fields)
            parts = f"PARTITIONED BY ({', '.join(self.parts)})" if self.parts else ""
            self.spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet {parts} CLUSTERED BY ({KEY}) SORTED BY ({KEY}) "
                           f"INTO {base[1]} BUCKETS LOCATION '{path}'")
            if self.parts:
                self.spark.catalog.recoverPartitions(name)
        return self.spark.table(name).select(*self.stored.names)

    def read_deltas(self, ids: list[int]) -> DataFrame:
        """Rows of some deltas with ``seq``, as one scan: the number is the folder's name up to its '~'.

        No union of scans: a semi join goes down into its parts, and what is above then counts on the parts' common
        partitioning, which adaptive execution may change ("Can't zip RDDs with unequal numbers of partitions").
        """
        names, root = self._deltas(), f"{self.path}/delta"
        found = self.spark.read.schema(T.StructType([*self.stored.fields, T.StructField("seq", T.StringType())])).option(
            "basePath", root).parquet(*[f"{root}/{names[i]}" for i in ids])
        return found.withColumn("seq", F.substring_index("seq", "~", 1).cast("long")).select(*self.stored.names, "seq")

    # -- writing
    def order(self) -> str:
        """What a delta's files are sorted by. A text's key has the text's order, in which rows come from a window over the case:
        they are not sorted again."""
        return self.case if isinstance(self.schema[self.case].dataType, T.StringType) else KEY

    def put(self, source: int | str, rows: DataFrame, seq: int | None = None) -> int | None:
        """Write the rows that a source batch changes, as the next merge; its number, or None if the source is in the table already."""
        token = str(source)
        if "~" in token or "/" in token:
            raise ValueError(f"a source's name holds neither '~' nor '/': {token}")
        if token in self.sources():
            return None
        seq = self.newest() + 1 if seq is None else seq
        w = (rows.withColumn(KEY, case_key(self.case)).select(*self.stored.names).sortWithinPartitions(self.order()).write.mode("overwrite"))
        with shuffles_dropped(self.spark):
            (w.partitionBy(*self.parts) if self.parts else w).parquet(f"{self.path}/delta/seq={seq}~{token}")
        return seq

    def write_base(self, rows: DataFrame, upto: int) -> None:
        """A new base, in buckets whose number follows the size of the files it replaces."""
        base, ids = self.state(upto)
        names = self._deltas()
        size = sum(folder_bytes(self.spark, p) for p in (
            *([f"{self.path}/base/upto={base[0]}~{base[1]}"] if base else []), *(f"{self.path}/delta/{names[i]}" for i in ids)))
        buckets = 1 << max(0, math.ceil(math.log2(max(1, size / BUCKET_BYTES))))
        self.spark.createDataFrame([(s,) for s in sorted(self.sources())], "source string").write.mode("overwrite").json(
            f"{self.path}/sources/upto={upto}")
        path = f"{self.path}/base/upto={upto}~{buckets}"
        name = f"docketline_fold_{hashlib.md5(path.encode()).hexdigest()}"
        w = (rows.withColumn(KEY, case_key(self.case)).select(*self.stored.names).repartition(buckets, KEY).write.format("parquet")
             .mode("overwrite").bucketBy(buckets, KEY).sortBy(KEY).option("path", path))
        with shuffles_dropped(self.spark):
            (w.partitionBy(*self.parts) if self.parts else w).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")                 # external: the files stay

    def clean(self, keep_bases: int = 1) -> None:
        """Delete what no reader of the newest ``keep_bases`` bases needs. Run it when no older version is read."""
        kept = self.bases()[-keep_bases:]
        if not kept:
            return
        for b in self.bases()[:-keep_bases]:
            delete_path(self.spark, f"{self.path}/base/upto={b[0]}~{b[1]}")
        for d, name in self._deltas().items():
            if d <= kept[0][0]:
                delete_path(self.spark, f"{self.path}/delta/{name}")


class CaseTable(NumberedFolders):
    """A case-keyed table whose deltas hold whole cases: a case's rows are those of its newest delta, else the base's."""

    def _union(self, base: DataFrame | None, delta: DataFrame | None, ids: list[int], buckets: int = 0) -> DataFrame:
        cols = [KEY, *self.schema.names]
        if delta is None:
            return base.select(*cols) if base is not None else self.spark.createDataFrame([], self.stored)
        rows = delta
        if len(ids) > 1:                                     # the newest delta counts whole: only the others are compared, and moved
            later = delta.where(F.col("seq") > ids[0]).groupBy(KEY).agg(F.max("seq").alias("__later"))
            rows = (delta.where(F.col("seq") < ids[-1]).join(later, KEY, "left").where("__later IS NULL OR __later <= seq").select(*cols)
                    .unionByName(delta.where(F.col("seq") == ids[-1]).select(*cols)))
        if base is None:
            return rows.select(*cols)
        keys = delta.select(KEY).distinct()
        keys = keys.repartition(buckets, KEY) if buckets else keys       # dealt like the base's buckets
        return base.join(keys.hint("merge"), KEY, "left_anti").select(*cols).unionByName(rows.select(*cols))

    def _read(self, upto: int | None, cases: Cases | None = None) -> DataFrame:
        base, ids = self.state(upto)
        kept = self.read_base(base) if base else None
        delta = self.read_deltas(ids) if ids else None
        if cases is not None:
            kept = cases.of(kept, base[1]) if kept is not None else None
            delta = cases.of(delta) if delta is not None else None
        return self._union(kept, delta, ids, base[1] if base else 0)

    def read(self, upto: int | None = None) -> DataFrame:
        """The table as of a merge (default: the newest)."""
        return self._read(upto).select(*self.schema.names)

    def read_cases(self, cases: Cases, upto: int | None = None) -> DataFrame:
        """The rows of some cases: with few of them, of their buckets only."""
        return self._read(upto, cases).select(*self.schema.names)

    def read_case(self, case: str) -> DataFrame:
        """One case's rows: one bucket of the base, and a pushed filter on the deltas."""
        one = self.spark.range(1).select(F.lit(case).cast("string").alias(self.case))
        return self.read_cases(Cases(one, self.case))

    def delta(self, seq: int) -> DataFrame:
        """The rows that merge ``seq`` wrote."""
        return self.read_deltas([seq]).select(*self.schema.names)

    def marked(self, batch: DataFrame, batch_bytes: int) -> DataFrame | None:
        """All stored rows and the batch's, these marked in ``NEW``, for a rebuild that picks the touched cases where it gathers them.

        Without a base, a look-up deals all stored rows, and those it finds again for the rebuild: so they are dealt once.
        None where there is a base, which a look-up does not move, or the batch is small beside what is stored.
        """
        base, names = self.state(None)[0], self._deltas()
        if base or batch_bytes * 10 < sum(folder_bytes(self.spark, f"{self.path}/delta/{n}") for n in names.values()):
            return None
        return self.read().withColumn(NEW, F.lit(False)).unionByName(batch.withColumn(NEW, F.lit(True)), allowMissingColumns=True)

    def merge(self, source: int | str, rows: DataFrame, rebuild: Callable[..., DataFrame], picks: bool = False) -> int | None:
        """Rebuild the cases that ``rows`` touch, from the newest state, and put them; None if ``source`` is in already.

        ``picks``: ``rebuild`` takes a second argument, a boolean column, and drops the cases that have no row marked in it.
        """
        if str(source) in self.sources():
            return None
        if self.newest() < 0:                                # nothing is stored: no case to look up
            return self.put(source, rebuild(self.read().unionByName(rows, allowMissingColumns=True)))
        # read three times (keys twice, rows): written once, so that a batch that is joined or parsed is made once
        stage = f"{self.path}/stage/seq={self.newest() + 1}"
        rows = rows.drop(*[c for c, t in rows.dtypes if t == "void" and c in self.schema.names])    # the union gives these back
        with shuffles_dropped(self.spark):
            rows.write.mode("overwrite").parquet(stage)
        staged = self.spark.read.schema(rows.schema).parquet(stage)
        whole = self.marked(staged, folder_bytes(self.spark, stage)) if picks else None
        if whole is None:
            old = self.read_cases(Cases(staged, self.case))
            built = rebuild(old.unionByName(staged, allowMissingColumns=True))
        else:
            built = rebuild(whole, NEW)
        seq = self.put(source, built)
        delete_path(self.spark, stage)
        return seq

    def fold(self) -> None:
        """A new base of the current state."""
        ids = self.deltas()
        if ids and ids[-1] > max((b for b, _ in self.bases()), default=-1):
            self.write_base(self.read(), ids[-1])
