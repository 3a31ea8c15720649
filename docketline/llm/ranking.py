"""Places of rows within groups of any size, without a group ever meeting in one task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketline.llm.common import materialise


def ranked(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], name: str) -> DataFrame:
    """``df`` with ``rank``: each row's place (from 0) within its group, in ascending order, nulls first.

    Rows are dealt by range of (group, order, row number), so a group of any size, and rows that are alike in all of them,
    spread over tasks; each task numbers its own rows in one pass. Only the group that a task begins with can
    have rows in earlier tasks: one row per task is gathered to find how many. The result is a written table, sorted by
    group and order within files. Columns named ``_group``, ``_tie``, ``_part``, ``_run`` or ``rank`` are not allowed. Groups are told
    apart by a 64-bit hash between neighbours only. An empty table stays empty.
    """
    keys = [F.col(g) if isinstance(g, str) else g for g in [*group, *order]]
    rows = df.withColumn("_tie", F.monotonically_increasing_id()).withColumn("_group", F.xxhash64(F.lit(len(group)), *[
        x for g in group for x in (F.col(g).isNull(), F.col(g))]))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(n, *keys, "_tie").sortWithinPartitions(*keys, "_tie").drop("_tie")
    schema = T.StructType([*rows.schema.fields, T.StructField("rank", T.LongType()), T.StructField("_part", T.IntegerType()),
                           T.StructField("_run", T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen, run = TaskContext.get().partitionId(), None, 0, -1
        for b in batches:
            if not b.num_rows:
                continue
            g = b.column("_group").to_numpy()
            new = np.r_[last is None or g[0] != last, g[1:] != g[:-1]]
            at = np.arange(len(g))
            head = np.maximum.accumulate(np.where(new, at, -1))
            rank = np.where(head < 0, at + seen, at - head)
            runs = run + np.cumsum(new)
            last, seen, run = g[-1], int(rank[-1]) + 1, int(runs[-1])
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(rank, pa.int64()), pa.array(np.full(len(g), part), pa.int32()), pa.array(runs, pa.int64())],
                names=[*b.schema.names, "rank", "_part", "_run"])

    rows = materialise(rows.mapInArrow(number, schema), name)
    ends = sorted(rows.groupBy("_part").agg(
        F.min_by("_group", "_run").alias("first"), F.max_by("_group", "_run").alias("last"), F.max("_run").alias("runs"),
        F.max_by("rank", F.struct("_run", "rank")).alias("top")).collect(), key=lambda r: r["_part"])
    before, carry, group_now = {}, 0, None
    for r in ends:
        if r["first"] == group_now:
            before[r["_part"]] = carry
        else:
            carry = 0
        carry = (carry if r["runs"] == 0 else 0) + r["top"] + 1
        group_now = r["last"]
    if before:
        shift = df.sparkSession.createDataFrame(list(before.items()), "_part int, _before long")
        rows = rows.join(F.broadcast(shift), "_part", "left").withColumn(      # a row per task at most
            "rank", F.when(F.col("_run") == 0, F.col("rank") + F.coalesce("_before", F.lit(0))).otherwise(F.col("rank"))).drop("_before")
    return rows.drop("_part", "_run", "_group")
