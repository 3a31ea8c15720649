"""What is written, kept and dealt again at size."""

import glob
import os
import time
import uuid

from pyspark.sql import functions as F

from docketline import registry
from docketline.operators import merge as M, windows as W
from docketline.operators.merge import CaseTable, NumberedFolders
from docketline.operators.tails import EventTails
from docketline.plans.medallion import Medallion
from docketline.plans.silver import build_silver
from docketline.plans.warehouse import materialize
from docketline.schemas import CORRUPT, SILVER_DDL
from docketline.session import path_exists, work_dir
from docketline.sources import fixtures

from .conftest import SF_SMALL, rows
from .helpers import ev, flat

STAMP = "2021-01-01 00:00:00"


def shuffle_bytes(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*.data")}


def settled(spark, before):
    """The shuffle files that stay behind (they go a little after their query)."""
    for _ in range(40):
        left = shuffle_bytes(spark) - before
        if not left:
            break
        time.sleep(0.25)
    return left


def build(df):
    return build_silver(df, processed_at=STAMP)


def test_writes_give_their_shuffles_back(spark):
    """maintained_volume, maintained_bands, gate_keeps_published: a table's write leaves no shuffle on disk."""
    b1, b2 = fixtures.movement_batches(spark, SF_SMALL)
    t = CaseTable(spark, work_dir(spark, "t", uuid.uuid4().hex), "numero_processo", SILVER_DDL)
    before = shuffle_bytes(spark)
    t.put("b1", build(b1))
    t.merge("b2", b2, build)
    left = settled(spark, before)
    assert not left
    materialize(spark, SF_SMALL, force=True)
    assert sum(map(os.path.getsize, settled(spark, before))) < 10_000         # verdicts of a row or two


def test_maintained_sums_keep_no_merged_batch(spark):
    """maintained_volume, maintained_bands: what the folded base holds is not kept as deltas and a landing too."""
    sums = registry._maintained(spark, SF_SMALL)
    base = sums.silver.bases()[-1][0]
    assert all(d > base for d in sums.silver.deltas())
    assert not path_exists(spark, f"{sums.path.removesuffix('/sums')}/landed")


def test_evolved_landings_are_compressed(spark, monkeypatch):
    """append_evolve."""
    how, write = [], registry.write_hits
    monkeypatch.setattr(registry, "write_hits", lambda *a, **k: how.append(k.get("compression")) or write(*a, **k))
    assert registry.QUERIES["append_evolve"](spark, SF_SMALL).count() == 5
    assert how == ["gzip", "gzip"]


def test_a_base_is_folded_by_many_tasks(spark, monkeypatch):
    """end_to_end_kpi, tests_by_batch: a fold and a merge into a base of 300 MB ran in two tasks."""
    t = CaseTable(spark, work_dir(spark, "t", uuid.uuid4().hex), "numero_processo", SILVER_DDL)
    t.put("b", build(flat(spark, [ev("A", 1, "2020-01-01"), ev("B", 1, "2020-01-02")], "2021-01-01")))
    monkeypatch.setattr(M, "folder_bytes", lambda *_: 300 << 20)
    t.fold()
    assert t.bases()[-1][1] >= 8 and t.read().count() == 2


def test_a_first_append_moves_nothing_after_its_build(spark, monkeypatch):
    """tail_append: counts per case come with the build's rows."""
    plans, put = [], NumberedFolders.put
    monkeypatch.setattr(NumberedFolders, "put", lambda self, source, rows, seq=None: plans.append(
        rows._jdf.queryExecution().executedPlan().toString()) or put(self, source, rows, seq))
    t = EventTails(spark, work_dir(spark, "t", uuid.uuid4().hex), SILVER_DDL, build)
    a = flat(spark, [ev("A", 1, "2020-01-01"), ev("A", 2, "2020-01-05"), ev(None, 1, "2020-01-01")], "2021-01-01")
    b = flat(spark, [ev("A", 3, "2020-02-01"), ev(None, 1, "2019-01-01")], "2021-02-01")
    t.append("a", a)
    assert len(plans) == 2 and not any("Exchange" in p for p in plans)
    t.append("b", b)
    key = ["numero_processo", "codigo_movimento", "data_movimento", "dias_desde_ultimo_movimento", "is_ultimo_movimento"]
    assert rows(t.read(), *key) == rows(build(a.unionByName(b)), *key)
    assert rows(t.tail.read(), "numero_processo", "__n", "__since") == [("A", 3, 0), (None, 2, 1)]


def test_hot_cases_are_made_once(spark, monkeypatch):
    """stream_upsert_silver: the hot cases are read three times, and were made anew each time."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def counted(n):
        made.add(1)
        return n

    events = [ev("A", i, f"2020-01-0{i}") for i in range(1, 7)] + [ev("B", 1, "2020-01-01")]
    df = flat(spark, events)
    hot = spark.createDataFrame([("A", 6)], "numero_processo string, __n bigint").select("numero_processo", counted("__n").alias("__n"))
    got = W.case_metrics(df, hot_case_rows=4, hot=hot, slice_rows=2)
    assert rows(got, "numero_processo", "codigo_movimento", "is_ultimo_movimento") == sorted(
        [("A", i, i == 6) for i in range(1, 7)] + [("B", 1, True)], key=repr)
    assert made.value == 1


def test_completeness_moves_bronze_keys_once(spark):
    """end_to_end_kpi, tests_by_batch: hits that bronze holds twice count once, without a pass of their own."""
    p = Medallion(spark, work_dir(spark, "t", uuid.uuid4().hex), processed_at=STAMP)
    hits = fixtures.bronze_hits(spark, SF_SMALL).withColumn(CORRUPT, F.lit(None).cast("string"))
    for tag in ("a", "again"):
        p.bronze_table.put(tag, hits)
    p.refresh()
    got = p.completeness()
    assert got.first()["failures"] == 0
    assert "Distinct" not in got._jdf.queryExecution().analyzed().toString()
