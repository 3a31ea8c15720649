"""The case table: what a merge reads and moves, and batches that finish late."""

import uuid

import pytest
from pyspark.sql import functions as F

from docketline.operators import merge as M
from docketline.operators.merge import KEY, Cases, CaseTable
from docketline.plans.medallion import Medallion
from docketline.plans.silver import build_silver
from docketline.schemas import SILVER_DDL
from docketline.session import delete_path, work_dir
from docketline.sources import fixtures

from .conftest import SF_SMALL
from .test_medallion import STAMP, everything, hit, land


def scans(df):
    """(rows read, files read) by the file scans of a frame that has run."""
    df.collect()
    out = []

    def walk(p):
        kind = p.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(p.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(p.plan())
        if kind == "FileSourceScanExec":
            m = p.metrics()
            out.append((m.apply("numOutputRows").value(), p.relation().location().getClass().getSimpleName()))
        c = p.children()
        for i in range(c.size()):
            walk(c.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return out


def under_base(plan: str) -> list[str]:
    """The nodes above the scan of a base, nearest first, up to the first join."""
    lines = plan.splitlines()
    at = next(i for i, x in enumerate(lines) if "FileScan" in x and "docketline_base" in x)
    depth, out = lines[at].index("FileScan"), []
    for x in reversed(lines[:at]):
        name = x.lstrip(" :+-*()0123456789")
        here = len(x) - len(name)
        if here < depth:
            depth = here
            out.append(name.split(" ")[0])
            if "Join" in name:
                break
    return out


@pytest.fixture
def stored(spark, monkeypatch):
    monkeypatch.setattr(M, "BUCKET_BYTES", 20_000)
    t = CaseTable(spark, work_dir(spark, "t", uuid.uuid4().hex), "numero_processo", SILVER_DDL)
    m = fixtures.movements(spark, SF_SMALL).withColumn("data_ingestao", F.to_timestamp(F.lit("2021-01-01")))
    t.merge("first", m, lambda rows: build_silver(rows, processed_at=STAMP))
    t.fold()
    t.clean()
    return t, m


def test_a_small_batch_reads_its_buckets_only(spark, stored):
    t, m = stored
    assert t.bases()[0][1] >= 8
    some = [r[0] for r in m.select("numero_processo").distinct().orderBy("numero_processo").limit(1).collect()]
    cases = Cases(m.where(F.col("numero_processo").isin(some)), "numero_processo")
    got = t.read_cases(cases)
    assert sum(n for n, _ in scans(got)) <= m.count() / t.bases()[0][1] * 3
    assert got.count() == m.where(F.col("numero_processo").isin(some)).count()
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()


def test_many_cases_join_without_moving_the_base(spark, stored):
    t, m = stored
    cases = Cases(m, "numero_processo", most=10)
    assert cases.few is None
    got = t.read_cases(cases)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in under_base(plan) if "Exchange" in x] and under_base(plan)[-1].endswith("Join")
    assert got.count() == m.count()
    # readers of base and deltas do not move the base either
    t.merge("second", m.limit(40).withColumn("data_ingestao", F.to_timestamp(F.lit("2021-02-01"))),
            lambda rows: build_silver(rows, processed_at=STAMP))
    plan = t.read()._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in under_base(plan) if "Exchange" in x] and under_base(plan)[-1].endswith("Join")
    assert t.read().count() == m.count()


def test_sources_are_merged_once_and_survive_folds(spark, stored):
    t, m = stored
    assert t.sources() == {"first"} and t.deltas() == []
    assert t.merge("first", m.limit(5), lambda rows: rows) is None
    with pytest.raises(ValueError):
        t.put("a~b", t.read())
    assert KEY not in t.read().columns


@pytest.mark.parametrize("fold", [False, True])
def test_a_batch_that_finishes_late_is_not_lost(spark, tmp_path, fold):
    root = str(tmp_path)
    land(root, "one", hit("A", (1, "a", "2020-01-01"), (2, "a", "2020-01-05")), hit("B", (1, "b", "2020-01-02")))
    p = Medallion(spark, root, STAMP)
    p.ingest(f"{root}/landing/*/*.json")
    # micro-batch 0 is taken back to the moment before its commit, before silver saw it
    for folder in ("silver", "fact"):
        delete_path(spark, f"{root}/{folder}")
    delete_path(spark, f"{root}/bronze/batch=0~s0/_SUCCESS")
    extra = land(root, "two", hit("A", (3, "c", "2020-02-01")), hit("C", (1, "x", "2020-03-01")), court="TJPR")
    p = Medallion(spark, root, STAMP)
    p.reload(extra)
    if fold:
        p.fold()
    assert {r[0] for r in p.silver().select("numero_processo").collect()} == {"A", "C"}
    # ... and now it is complete
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/bronze/batch=0~s0/_SUCCESS")
    fs.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(fs).close()
    assert p.completeness().first()["failures"] == 3
    with pytest.raises(RuntimeError):
        p.publish()
    p.refresh()
    assert p.completeness().first()["failures"] == 0
    p.publish()
    got = p.gold().fato.select("numero_processo", "codigo_movimento", "dias_desde_ultimo_movimento", "is_ultimo_movimento")
    assert everything(got) == [("A", 1, None, False), ("A", 2, 4, False), ("A", 3, 27, True), ("B", 1, None, True), ("C", 1, None, True)]
