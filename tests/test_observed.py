"""Data tests counted while writing."""
import pytest
from pyspark.sql import functions as F

from docketline.plans.checks import Test, run_tests
from docketline.plans.fact import build_fact
from docketline.plans.medallion import Medallion
from docketline.plans.observed import Watch
from docketline.plans.warehouse import gold
from docketline.session import delete_path

from .conftest import SF_SMALL
from .test_medallion import STAMP, hit, land
from .test_plans import plan

TESTS = [Test("t", "a", "not_null"), Test("t", "a", "expression", expression="a > 0"),
         Test("t", "k", "relationships", to="p", field="k")]


@pytest.mark.parametrize("data", [[(1, "x"), (None, "y"), (-1, None), (-1, "z"), (None, "z")], []])
def test_watch_counts_what_the_tests_count(spark, tmp_path, data):
    df = spark.createDataFrame(data, "a int, k string")
    parents = {"p": spark.createDataFrame([("x",), ("y",), ("y",), (None,)], "k string")}
    watch = Watch("t", parents, TESTS)
    watch.over(df).write.parquet(f"{tmp_path}/t")
    back = spark.read.parquet(f"{tmp_path}/t")
    assert back.count() == len(data) and back.columns == ["a", "k"]
    want = {(r.column_name, r.test): r.failures for r in run_tests({"t": back, **parents}, TESTS).collect()}
    assert {(t.column, t.kind): n for t, n in watch.seen().items()} == want
    assert sum(want.values()) == (6 if data else 0)


def test_large_parents_are_left_to_the_table(spark):
    parents = {"p": spark.createDataFrame([("x",)], "k string")}
    assert [t.kind for t in Watch("t", parents, TESTS, max_bytes=1).tests] == ["not_null", "expression"]


def test_seen_tests_do_not_scan_the_fact(spark):
    g = gold(spark, SF_SMALL)
    tables = {t: df for t, df in g.tables().items() if t != "silver"}
    watch = Watch("fato_movimentos", tables)
    df = run_tests(tables, seen={t: 0 for t in watch.tests})
    assert "dim_orgaos" in plan(df, "extended") and not any("fato_movimentos" in f for f in df.inputFiles())
    assert any("fato_movimentos" in f for f in run_tests(tables).inputFiles())
    stored = {tuple(r) for r in g.test_results().collect()}
    assert stored == {tuple(r) for r in run_tests(tables).collect()}


def test_batches_leave_bounds_and_failing_tests_are_counted(spark, tmp_path):
    root = str(tmp_path)
    p = Medallion(spark, root, STAMP)
    land(root, "one", hit("A", (1, "a", "2019-12-01"), (2, "b", "2020-02-01")), hit("B", (1, "c", "2020-01-02")))
    p.ingest(f"{root}/landing/*/*.json")
    p.publish()
    negative = next(t for t in p.fact_tests.tests if t.kind == "expression")
    dims = {t.to: p.gold().table(t.to) for t in p.fact_tests.links}
    assert set(p.fact_tests.seen(dims)) == set(p.fact_tests.tests) - {negative}
    exact = {(r.column_name, r.test): r.failures for r in p.fact_results().collect()}
    assert exact.pop(("dias_desde_ajuizamento", "expression")) == 1 and not any(exact.values())
    # an orphan key in any live merge is not taken for clean
    few = {t: df.where(F.lit(False)) for t, df in dims.items()}
    assert not any(t.kind == "relationships" for t in p.fact_tests.seen(few))
    # a writer that died before its note, then a fold: the bound still covers all merges
    land(root, "two", hit("C", (1, "a", "2020-03-01")))
    p.ingest(f"{root}/landing/*/*.json")
    delete_path(spark, f"{root}/fact_tests/counts/seq=1")
    delete_path(spark, f"{root}/fact_tests/keys/seq=1")
    before = p.fact_tests.seen(dims)
    p.fold()
    assert p.fact_tests.seen(dims) == before and list(p.fact_tests._noted("upto")) == [1] and not p.fact_tests._noted("seq")
    p.publish()
    assert p.fact_results().where("failures > 0").count() == 1
    assert {t.kind for t in p.fact_tests.seen(dims)} == {"not_null", "relationships"}


def test_null_keys_stop_the_publication(spark, tmp_path, monkeypatch):
    from docketline.plans import medallion
    root = str(tmp_path)
    land(root, "one", hit("A", (1, "a", "2020-01-01")))
    p = Medallion(spark, root, STAMP)
    monkeypatch.setattr(medallion, "build_fact", lambda s: build_fact(s).withColumn("fk_classe", F.lit(None).cast("string")))
    p.ingest(f"{root}/landing/*/*.json")
    with pytest.raises(RuntimeError, match="1 error"):
        p.publish()
