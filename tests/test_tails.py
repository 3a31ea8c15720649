"""W1/W2 carried across batches, and reports kept from touched cases."""

import uuid

import pytest
from pyspark.sql import functions as F

from docketline.operators import merge as M
from docketline.operators.merge import CaseTable
from docketline.operators.tails import EventTails
from docketline.plans import maintained, reports as R
from docketline.plans.dims import dim_calendario, dim_classes, dim_tribunais, calendar_bounds, silver_groups
from docketline.plans.fact import build_fact
from docketline.plans.maintained import MaintainedReports
from docketline.plans.silver import build_silver
from docketline.schemas import SILVER_DDL
from docketline.session import delete_path, work_dir

from .conftest import rows
from .helpers import ev, flat
from .test_medallion import STAMP, everything

BATCHES = [
    [ev("A", 1, "2020-01-01"), ev("A", 2, "2020-01-05"), ev("B", 1, None), ev("B", 2, "2020-03-01"), ev(None, 1, "2020-01-01"), ev("C", 5, "2020-01-01")],
    [ev("A", 3, "2020-02-01"), ev("A", 4, "2020-02-01"), ev(None, 2, "2020-05-01"), ev("D", 1, "2020-06-01"), ev("C", 6, "2020-01-01")],   # in order
    [ev("A", 9, "2020-01-03"), ev("B", 3, "2020-04-01"), ev("D", 1, "2020-06-01", name="again"), ev("C", 7, None)],                       # late, repeated
    [ev("A", 5, "2020-09-01"), ev("B", 1, None, name="again"), ev("E", 1, None), ev("D", 2, "2020-07-01", court="TJPR")],
    [],
    [ev("E", 2, None), ev("E", 3, "2020-01-01"), ev("A", 5, "2020-09-01", name="again")],
]


def build(rows):
    return build_silver(rows, processed_at=STAMP)


def batches(spark):
    return [flat(spark, b, f"2021-0{i + 1}-01") for i, b in enumerate(BATCHES)]


@pytest.mark.parametrize("folds", [(), (0, 3)])
def test_equals_one_build(spark, monkeypatch, folds):
    monkeypatch.setattr(M, "BUCKET_BYTES", 2000)
    t = EventTails(spark, work_dir(spark, "t", uuid.uuid4().hex), SILVER_DDL, build)
    read, closed = [], EventTails._closed
    monkeypatch.setattr(EventTails, "_closed", lambda self, upto, cases=None: read.append((upto, cases)) or closed(self, upto, cases))
    all_rows = None
    for i, b in enumerate(batches(spark)):
        read.clear()
        assert t.append(i, b) == i
        if i < 2:
            assert not read                                   # batches in order read no closed row
        all_rows = b if all_rows is None else all_rows.unionByName(b)
        if i in folds:
            t.fold()
        if i in (2, 5):
            assert everything(t.read()) == everything(build(all_rows))
    assert t.append(2, batches(spark)[2]) is None


def test_a_merge_that_died_is_made_again(spark):
    t = EventTails(spark, work_dir(spark, "t", uuid.uuid4().hex), SILVER_DDL, build)
    b = batches(spark)
    t.append("one", b[0])
    before = everything(t.read())
    t.append("two", b[1])
    delete_path(spark, f"{t.tail.path}/delta/seq=1~two/_SUCCESS")     # closed rows are there, the commit is not
    assert everything(t.read()) == before
    t.append("three", b[2])
    t.append("two", b[1])
    assert everything(t.read()) == everything(build(b[0].unionByName(b[1]).unionByName(b[2])))


def test_reports_follow_moved_flags(spark, monkeypatch):
    root = work_dir(spark, "t", uuid.uuid4().hex)
    silver = CaseTable(spark, f"{root}/silver", "numero_processo", SILVER_DDL)
    kept = MaintainedReports(spark, f"{root}/sums", silver)
    for i, b in enumerate(batches(spark)):
        silver.merge(i, b, build)
        monkeypatch.setattr(CaseTable, "read", None)          # an update reads touched cases only
        assert kept.update() == [i]
        monkeypatch.undo()
        if i == 3:
            silver.fold()
            kept.compact()
    s = silver.read()
    fact, groups = build_fact(s), silver_groups(s)
    courts, classes, days = dim_tribunais(groups), dim_classes(groups), dim_calendario(calendar_bounds(groups))
    for got, want in ((kept.kpi(), R.kpi(fact)), (kept.congestion_by_court(), R.congestion_by_court(fact, courts)),
                      (kept.inactivity_bands(), R.inactivity_bands(fact, courts)), (kept.volume_by_class(classes), R.volume_by_class(fact, classes)),
                      (kept.weekly_flow(), R.weekly_flow(fact, days))):
        assert everything(got.select(*want.columns)) == everything(want)
    assert maintained.CASE_SUMS and kept.update() == []


def test_no_batch_yet(spark):
    root = work_dir(spark, "t", uuid.uuid4().hex)
    silver = CaseTable(spark, f"{root}/silver", "numero_processo", SILVER_DDL)
    kept = MaintainedReports(spark, f"{root}/sums", silver)
    assert kept.update() == [] and kept.congestion_by_court().count() == 0
    assert EventTails(spark, f"{root}/tails", SILVER_DDL, build).read().count() == 0


def test_deltas_are_one_scan(spark, tmp_path):
    """A union of scans lets a join above count on a partitioning that adaptive execution changes."""
    schema = "numero_processo string, v bigint, is_ultimo_movimento boolean"
    for parts in ([], ["is_ultimo_movimento"]):
        t = CaseTable(spark, f"{tmp_path}/t{len(parts)}", "numero_processo", schema, parts)
        for name, made in (("b1", [("1", 1, True), (None, 2, False)]), ("b 2", [("1", 3, None)]), ("none", [])):
            t.put(name, spark.createDataFrame(made, schema))
        got = t.read_deltas([0, 1, 2])
        assert "Union" not in got._jdf.queryExecution().toString()
        assert rows(got, "numero_processo", "v", "is_ultimo_movimento", "seq") == sorted(
            [("1", 1, True, 0), (None, 2, False, 0), ("1", 3, None, 1)], key=repr)
        assert rows(t.read(), "numero_processo", "v") == sorted([(None, 2), ("1", 3)], key=repr)
        assert t.read_deltas([2]).count() == 0


def staged_reads(monkeypatch, module):
    """The files that each batch asked for its cases lies in."""
    seen, cases = [], module.Cases
    monkeypatch.setattr(module, "Cases", lambda df, *a, **k: seen.append(df.inputFiles()) or cases(df, *a, **k))
    return seen


def test_a_merge_reads_its_batch_once(spark, monkeypatch):
    seen = staged_reads(monkeypatch, M)
    t = CaseTable(spark, work_dir(spark, "t", uuid.uuid4().hex), "numero_processo", SILVER_DDL)
    first, second = batches(spark)[:2]
    t.merge(0, first, build)
    assert not seen                                           # an empty table has no case to look up
    t.merge(1, second, build)
    assert len(seen) == 1 and seen[0] and all("/stage/" in f for f in seen[0])
    assert everything(t.read()) == everything(build(first.unionByName(second)))


def test_a_first_append_looks_up_no_tail(spark, monkeypatch):
    from docketline.operators import tails
    seen = staged_reads(monkeypatch, tails)
    t = EventTails(spark, work_dir(spark, "t", uuid.uuid4().hex), SILVER_DDL, build)
    first = batches(spark)[0]
    t.append(0, first)
    assert not seen and everything(t.read()) == everything(build(first))


def test_old_rows_are_looked_up_once_for_all_sums(spark, monkeypatch):
    root, files = work_dir(spark, "t", uuid.uuid4().hex), []
    silver = CaseTable(spark, f"{root}/silver", "numero_processo", SILVER_DDL)
    kept = MaintainedReports(spark, f"{root}/sums", silver)
    for name in ("case_sums", "week_sums"):
        of = getattr(maintained, name)
        monkeypatch.setattr(maintained, name, lambda df, of=of: files.append(df.inputFiles()) or of(df))
    for i, b in enumerate(batches(spark)[:2]):
        silver.merge(i, b, build)
        kept.update()
    assert sum(bool(f) and all("/sums/stage/" in x for x in f) for f in files) == 2
