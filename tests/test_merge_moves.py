"""What a merge moves, and that its rows stay those of one build."""

import uuid

from pyspark.sql import functions as F

from docketline.operators import merge as M
from docketline.operators.merge import KEY, Cases, CaseTable
from docketline.plans.silver import build_silver, flatten_hits
from docketline.schemas import CORRUPT, SILVER_DDL
from docketline.session import work_dir
from docketline.sources import fixtures
from docketline.sources.json_source import BronzeTable
from docketline.streaming import ingest as I
from docketline.streaming.ingest import merge_pending, silver_table

from .conftest import SF_SMALL, rows
from .helpers import ev, flat

STAMP = "2021-01-01 00:00:00"
PLAIN = ["numero_processo", "codigo_movimento", "nome_movimento", "data_movimento", "dias_desde_ultimo_movimento", "is_ultimo_movimento"]


def build(df, only=None):
    return build_silver(df, processed_at=STAMP, only=only)


def batches(spark):
    first = [ev("A", 1, "2020-01-01"), ev("A", 2, "2020-01-05"), ev("B", 1, "2020-01-02"), ev(None, 1, "2020-01-03"), ev("C", 1, "2020-02-01")]
    second = [ev("A", 3, "2020-01-03"), ev("A", 2, "2020-01-05", name="novo"), ev(None, 2, "2020-01-10"), ev("D", 1, None)]
    return flat(spark, first, "2021-01-01"), flat(spark, second, "2021-02-01")


def table(spark, schema=SILVER_DDL):
    return CaseTable(spark, work_dir(spark, "t", uuid.uuid4().hex), "numero_processo", schema)


def test_a_batch_beside_deltas_is_merged_without_a_lookup(spark, monkeypatch):
    a, b = batches(spark)
    t = table(spark)
    t.merge("a", a, build, picks=True)

    def no_lookup(*_):
        raise AssertionError("cases are looked up")

    monkeypatch.setattr(M, "Cases", no_lookup)
    t.merge("b", b, build, picks=True)
    assert {r[0] for r in t.delta(1).select("numero_processo").collect()} == {"A", "D", None}       # touched cases only
    assert rows(t.read(), *PLAIN) == rows(build(a.unionByName(b)), *PLAIN)


def test_a_small_batch_or_a_base_is_looked_up(spark, monkeypatch):
    a, b = batches(spark)
    t = table(spark)
    t.merge("a", a, build, picks=True)
    assert t.marked(b, 0) is None and t.marked(b, 1 << 40) is not None
    t.fold()
    assert t.marked(b, 1 << 40) is None
    t.merge("b", b, build, picks=True)
    assert rows(t.read(), *PLAIN) == rows(build(a.unionByName(b)), *PLAIN)


def test_copies_of_an_event_are_chosen_alike_with_and_without_marks(spark):
    """The mark is no part of the row hash that decides between copies of equal ingest time."""
    a = flat(spark, [ev("A", 1, "2020-01-01", name=f"x{i}") for i in range(9)], "2021-01-01")
    want = rows(build(a), *PLAIN)
    for i in range(9):
        part = F.col("nome_movimento") == f"x{i}"
        assert rows(build(a.withColumn(M.NEW, part), M.NEW), *PLAIN) == want


def test_pending_bronze_is_merged_without_a_lookup(spark, monkeypatch):
    e1, e2 = fixtures.event_batches(spark, SF_SMALL)
    root = work_dir(spark, "t", uuid.uuid4().hex)
    bronze, silver = BronzeTable(spark, f"{root}/bronze"), silver_table(spark, f"{root}/silver")
    def no_lookup(*_):
        raise AssertionError("cases are looked up")

    monkeypatch.setattr(I, "Cases", no_lookup)
    for tag, e, at in (("s1", e2, fixtures.BATCH2_INGEST), ("s0", e1, fixtures.BATCH1_INGEST)):
        bronze.put(tag, fixtures.bronze_hits(spark, SF_SMALL, at, events=e).withColumn(CORRUPT, F.lit(None).cast("string")))
        merge_pending(spark, bronze.path, silver.path, STAMP, hot_case_rows=None)
    whole = build(flatten_hits(bronze.read()))
    assert rows(silver.read(), *PLAIN) == rows(whole, *PLAIN)


def test_the_newest_delta_is_not_compared(spark):
    t = table(spark)
    parts = [[("A", 1), ("B", 1), ("C", 1), (None, 1)], [("B", 2), ("C", 2)], [("C", 3), ("D", 3), (None, 3)]]
    for i, p in enumerate(parts):
        t.put(i, build(flat(spark, [ev(c, code, "2020-01-01") for c, code in p], "2021-01-01")))
    got = t.read()
    assert rows(got, "numero_processo", "codigo_movimento") == sorted(
        [("A", 1), ("B", 2), ("C", 3), ("D", 3), (None, 3)], key=repr)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = t.read()._jdf.queryExecution().sparkPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    at = next(i for i, x in enumerate(plan) if "Union" in x)
    newest = [x for x in plan[at:] if x.startswith("+- ")]                # the union's last child
    assert newest and not any("Join" in x for x in plan[plan.index(newest[-1]):])
    t.fold()
    t.put("late", build(flat(spark, [ev("A", 9, "2020-01-01")], "2021-01-01")))
    assert rows(t.read(), "numero_processo", "codigo_movimento") == sorted(
        [("A", 9), ("B", 2), ("C", 3), ("D", 3), (None, 3)], key=repr)


def test_rows_in_the_order_of_the_case_are_not_sorted_again(spark):
    a, _ = batches(spark)
    t = table(spark)
    t.put("a", build(a))
    stored = spark.read.parquet(f"{t.path}/delta").select(KEY, F.spark_partition_id().alias("p"))
    assert stored.count() == 5
    built = build(a).withColumn(KEY, M.case_key("numero_processo"))
    assert t.order() == "numero_processo"
    plan = built.sortWithinPartitions(t.order())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1
    assert CaseTable(spark, t.path, "codigo_classe", SILVER_DDL).order() == KEY


def test_many_cases_are_not_collected(spark, monkeypatch):
    many = spark.range(1000).select(F.col("id").cast("string").alias("c"))
    assert Cases(many, "c", most=10).few is None and len(Cases(many, "c", most=2000).few) == 1000
    assert len(Cases(many.limit(10), "c", most=10).few) == 10 and Cases(many.limit(15), "c", most=10).few is None
