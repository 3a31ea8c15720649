import random

from pyspark.sql import functions as F

from docketline.operators.aggregates import conditional_distinct
from docketline.plans import dims
from docketline.plans import reports as R
from docketline.plans.fact import build_fact
from docketline.plans.silver import build_silver

from .helpers import ev, flat


def test_conditional_distinct_equals_direct(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice("xyz"), rnd.choice([None, "a", "b", "c", "d"]), rnd.randint(-5, 400)) for _ in range(500)]
    df = spark.createDataFrame(rows, "g string, id string, v int")
    preds = {"p1": F.col("v") > 90, "p2": F.col("v").between(0, 29), "all": None}
    mine = sorted(tuple(r) for r in conditional_distinct(df, ["g"], "id", preds).select("g", "p1", "p2", "all").collect())
    direct = df.groupBy("g").agg(
        F.count_distinct(F.when(F.col("v") > 90, F.col("id"))).alias("p1"),
        F.count_distinct(F.when(F.col("v").between(0, 29), F.col("id"))).alias("p2"),
        F.count_distinct("id").alias("all"))
    assert mine == sorted(tuple(r) for r in direct.select("g", "p1", "p2", "all").collect())


def test_single_event_case_in_no_band(spark):
    s = build_silver(flat(spark, [ev("A", 1, "2020-01-01"), ev("B", 1, "2020-01-01"),
                                  ev("B", 2, "2021-03-01")]), processed_at="2022-01-01")
    f, t = build_fact(s), dims.dim_tribunais(s)
    r = R.inactivity_bands(f, t).first()
    assert [r["30d"], r["60d"], r["90d"], r["180d"], r["180_365d"], r["365d_plus"]] == [0, 0, 0, 0, 0, 1]
    k = R.kpi(f).first()
    assert (k.total_processos, k.total_movimentos, k.processos_parados) == (2, 3, 1)


def test_top_k_has_tie_breaker(spark):
    s = build_silver(flat(spark, [ev(f"C{i}", 1, "2020-01-01", cls=(i, f"K{i:02d}")) for i in range(15)]),
                     processed_at="2022-01-01")
    top = R.top_classes_by_age(build_fact(s), dims.dim_classes(s)).collect()
    assert [r.nome_classe for r in top] == [f"K{i:02d}" for i in range(10)]


def test_approx_percentiles_close_to_exact(spark):
    from docketline.operators.aggregates import percentiles
    rnd = random.Random(5)
    df = spark.createDataFrame([(rnd.randint(0, 3000),) for _ in range(5000)], "d int")
    ex = df.agg(percentiles("d").alias("p")).first().p
    ap = df.agg(percentiles("d", exact=False).alias("p")).first().p
    assert all(abs(a - b) <= 30 for a, b in zip(ex, ap))


def test_latest_event_edge_cases(spark):
    from docketline.operators.aggregates import latest_event, latest_event_nested
    df = spark.createDataFrame([
        (1, [(1, "a", "2020-01-01T00:00:00.000Z"), (2, None, "2020-02-01T00:00:00.000Z")]),
        (2, []), (3, None), (4, [(3, "c", "2020-01-01T00:00:00.000Z")]), (4, [(3, "d", "2020-01-02T00:00:00.000Z")]), (4, [])],
        "k int, m array<struct<codigo:bigint,nome:string,dataHora:string>>")
    got = {r.k: r.ultimo_movimento for r in latest_event_nested(df, {"k": F.col("k")}, "m").collect()}
    assert got == {1: "nome não disponível", 2: "sem movimentos", 3: "sem movimentos", 4: "d"}
    flat_rows = spark.createDataFrame([("A", None, "x"), ("A", None, "y"), ("B", "2020-01-01", None)],
                                      "case string, ts string, name string")
    out = {r.case: r.ultimo_movimento for r in latest_event(flat_rows, "case", "ts", "name").collect()}
    assert out == {"A": "sem movimentos", "B": "nome não disponível"}
