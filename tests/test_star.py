from pyspark.sql import functions as F

from docketline.plans import dims
from docketline.plans.checks import dq_negative_share, gate, run_tests
from docketline.plans.fact import build_fact, fact_by_join
from docketline.plans.silver import build_silver

from .helpers import ev, flat


def _silver(spark):
    evs = [ev("A", 50, "2020-01-01", cls=(1, "Zeta"), court="TJRS", org=(10, "V1")),
           ev("A", 150, "2020-05-01", cls=(1, "Alfa"), court="TJRS", org=(10, "V1")),
           ev("B", 700, "2019-12-30", filed="2020-01-01", cls=(2, "Beta"), court="TJSC", org=(10, "V9")),
           ev("C", 5, "2020-02-02", cls=(None, None), court=None, org=(None, None))]
    return build_silver(flat(spark, evs), processed_at="2022-01-01")


def test_class_with_two_names_no_fanout(spark):
    s = _silver(spark)
    c = dims.dim_classes(s)
    assert sorted(tuple(r) for r in c.select("codigo_classe", "nome_classe").collect()) == [(1, "Alfa"), (2, "Beta")]
    assert dims.dim_classes_distinct(s).count() == 3  # the reference's form repeats code 1
    f = fact_by_join(s, dims.dim_tribunais(s), c, dims.dim_orgaos(s))
    assert f.count() == s.count()


def test_fact_keys_equal_join_form(spark):
    s = _silver(spark)
    t, c, o = dims.dim_tribunais(s), dims.dim_classes(s), dims.dim_orgaos(s)
    a = sorted(tuple(r) for r in build_fact(s).collect())
    b = sorted(tuple(r) for r in fact_by_join(s, t, c, o).collect())
    assert a == b
    nulls = build_fact(s).where(F.col("numero_processo") == "C").first()
    assert nulls.fk_tribunal is None and nulls.fk_classe is None and nulls.fk_orgao is None


def test_calendar(spark):
    cal = dims.dim_calendario(spark=spark, start="2024-12-28", end="2025-01-02")
    rows = {r.data.isoformat(): r for r in cal.collect()}
    assert len(rows) == 6
    r = rows["2024-12-30"]
    assert (r.sk_data, r.dia_semana, r.is_fim_de_semana, r.semestre, r.nome_mes) == (20241230, "Monday", False, 2, "December")
    assert rows["2024-12-28"].is_fim_de_semana is True


def test_checks_and_gate(spark):
    s = _silver(spark)
    tables = {"silver": s, "fato_movimentos": build_fact(s), "dim_tribunais": dims.dim_tribunais(s),
              "dim_classes": dims.dim_classes(s), "dim_orgaos": dims.dim_orgaos(s),
              "dim_calendario": dims.dim_calendario(spark=spark, start="2019-01-01", end="2020-12-31"),
              "dim_assuntos": spark.createDataFrame([], "sk_assunto string, codigo_assunto bigint, nome_assunto string")}
    res = {(r.model, r.column_name, r.test): r.failures for r in run_tests(tables).collect()}
    assert res[("fato_movimentos", "dias_desde_ajuizamento", "expression")] == 1  # warn
    assert res[("fato_movimentos", "fk_tribunal", "not_null")] == 1  # case C has no court
    g = gate(run_tests(tables)).first()
    assert g.errors >= 1 and g.warnings == 1 and g.publish is False
    share = dq_negative_share(s).first()
    assert (share.dias_negativos, share.total_linhas, share.percentual_negativos) == (1, 4, 25.0)
