"""Dashboard queries P1-P15 over the gold fact and dimensions.

All take the fact and the (size-checked, broadcastable) dimensions and
return lazy DataFrames. Conditional distinct counts go through the
case-grain rewrite (``operators.aggregates.conditional_distinct``); every
top-k has a unique tie-breaker so the kept rows are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import week_label, weekday_ordinal
from ..operators.aggregates import (DEFAULT_PERCENTILES, conditional_distinct, percentiles,
                                    round_avg)

CASE = "numero_processo"
GAP = "dias_desde_ultimo_movimento"
AGE = "dias_desde_ajuizamento"
LATEST = "is_ultimo_movimento"
# Fixed values that must equal the reference's: stalled after 90 days, the
# one-year list after 365, and the inactivity bands (inclusive day ranges).
STALLED_DAYS = 90
STALE_YEAR_DAYS = 365
INACTIVITY_BANDS = (
    ("30d", 0, 29),
    ("60d", 30, 59),
    ("90d", 60, 89),
    ("180d", 90, 179),
    ("180_365d", 180, 364),
    ("365d_plus", 365, None),
)


def latest(fact: DataFrame) -> DataFrame:
    """Latest event of each case (prunes to one fact partition)."""
    return fact.where(F.col(LATEST))


def _trib(fact: DataFrame, tribunais: DataFrame) -> DataFrame:
    return fact.join(tribunais, F.col("fk_tribunal") == F.col("sk_tribunal"))


def kpi(fact: DataFrame) -> DataFrame:
    """Cases, movements, mean age over all movements, stalled cases."""
    stalled = (F.col(GAP) > STALLED_DAYS) & F.col(LATEST)
    per_case = fact.groupBy(CASE).agg(
        F.count(F.lit(1)).alias("__n"), F.sum(AGE).alias("__s"), F.count(AGE).alias("__c"),
        F.max(F.coalesce(stalled, F.lit(False))).alias("__st"))
    return per_case.agg(
        F.count(CASE).alias("total_processos"),
        F.sum("__n").alias("total_movimentos"),
        F.round(F.sum("__s").cast("double") / F.sum("__c"), 0).alias("tmp_medio"),
        F.count(F.when(F.col("__st") & F.col(CASE).isNotNull(), 1)).alias("processos_parados"))


def congestion_by_court(fact: DataFrame, tribunais: DataFrame) -> DataFrame:
    """Cases and stalled cases per court (latest events)."""
    j = _trib(latest(fact), tribunais)
    return conditional_distinct(j, ["sigla_tribunal"], CASE, {
        "total_processos": None,
        "processos_parados": F.col(GAP) > STALLED_DAYS,
    })


def inactivity_bands(fact: DataFrame, tribunais: DataFrame) -> DataFrame:
    """Distinct cases per court in each inactivity band; a null gap is in none."""
    preds = {}
    for name, lo, hi in INACTIVITY_BANDS:
        preds[name] = (F.col(GAP) >= lo) if hi is None else F.col(GAP).between(lo, hi)
    return conditional_distinct(_trib(latest(fact), tribunais), ["sigla_tribunal"], CASE, preds)


def duration_percentiles(fact: DataFrame, tribunais: DataFrame, exact: bool = True) -> DataFrame:
    """p25..p95 and mean of case age at its latest event, per court."""
    j = _trib(latest(fact), tribunais)
    g = j.groupBy("sigla_tribunal").agg(percentiles(AGE, DEFAULT_PERCENTILES, exact).alias("__p"),
                                        round_avg(AGE).alias("media_dias"))
    names = ["p25_dias", "p50_dias", "p75_dias", "p90_dias", "p95_dias"]
    return g.select("sigla_tribunal",
                    *[F.round(F.col("__p")[i], 0).alias(n) for i, n in enumerate(names)],
                    "media_dias").orderBy(F.desc("media_dias"), "sigla_tribunal")


def _by_class(fact: DataFrame, classes: DataFrame) -> DataFrame:
    j = latest(fact).join(classes, F.col("fk_classe") == F.col("sk_classe"))
    return j.groupBy("nome_classe").agg(
        F.count_distinct(CASE).alias("total_processos"),
        round_avg(AGE).alias("tmp_medio"),
        F.count(F.lit(1)).alias("total_movimentos"))


def volume_by_class(fact: DataFrame, classes: DataFrame) -> DataFrame:
    """P5: cases, mean age and movements per class (latest events)."""
    return _by_class(fact, classes).orderBy(F.desc("total_processos"), "nome_classe")


def top_classes_by_age(fact: DataFrame, classes: DataFrame, k: int = 10) -> DataFrame:
    """P5 ordered by mean age, top k."""
    return _by_class(fact, classes).orderBy(F.desc("tmp_medio"), "nome_classe").limit(k)


def top_stalled_organs(fact: DataFrame, tribunais: DataFrame, orgaos: DataFrame,
                       k: int = 20) -> DataFrame:
    """Stalled cases and mean inactivity per court and organ, top k."""
    f = latest(fact).where(F.col(GAP) > STALLED_DAYS)
    j = _trib(f, tribunais).join(orgaos.select("sk_orgao", "nome_orgao"),
                                 F.col("fk_orgao") == F.col("sk_orgao"))
    g = j.groupBy("sigla_tribunal", "nome_orgao").agg(
        F.count_distinct(CASE).alias("processos_parados"),
        round_avg(GAP).alias("media_inatividade"))
    return g.orderBy(F.desc("processos_parados"), "sigla_tribunal", "nome_orgao").limit(k)


def stale_over_1y(fact: DataFrame, tribunais: DataFrame, orgaos: DataFrame,
                  classes: DataFrame) -> DataFrame:
    """Cases whose last gap exceeds a year, with court, organ and class."""
    f = latest(fact).where(F.col(GAP) > STALE_YEAR_DAYS)
    j = (_trib(f, tribunais)
         .join(orgaos.select("sk_orgao", "nome_orgao"), F.col("fk_orgao") == F.col("sk_orgao"))
         .join(classes.select("sk_classe", "nome_classe"), F.col("fk_classe") == F.col("sk_classe")))
    return (j.select(CASE, "sigla_tribunal", "nome_orgao", "nome_classe", GAP, AGE)
            .orderBy(F.desc(GAP), CASE))


def _per_day(fact: DataFrame, calendario: DataFrame, *attributes: str) -> DataFrame:
    """Movements per event day: counted by the integer key first, so the calendar joins days, not events."""
    per_key = fact.groupBy("fk_data_movimento").agg(F.count(F.lit(1)).alias("__n"))
    cal = calendario.select("sk_data", *attributes)
    return per_key.join(cal, F.col("fk_data_movimento") == F.col("sk_data"))


def movements_by_weekday(fact: DataFrame, calendario: DataFrame) -> DataFrame:
    """Movements per day name, with Monday = 1 ordinal."""
    g = _per_day(fact, calendario, "dia_semana").groupBy("dia_semana").agg(F.sum("__n").alias("total_movimentos"))
    return (g.select("dia_semana", weekday_ordinal("dia_semana").alias("dia_semana_ordem"),
                     "total_movimentos").orderBy("dia_semana_ordem"))


def movements_by_day(fact: DataFrame, calendario: DataFrame) -> DataFrame:
    """P10: movements per calendar day with heat-map attributes."""
    g = _per_day(fact, calendario, "data", "dia_semana", "mes", "ano")
    return (g.select("data", F.dayofyear("data").alias("dia_ano"), "dia_semana",
                     weekday_ordinal("dia_semana").alias("dia_semana_ordem"), "mes", "ano",
                     F.col("__n").alias("total_movimentos"))
            .orderBy("dia_semana_ordem", "dia_ano", "ano"))


def weekly_flow(fact: DataFrame, calendario: DataFrame, full: bool = False) -> DataFrame:
    """Weekly movements, left-joined with weekly new cases (C6, B11; H8, H9).

    The week number is the ISO week joined to the calendar year, as in the
    reference (2024-12-30 is week 1 of 2024). ``full=True`` keeps weeks that
    only have filings.
    """
    cal = calendario.select("sk_data", "ano", F.weekofyear("data").alias("semana"))
    mv = (_per_day(fact, calendario, "ano", "data").groupBy("ano", F.weekofyear("data").alias("semana"))
          .agg(F.sum("__n").alias("total_movimentos")))
    # one row per (case, filing day) first: the distinct count then needs no
    # second pass over all movements (a case can have a filing day per instance)
    filings = fact.select(CASE, "fk_data_ajuizamento").distinct()
    nw = (filings.join(cal, F.col("fk_data_ajuizamento") == F.col("sk_data"))
          .groupBy("ano", "semana").agg(F.count_distinct(CASE).alias("novos_processos")))
    j = mv.join(nw, ["ano", "semana"], "full" if full else "left")
    return (j.select("ano", "semana", week_label("ano", "semana").alias("ano_semana"),
                     F.coalesce(F.col("novos_processos"), F.lit(0)).alias("novos_processos"),
                     F.coalesce(F.col("total_movimentos"), F.lit(0)).alias("total_movimentos"))
            .orderBy("ano", "semana"))


def pct_stalled(fact: DataFrame) -> DataFrame:
    """Share of cases stalled (> 90 days at the latest event)."""
    k = kpi(fact)
    return k.select("total_processos", "processos_parados",
                    F.round(F.try_divide(F.col("processos_parados").cast("double") * 100.0,
                                         F.col("total_processos")), 2).alias("pct_parados"))


def top5_class_monthly(fact: DataFrame, classes: DataFrame, k: int = 5) -> DataFrame:
    """Monthly movements of the k classes with most cases.

    The classes are ranked on the latest events (one fact partition); the top-k list has at most k
    rows, so its broadcast is bounded by k.
    """
    top = (_by_class(fact, classes).orderBy(F.desc("total_processos"), "nome_classe")
           .limit(k).select("nome_classe"))
    picked = classes.select("sk_classe", "nome_classe").join(F.broadcast(top), "nome_classe", "left_semi")
    j = fact.join(F.broadcast(picked), F.col("fk_classe") == F.col("sk_classe"))
    return (j.groupBy("nome_classe", F.trunc(F.col("data_movimento").cast("date"), "month").alias("mes"))
            .agg(F.count(F.lit(1)).alias("total_movimentos"),
                 F.count_distinct(CASE).alias("processos"))
            .orderBy("nome_classe", "mes"))


def movements_by_month(fact: DataFrame) -> DataFrame:
    """Monthly movements and cases moved."""
    return (fact.groupBy(F.trunc(F.col("data_movimento").cast("date"), "month").alias("mes"))
            .agg(F.count(F.lit(1)).alias("total_movimentos"),
                 F.count_distinct(CASE).alias("processos"))
            .orderBy("mes"))


def phase_bottlenecks(fact: DataFrame, exact: bool = True) -> DataFrame:
    """Per phase, movements, mean and median/p90 gap to the previous movement."""
    g = fact.groupBy("tipo_fase").agg(
        F.count(F.lit(1)).alias("total_movimentos"),
        round_avg(GAP).alias("media_gap"),
        percentiles(GAP, (0.5, 0.9), exact).alias("__p"))
    return g.select("tipo_fase", "total_movimentos", "media_gap",
                    F.round(F.col("__p")[0], 0).alias("p50_gap"),
                    F.round(F.col("__p")[1], 0).alias("p90_gap")).orderBy("tipo_fase")


def inactivity_as_of(fact: DataFrame, tribunais: DataFrame, as_of=None) -> DataFrame:
    """H7 option: days from each case's latest event to ``as_of`` (default: the
    latest event date in the data, as a scalar subquery),
    per court: cases, mean days inactive, cases inactive more than a year."""
    if as_of is None:
        ref = fact.agg(F.max(F.col("data_movimento").cast("date"))).scalar()  # scalar subquery
    else:
        ref = F.to_date(F.lit(as_of))
    j = _trib(latest(fact), tribunais)
    days = F.datediff(ref, F.col("data_movimento"))
    return j.groupBy("sigla_tribunal").agg(
        F.count(F.lit(1)).alias("processos"),
        F.round(F.avg(days), 0).alias("media_dias_inativo"),
        F.count_if(days > STALE_YEAR_DAYS).alias("inativos_mais_1_ano"))
