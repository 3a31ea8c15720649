"""Gold dimensions.

Every dimension is a grouping of silver (or bronze) on its natural key, so
each is as small as the number of distinct keys: courts, classes, organs,
subjects, days. A gold build takes them from ``silver_groups``, which reads silver once. Keys are md5 surrogate keys of the natural key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key
from ..functions.parse import parse_json_array
from ..operators.joins import join_dim


def silver_groups(silver: DataFrame) -> DataFrame:
    """One pass over silver for M1, M2, M4 and the calendar's bounds: the distinct courts, classes,
    organs and their names, with the first and last date of each. As small as their combinations."""
    return (silver.groupBy("sigla_tribunal", "codigo_classe", "nome_classe", "codigo_orgao", "nome_orgao")
            .agg(F.least(F.min("data_ajuizamento"), F.min("data_movimento")).alias("first_date"),
                 F.greatest(F.max("data_ajuizamento"), F.max("data_movimento")).alias("last_date")))


def dim_tribunais(silver: DataFrame) -> DataFrame:
    """M1: one row per court."""
    return (silver.where(F.col("sigla_tribunal").isNotNull())
            .select("sigla_tribunal").distinct()
            .select(surrogate_key("sigla_tribunal").alias("sk_tribunal"), "sigla_tribunal"))


def dim_classes(silver: DataFrame) -> DataFrame:
    """M2: one row per class code; one name per code (min), so no fact fan-out (H5)."""
    g = (silver.where(F.col("codigo_classe").isNotNull())
         .groupBy("codigo_classe").agg(F.min("nome_classe").alias("nome_classe")))
    return g.select(surrogate_key("codigo_classe").alias("sk_classe"), "codigo_classe", "nome_classe")


def dim_classes_distinct(silver: DataFrame) -> DataFrame:
    """M2 as the reference writes it (distinct code, name): may repeat a key (H5)."""
    g = (silver.where(F.col("codigo_classe").isNotNull())
         .select("codigo_classe", "nome_classe").distinct())
    return g.select(surrogate_key("codigo_classe").alias("sk_classe"), "codigo_classe", "nome_classe")


def subjects_exploded(bronze: DataFrame) -> DataFrame:
    """JSON-string subjects -> (codigo_assunto, nome_assunto); bad/null/code-less dropped."""
    base = bronze.where(F.col("_source.assuntos").isNotNull())
    parsed = base.select(F.inline(parse_json_array(F.col("_source.assuntos"))))
    return (parsed.where(F.col("codigo").isNotNull())
            .select(F.col("codigo").alias("codigo_assunto"), F.col("nome").alias("nome_assunto")))


def dim_assuntos(bronze: DataFrame) -> DataFrame:
    """M3: one row per subject code with the smallest name."""
    g = subjects_exploded(bronze).groupBy("codigo_assunto").agg(F.min("nome_assunto").alias("nome_assunto"))
    return g.select(surrogate_key("codigo_assunto").alias("sk_assunto"), "codigo_assunto", "nome_assunto")


def dim_orgaos(silver: DataFrame, tribunais: DataFrame | None = None) -> DataFrame:
    """M4: (organ code, court) grain, smallest name, FK to the court (C4 left join)."""
    tribunais = dim_tribunais(silver) if tribunais is None else tribunais
    g = (silver.where(F.col("codigo_orgao").isNotNull())
         .groupBy("codigo_orgao", "sigla_tribunal").agg(F.min("nome_orgao").alias("nome_orgao")))
    j = join_dim(g, tribunais, "sigla_tribunal", "left")
    return j.select(surrogate_key("codigo_orgao", "sigla_tribunal").alias("sk_orgao"),
                    "codigo_orgao", "nome_orgao", F.col("sk_tribunal").alias("fk_tribunal"))


def calendar_bounds(groups: DataFrame) -> DataFrame:
    """One row (lo, hi): whole years spanning every filing and event date of ``silver_groups``."""
    return groups.agg(F.make_date(F.year(F.min("first_date")), F.lit(1), F.lit(1)).alias("lo"),
                      F.make_date(F.year(F.max("last_date")), F.lit(12), F.lit(31)).alias("hi"))


def dim_calendario(bounds: DataFrame | None = None, spark=None,
                   start: str | None = None, end: str | None = None) -> DataFrame:
    """M5: one row per day in [lo, hi] with calendar attributes.

    Either a one-row ``bounds`` frame (lo, hi) or literal ``start``/``end``.
    The row count is the day span, independent of the data volume.
    """
    if bounds is None:
        bounds = spark.range(1).select(F.to_date(F.lit(start)).alias("lo"),
                                       F.to_date(F.lit(end)).alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("data"))
    d = F.col("data")
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("sk_data"),
        d,
        F.year(d).alias("ano"),
        F.month(d).alias("mes"),
        F.date_format(d, "MMMM").alias("nome_mes"),
        F.quarter(d).alias("trimestre"),
        F.when(F.month(d) <= 6, 1).otherwise(2).alias("semestre"),
        F.date_format(d, "EEEE").alias("dia_semana"),
        F.dayofweek(d).isin(1, 7).alias("is_fim_de_semana"),
        F.lit(False).alias("is_feriado_nacional"),
    )
