"""Distinct counts and percentiles from mergeable states.

One small state per day, court and phase: a HyperLogLog sketch of the cases, KLL sketches of gaps and of the ages
of latest events. A day's states are built once, from that day's events; any span of days, court or phase is
answered by merging states, without reading events. Merging two days gives the state of both.

Stated errors: distinct counts within ``HLL_BOUND`` of the exact count (five standard errors of 2**14 registers), and the
value given for a percentile has an exact rank within ``KLL_BOUND`` of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import phase_bucket
from .reports import AGE, CASE, GAP, LATEST

HLL_LGK, HLL_BOUND = 14, 0.041
KLL_K, KLL_BOUND = 800, 0.02
STATE = ["dia", "sigla_tribunal", "tipo_fase"]


def day_states(silver: DataFrame) -> DataFrame:
    """A state per day of the event, court and phase of the movement."""
    rows = silver.withColumn("dia", F.col("data_movimento").cast("date")).withColumn("tipo_fase", phase_bucket("codigo_movimento"))
    return rows.groupBy(*STATE).agg(
        F.count(F.lit(1)).alias("movimentos"), F.hll_sketch_agg(CASE, HLL_LGK).alias("casos"),
        F.sum(GAP).alias("soma_gap"), F.count(GAP).alias("n_gap"), F.expr(f"kll_sketch_agg_bigint(CAST({GAP} AS BIGINT), {KLL_K})").alias("gaps"),
        F.expr(f"kll_sketch_agg_bigint(CASE WHEN {LATEST} THEN CAST({AGE} AS BIGINT) END, {KLL_K})").alias("idades"))


def _quantile(sketch: str, q: float) -> Column:
    n = f"kll_sketch_get_n_bigint({sketch})"
    return F.expr(f"CASE WHEN {n} > 0 THEN kll_sketch_get_quantile_bigint({sketch}, {q}D) END")


def distinct_cases(states: DataFrame, by: Sequence[str]) -> DataFrame:
    """Movements and the estimated number of distinct cases per group."""
    return states.groupBy(*by).agg(F.sum("movimentos").alias("movimentos"),
                                   F.hll_sketch_estimate(F.hll_union_agg("casos")).alias("processos"))


def age_percentiles(states: DataFrame, quantiles: Sequence[float], by: Sequence[str] = ("sigla_tribunal",)) -> DataFrame:
    """The given percentiles of the age at the latest event, as an array."""
    return states.groupBy(*by).agg(F.expr("kll_merge_agg_bigint(idades)").alias("s")).select(
        *by, F.array(*[_quantile("s", q) for q in quantiles]).alias("valores"))


def gap_percentiles(states: DataFrame, quantiles: Sequence[float], by: Sequence[str] = ("tipo_fase",)) -> DataFrame:
    """Movements, mean gap (exact: sums add up) and percentiles of the gap."""
    return states.groupBy(*by).agg(F.sum("movimentos").alias("total_movimentos"), F.sum("soma_gap").alias("g"), F.sum("n_gap").alias("n"),
                                   F.expr("kll_merge_agg_bigint(gaps)").alias("s")).select(
        *by, "total_movimentos", F.round(F.col("g").cast("double") / F.nullif(F.col("n"), F.lit(0)), 0).alias("media_gap"),
        F.array(*[_quantile("s", q) for q in quantiles]).alias("valores"))


def ranks_within(exact: DataFrame, value: str, found: DataFrame, quantiles: Sequence[float], by: str, bound: float = KLL_BOUND) -> DataFrame:
    """(by, n, dentro): whether each percentile found has an exact rank within ``bound`` of the one asked for."""
    rows = exact.where(F.col(value).isNotNull()).join(F.broadcast(found.select(by, "valores")), by)      # a row per group
    counts = [c for i in range(len(quantiles)) for c in (
        F.count_if(F.col(value) < F.col("valores")[i]).alias(f"l{i}"), F.count_if(F.col(value) <= F.col("valores")[i]).alias(f"u{i}"))]
    ok = F.lit(True)
    for i, q in enumerate(quantiles):
        ok = ok & (F.col(f"l{i}") <= (q + bound) * F.col("n")) & (F.col(f"u{i}") >= (q - bound) * F.col("n"))
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"), *counts).select(by, "n", ok.alias("dentro"))
