"""Aggregate operators.

``conditional_distinct`` is the hand rewrite of several
``COUNT(DISTINCT CASE WHEN p THEN id END)`` in one query. Spark plans n such
distincts as an Expand that copies every row n times before the shuffle; here
rows are first reduced to (groups, id) with one ``max(p)`` per predicate
(partial aggregation collapses repeated ids map-side), then counted. One
shuffle of the reduced rows, no blow-up, and equal results: an id counts for
a predicate iff some row of it satisfies the predicate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_PERCENTILES = (0.25, 0.50, 0.75, 0.90, 0.95)


def conditional_distinct(df: DataFrame, group: Sequence[str], id_col: str,
                         predicates: Mapping[str, Column | None],
                         extra: Mapping[str, tuple[str, Column]] | None = None) -> DataFrame:
    """D3: ``count(distinct case when p then id end)`` for each named predicate.

    ``predicates[name] = None`` means an unconditional distinct count.
    ``extra[name] = (kind, col)`` adds row-level aggregates that survive the
    two-step plan: kind is ``count`` (rows), ``sum``, or ``nn`` (non-null count).
    """
    flags = []
    for i, (name, p) in enumerate(predicates.items()):
        cond = F.lit(True) if p is None else F.coalesce(p, F.lit(False))
        flags.append(F.max(cond).alias(f"__p{i}"))
    extra = dict(extra or {})
    inner = []
    for name, (kind, col) in extra.items():
        if kind == "count":
            inner.append(F.count(F.lit(1)).alias(f"__x_{name}"))
        elif kind == "sum":
            inner.append(F.sum(col).alias(f"__x_{name}"))
        elif kind == "nn":
            inner.append(F.count(col).alias(f"__x_{name}"))
        else:
            raise ValueError(kind)
    per_id = df.groupBy(*group, id_col).agg(*flags, *inner)
    outer = [F.count(F.when(F.col(f"__p{i}") & F.col(id_col).isNotNull(), 1)).alias(name)
             for i, name in enumerate(predicates)]
    outer += [F.sum(f"__x_{name}").alias(name) for name in extra]
    return per_id.groupBy(*group).agg(*outer)


def round_avg(c: str | Column, scale: int = 0) -> Column:
    """``ROUND(AVG(x), scale)``; nulls ignored."""
    return F.round(F.avg(c), scale)


def percentiles(c: str | Column, probs: Sequence[float] = DEFAULT_PERCENTILES,
                exact: bool = True, accuracy: int = 10000) -> Column:
    """One array of interpolated percentiles (exact) or approximate ones.

    The exact buffer keeps one entry per distinct value in the group, which
    is small for day counts; ``exact=False`` bounds it for any domain.
    """
    c = F.col(c) if isinstance(c, str) else c
    arr = F.array(*[F.lit(p) for p in probs])
    return F.percentile(c, arr) if exact else F.percentile_approx(c, arr, accuracy)


def count_if_share(pred: Column, scale: int = 2) -> tuple[Column, Column, Column]:
    """(matching rows, all rows, percent share as double)."""
    hit = F.count_if(pred)
    total = F.count(F.lit(1))
    pct = F.round(hit.cast("double") * 100.0 / total, scale)
    return hit, total, pct


def latest_event(df: DataFrame, case: str, ts: str, name: str,
                 empty_text: str = "sem movimentos",
                 missing_name: str = "nome não disponível") -> DataFrame:
    """D10 on exploded rows: per case, the name of the event with the greatest time.

    Ties on time go to the greatest name, so the answer is deterministic.
    Partial aggregation keeps one candidate per case per task.
    """
    best = F.max(F.struct(F.col(ts).alias("t"), F.coalesce(F.col(name), F.lit(missing_name)).alias("n")))
    out = df.groupBy(case).agg(best.alias("__b"), F.count(F.col(ts)).alias("__k"))
    return out.select(case, F.when(F.col("__k") > 0, F.col("__b.n"))
                      .otherwise(F.lit(empty_text)).alias("ultimo_movimento"))


def latest_candidate(arr: str | Column, missing_name: str = "nome não disponível") -> Column:
    """D10 inside one array: its greatest (time text, name), null for a null or empty array."""
    arr = F.col(arr) if isinstance(arr, str) else arr
    return F.array_max(F.transform(arr, lambda m: F.struct(
        F.coalesce(m["dataHora"], F.lit("")).alias("t"), F.coalesce(m["nome"], F.lit(missing_name)).alias("n"))))


def latest_event_nested(hits: DataFrame, keys: Mapping[str, Column], arr: str,
                        empty_text: str = "sem movimentos") -> DataFrame:
    """D10 without exploding: the greatest candidate over the hits of a key (a large case has several)."""
    best = hits.select(*[c.alias(k) for k, c in keys.items()], latest_candidate(arr).alias("__c"))
    out = best.groupBy(*keys).agg(F.max("__c").alias("__b"))
    return out.select(*keys, F.coalesce(F.col("__b.n"), F.lit(empty_text)).alias("ultimo_movimento"))
