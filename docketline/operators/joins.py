"""Join helpers.

Broadcast is only ever applied behind a measured size: ``checked_broadcast``
measures the side's bytes and falls back to a plain join, which Spark plans
as a shuffle join and AQE may still convert at runtime.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bytes (as JSON text) that a broadcast side may hold.
BROADCAST_BYTES = 64 << 20


def frame_bytes(df: DataFrame) -> int:
    """Size of the rows as JSON text: one aggregate pass, for any column types."""
    return df.agg(F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*df.columns)))), F.lit(0)).alias("b")).first()["b"]


def checked_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` if it holds at most ``max_bytes``, else ``df`` unchanged."""
    return F.broadcast(df) if frame_bytes(df) <= max_bytes else df


def shuffle_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join of two sides that both grow with the data: a sort-merge join.

    Neither side is ever broadcast, whatever a small test input's statistics
    suggest; the sort-merge join spills instead of failing, and AQE can still
    split a skewed partition of either side.
    """
    return left.join(right.hint("merge"), on, how)


def join_dim(fact: DataFrame, dim: DataFrame, on, how: str = "inner",
             max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Fact joined to one dimension; the dimension is broadcast when small."""
    return fact.join(checked_broadcast(dim, max_bytes), on, how)


def anti_join_orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-null foreign key has no parent row (a sort-merge anti join)."""
    keys = parent.select(F.col(pk).alias("__pk"))
    return shuffle_join(child.where(F.col(fk).isNotNull()), keys, F.col(fk) == F.col("__pk"), "left_anti")


def null_safe_condition(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equality on all keys treating null = null (``<=>``)."""
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[k])
        cond = c if cond is None else cond & c
    return cond


def scalar_filter(df: DataFrame, col: str, scalar: DataFrame, op: str = "==") -> DataFrame:
    """Filter by an uncorrelated one-row, one-column subquery.

    ``scalar`` is an aggregate (one row by construction); it runs once as a
    scalar subquery and its value is used in the filter, so the predicate can
    still be pushed to the scan.
    """
    v = scalar.select(scalar.columns[0]).scalar()
    cond = {"==": F.col(col) == v, ">": F.col(col) > v, ">=": F.col(col) >= v,
            "<": F.col(col) < v}[op]
    return df.where(cond)
