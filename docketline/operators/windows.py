"""Per-case window metrics, skew-aware.

The reference computes the gap to the previous event with ``lag`` over an
ascending window and the latest flag with ``row_number`` over a descending
one: one exchange, two sorts. Here both come from one ascending window
(``lag`` for the gap, ``lead(1) IS NULL`` for the latest flag): one exchange,
one sort. The order is made total with a row hash (hazard H1).

Hot cases. A window holds a whole partition-by group in one task. When one
case may carry a large share of all events, ``case_metrics`` splits such
cases: they are range-partitioned on the full sort key (so one case spans
many tasks), the partition id is pinned by writing the rows, metrics
are computed inside each (case, slice) and the slice borders are fixed from
a per-slice summary (one row per slice, so bounded by the slice count).
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shuffles_dropped, work_dir
from .joins import BROADCAST_BYTES

TIE = "__tie"


def with_tiebreak(df: DataFrame, name: str = TIE) -> DataFrame:
    """Row hash over every column: a deterministic last sort key."""
    return df.withColumn(name, F.xxhash64(*[F.col(c) for c in df.columns]))


def _order(ts: str, tie: Sequence[str], h: str) -> list[Column]:
    return ([F.col(ts).asc_nulls_first()] + [F.col(t).asc_nulls_first() for t in tie]
            + [F.col(h).asc()])


def case_window(case: str, ts: str, tie: Sequence[str] = (), h: str = TIE):
    """The one named window shared by lag and lead."""
    return Window.partitionBy(case).orderBy(*_order(ts, tie, h))


def _plain(df: DataFrame, case: str, ts: str, tie: Sequence[str], gap: str, latest: str,
           h: str, dedup_order: Sequence[str] | None = None, only: str | None = None) -> DataFrame:
    """Metrics with one hash exchange on the case and one sort.

    With ``dedup_order`` the rows are reduced to one per (case, ts, *tie) -
    the greatest by ``dedup_order`` then row hash - in the same window: copies
    of an event lie side by side, newest first, so a row stays if the one
    before it has another key. That one has the time of the event before, and
    the rows of the last key are those that equal the case's last row. The row
    hash is taken after the exchange and does not travel. ``only`` (with
    ``dedup_order``): cases without a row marked in it are dropped, in that window too.
    """
    if dedup_order is None:
        w = case_window(case, ts, tie, h)
        return (df.withColumn(gap, F.datediff(F.col(ts), F.lag(ts).over(w)))
                  .withColumn(latest, F.lead(F.lit(1)).over(w).isNull()))
    plain = [c for c in df.columns if c not in (h, only)]
    df = df.drop(h).repartition(F.col(case)).withColumn(h, F.xxhash64(*plain))
    w = Window.partitionBy(case).orderBy(
        F.col(ts).asc_nulls_first(), *[F.col(t).asc_nulls_first() for t in tie],
        *[F.col(c).desc_nulls_last() for c in dedup_order], F.col(h).desc())
    whole, key = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing), [ts, *tie]
    cols = [*plain, h]
    df = df.select("*", F.lag(F.lit(1)).over(w).alias("__before"),
                   *[F.lag(c).over(w).alias(f"__before_{c}") for c in key],
                   *[F.last(c).over(whole).alias(f"__end_{c}") for c in key],
                   (F.max(only).over(whole) if only else F.lit(True)).alias("__picked"))
    same = [reduce(and_, [F.col(c).eqNullSafe(F.col(f"__{at}_{c}")) for c in key]) for at in ("before", "end")]
    return (df.where(F.col("__picked") & (F.col("__before").isNull() | ~same[0]))
              .select(*cols, F.datediff(F.col(ts), F.col(f"__before_{ts}")).alias(gap), same[1].alias(latest)))


def _split(df: DataFrame, case: str, ts: str, tie: Sequence[str], gap: str, latest: str,
           h: str, slices: int) -> DataFrame:
    """Metrics for hot cases, computed over range slices of each case."""
    part = "__slice"
    order = _order(ts, tie, h)
    # pinned as written rows: columns, compressed, a fraction of a checkpoint's size
    at, spark = work_dir(df.sparkSession, "slices", uuid.uuid4().hex), df.sparkSession
    ranged = df.repartitionByRange(slices, F.col(case), *order).withColumn(part, F.spark_partition_id())
    with shuffles_dropped(spark):
        ranged.write.parquet(at)
    ranged = spark.read.schema(ranged.schema).parquet(at)
    w = Window.partitionBy(case, part).orderBy(*order)
    local = (ranged.withColumn("__prev", F.lag(ts).over(w))
                   .withColumn("__first", F.lag(F.lit(1)).over(w).isNull())
                   .withColumn("__last", F.lead(F.lit(1)).over(w).isNull()))
    key = F.struct(*[F.col(c) for c in [ts, *tie, h]])
    summary = (ranged.groupBy(case, part).agg(F.max(key).alias("__tail")))
    ws = Window.partitionBy(case).orderBy(part)
    summary = (summary.select(
        case, part,
        F.lag(F.col("__tail")[ts]).over(ws).alias("__prev_tail"),
        F.lead(F.lit(1)).over(ws).isNull().alias("__last_slice")))
    # one row per (case, slice); both sides are clustered by these keys already. A null case joins too.
    keys = summary.select(F.col(case).alias("__case"), F.col(part).alias("__part"), "__prev_tail", "__last_slice")
    out = local.join(keys.hint("merge"), F.col(case).eqNullSafe(F.col("__case")) & (F.col(part) == F.col("__part")))
    prev = F.when(F.col("__first"), F.col("__prev_tail")).otherwise(F.col("__prev"))
    return (out.withColumn(gap, F.datediff(F.col(ts), prev))
               .withColumn(latest, F.col("__last") & F.col("__last_slice"))
               .drop("__prev", "__first", "__last", "__prev_tail", "__last_slice", "__case", "__part", part))


def hot_cases(counts: DataFrame, case: str, n: str, hot_case_rows: int) -> DataFrame:
    """Cases with more than ``hot_case_rows`` events, from a per-case count:
    at most total_rows / hot_case_rows rows, the null case among them.

    Count where it is cheapest (e.g. ``size(movimentos)`` per hit in bronze,
    or rows per key in the source table) instead of re-reading the events.
    """
    return (counts.groupBy(case).agg(F.sum(n).alias("__n"))
            .where(F.col("__n") > hot_case_rows))


def case_metrics(df: DataFrame, case: str = "numero_processo", ts: str = "data_movimento",
                 tie: Sequence[str] = ("codigo_movimento",),
                 gap: str = "dias_desde_ultimo_movimento",
                 latest: str = "is_ultimo_movimento",
                 hot_case_rows: int | None = None,
                 dedup_order: Sequence[str] | None = None,
                 hot: DataFrame | None = None, slice_rows: int = 1_000_000, only: str | None = None) -> DataFrame:
    """W1 + W2: days since the previous event of the case, and the latest flag.

    ``dedup_order``: first keep one row per event key (case, ts, *tie), the
    greatest by these columns (W4/H2), fused into the metric pass.
    ``hot_case_rows``: cases with more events than this go through the
    sliced path. ``hot``: those cases with their counts (``hot_cases``), if
    already known; otherwise they are counted from ``df`` (one more pass over
    it). ``hot_case_rows=None`` skips the check. ``slice_rows``: rows of hot cases per range slice.
    ``only``: a boolean column, true in some row of each case that is wanted; it needs ``dedup_order``, and no hot cases.
    """
    if only and (hot_case_rows is not None or dedup_order is None):
        raise ValueError("only: with dedup_order, without hot_case_rows")
    cols = [c for c in df.columns if c != only]
    df = with_tiebreak(df)
    if hot_case_rows is None:
        return _plain(df, case, ts, tie, gap, latest, TIE, dedup_order, only).select(*cols, gap, latest)
    if hot is None:
        hot = hot_cases(df.select(case, F.lit(1).alias("__one")), case, "__one", hot_case_rows)
    # read three times (their number, two joins): written once
    at, names = work_dir(df.sparkSession, "hot", uuid.uuid4().hex), hot.schema
    with shuffles_dropped(df.sparkSession):
        hot.write.parquet(at)
    hot = df.sparkSession.read.schema(names).parquet(at)
    stats = hot.agg(F.count(F.lit(1)).alias("k"), F.sum("__n").alias("rows")).first()
    if not stats["k"]:
        return _plain(df, case, ts, tie, gap, latest, TIE, dedup_order).select(*cols, gap, latest)
    keys = hot.select(F.col(case).alias("__case"))
    # a few bytes a key: broadcast only as far as that stays small
    keys = F.broadcast(keys) if stats["k"] * 64 <= BROADCAST_BYTES else keys.hint("merge")
    same = F.col(case).eqNullSafe(F.col("__case"))
    cold = df.join(keys, same, "left_anti")
    hot_rows = df.join(keys, same, "left_semi")
    if dedup_order is not None:
        # copies of one event collapse map-side in the aggregate, then the
        # surviving rows are sliced
        hot_rows = with_tiebreak(dedup_latest(hot_rows.drop(TIE), [case, ts, *tie], dedup_order))
    slices = max(2, math.ceil(stats["rows"] / slice_rows))
    out_cold = _plain(cold, case, ts, tie, gap, latest, TIE, dedup_order).select(*cols, gap, latest)
    out_hot = _split(hot_rows, case, ts, tie, gap, latest, TIE, slices).select(*cols, gap, latest)
    return out_cold.unionByName(out_hot)


def dedup_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key, the one with the greatest ``order_by`` (ties: row hash).

    Written as ``max(struct)`` per key rather than ``row_number() = 1``: it is
    an ordinary aggregate, so map-side partial aggregation collapses a key
    with many copies before the shuffle. Null keys group together (null-safe).
    """
    cols = df.columns
    rest = [c for c in cols if c not in keys]
    tmp = with_tiebreak(df)
    packed = F.struct(*[F.col(c) for c in order_by], F.col(TIE).alias(TIE),
                      *[F.col(c) for c in rest if c not in order_by])
    agg = tmp.groupBy(*keys).agg(F.max(packed).alias("__best"))
    return agg.select(*[F.col(c) if c in keys else F.col("__best")[c].alias(c) for c in cols])


def share_of_total(df: DataFrame, count_col: str, out: str, scale: int = 2) -> DataFrame:
    """``count * 100 / sum(count) over ()`` on an already aggregated frame."""
    total = F.sum(count_col).over(Window.partitionBy())
    return df.withColumn(out, F.round(F.col(count_col).cast("double") * 100.0 / total, scale))
