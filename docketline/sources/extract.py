"""Bounded extracts and per-source watermarks.

The reference fetches, per source, the cases filed inside a window
[start 00:00:00, end 23:59:59], chooses start from a saved watermark, else a
manual value, else a default, skips sources already up to date, and advances
the watermark only for sources that loaded something. Here the sources,
the state and the windows are small DataFrames, and the extract is a
broadcast range join of the hits against one window row per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.parse import clamp_date, parse_filing_ts
from ..operators.joins import checked_broadcast
from ..session import complete_children

# Fixed values that must equal the reference's: default first day, and the
# nine requested source fields.
DEFAULT_START = "2024-01-01"
SOURCE_FIELDS = ("numeroProcesso", "tribunal", "grau", "dataAjuizamento", "classe",
                 "orgaoJulgador", "movimentos", "assuntos", "nivelSigilo")
STATE_DDL = "tribunal string, watermark string"


def _check_date_text(label: str, v: str | None) -> None:
    """Parameters (not data) are checked on the driver: three integers or an error."""
    if v is None:
        return
    parts = v.split("-")
    if len(parts) != 3 or not all(p.lstrip("-").isdigit() for p in parts):
        raise ValueError(f"invalid {label}: '{v}' (use YYYY-MM-DD)")


def require_dates(df: DataFrame, cols: list[str]) -> DataFrame:
    """B12 error path: fail the job if a date text is not three integers.

    The check is a filter (true, or an error), so the optimizer cannot prune it.
    """
    for c in cols:
        bad = F.col(c).isNotNull() & clamp_date(F.col(c)).isNull()
        msg = F.concat(F.lit(f"invalid {c}: '"), F.col(c), F.lit("' (use YYYY-MM-DD)"))
        df = df.where(F.when(bad, F.raise_error(msg)).otherwise(F.lit(True)))
    return df


def _filed(bronze: DataFrame) -> Column:
    """The filing time: bronze's typed column, which a scan can filter on, else parsed from the text."""
    return F.col("filed_at") if "filed_at" in bronze.columns else parse_filing_ts(F.col("_source.dataAjuizamento"))


def extract_range(bronze: DataFrame, start: str | Column, end: str | Column, *more: str) -> DataFrame:
    """Hits filed in [start 00:00:00, end 23:59:59], nine source fields (and the columns ``more``), in cursor order."""
    s = F.to_timestamp(F.to_date(start if isinstance(start, Column) else F.lit(start)))
    e = F.to_timestamp(F.to_date(end if isinstance(end, Column) else F.lit(end))) + F.expr("INTERVAL 86399 SECONDS")
    out = bronze.where(_filed(bronze).between(s, e))
    return out.select(F.struct(*[F.col(f"_source.{f}").alias(f) for f in SOURCE_FIELDS]).alias("_source"),
                      "sort", "tribunal", *more).orderBy("sort")


class PagedExtract:
    """A12 by cursor: an extract in the order of (``sort``, ``_id``), stored once and read page by page.

    ``write`` range-partitions the hits by the cursor and sorts each slice; a hit's ``slot`` (slice and place in it) grows
    with the order and is pinned by the write, so hits with equal cursors keep one order. ``borders`` has a row per page
    with its first and last cursor. A reader that stopped after page k goes on with ``after(k)``: the slots of the next
    pages are one range, which the scan filters on. Null cursors come first; an empty extract has no pages.
    One writer; a path is written once.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def write(self, hits: DataFrame, page_rows: int = 500) -> PagedExtract:
        (hits.repartitionByRange("sort", "_id").sortWithinPartitions("sort", "_id")
         .withColumn("slot", F.monotonically_increasing_id()).write.parquet(f"{self.path}/hits"))
        # rows before each slice: one row per slice, as many as the exchange has partitions
        sizes = (self.spark.read.parquet(f"{self.path}/hits").groupBy(F.shiftright("slot", 33).alias("slice"))
                 .agg(F.count(F.lit(1)).alias("n")))
        before = F.coalesce(F.sum("n").over(Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        sizes.select("slice", before.alias("before"), F.lit(page_rows).alias("page_rows")).write.parquet(f"{self.path}/slices")
        ends = F.struct("slot", "sort", "_id")
        (self._numbered().groupBy("page").agg(F.count(F.lit(1)).alias("hits"), F.min(ends).alias("first"), F.max(ends).alias("last"))
         .write.parquet(f"{self.path}/borders"))
        return self

    def _numbered(self) -> DataFrame:
        """The stored hits with their page."""
        slices = self.spark.read.parquet(f"{self.path}/slices")
        place = F.col("slot").bitwiseAND(F.lit((1 << 33) - 1))
        hits = self.spark.read.parquet(f"{self.path}/hits").withColumn("slice", F.shiftright("slot", 33))
        page = F.floor((F.col("before") + place) / F.col("page_rows"))
        return hits.join(F.broadcast(slices), "slice").withColumn("page", page).drop("slice", "before", "page_rows")

    def borders(self) -> DataFrame:
        """(page, hits, first, last): ``first`` and ``last`` are structs of slot, sort and _id."""
        return self.spark.read.parquet(f"{self.path}/borders")

    def after(self, page: int = -1, pages: int | None = None) -> DataFrame:
        """The hits of the ``pages`` pages after ``page`` (all that are left without it), with ``page`` and ``slot``."""
        todo = self.borders().where(F.col("page") > page)
        if pages is not None:
            todo = todo.where(F.col("page") <= page + pages)
        lo, hi = todo.agg(F.min("first.slot"), F.max("last.slot")).first()
        stored = self._numbered()
        return stored.where(F.lit(False)) if lo is None else stored.where(F.col("slot").between(lo, hi))


def watermark_windows(sources: DataFrame, state: DataFrame, end: str,
                      manual: str | None = None, default: str = DEFAULT_START) -> DataFrame:
    """(tribunal, data_inicio, data_fim, origem) for sources that need a fetch.

    Start = saved watermark, else manual input, else default (the code's
    precedence, H14); dates are clamped (B12) and text that is not a date
    fails the job; sources with start >= end are skipped.
    """
    st = checked_broadcast(state.select("tribunal", F.col("watermark")))
    j = sources.select("tribunal").distinct().join(st, "tribunal", "left")
    raw = F.coalesce(F.col("watermark"), F.lit(manual).cast("string"), F.lit(default))
    origem = (F.when(F.col("watermark").isNotNull(), F.lit("watermark"))
              .when(F.lit(manual).isNotNull(), F.lit("manual")).otherwise(F.lit("default")))
    for label, v in (("end", end), ("manual", manual), ("default", default)):
        _check_date_text(label, v)
    w = require_dates(j.select("tribunal", raw.alias("__ini"), origem.alias("origem")), ["__ini"])
    w = w.select("tribunal", clamp_date("__ini").alias("data_inicio"),
                 clamp_date(F.lit(end)).alias("data_fim"), "origem")
    return w.where(F.col("data_inicio") < F.col("data_fim"))


def extract_windows(bronze: DataFrame, windows: DataFrame, by: str | None = None) -> DataFrame:
    """Hits of each source inside its own window (inclusive end day, H12 noted).

    ``by``: the time column that the window is on; default the filing time, as in the reference. With
    ``data_ingestao`` a late filing of an old case is not missed (H11).
    """
    w = checked_broadcast(windows)
    at = _filed(bronze) if by is None else F.col(by)
    lo = F.to_timestamp(F.col("data_inicio"))
    hi = F.to_timestamp(F.col("data_fim")) + F.expr("INTERVAL 86399 SECONDS")
    return (bronze.join(w, "tribunal").where(at.between(lo, hi))
            .drop("data_inicio", "data_fim", "origem"))


def advance_watermark(state: DataFrame, windows: DataFrame, loaded: DataFrame) -> DataFrame:
    """New state. A source moves to its window end only if it loaded
    at least one hit; an empty or failed load keeps the old watermark."""
    ok = (windows.join(loaded.where(F.col("hits") > 0), "tribunal")
          .select("tribunal", F.date_format("data_fim", "yyyy-MM-dd").alias("__new")))
    merged = state.join(ok, "tribunal", "full")
    return merged.select("tribunal", F.coalesce(F.col("__new"), F.col("watermark")).alias("watermark"))


def _state_versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n.removeprefix("v=")) for n in complete_children(spark, path))


def read_watermark(spark: SparkSession, path: str) -> DataFrame:
    """The newest saved state; none saved means no watermark yet."""
    done = _state_versions(spark, path)
    return spark.read.schema(STATE_DDL).json(f"{path}/v={done[-1]}") if done else spark.createDataFrame([], STATE_DDL)


def write_watermark(state: DataFrame, path: str) -> None:
    """Save the state after the data commit, as a new version: a reader, or
    a crash in between, always finds a whole one. The new state may derive from the old one."""
    done = _state_versions(state.sparkSession, path)
    state.coalesce(1).write.mode("overwrite").json(f"{path}/v={done[-1] + 1 if done else 0}")
