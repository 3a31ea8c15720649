"""Bronze -> silver.

One code path builds silver for a first load and for every later batch:
flatten, explode, parse, deduplicate to the event key (keeping the newest
ingest), then the per-case window metrics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import case_number_digits, parse_event_ts, parse_filing_ts, parts_of_digits
from ..operators.merge import bucket_of, merge_cases
from ..operators.windows import case_metrics, dedup_latest, hot_cases
from ..schemas import EVENT_KEY, FLAT_COLUMNS, SILVER_COLUMNS


def flatten_hits(bronze: DataFrame, keep_ingest: bool = True) -> DataFrame:
    """B1 + B2 + B4 + B5: one row per movement; null or empty ``movimentos`` vanish.

    Only the nested fields named here are read (nested column pruning).
    """
    s = "_source."
    cols = [
        F.col(s + "numeroProcesso").alias("numero_processo"),
        F.col(s + "tribunal").alias("sigla_tribunal"),
        F.col(s + "grau").alias("grau"),
        parse_filing_ts(F.col(s + "dataAjuizamento")).alias("data_ajuizamento"),
        F.col(s + "classe.codigo").alias("codigo_classe"),
        F.col(s + "classe.nome").alias("nome_classe"),
        F.col(s + "orgaoJulgador.codigo").alias("codigo_orgao"),
        F.col(s + "orgaoJulgador.nome").alias("nome_orgao"),
        F.col(s + "nivelSigilo").alias("nivel_sigilo"),
        F.explode(F.col(s + "movimentos")).alias("__mov"),
    ]
    if keep_ingest and "data_ingestao" in bronze.columns:
        cols.append(F.col("data_ingestao"))
    exploded = bronze.select(*cols)
    out = [c for c in FLAT_COLUMNS if c not in ("codigo_movimento", "nome_movimento", "data_movimento")]
    extra = ["data_ingestao"] if "data_ingestao" in exploded.columns else []
    return exploded.select(
        *out,
        F.col("__mov.codigo").alias("codigo_movimento"),
        F.col("__mov.nome").alias("nome_movimento"),
        parse_event_ts(F.col("__mov.dataHora")).alias("data_movimento"),
        *extra,
    ).select(*FLAT_COLUMNS, *extra)


def hot_cases_from_bronze(bronze: DataFrame, hot_case_rows: int, stored: DataFrame | None = None) -> DataFrame:
    """Hot cases counted from the nested hits (one array size per hit, no explode) and
    from the stored rows of their cases, which they will be rebuilt with."""
    case = F.col("_source.numeroProcesso").alias("numero_processo")
    counts = bronze.select(case, F.coalesce(F.size("_source.movimentos"), F.lit(0)).alias("__m")).where(F.col("__m") > 0)
    if stored is not None:
        counts = counts.unionByName(stored.groupBy("numero_processo").agg(F.count(F.lit(1)).cast("int").alias("__m")))
    return hot_cases(counts, "numero_processo", "__m", hot_case_rows)


def add_case_number_parts(df: DataFrame, col: str = "numero_processo") -> DataFrame:
    """B6 + B13: ``SELECT *, parts...``. The digits are a column of their own, so that a row is stripped once."""
    return df.withColumn("__digits", case_number_digits(col)).withColumns(parts_of_digits("__digits")).drop("__digits")


INGEST = "data_ingestao"


def dedup_events(flat: DataFrame, order_by: tuple[str, ...] = (INGEST,)) -> DataFrame:
    """One row per event key, the newest wins (null-safe keys).

    Newest = the latest ingest time, then the row hash; columns absent are skipped.
    """
    order = [c for c in order_by if c in flat.columns]
    return dedup_latest(flat, EVENT_KEY, order)


def build_silver(flat: DataFrame, processed_at: str | Column | None = None,
                 dedup: bool = True, hot_case_rows: int | None = None,
                 hot: DataFrame | None = None, slice_rows: int = 1_000_000, only: str | None = None) -> DataFrame:
    """Flat events -> silver rows (``SILVER_COLUMNS``).

    The ingest time is kept (null where the input has none): a later merge compares
    copies of an event by it, whatever the order of the batches.
    ``processed_at``: fixed processing time for reproducible output; default
    ``current_timestamp()`` as in the reference. ``only``: of the cases with a row marked in this column.
    """
    return silver_columns(silver_events(flat, dedup, hot_case_rows, hot, slice_rows, only), processed_at)


def silver_events(flat: DataFrame, dedup: bool = True, hot_case_rows: int | None = None,
                  hot: DataFrame | None = None, slice_rows: int = 1_000_000, only: str | None = None) -> DataFrame:
    """The part of ``build_silver`` that needs other rows: one row per event key with gap and latest flag."""
    ingest = F.col(INGEST) if INGEST in flat.columns else F.lit(None).cast("timestamp")
    df = flat.select(*FLAT_COLUMNS, ingest.alias(INGEST), *([only] if only else []))
    # dedup to the event key (H2) is fused into the window pass; derived
    # columns are added after it so they do not ride through the shuffle
    return case_metrics(df, hot_case_rows=hot_case_rows, dedup_order=[INGEST] if dedup else None,
                        hot=hot, slice_rows=slice_rows, only=only)


def silver_columns(events: DataFrame, processed_at: str | Column | None = None, *more: str) -> DataFrame:
    """The part of ``build_silver`` that needs only a row: case-number parts, age and processing time; ``more``: columns to keep."""
    df = add_case_number_parts(events)
    df = df.withColumn("dias_desde_ajuizamento",
                       F.datediff(F.col("data_movimento"), F.col("data_ajuizamento")))
    if processed_at is None:
        stamp = F.current_timestamp()
    elif isinstance(processed_at, str):
        stamp = F.to_timestamp(F.lit(processed_at))
    else:
        stamp = processed_at
    return df.withColumn("data_processamento", stamp).select(*SILVER_COLUMNS, *more)


def merge_silver(existing: DataFrame, batch_flat: DataFrame,
                 processed_at: str | Column | None = None,
                 hot_case_rows: int | None = None) -> DataFrame:
    """Touched-case upsert of a flat batch into silver (H3): every case in the
    batch is rebuilt from its stored events plus the batch's, newest copy of
    each event winning; other cases are unchanged."""
    def rebuild(combined: DataFrame) -> DataFrame:
        return build_silver(combined, processed_at=processed_at, hot_case_rows=hot_case_rows)
    return merge_cases(existing, batch_flat, "numero_processo", rebuild)


_TIMELINE = ["numero_processo", "nome_movimento", "data_movimento", "dias_desde_ajuizamento",
             "dias_desde_ultimo_movimento", "is_ultimo_movimento", "codigo_movimento"]


def case_timeline(silver: DataFrame, case: str | Column | None = None, buckets: int | None = None) -> DataFrame:
    """F4 + C8 + F5: one case's events in time order.

    Without a case the smallest case number with a timed event is used
    (a deterministic stand-in for the reference's ``LIMIT 1``), as a scalar
    subquery over two columns. A silver stored in ``buckets`` of the case is read in one bucket only.
    """
    if case is None:
        case = silver.where(F.col("data_movimento").isNotNull()).agg(F.min("numero_processo")).scalar()
    elif isinstance(case, str):
        case = F.lit(case)
    sel = silver.where(F.col("numero_processo") == case)
    if buckets:
        sel = sel.where(F.col("bucket") == bucket_of(case, buckets))
    return (sel.select(*_TIMELINE)
            .orderBy(F.col("data_movimento").asc_nulls_first(), "codigo_movimento"))
