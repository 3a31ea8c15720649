"""The driver's TPC-H-like tables re-read as the case/event model (FIXTURES.md §2).

This is the only module that knows the test tables. Everything it returns is
a lazy DataFrame derived from whole tables:

* ``case_header``  one row per order = one case (orders ⋈ customer ⋈ nation ⋈ region)
* ``movements``    one row per lineitem = one event, flat silver input
* ``bronze_hits``  the same events nested back into search hits (one hit per
                   case, instance and bounded chunk of events), with
                   mixed-format filing dates and JSON-string subjects
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parse import FILING_TS_FORMATS
from ..operators.joins import checked_broadcast, shuffle_join
from ..session import shuffles_dropped

# Events per hit before a case/instance is split into several hits.
HIT_EVENTS = 1000
# Default ingest time stamped on fixture bronze (deterministic, not "now").
FIXTURE_INGEST = "2001-12-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def case_number(key: Column, year: Column, region: Column, nation: Column) -> Column:
    """A 20-digit case number that no two order keys share.

    The key's last seven digits are the sequence, the two before them the check
    digits, two more open the origin segment and one the court segment: twelve digits
    in all, and an error beyond.
    """
    def digits(div: int, width: int) -> Column:
        return F.lpad(_s(((key - F.pmod(key, F.lit(div))) / F.lit(div)).cast("bigint") % F.lit(10 ** width)), width, "0")

    number = F.concat(digits(1, 7), digits(10 ** 7, 2), F.lpad(_s(year), 4, "0"), F.lit("8"), digits(10 ** 11, 1), _s(region),
                      digits(10 ** 9, 2), F.lpad(_s(nation), 2, "0"))
    fits = key.between(0, 10 ** 12 - 1) & region.between(0, 9) & nation.between(0, 99)
    return F.when(fits, number).otherwise(F.raise_error(F.lit("order, region or nation key beyond the case number")))


def case_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One case per order, with court (region), organ (nation) and class (priority)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                              "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = checked_broadcast(table(spark, sf_dir, "nation")
                          .select("n_nationkey", "n_name", "n_regionkey"))
    r = checked_broadcast(table(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    j = (shuffle_join(o, c, o.o_custkey == c.c_custkey)
          .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
          .join(r, F.col("n_regionkey") == F.col("r_regionkey")))
    numero = case_number(F.col("o_orderkey"), F.year("o_orderdate"), F.col("r_regionkey"), F.col("n_nationkey"))
    return j.select(
        F.col("o_orderkey"),
        F.col("o_custkey"),
        F.col("c_mktsegment"),
        F.col("o_orderpriority"),
        numero.alias("numero_processo"),
        F.col("r_name").alias("sigla_tribunal"),
        F.col("o_orderdate").cast("timestamp").alias("data_ajuizamento"),
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("codigo_classe"),
        F.substring("o_orderpriority", 3, 1 << 20).alias("nome_classe"),
        F.col("n_nationkey").cast("bigint").alias("codigo_orgao"),
        F.col("n_name").alias("nome_orgao"),
        F.pmod(F.col("o_orderkey"), F.lit(5)).cast("bigint").alias("nivel_sigilo"),
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linestatus",
        F.col("l_shipdate").cast("timestamp").alias("data_movimento"))


def movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat events (silver input), one per lineitem."""
    h = case_header(spark, sf_dir)
    e = _events(spark, sf_dir)
    j = shuffle_join(e, h, e.l_orderkey == h.o_orderkey)
    return j.select(
        "numero_processo", "sigla_tribunal",
        F.col("l_linestatus").alias("grau"),
        "data_ajuizamento", "codigo_classe", "nome_classe", "codigo_orgao", "nome_orgao",
        "nivel_sigilo",
        F.col("l_partkey").alias("codigo_movimento"),
        F.concat(F.lit("movimento "), _s(F.col("l_partkey"))).alias("nome_movimento"),
        "data_movimento",
    )


def hot_cases(spark: SparkSession, sf_dir: str, hot_case_rows: int) -> DataFrame:
    """Cases with more than ``hot_case_rows`` events, counted on lineitem's order
    key alone (one column, partial aggregation) and only then named."""
    from ..operators.windows import hot_cases as _hot
    per_order = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("__k"))
    big = per_order.where(F.col("__k") > hot_case_rows)
    with shuffles_dropped(spark):
        none = big.isEmpty()
    if none:                                                 # no order needs its name: the header is not joined
        return spark.createDataFrame([], "numero_processo string, __n bigint")
    named = shuffle_join(case_header(spark, sf_dir), big, F.col("o_orderkey") == F.col("l_orderkey"))
    return _hot(named.select("numero_processo", "__k"), "numero_processo", "__k", hot_case_rows)


def _filing_text(ts: Column, selector: Column) -> Column:
    """Filing time written in one of the four accepted formats, chosen per case."""
    expr = None
    for i, f in enumerate(FILING_TS_FORMATS):
        cond = selector == i
        txt = F.date_format(ts, f)
        expr = F.when(cond, txt) if expr is None else expr.when(cond, txt)
    return expr


def subjects(h: DataFrame) -> Column:
    """JSON-string subjects per case, with bad, null and code-less elements mixed in."""
    k = F.col("o_orderkey")
    good1 = F.to_json(F.struct((F.lit(1000) + F.pmod(F.col("o_custkey"), F.lit(50))).alias("codigo"),
                               F.concat(F.lit("assunto "), F.col("c_mktsegment")).alias("nome")))
    good2 = F.to_json(F.struct((F.lit(2000) + F.pmod(k, F.lit(30))).alias("codigo"),
                               F.concat(F.lit("assunto "), F.col("o_orderpriority")).alias("nome")))
    bad = F.when(F.pmod(k, F.lit(7)) == 0, F.lit("bad"))
    nul = F.when(F.pmod(k, F.lit(11)) == 0, F.lit(None).cast("string"))
    nocode = F.when(F.pmod(k, F.lit(13)) == 0, F.lit('{"nome": "sem codigo"}'))
    arr = F.array(good1, good2, bad, nul, nocode)
    # keep the deliberate null element only where selected; drop unselected slots
    keep = F.array(F.lit(True), F.lit(True), F.pmod(k, F.lit(7)) == 0,
                   F.pmod(k, F.lit(11)) == 0, F.pmod(k, F.lit(13)) == 0)
    zipped = F.arrays_zip(arr.alias("v"), keep.alias("k"))
    return F.transform(F.filter(zipped, lambda z: z["k"]), lambda z: z["v"])


def subject_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped hits carrying only the subjects: one per case with events.

    Enough for the subject dimension (one smallest name per code does not
    depend on how often a case repeats), without nesting every event.
    """
    h = case_header(spark, sf_dir)
    keys = table(spark, sf_dir, "lineitem").select("l_orderkey").distinct()
    j = shuffle_join(h, keys, h.o_orderkey == keys.l_orderkey, "left_semi")
    return j.select(F.struct(F.col("numero_processo").alias("numeroProcesso"),
                             subjects(h).alias("assuntos")).alias("_source"))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem as raw events: (l_orderkey, l_partkey, l_linestatus, data_movimento, nome)."""
    return _events(spark, sf_dir).withColumn(
        "nome", F.concat(F.lit("movimento "), _s(F.col("l_partkey"))))


def bronze_hits(spark: SparkSession, sf_dir: str, ingest_ts: str = FIXTURE_INGEST,
                hit_events: int = HIT_EVENTS, events: DataFrame | None = None,
                drop_fields: tuple[str, ...] = ()) -> DataFrame:
    """Nested search hits (BRONZE schema) built from the tables.

    Events are grouped per (case, instance); a group with more than
    ``hit_events`` events is spread over several hits by a hash of the event,
    so no single row collects an unbounded list; the hits of a large case are gathered in different
    tasks. Queries on hits therefore combine the hits of a case. ``events``
    defaults to all lineitems (see ``raw_events``); ``drop_fields`` removes
    source fields (an older schema, for evolution checks).
    """
    h = case_header(spark, sf_dir)
    e = raw_events(spark, sf_dir) if events is None else events
    sizes = (e.groupBy("l_orderkey", "l_linestatus").agg(F.count(F.lit(1)).alias("__n"))
             .where(F.col("__n") > hit_events))
    with shuffles_dropped(spark):
        none = sizes.isEmpty()
    if none:
        # no group is spread: events move once, to their case, where the join with the header takes the hits
        e = e.withColumn("__chunk", F.lit(0).cast("bigint")).repartition("l_orderkey")
    else:
        # only groups beyond one hit are joined with their size (a skewed side that AQE can split); the
        # repartition deals the hits of one large group to different tasks
        e = shuffle_join(e, sizes, ["l_orderkey", "l_linestatus"], "left")
        chunks = F.coalesce(F.ceil(F.col("__n") / F.lit(hit_events)), F.lit(1))
        e = e.withColumn("__chunk", F.pmod(F.xxhash64("l_partkey", "data_movimento"), chunks))
        e = e.repartition("l_orderkey", "l_linestatus", "__chunk")
    # sorted by time then code inside the array; fields reordered after the sort
    mov = F.struct(
        F.date_format("data_movimento", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("dataHora"),
        F.col("l_partkey").alias("codigo"),
        F.col("nome").alias("nome"))
    grouped = (e.groupBy("l_orderkey", "l_linestatus", "__chunk")
                .agg(F.sort_array(F.collect_list(mov)).alias("__movs")))
    grouped = grouped.withColumn("movimentos", F.transform("__movs", lambda m: F.struct(
        m["codigo"].alias("codigo"), m["nome"].alias("nome"), m["dataHora"].alias("dataHora"))))
    j = shuffle_join(grouped, h, grouped.l_orderkey == h.o_orderkey)
    fields = [
        F.col("numero_processo").alias("numeroProcesso"),
        F.col("sigla_tribunal").alias("tribunal"),
        F.col("l_linestatus").alias("grau"),
        _filing_text(F.col("data_ajuizamento"), F.pmod(F.col("o_orderkey"), F.lit(4)))
        .alias("dataAjuizamento"),
        F.struct(F.col("codigo_classe").alias("codigo"), F.col("nome_classe").alias("nome"))
        .alias("classe"),
        F.struct(F.col("codigo_orgao").alias("codigo"), F.col("nome_orgao").alias("nome"))
        .alias("orgaoJulgador"),
        F.col("nivel_sigilo").alias("nivelSigilo"),
        F.col("movimentos"),
        subjects(h).alias("assuntos"),
    ]
    names = ["numeroProcesso", "tribunal", "grau", "dataAjuizamento", "classe", "orgaoJulgador",
             "nivelSigilo", "movimentos", "assuntos"]
    source = F.struct(*[f for f, n in zip(fields, names) if n not in drop_fields])
    return j.select(
        F.concat_ws("-", "numero_processo", "l_linestatus", _s(F.col("__chunk"))).alias("_id"),
        source.alias("_source"),
        F.array(F.col("o_orderkey"), F.col("__chunk").cast("bigint")).alias("sort"),
        F.col("sigla_tribunal").alias("tribunal"),
        F.to_timestamp(F.lit(ingest_ts)).alias("data_ingestao"),
        F.col("data_ajuizamento").alias("filed_at"),
    )


# Batch split used by the merge and streaming checks: events before the cut
# date or without a time, then events from the overlap start on, where the overlap month is
# delivered again with revised names.
BATCH_CUT = "2000-01-01"
OVERLAP_FROM = "1999-12-01"
BATCH1_INGEST = "2001-12-01 00:00:00"
BATCH2_INGEST = "2002-01-01 00:00:00"


def event_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(batch1, batch2) raw events for ``bronze_hits``; same split as ``movement_batches``."""
    e = raw_events(spark, sf_dir)
    ts = F.col("data_movimento")
    cut = F.to_timestamp(F.lit(BATCH_CUT))
    b1 = e.where((ts < cut) | ts.isNull())
    b2 = (e.where(ts >= F.to_timestamp(F.lit(OVERLAP_FROM)))
          .withColumn("nome", F.when(ts < cut, F.concat("nome", F.lit(" (revisto)")))
                      .otherwise(F.col("nome"))))
    return b1, b2


def movement_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(batch1, batch2) flat events with ``data_ingestao``."""
    m = movements(spark, sf_dir)
    ts = F.col("data_movimento")
    cut = F.to_timestamp(F.lit(BATCH_CUT))
    b1 = m.where((ts < cut) | ts.isNull()).withColumn("data_ingestao", F.to_timestamp(F.lit(BATCH1_INGEST)))
    b2 = (m.where(ts >= F.to_timestamp(F.lit(OVERLAP_FROM)))
          .withColumn("nome_movimento",
                      F.when(ts < cut, F.concat("nome_movimento", F.lit(" (revisto)")))
                      .otherwise(F.col("nome_movimento")))
          .withColumn("data_ingestao", F.to_timestamp(F.lit(BATCH2_INGEST))))
    return b1, b2
