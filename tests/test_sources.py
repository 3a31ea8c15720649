import uuid

from pyspark.sql import functions as F

from docketline.plans.silver import flatten_hits
from docketline.session import work_dir
from docketline.sources import fixtures
from docketline.sources.extract import (PagedExtract, advance_watermark, extract_range, read_watermark,
                                        watermark_windows, write_watermark)
from docketline.sources.json_source import read_hits, write_hits

from .conftest import SF_SMALL


def test_json_array_round_trip(spark):
    hits = fixtures.bronze_hits(spark, SF_SMALL)
    path = work_dir(spark, "t", uuid.uuid4().hex)
    write_hits(hits, path, layout="array", hits_per_file=200)
    back = read_hits(spark, path, multiline=True, ingest_ts=fixtures.FIXTURE_INGEST)
    a = sorted(tuple(r) for r in flatten_hits(back, keep_ingest=False).collect())
    b = sorted(tuple(r) for r in fixtures.movements(spark, SF_SMALL).collect())
    assert a == b
    assert {r.tribunal for r in back.select("tribunal").distinct().collect()} == \
        {r.r_name for r in fixtures.table(spark, SF_SMALL, "region").collect()}


def test_extract_range_inclusive_bounds(spark):
    hits = fixtures.bronze_hits(spark, SF_SMALL)
    x = extract_range(hits, "1996-01-01", "1996-01-31")
    days = {r[0] for r in x.select(F.col("_source.dataAjuizamento")).collect()}
    assert x.count() > 0 and all(d[:4] == "1996" or d.startswith("1996") for d in days)
    assert set(x.select("_source.*").columns) == {"numeroProcesso", "tribunal", "grau", "dataAjuizamento",
                                                   "classe", "orgaoJulgador", "movimentos", "assuntos",
                                                   "nivelSigilo"}


def test_pages_join_to_the_extract(spark):
    """Ties across borders, repeated and null cursors; a resume after any page repeats and loses nothing."""
    rows = ([(i, [i // 40], f"id{i:04d}") for i in range(330)] + [(1000 + i, [3], "id0123") for i in range(25)]
            + [(2000, None, None), (2001, None, "x"), (2002, [5], None)])
    hits = spark.createDataFrame(rows, "n int, sort array<long>, _id string").repartition(5)
    p = PagedExtract(spark, work_dir(spark, "t", uuid.uuid4().hex)).write(hits, page_rows=10)
    borders = sorted(p.borders().collect(), key=lambda r: r.page)
    assert [r.page for r in borders] == list(range(36)) and [r.hits for r in borders] == [10] * 35 + [8]
    cursor = lambda x: (x.sort is not None, x.sort or [], x._id is not None, x._id or "")
    assert all(cursor(a["last"]) <= cursor(b["first"]) for a, b in zip(borders, borders[1:]))
    for k in (-1, 0, 12, 35):
        first, rest = p.after(pages=k + 1).collect() if k >= 0 else [], p.after(k).collect()
        assert {r.page for r in first} == set(range(k + 1)) and {r.page for r in rest} == set(range(k + 1, 36))
        assert sorted(r.n for r in first + rest) == sorted(n for n, _, _ in rows)
    plan = p.after(3, 2)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(slot," in plan and "LessThanOrEqual(slot," in plan
    empty = PagedExtract(spark, work_dir(spark, "t", uuid.uuid4().hex)).write(hits.limit(0))
    assert empty.borders().count() == 0 and empty.after().count() == 0


def test_watermark_precedence_and_advance(spark):
    sources = spark.createDataFrame([("A",), ("B",), ("C",)], "tribunal string")
    state = spark.createDataFrame([("A", "2024-02-30"), ("C", "2025-01-01")], "tribunal string, watermark string")
    w = {r.tribunal: r for r in watermark_windows(sources, state, "2024-12-31", manual="2024-06-01").collect()}
    assert set(w) == {"A", "B"}  # C is up to date
    assert (str(w["A"].data_inicio), w["A"].origem) == ("2024-02-29", "watermark")
    assert (str(w["B"].data_inicio), w["B"].origem) == ("2024-06-01", "manual")
    loaded = spark.createDataFrame([("A", 0), ("B", 5)], "tribunal string, hits bigint")
    windows = watermark_windows(sources, state, "2024-12-31", manual="2024-06-01")
    new = {r.tribunal: r.watermark for r in advance_watermark(state, windows, loaded).collect()}
    assert new == {"A": "2024-02-30", "B": "2024-12-31", "C": "2025-01-01"}


def test_missing_watermark_is_empty(spark):
    path = work_dir(spark, "t", uuid.uuid4().hex, "wm")
    assert read_watermark(spark, path).count() == 0
    write_watermark(spark.createDataFrame([("A", "2024-01-01")], "tribunal string, watermark string"), path)
    assert read_watermark(spark, path).first().watermark == "2024-01-01"


def test_fixture_hot_cases_match_event_counts(spark):
    hot = {r["numero_processo"]: r["__n"] for r in fixtures.hot_cases(spark, SF_SMALL, 5).collect()}
    counts = fixtures.movements(spark, SF_SMALL).groupBy("numero_processo").count().where("count > 5")
    assert hot == {r.numero_processo: r["count"] for r in counts.collect()}
    assert len(hot) > 0


def test_subject_hits_give_same_dimension(spark):
    from docketline.plans.dims import dim_assuntos
    a = sorted(tuple(r) for r in dim_assuntos(fixtures.subject_hits(spark, SF_SMALL)).collect())
    b = sorted(tuple(r) for r in dim_assuntos(fixtures.bronze_hits(spark, SF_SMALL)).collect())
    assert a == b and len(a) > 0


def test_watermark_bad_date_fails(spark):
    import pytest
    sources = spark.createDataFrame([("A",)], "tribunal string")
    state = spark.createDataFrame([], "tribunal string, watermark string")
    with pytest.raises(Exception, match="invalid"):
        watermark_windows(sources, state, "2024-12").collect()


def test_forced_reload_doubles_bronze_not_silver(spark):
    from docketline.plans.silver import build_silver
    from docketline.sources.json_source import BronzeTable
    from docketline.streaming.ingest import reload_files
    root = work_dir(spark, "t", uuid.uuid4().hex)
    write_hits(fixtures.bronze_hits(spark, SF_SMALL), f"{root}/landing")
    reload_files(spark, f"{root}/landing", f"{root}/bronze", "r1", ingest_ts="2021-01-01 00:00:00")
    reload_files(spark, f"{root}/landing", f"{root}/bronze", "r2", ingest_ts="2021-02-01 00:00:00")
    bronze = BronzeTable(spark, f"{root}/bronze").read()
    hits = fixtures.bronze_hits(spark, SF_SMALL).count()
    assert bronze.count() == 2 * hits
    silver = build_silver(flatten_hits(bronze), processed_at="2022-01-01")
    assert silver.count() == fixtures.movements(spark, SF_SMALL).count()


def test_case_numbers_do_not_collide(spark):
    from docketline.sources.fixtures import case_number
    keys = [7, 1234567, 12345678, 11234567, 112345678, 212345678, 10**9 + 7, 10**11 + 7, 999_999_999_999]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    col = F.col("k")
    got = [r[0] for r in df.select(case_number(col, F.lit(1995), F.lit(3), F.lit(24))).collect()]
    assert len(set(got)) == len(keys) and all(len(n) == 20 and n.isdigit() for n in got)
    import pytest
    with pytest.raises(Exception, match="beyond the case number"):
        df.select(case_number(col + 10**12, F.lit(1995), F.lit(3), F.lit(24))).collect()


def test_watermark_by_ingest_time(spark):
    from docketline.sources.extract import extract_windows
    hits = fixtures.bronze_hits(spark, SF_SMALL)
    w = spark.createDataFrame([("ASIA", "2001-11-01", "2001-12-31")], "tribunal string, data_inicio string, data_fim string").select(
        "tribunal", F.to_date("data_inicio").alias("data_inicio"), F.to_date("data_fim").alias("data_fim"), F.lit("x").alias("origem"))
    assert extract_windows(hits, w).count() == 0
    assert extract_windows(hits, w, by="data_ingestao").count() == hits.where("tribunal = 'ASIA'").count() > 0


def test_database_is_created_once(spark):
    from docketline.sources.json_source import ensure_database
    name = f"db_{uuid.uuid4().hex}"
    ensure_database(spark, name)
    ensure_database(spark, name)
    assert spark.catalog.databaseExists(name)
    spark.sql(f"DROP DATABASE {name}")


def test_changed_types_cost_a_field_and_not_the_hit(spark, tmp_path):
    import json

    from docketline.plans.medallion import Medallion
    from .test_medallion import hit, land, rows

    root = str(tmp_path)
    odd = hit("A", (1, "a", "2020-01-01"), (2, "b", "2020-01-05"), nivelSigilo="alto", nova={"k": [1]})
    odd["_source"]["movimentos"][1]["codigo"] = "x"
    flat_moves = hit("B", (1, "a", "2020-01-01"), movimentos={"codigo": 1}, nova=7)
    land(root, "one", odd, flat_moves, json.dumps([hit("C", (1, "c", "2020-02-01"))]), "[1, 2]", '"text"', '{"_id": "broken')
    land(root, "two", hit("D", (1, "d", "2020-02-01"), nova="text", classe="Classe"), court="TJPR")
    p = Medallion(spark, root, "2022-01-01")
    p.ingest(f"{root}/landing/*/*.json")
    assert rows(p.silver(), "numero_processo", "codigo_movimento", "nivel_sigilo") == [
        ("A", 1, None), ("A", None, None), ("C", 1, 0), ("D", 1, 0)]
    assert rows(p.changed_fields(), "tribunal", "field", "hits") == [
        ("TJPR", "_source.classe", 1), ("TJRS", "_source.movimentos", 1), ("TJRS", "_source.movimentos.codigo", 1), ("TJRS", "_source.nivelSigilo", 1)]
    assert rows(p.bronze(), "_source.numeroProcesso", "_source.nova") == [("A", '{"k":[1]}'), ("B", "7"), ("C", None), ("D", "text")]
    assert p.rejects().count() == 4
