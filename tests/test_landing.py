"""Landed files and what is read from them: packed lines, array files by source, typed fields taken out at once."""

import json
import os

from pyspark.sql import functions as F

from docketline.functions.parse import case_number_parts, parse_event_ts, parse_filing_ts
from docketline.operators.windows import case_metrics
from docketline.schemas import CHANGED, HIT, SOURCE
from docketline.sources.json_source import _typed, read_hits, read_variants, typed_hits, write_hits
from tests.conftest import rows
from tests.helpers import ev, flat


def _hits(spark, n):
    made = [(f"{i}", "TJRS" if i % 4 else "TJSP", json.dumps({"_id": f"{i}", "_source": {
        "numeroProcesso": f"{i:020d}", "movimentos": [{"codigo": i, "nome": "a", "dataHora": None}]}, "sort": [i]})) for i in range(n)]
    df = spark.createDataFrame(made, "id string, tribunal string, j string")
    return df.select(F.from_json("j", HIT).alias("h"), "tribunal").select("h.*", "tribunal")


def _files(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, fs in os.walk(root) for f in fs if f.startswith("part-"))


def test_lines_are_landed_packed_and_read_back(spark, tmp_path):
    write_hits(_hits(spark, 30), f"{tmp_path}/l", compression="gzip")
    assert _files(f"{tmp_path}/l") and all(f.endswith(".json.gz") for f in _files(f"{tmp_path}/l"))
    back = read_hits(spark, f"{tmp_path}/l", multiline=False)
    assert sorted(r[0] for r in back.select("_id").collect()) == sorted(f"{i}" for i in range(30))


def test_array_files_lie_in_one_folder_per_source_and_follow_its_size(spark, tmp_path):
    write_hits(_hits(spark, 400), f"{tmp_path}/a", layout="array", hits_per_file=100)
    files = _files(f"{tmp_path}/a")
    assert {os.path.dirname(f) for f in files} == {"tribunal=TJRS", "tribunal=TJSP"}
    assert len(files) == 4                                     # 300 hits of one source in 3 files, 100 of the other in one
    got = read_hits(spark, f"{tmp_path}/a", multiline=True)
    assert got.count() == 400 and rows(got.groupBy("tribunal").count()) == [("TJRS", 300), ("TJSP", 100)]


def test_a_typed_value_is_taken_out_at_once(spark, tmp_path):
    assert "map<string,variant>" not in str(_typed(F.col("hit"), "$['_source']", SOURCE))
    lines = [
        {"_id": "1", "_source": {"numeroProcesso": "1", "nivelSigilo": "alto", "classe": {"codigo": 1, "nome": "c"}, "movimentos": [{"codigo": 1, "nome": "a"}]}},
        {"_id": "2", "_source": {"numeroProcesso": "2", "nivelSigilo": 1, "classe": 7, "movimentos": [{"codigo": "x", "nome": "a"}, 5, None]}},
        {"_id": "3", "_source": {"numeroProcesso": "3", "nivelSigilo": 1, "movimentos": "none", "nova": {"x": [1]}}},
        {"_id": "5", "_source": {"numeroProcesso": "5", "grau": "G1", "nova": 4}},
    ]
    (tmp_path / "TJRS").mkdir()
    (tmp_path / "TJRS" / "x.json").write_text("\n".join(map(json.dumps, lines)))
    got = typed_hits(read_variants(spark, str(tmp_path))).select(
        "_id", "_source.numeroProcesso", "_source.nivelSigilo", "_source.classe.nome", "_source.movimentos.codigo", "_source.nova", CHANGED)
    assert [tuple(r) for r in got.orderBy("_id").collect()] == [
        ("1", "1", None, "c", [1], None, ["_source.nivelSigilo"]),
        ("2", "2", 1, None, [None, None, None], None, ["_source.classe", "_source.movimentos.codigo"]),
        ("3", "3", 1, None, None, '{"x":[1]}', ["_source.movimentos"]),
        ("5", "5", None, None, None, "4", []),
    ]


def test_case_numbers_are_cut_without_a_pattern_per_part(spark):
    parts = case_number_parts("n")
    assert not any("regexp_extract" in str(c) for c in parts.values())
    df = spark.createDataFrame([("0000246-44.2024.8.16.0192",), ("12",), (None,), ("1234567890123456789012",), ("x",)], "n string")
    assert [tuple(r) for r in df.select(*[c.alias(k) for k, c in parts.items()]).collect()] == [
        ("0000246", "44", 2024, 8, 16, "0192"), ("", "", None, None, None, ""), (None,) * 6,
        ("1234567", "89", 123, 4, 56, "7890"), ("", "", None, None, None, "")]


def test_times_of_every_shape(spark):
    texts = ["20240131102030", "2024-01-31T10:20:30.123", "2024-01-31T10:20:30", "2024-01-31", "2024-01-31t10:20:30", "", "x", "2024-13-01",
             "20240131", "2024-01-31T10:20:30Z", "-2024-01-31", "2024-01-31 ", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    formats = ("yyyyMMddHHmmss", "yyyy-MM-dd'T'HH:mm:ss.SSS", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd")
    tried = F.coalesce(*[F.try_to_timestamp("t", F.lit(f)) for f in formats])
    assert "CASE WHEN" in str(parse_filing_ts("t"))            # a format is tried on its own shape only
    assert df.where(~parse_filing_ts("t").eqNullSafe(tried)).count() == 0
    odd = spark.createDataFrame([("2024-01-31T10:20:30.123Z",), ("2024-01-31T10:20:30.123",), ("2024-01-31T10:20:30.123ZZ",), ("Z",), ("",), (None,)], "t string")
    old = F.try_to_timestamp(F.regexp_replace("t", "Z$", ""), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSS"))
    assert odd.where(~parse_event_ts("t").eqNullSafe(old)).count() == 0


def test_slices_of_hot_cases_are_pinned_as_written_columns(spark):
    events = [ev("1", i, f"2020-01-{1 + i:02d}") for i in range(9)] + [ev(None, i, None) for i in range(6)] + [ev("2", 1, "2020-01-01")]
    made = []
    kind = type(flat(spark, events))
    old = kind.checkpoint
    kind.checkpoint = lambda self, *a, **b: made.append(1) or old(self, *a, **b)
    try:
        got = case_metrics(flat(spark, events), hot_case_rows=4, slice_rows=3)
        cols = ("numero_processo", "codigo_movimento", "dias_desde_ultimo_movimento", "is_ultimo_movimento")
        assert rows(got, *cols) == rows(case_metrics(flat(spark, events)), *cols)
    finally:
        kind.checkpoint = old
    assert not made
