import datetime as dt

from pyspark.sql import types as T

from docketline.plans.silver import build_silver, flatten_hits, merge_silver
from docketline.schemas import BRONZE

from .helpers import ev, flat


def _hit(case, movs, filed="20200101000000"):
    src = (case, "TJRS", "G1", filed, (1, "C"), (10, "V"), 0, movs, None)
    return ("id-" + case, src, [1], "TJRS", dt.datetime(2021, 1, 1))


def test_null_and_empty_movements_vanish(spark):
    df = spark.createDataFrame([_hit("A", None), _hit("B", []),
                                _hit("C", [(5, "x", "2020-01-02T00:00:00.000Z"),
                                           (6, "y", "2020-01-02T00:00:00Z")])], T.StructType([f for f in BRONZE.fields if f.name not in ("_corrupt_record", "filed_at")]))
    out = flatten_hits(df).collect()
    assert [(r.numero_processo, r.codigo_movimento) for r in out] == [("C", 5), ("C", 6)]
    assert out[0].data_movimento == dt.datetime(2020, 1, 2) and out[1].data_movimento is None


def test_same_case_loaded_twice(spark):
    evs = [ev("A", 1, "2020-01-01"), ev("A", 2, "2020-01-11")]
    once = build_silver(flat(spark, evs, "2021-01-01"), processed_at="2022-01-01")
    twice = build_silver(flat(spark, evs, "2021-01-01").unionByName(flat(spark, evs, "2021-02-01")),
                         processed_at="2022-01-01")
    key = ("numero_processo", "codigo_movimento", "dias_desde_ultimo_movimento", "is_ultimo_movimento")
    assert sorted(tuple(r[k] for k in key) for r in once.collect()) == \
        sorted(tuple(r[k] for k in key) for r in twice.collect())
    assert twice.count() == 2


def test_late_older_event_recomputes_case(spark):
    s1 = build_silver(flat(spark, [ev("A", 1, "2020-01-01"), ev("A", 2, "2020-03-01"),
                                   ev("B", 9, "2020-01-01")], "2021-01-01"), processed_at="2022-01-01")
    late = flat(spark, [ev("A", 3, "2020-02-01")], "2021-02-01")
    s2 = merge_silver(s1, late, processed_at="2022-01-01")
    got = {(r.numero_processo, r.codigo_movimento): (r.dias_desde_ultimo_movimento, r.is_ultimo_movimento)
           for r in s2.collect()}
    assert got == {("A", 1): (None, False), ("A", 3): (31, False), ("A", 2): (29, True),
                   ("B", 9): (None, True)}


def test_null_time_merged_twice_is_one_row(spark):
    s1 = build_silver(flat(spark, [ev("A", 1, None)], "2021-01-01"), processed_at="2022-01-01")
    s2 = merge_silver(s1, flat(spark, [ev("A", 1, None)], "2021-02-01"), processed_at="2022-01-01")
    assert s2.count() == 1


def test_negative_age(spark):
    s = build_silver(flat(spark, [ev("A", 1, "2019-12-30", filed="2020-01-01")]), processed_at="2022-01-01")
    assert s.first().dias_desde_ajuizamento == -2


def test_batches_in_any_order_and_twice(spark):
    from docketline.sources import fixtures
    b1, b2 = fixtures.movement_batches(spark, "/root/testdata/sf0.001")

    def key(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    full = build_silver(b1.unionByName(b2), processed_at="2022-01-01")
    fwd = merge_silver(build_silver(b1, processed_at="2022-01-01"), b2, processed_at="2022-01-01")
    rev = merge_silver(build_silver(b2, processed_at="2022-01-01"), b1, processed_at="2022-01-01")
    twice = merge_silver(fwd.checkpoint(eager=True), b2, processed_at="2022-01-01")
    assert key(full) == key(fwd) == key(rev) == key(twice)
