import random


from docketline.operators.windows import case_metrics, dedup_latest, share_of_total
from docketline.plans.silver import build_silver

from .helpers import ev, flat


def _m(df, **kw):
    out = case_metrics(df, **kw).select("numero_processo", "codigo_movimento", "data_movimento",
                                        "dias_desde_ultimo_movimento", "is_ultimo_movimento")
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_single_event_case(spark):
    df = flat(spark, [ev("A", 1, "2020-01-05")])
    (row,) = _m(df)
    assert row[3] is None and row[4] is True


def test_ties_broken_by_code(spark):
    df = flat(spark, [ev("A", 7, "2020-01-05"), ev("A", 3, "2020-01-05"), ev("A", 1, "2020-01-01")])
    got = {r[1]: (r[3], r[4]) for r in _m(df)}
    assert got == {1: (None, False), 3: (4, False), 7: (0, True)}


def test_null_times_sort_first(spark):
    df = flat(spark, [ev("A", 1, None), ev("A", 2, "2020-01-03"), ev("A", 3, "2020-01-01")])
    got = {r[1]: (r[3], r[4]) for r in _m(df)}
    assert got[1] == (None, False)
    assert got[3] == (None, False)  # previous row has a null time
    assert got[2] == (2, True)


def test_hot_split_equals_plain(spark):
    rnd = random.Random(7)
    evs = []
    for i in range(600):  # one hot case, plus small ones; repeated times for ties
        case = "HOT" if i % 3 else f"C{i % 11}"
        day = rnd.randint(1, 28)
        evs.append(ev(case, rnd.randint(1, 50), f"2021-{rnd.randint(1, 12):02d}-{day:02d}"))
    df = flat(spark, evs).dropDuplicates(["numero_processo", "codigo_movimento", "data_movimento"])
    assert _m(df) == _m(df, hot_case_rows=20)


def test_fused_dedup_keeps_newest(spark):
    old = flat(spark, [ev("A", 1, "2020-01-01", name="old"), ev("A", 2, "2020-02-01")], "2021-01-01")
    new = flat(spark, [ev("A", 1, "2020-01-01", name="new")], "2021-06-01")
    s = build_silver(old.unionByName(new), processed_at="2022-01-01")
    got = sorted((r.codigo_movimento, r.nome_movimento, r.dias_desde_ultimo_movimento)
                 for r in s.collect())
    assert got == [(1, "new", None), (2, "mov 2", 31)]


def test_dedup_latest_many_copies(spark):
    rows = [("k", i, f"v{i}") for i in range(200)] + [("j", 1, "x")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    got = sorted(tuple(r) for r in dedup_latest(df, ["k"], ["o"]).collect())
    assert got == [("j", 1, "x"), ("k", 199, "v199")]


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "k string, n bigint")
    got = dict((r.k, r.p) for r in share_of_total(df, "n", "p").collect())
    assert got == {"a": 25.0, "b": 75.0}


def test_hot_keys_given_equal_counted(spark):
    from docketline.operators.windows import hot_cases
    evs = [ev("HOT", i, f"2021-01-{1 + i % 28:02d}") for i in range(60)] + [ev("B", 1, "2021-01-01")]
    df = flat(spark, evs)
    counts = df.groupBy("numero_processo").count()
    hot = hot_cases(counts, "numero_processo", "count", 10)
    assert [r.numero_processo for r in hot.collect()] == ["HOT"]
    assert _m(df, hot_case_rows=10, hot=hot) == _m(df) == _m(df, hot_case_rows=10)


def test_hot_split_with_null_times_and_copies(spark):
    rnd = random.Random(11)
    evs = []
    for i in range(400):
        case = "HOT" if i % 4 else f"C{i % 7}"
        ts = None if i % 37 == 0 else f"2022-{rnd.randint(1, 12):02d}-{rnd.randint(1, 28):02d}"
        evs.append(ev(case, rnd.randint(1, 30), ts, name=f"n{i}"))
    df = flat(spark, evs, "2023-01-01")
    df = df.unionByName(flat(spark, evs[:80], "2023-02-01"))  # newer copies of some events
    order = ["data_ingestao"]
    assert _m(df, dedup_order=order) == _m(df, dedup_order=order, hot_case_rows=15)


def test_copies_of_last_event_and_null_keys(spark):
    evs = [ev("A", 1, "2020-01-01"), ev("A", 2, "2020-01-05"), ev("A", None, None), ev(None, 1, None), ev(None, 1, "2020-01-03")]
    old, new = flat(spark, evs, "2021-01-01"), flat(spark, evs, "2021-06-01")
    s = build_silver(old.unionByName(new).unionByName(new), processed_at="2022-01-01")
    got = sorted(((r.numero_processo, r.codigo_movimento, r.dias_desde_ultimo_movimento, r.is_ultimo_movimento, r.data_ingestao.month)
                  for r in s.collect()), key=repr)
    assert got == sorted([("A", None, None, False, 6), ("A", 1, None, False, 6), ("A", 2, 4, True, 6),
                          (None, 1, None, False, 6), (None, 1, None, True, 6)], key=repr)
