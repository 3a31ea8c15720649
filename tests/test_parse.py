import datetime as dt

from pyspark.sql import functions as F

from docketline.functions import (array_first, case_number_parts, clamp_date, parse_event_ts,
                                  parse_filing_ts)
from docketline.plans.dims import subjects_exploded


def test_filing_formats(spark):
    df = spark.createDataFrame([("20240305101112",), ("2024-03-05T10:11:12.345",),
                                ("2024-03-05T10:11:12",), ("2024-03-05",), ("05/03/2024",), (None,)], "t string")
    got = [r[0] for r in df.select(parse_filing_ts("t")).collect()]
    assert got[0] == dt.datetime(2024, 3, 5, 10, 11, 12)
    assert got[1] == dt.datetime(2024, 3, 5, 10, 11, 12, 345000)
    assert got[2] == dt.datetime(2024, 3, 5, 10, 11, 12)
    assert got[3] == dt.datetime(2024, 3, 5)
    assert got[4] is None and got[5] is None


def test_event_time_needs_millis(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05.678Z",), ("2024-01-02T03:04:05Z",)], "t string")
    got = [r[0] for r in df.select(parse_event_ts("t")).collect()]
    assert got[0] == dt.datetime(2024, 1, 2, 3, 4, 5, 678000)
    assert got[1] is None


def test_case_number(spark):
    df = spark.createDataFrame([("00002464420248160192",), ("0000246-44.2024.8.16.0192",), ("12",)], "n string")
    out = df.select(*[c.alias(k) for k, c in case_number_parts("n").items()]).collect()
    assert tuple(out[0]) == ("0000246", "44", 2024, 8, 16, "0192")
    assert tuple(out[1]) == tuple(out[0])
    assert tuple(out[2]) == ("", "", None, None, None, "")


def test_clamp_date(spark):
    df = spark.createDataFrame([("2025-02-30",), ("2025-13-01",), ("2024-02-31",), ("2025-00-00",),
                                ("x-1-2",), ("2025-1",)], "t string")
    got = [r[0] for r in df.select(clamp_date("t")).collect()]
    assert got[:4] == [dt.date(2025, 2, 28), dt.date(2025, 12, 1), dt.date(2024, 2, 29), dt.date(2025, 1, 1)]
    assert got[4] is None and got[5] is None


def test_array_first_null_safe(spark):
    df = spark.createDataFrame([([1, 2],), ([],), (None,)], "a array<int>")
    assert [r[0] for r in df.select(array_first("a")).collect()] == [1, None, None]


def test_subjects_bad_and_null_dropped(spark):
    src = F.struct(F.col("a").alias("assuntos"))
    df = spark.createDataFrame([(['{"codigo": 7, "nome": "x"}', "bad", None, '{"nome": "y"}'],), (None,)],
                               "a array<string>").select(src.alias("_source"))
    assert [tuple(r) for r in subjects_exploded(df).collect()] == [(7, "x")]


def test_require_dates_fails_on_bad_text(spark):
    import pytest
    from docketline.sources.extract import require_dates
    ok = spark.createDataFrame([("2025-02-30",), (None,)], "d string")
    assert require_dates(ok, ["d"]).count() == 2
    bad = spark.createDataFrame([("2025-02",)], "d string")
    with pytest.raises(Exception, match="invalid d"):
        require_dates(bad, ["d"]).collect()


def test_scalar_filter(spark):
    from docketline.operators.joins import scalar_filter
    df = spark.createDataFrame([(i,) for i in range(10)], "v int")
    mx = df.agg(F.max("v"))
    assert [r.v for r in scalar_filter(df, "v", mx, "==").collect()] == [9]
    assert sorted(r.v for r in scalar_filter(df, "v", df.agg(F.avg("v")), ">").collect()) == [5, 6, 7, 8, 9]
