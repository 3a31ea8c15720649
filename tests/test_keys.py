import datetime as dt

from pyspark.sql import functions as F

from docketline.functions import (date_key, iso_weekday, phase_bucket, surrogate_key, week_label,
                                  weekday_ordinal)


def test_phase_bucket(spark):
    df = spark.createDataFrame([(0,), (1,), (99,), (100,), (699,), (700,), (None,)], "c bigint")
    got = [r[0] for r in df.select(phase_bucket("c")).collect()]
    assert got == ["outro", "distribuição", "distribuição", "conhecimento", "arquivamento", "outro", "outro"]


def test_date_key_and_week(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 30),), (None,)], "d date")
    out = df.select(date_key("d").alias("k"), F.weekofyear("d").alias("w"), F.year("d").alias("y")).collect()
    assert (out[0].k, out[0].w, out[0].y) == (20241230, 1, 2024)
    assert out[1].k is None
    lab = df.limit(1).select(week_label(F.year("d"), F.weekofyear("d"))).first()[0]
    assert lab == "2024-W01"  # ISO week joined to the calendar year (H8)


def test_surrogate_key_matches_md5_of_text(spark):
    import hashlib
    df = spark.createDataFrame([(5, "TJRS"), (5, None)], "c bigint, s string")
    got = [r[0] for r in df.select(surrogate_key("c", "s")).collect()]
    assert got[0] == hashlib.md5(b"5-TJRS").hexdigest()
    assert got[1] == hashlib.md5(b"5-_dbt_utils_surrogate_key_null_").hexdigest()


def test_weekday(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1) + dt.timedelta(days=i),) for i in range(7)], "d date")
    out = df.select(weekday_ordinal(F.date_format("d", "EEEE")).alias("a"), iso_weekday("d").alias("b")).collect()
    assert [r.a for r in out] == [1, 2, 3, 4, 5, 6, 7] == [r.b for r in out]
