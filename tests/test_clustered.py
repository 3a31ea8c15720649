"""Space-filling order: equal results from few files."""
import pytest
from pyspark.sql import functions as F

from docketline.plans.clustered import Clustered
from docketline.plans.warehouse import gold

from .conftest import SF_SMALL, rows

COLS = ["fk_data_movimento", "fk_tribunal", "numero_processo"]


def test_a_month_of_one_court_opens_few_files(spark, tmp_path):
    fact = gold(spark, SF_SMALL).fato
    c = Clustered(spark, str(tmp_path), COLS)
    c.write(fact, 64)
    assert rows(c.rows().select(*fact.columns)) == rows(fact)
    files = c.bounds().count()
    court = fact.agg(F.min("fk_tribunal")).first()[0]
    ranges = {"fk_data_movimento": (19950301, 19950331), "fk_tribunal": (court, court)}
    got = c.read(ranges)
    want = fact.where(F.col("fk_data_movimento").between(*ranges["fk_data_movimento"]) & (F.col("fk_tribunal") == court))
    assert want.count() > 0 and rows(got, *fact.columns) == rows(want)
    # 64 files are two bits for each of three columns: a narrow range meets at most two of four ranges of its column
    assert files >= 50 and len(got.inputFiles()) <= files / 4
    case = fact.agg(F.min("numero_processo")).first()[0]
    one = c.read({"numero_processo": (case, case)})
    assert rows(one, *fact.columns) == rows(fact.where(F.col("numero_processo") == case)) and len(one.inputFiles()) <= files / 2


@pytest.mark.parametrize("data", [
    [], [(None, None)] * 5, [(1, "a")] * 300 + [(None, "b"), (2, None), (-3, ""), (9, "é" * 9)]])
def test_nulls_ties_hot_values_and_empty_tables(spark, tmp_path, data):
    df = spark.createDataFrame(data, "d int, t string")
    c = Clustered(spark, str(tmp_path), ["d", "t"])
    c.write(df, 4)
    assert rows(c.rows()) == rows(df)
    for ranges in ({"d": (1, 2)}, {"d": (None, 1), "t": ("a", None)}, {"t": ("é", "ê")}, {"d": (None, None)}):
        want = df
        for k, (lo, hi) in ranges.items():
            want = want.where(F.col(k).isNotNull())
            want = want if lo is None else want.where(F.col(k) >= lo)
            want = want if hi is None else want.where(F.col(k) <= hi)
        assert rows(c.read(ranges)) == rows(want)
    with pytest.raises(ValueError):
        c.read({"x": (1, 2)})
