"""Mergeable states: errors as stated, and two days merged are the state of both."""

import pytest
from pyspark.sql import functions as F

from docketline.operators.aggregates import DEFAULT_PERCENTILES
from docketline.plans import reports as R
from docketline.plans import sketches as K
from docketline.plans.silver import build_silver
from docketline.sources import fixtures

from .conftest import SF_SMALL
from .helpers import ev, flat


@pytest.fixture(scope="module")
def silver(spark):
    return build_silver(fixtures.movements(spark, SF_SMALL), processed_at="2022-01-01").cache()


def test_merged_days_equal_one_build(spark, silver):
    parts = [K.day_states(silver.where(c)) for c in ("data_movimento < '1998-01-01'", "data_movimento >= '1998-01-01'", "data_movimento IS NULL")]
    merged = parts[0].unionByName(parts[1]).unionByName(parts[2])
    for by in (["sigla_tribunal"], ["tipo_fase"], []):
        one, two = (sorted(map(tuple, K.distinct_cases(s, by).collect())) for s in (K.day_states(silver), merged))
        assert one == two
        exact = dict((tuple(r)[:-1], r[-1]) for r in silver.withColumn("tipo_fase", K.phase_bucket("codigo_movimento")).groupBy(*by).agg(
            F.count_distinct("numero_processo")).collect())
        assert all(abs(r[-1] - exact[r[:len(by)]]) <= K.HLL_BOUND * exact[r[:len(by)]] for r in two)
    for found in (K.age_percentiles(merged, DEFAULT_PERCENTILES), K.age_percentiles(K.day_states(silver), DEFAULT_PERCENTILES)):
        out = K.ranks_within(silver.where(R.LATEST), R.AGE, found, DEFAULT_PERCENTILES, "sigla_tribunal").collect()
        assert len(out) == 5 and all(r.dentro for r in out)


def test_a_wrong_value_is_out_of_bounds(spark, silver):
    wrong = K.age_percentiles(K.day_states(silver), DEFAULT_PERCENTILES).withColumn("valores", F.transform("valores", lambda x: x + 400))
    assert not any(r.dentro for r in K.ranks_within(silver.where(R.LATEST), R.AGE, wrong, DEFAULT_PERCENTILES, "sigla_tribunal").collect())


def test_groups_without_values_and_empty_table(spark):
    one = build_silver(flat(spark, [ev("A", 1, None), ev(None, 2, "2020-01-01", court=None)]), processed_at="2022-01-01")
    got = K.gap_percentiles(K.day_states(one), (0.5,)).collect()
    assert sum(r.total_movimentos for r in got) == 2 and all(r.valores == [None] and r.media_gap is None for r in got)
    assert K.distinct_cases(K.day_states(one.limit(0)), ["dia"]).count() == 0
