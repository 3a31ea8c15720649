"""Plan shape: the physical properties the design relies on at scale."""
import contextlib
import io

from docketline.plans import dims
from docketline.plans import reports as R
from docketline.plans.fact import build_fact
from docketline.plans.silver import build_silver
from docketline.sources import fixtures

from .conftest import SF_SMALL
from .helpers import ev, flat


def plan(df, mode: str = "simple") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_silver_one_exchange_one_sort(spark):
    df = flat(spark, [ev("A", 1, "2020-01-01"), ev("A", 2, "2020-01-02")], "2021-01-01")
    p = plan(build_silver(df, processed_at="2022-01-01"))
    assert p.count("Exchange hashpartitioning(numero_processo") == 1
    assert p.count("Sort [numero_processo") == 1
    assert p.count("Exchange") == 1


def test_multi_distinct_has_no_expand(spark):
    s = build_silver(flat(spark, [ev("A", 1, "2020-01-01")]), processed_at="2022-01-01")
    p = plan(R.inactivity_bands(build_fact(s), dims.dim_tribunais(s)))
    assert "Expand" not in p


def test_big_joins_are_sort_merge(spark):
    p = plan(fixtures.movements(spark, SF_SMALL))
    assert "SortMergeJoin [l_orderkey" in p
    assert "SortMergeJoin [o_custkey" in p


def test_latest_dashboards_prune_partitions(spark):
    from docketline.plans.warehouse import gold
    g = gold(spark, SF_SMALL)
    p = plan(R.congestion_by_court(g.fato, g.dim("tribunais")))
    assert "PartitionFilters: [isnotnull(is_ultimo_movimento" in p
    assert "BroadcastHashJoin" in p


def test_uniqueness_report_has_no_expand(spark):
    from docketline.plans.checks import dq_uniqueness
    s = build_silver(flat(spark, [ev("A", 1, "2020-01-01")]), processed_at="2022-01-01")
    assert "Expand" not in plan(dq_uniqueness(s))


def test_case_lookup_prunes_buckets(spark):
    from docketline.plans.silver import case_timeline
    from docketline.plans.warehouse import SILVER_BUCKETS, gold
    p = plan(case_timeline(gold(spark, SF_SMALL).silver_by_bucket, buckets=SILVER_BUCKETS))
    assert "PartitionFilters: [isnotnull(bucket" in p


def test_extract_pushes_its_dates_down(spark):
    import uuid

    from docketline.session import work_dir
    from docketline.sources.extract import extract_range
    from docketline.sources.json_source import BronzeTable
    bronze = BronzeTable(spark, work_dir(spark, "t", uuid.uuid4().hex))
    bronze.put("x", fixtures.bronze_hits(spark, SF_SMALL).selectExpr("*", "cast(null as string) as _corrupt_record"))
    p = plan(extract_range(bronze.read(), "1996-01-01", "1996-12-31"), "formatted")
    assert "GreaterThanOrEqual(filed_at,1996-01-01" in p and "LessThanOrEqual(filed_at,1996-12-31" in p


def test_calendar_joins_days_not_events(spark):
    s = build_silver(flat(spark, [ev("A", 1, "2020-01-01")]), processed_at="2022-01-01")
    cal = dims.dim_calendario(dims.calendar_bounds(dims.silver_groups(s)))
    p = plan(R.movements_by_day(build_fact(s), cal))
    lines = p.splitlines()
    join = next(i for i, x in enumerate(lines) if "Join" in x)
    assert any("HashAggregate(keys=[fk_data_movimento" in x for x in lines[join:])


def test_dimensions_read_silver_once(spark):
    s = build_silver(flat(spark, [ev("A", 1, "2020-01-01")]), processed_at="2022-01-01")
    assert plan(dims.silver_groups(s)).count("Exchange hashpartitioning(numero_processo") == 1


def test_silver_one_window_no_hash_in_the_exchange(spark):
    p = plan(build_silver(flat(spark, [ev("A", 1, "2020-01-01")], "2021-01-01"), processed_at="2022-01-01"), "formatted")
    assert "WindowGroupLimit" not in p and p.count(") Window\n") == 1       # the tree's line is drawn otherwise
    exchange = p[p.index(") Exchange\nInput"):]
    assert "__tie" not in exchange[:exchange.index("\n\n")]


def test_case_number_is_stripped_once(spark):
    p = plan(build_silver(flat(spark, [ev("A", 1, "2020-01-01")]), processed_at="2022-01-01"))
    assert p.count("regexp_replace(") == 1


def test_no_hot_case_joins_no_header(spark):
    assert "Join" not in plan(fixtures.hot_cases(spark, SF_SMALL, 10 ** 6))


def test_date_key_formats_no_usual_date(spark):
    from pyspark.sql import functions as F

    from docketline.functions import date_key
    df = spark.sql("SELECT explode(array(DATE '2020-02-09', DATE '0001-01-01', DATE '9999-12-31', NULL)) AS d")
    got = [r[0] for r in df.select(date_key("d")).collect()]
    assert got == [20200209, 10101, 99991231, None]
    assert got == [r[0] for r in df.select(F.date_format("d", "yyyyMMdd").cast("int")).collect()]
    assert "CASE WHEN" in plan(df.select(date_key("d")))
