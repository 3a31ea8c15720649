"""What the building of hits moves, and that its rows do not depend on it."""

from docketline.plans.silver import flatten_hits
from docketline.schemas import FLAT_COLUMNS
from docketline.sources import fixtures

from .conftest import SF_SMALL


def test_hits_of_bounded_groups_move_their_events_once(spark):
    h = fixtures.bronze_hits(spark, SF_SMALL)
    plan = h._jdf.queryExecution().sparkPlan().toString()
    assert "__n" not in plan                                             # no join with the groups' sizes
    executed = h._jdf.queryExecution().executedPlan().toString()
    moved = [x for x in executed.splitlines() if "Exchange hashpartitioning(l_orderkey" in x]
    assert len(moved) == 1 and "l_linestatus" not in moved[0]
    # the same events as hits of one event each, which go the other way
    small = fixtures.bronze_hits(spark, SF_SMALL, hit_events=1)
    assert "__n" in small._jdf.queryExecution().sparkPlan().toString()
    one, other = (flatten_hits(x).select(*FLAT_COLUMNS) for x in (h, small))
    assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()
