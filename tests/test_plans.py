"""Physical-plan checks: the optimisations the design relies on are present."""

import contextlib
import io
import os

import pytest

from lodgepole.functions.dates import parse_date
from lodgepole.operators import metrics
from lodgepole.operators.merge import upsert
from lodgepole.plans.batch import materialise_curated
from lodgepole.session import lake_root
from lodgepole.sources.domain import raw_table
from lodgepole.sources.updates import listing_price_updates

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def _explain(df, extended: bool = False) -> str:
    """Text of ``df.explain()`` (physical plan; with ``extended`` also the
    optimized logical plan)."""
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(extended=extended)
    return buf.getvalue()


def _plan(df) -> str:
    return _explain(df)


def _optimized(df) -> str:
    text = _explain(df, extended=True)
    start = text.index("== Optimized Logical Plan ==")
    return text[start : text.index("== Physical Plan ==")]


@pytest.fixture(scope="module")
def curated(spark):
    return materialise_curated(spark, SF, lake_root(spark) + "/test-plans")


def test_topk_uses_partial_window_group_limit(curated):
    b, l = curated["curated_bookings"], curated["curated_apartments"]
    for df in (metrics.popular_locations(b, l), metrics.top_performing_listings(b, l)):
        plan = _plan(df)
        assert "WindowGroupLimit" in plan and "Partial" in plan


def test_status_filter_and_pruning_reach_the_scan(curated):
    df = metrics.user_weekly_bookings(curated["curated_bookings"])
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(booking_status), EqualTo(booking_status,confirmed)]" in plan
    assert "ReadSchema: struct<booking_id:bigint,user_id:bigint,booking_date:date,booking_status:string>" in plan


def test_occupancy_has_no_listing_sized_cross_join(spark, curated):
    df = metrics.occupancy_rate(
        spark, curated["curated_apartments"], curated["curated_bookings"], "1995-01-01", "2001-12-31"
    )
    plan = _optimized(df)
    # no cross join at all: the active-listing count is one aggregate,
    # evaluated as a scalar subquery and placed on every spine month
    assert "Join Cross" not in plan and "scalar-subquery" in plan
    assert "Aggregate [count(1) AS active_listings" in plan
    # one derived month key serves the grouping and the join
    assert plan.count("trunc(checkin_date") >= 1 and "year(checkin_date" not in plan
    assert "EqualTo(booking_status,confirmed)" in _plan(df)


def test_upsert_cuts_hot_keys_before_the_shuffle(spark):
    df = upsert(
        raw_table(spark, SF, "apartments"),
        listing_price_updates(spark, SF),
        ["id"],
        [parse_date("last_modified_timestamp")],
    )
    plan = _plan(df)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_metrics_join_preaggregated_bookings(curated):
    df = metrics.popular_locations(curated["curated_bookings"], curated["curated_apartments"])
    plan = _optimized(df)
    join_at = plan.index("Join Inner")
    # bookings are counted per (year, week, listing) below the join
    below = plan[join_at:]
    assert "Aggregate [" in below and "count(1) AS n" in below
