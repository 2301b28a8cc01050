"""Physical-plan properties the design relies on (checked on sf0.001)."""

import re

import pytest
from conftest import SF_SMALL

from perkspark.plans.explain import physical_plan
from perkspark.plans.registry import QUERIES


def _plan(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    return physical_plan(df)


@pytest.fixture()
def static_plans(spark):
    """Plans without AQE re-planning, so the chosen strategy is visible."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_revenue_is_a_sweep_over_one_scan_of_the_events(spark, static_plans):
    plan = _plan(spark, "channel_revenue")
    assert "_bin" not in plan and "SortMergeJoin" not in plan
    # journeys and transaction hours from one aggregate; besides, only the members' ids are counted
    scans = [s for s in re.findall(r"ReadSchema: struct<([^>]*)>", plan) if "user_id" in s]
    assert len(scans) == 2 and "user_id:bigint" in scans, scans
    assert re.search(r"HashAggregate\(keys=\[customer_id#\d+, offer_id#\d+, hour#\d+", plan) or re.search(r"HashAggregate\(keys=\[customer_id#\d+, offer_id#\d+, _groupingexpression#\d+\]", plan), plan


def test_metrics_do_not_join_the_durations(spark, static_plans):
    for name in ("age_distribution", "customer_offer_status", "channel_metrics", "offer_completion_metrics"):
        assert "duration" not in _plan(spark, name), name


def test_journey_is_one_partial_aggregate(spark, static_plans):
    plan = _plan(spark, "offer_interactions")
    assert plan.count("Exchange hashpartitioning(customer_id") == 1
    assert "partial_min" in plan


def test_only_proven_dimensions_are_broadcast(spark, static_plans):
    # static broadcast from size estimates is off: the per-hour transaction
    # aggregate (grows with the data) must not be broadcast
    plan = _plan(spark, "channel_revenue")
    for m in re.finditer(r"BroadcastExchange.*\n(.*\n){0,3}", plan):
        assert "event_time_hours" not in m.group(0) and "hour" not in m.group(0)


def test_scans_read_only_needed_columns(spark, static_plans):
    plan = _plan(spark, "tpch_median_price_by_brand")
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert sorted(schemas) == sorted(["l_partkey:bigint,l_extendedprice:double", "p_partkey:bigint,p_brand:string"])


def test_channel_measures_are_pre_aggregated_per_offer(spark, static_plans):
    plan = _plan(spark, "channel_metrics")
    # the journey is reduced to one row per offer before the channel fan-out
    assert re.search(r"HashAggregate\(keys=\[offer_id#\d+\]", plan)


def test_above_the_bound_dimensions_are_not_broadcast(spark, static_plans):
    from conftest import rows

    from perkspark.plans.pipeline import LoyaltyPipeline

    small = LoyaltyPipeline.from_warehouse(spark, SF_SMALL)
    expected = rows(small.channel_effectiveness, *small.channel_effectiveness.columns)
    spark.conf.set("perkspark.broadcast.maxRows", "1")
    try:
        big = LoyaltyPipeline.from_warehouse(spark, SF_SMALL)
        assert big.offers_small is False
        assert big.offer_channels_small is False
        df = big.channel_effectiveness
        # only the bounded list of heavy members is broadcast
        assert re.findall(r"BroadcastHashJoin \[(\w+)#", physical_plan(df)) == ["customer_id"]
        assert rows(df, *df.columns) == expected
    finally:
        spark.conf.unset("perkspark.broadcast.maxRows")


def test_orders_are_collapsed_per_customer_day_and_joined_with_nothing(spark, static_plans):
    plan = _plan(spark, "tpch_orders_in_customer_interval")
    assert "Join" not in plan and plan.count("FileScan") == 1
    # map-side partial aggregate per (customer, day) before the shuffle
    assert re.search(r"HashAggregate\(keys=\[o_custkey#\d+L?, _groupingexpression#\d+\], functions=\[partial_count", plan)


def test_size_proofs(spark):
    from perkspark.plans.broadcast import has_at_most
    from perkspark.plans.pipeline import LoyaltyPipeline

    dim = spark.range(0, 10, 1, 4)
    assert has_at_most(dim, 10) and not has_at_most(dim, 9)
    # 200 offers, each on 2-4 channels: the offer-keyed dimensions fit a bound
    # of 200 rows, the channel-fanned ones do not
    spark.conf.set("perkspark.broadcast.maxRows", "200")
    try:
        p = LoyaltyPipeline.from_warehouse(spark, SF_SMALL)
        assert p.offers.count() == 200
        assert p.offers_small is True and p.offer_channels_small is False
    finally:
        spark.conf.unset("perkspark.broadcast.maxRows")


def test_completion_distinct_members_need_no_expand(spark, static_plans):
    plan = _plan(spark, "offer_completion_metrics")
    assert "Expand [" not in plan
    # one row per (type, channel, member) before the distinct counts
    assert re.search(r"HashAggregate\(keys=\[offer_type#\d+, channel#\d+, customer_id#\d+\], functions=\[partial_(bool_or|max)", plan), plan


def test_channel_revenue_counts_offers_and_members_in_one_aggregate(spark, static_plans):
    plan = _plan(spark, "channel_revenue")
    assert "Expand [" not in plan
    # partial sums per (channel, id) before anything is shuffled
    assert re.search(r"HashAggregate\(keys=\[channel#\d+, .*functions=\[partial_sum", plan), plan


def test_no_registered_query_plans_an_expand(spark, static_plans):
    with_expand = [name for name in QUERIES if "Expand [" in _plan(spark, name)]
    assert with_expand == []
