"""Metric operators on literal journeys (FIXTURES.md section 4)."""

import pytest
from conftest import rows

from perkspark import schemas
from perkspark.operators import views
from perkspark.plans.pipeline import LoyaltyPipeline


def _rec(c, o, t):
    return (c, "offer received", f"{{'offer id': '{o}'}}", t)


def _done(c, o, t):
    return (c, "offer completed", f"{{'offer_id': '{o}', 'reward': 1}}", t)


def _tx(c, amount, t):
    return (c, "transaction", f"{{'amount': {amount}}}", t)


def _pipeline(spark, offers, events, customers=None):
    customers = customers or [("a", 20170101, "F", 30, 50000.0)]
    return LoyaltyPipeline(
        spark.createDataFrame(customers, schemas.RAW_CUSTOMERS),
        spark.createDataFrame(offers, schemas.RAW_OFFERS),
        spark.createDataFrame(events, schemas.RAW_EVENTS),
    )


@pytest.fixture(scope="module")
def channel_case(spark):
    offers = [
        ("o1", "bogo", 5, 5, 7, "['web', 'email']"),
        ("o2", "discount", 10, 7, 7, "['mobile']"),
        ("o3", "bogo", 5, 5, 7, "['email', 'social']"),
    ]
    events = [
        _rec("a", "o1", 10), _done("a", "o1", 20),
        _tx("a", 8.0, 9), _tx("a", 1.0, 10), _tx("a", 2.0, 20), _tx("a", 4.0, 21),  # out, in, in, out
        _rec("b", "o2", 0), _done("b", "o2", 5),  # completed, no transaction: reward fallback
        _rec("c", "o3", 3),  # never completed
    ]
    return _pipeline(spark, offers, events)


def test_channel_effectiveness(channel_case):
    got = rows(
        channel_case.channel_effectiveness,
        "channel", "total_offers_sent", "offers_completed", "completion_rate",
        "total_revenue_generated", "avg_revenue_per_offer", "effectiveness_rank",
    )
    assert got == [
        ("email", 2, 1, 50.0, 3.0, 3.0, 3),
        ("mobile", 1, 1, 100.0, 7.0, 7.0, 1),
        ("social", 1, 0, 0.0, 0.0, 0.0, 4),
        ("web", 1, 1, 100.0, 3.0, 3.0, 1),
    ]


def test_channel_views(channel_case):
    perf = rows(views.channel_performance_view(channel_case.channel_effectiveness), "channel", "performance_level")
    assert perf == [("email", "High"), ("mobile", "High"), ("social", "Low"), ("web", "High")]


def test_revenue_pairs_match_sums(channel_case):
    from perkspark.operators import channel

    pairs = channel.offer_period_transactions(channel_case.offer_interactions, channel_case.events_processed)
    assert sorted(r.transaction_amount for r in pairs.collect()) == [1.0, 2.0]


def test_performance_level_thresholds(spark):
    df = spark.createDataFrame(
        [(c, 1, 1, r, 0.0, 1) for c, r in [("a", 29.99), ("b", 30.0), ("c", 49.99), ("d", 50.0)]],
        "channel string, total_offers_sent long, offers_completed long, completion_rate double, "
        "total_revenue_generated double, effectiveness_rank int",
    )
    got = rows(views.channel_performance_view(df), "channel", "performance_level")
    assert got == [("a", "Low"), ("b", "Medium"), ("c", "Medium"), ("d", "High")]


@pytest.fixture(scope="module")
def completion_case(spark):
    offers = [
        ("o1", "bogo", 5, 5, 7, "['web']"),
        ("o2", "discount", 10, 2, 7, "['web']"),
        ("o3", "informational", 0, 0, 3, "['web']"),
    ]
    events = []
    for i, t in enumerate([1, 2, 3, 4]):  # o1: times 1, 2, 3, 4
        events += [_rec(f"m{i}", "o1", 0), _done(f"m{i}", "o1", t)]
    events += [_rec("x", "o2", 10), _done("x", "o2", 15)]  # o2: one completion
    events += [_rec("y", "o3", 1)]  # informational: received, never completed
    return _pipeline(spark, offers, events)


def test_completion_metrics(completion_case):
    got = rows(
        completion_case.offer_completion_metrics,
        "offer_type", "channel", "median_completion_time_hours", "min_completion_time_hours",
        "max_completion_time_hours", "std_dev_hours", "total_completions", "total_received", "completion_rate",
    )
    assert got == [
        ("bogo", "web", 2.0, 1.0, 4.0, 1.29, 4, 4, 100.0),
        ("discount", "web", 5.0, 5.0, 5.0, None, 1, 1, 100.0),  # one completion: stddev null
    ]  # informational has no completion: no row


def test_age_distribution_shares(small_pipeline):
    df = small_pipeline.age_distribution.collect()
    statuses = {r.completion_status for r in df}
    assert statuses and statuses <= {"Completed", "Not Completed"}
    for status in statuses:
        total = sum(r.percentage for r in df if r.completion_status == status)
        assert abs(total - 100.0) < 0.1


def test_offer_type_insights_round_the_exact_means_half_up(spark):
    from perkspark.operators.reports import offer_type_insights, offer_type_summary

    metrics = spark.createDataFrame(
        [("bogo", "web", 64.44, 50.25, 10, 20), ("bogo", "email", 64.46, 50.35, 5, 10), ("discount", "web", 81.38, 64.5, 3, 4)],
        "offer_type string, channel string, avg_completion_time_hours double, completion_rate double, "
        "total_completions long, total_received long",
    )
    summary = {r.offer_type: r for r in offer_type_summary(metrics).collect()}
    assert (summary["bogo"].avg_completion_time_hours, summary["bogo"].completion_rate) == (64.45, 50.3)
    assert (summary["bogo"].total_completions, summary["bogo"].total_received) == (15, 30)
    got = {r.offer_type: (r.avg_completion_time_hours, r.completion_rate) for r in offer_type_insights(metrics).collect()}
    assert got == {"bogo": (64.5, 50.3), "discount": (81.4, 64.5)}


def test_completion_metrics_keep_member_counts_of_an_untyped_offer(spark):
    from perkspark.operators.completion import offer_completion_metrics

    offers = spark.createDataFrame(
        [("o1", None, ["web", "email"]), ("o2", "bogo", ["web"])], "offer_id string, offer_type string, channels_list array<string>"
    )
    journeys = spark.createDataFrame(
        [
            ("c1", "o1", 5, True, True),
            ("c2", "o1", None, False, True),
            ("c1", "o2", 3, True, True),
            ("c3", "o2", 7, True, True),
        ],
        "customer_id string, offer_id string, time_to_complete int, is_completed boolean, is_received boolean",
    )
    got = {
        (r.offer_type, r.channel): (r.total_completions, r.total_received, r.unique_customers, r.total_customers_targeted)
        for r in offer_completion_metrics(journeys, offers).collect()
    }
    assert got == {(None, "web"): (1, 2, 1, 2), (None, "email"): (1, 2, 1, 2), ("bogo", "web"): (2, 2, 2, 2)}
