
from perkspark.operators import completion, reports


def test_quality_flags_partition_members(small_pipeline):
    c = small_pipeline.customers_cleansed
    counts = {r.data_quality_flag: r["count"] for r in c.groupBy("data_quality_flag").count().collect()}
    assert sum(counts.values()) == c.count() == small_pipeline.customers.count()
    assert set(counts) <= {"valid", "incomplete", "invalid_age", "invalid_income"}


def test_email_row_equals_unfanned_totals(small_pipeline):
    # every generated offer carries email, so the email row covers each journey once
    ce = {r.channel: r for r in small_pipeline.channel_effectiveness.collect()}
    received = small_pipeline.offer_interactions.filter("is_received")
    assert ce["email"].total_offers_sent == received.count()
    assert ce["email"].offers_completed == received.filter("is_completed").count()
    for r in ce.values():
        assert r.offers_completed <= r.total_offers_sent and r.effectiveness_rank >= 1


def test_offer_summary_sums_metrics(small_pipeline):
    m = small_pipeline.offer_completion_metrics
    summary = {r.offer_type: r for r in reports.offer_type_summary(m).collect()}
    for t, row in summary.items():
        sub = m.filter(m.offer_type == t).collect()
        assert row.total_completions == sum(r.total_completions for r in sub)
        assert row.total_received == sum(r.total_received for r in sub)


def test_overall_average_is_weighted_by_channels(small_pipeline):
    p = small_pipeline
    overall = completion.completion_avg_overall(p.offer_interactions, p.offers_enriched).collect()[0]
    by_channel = completion.completion_avg_by(p.offer_interactions, p.offers_enriched, "channel").collect()
    assert overall.completions_channel_rows == sum(r.completions for r in by_channel)


def test_layer_audit_counts(small_pipeline):
    audit = {(r.layer, r.table_name): r.row_count for r in small_pipeline.layer_audit().collect()}
    assert audit[("bronze", "events")] == small_pipeline.events.count()
    assert audit[("silver", "events_processed")] == audit[("bronze", "events")]
    assert audit[("gold", "v_channel_performance")] == audit[("gold", "channel_effectiveness")]
