"""
follow from the library's formulas.  The member and event files behind them
are not public, so these check formulas, not the pipeline end to end."""

from perkspark.operators import views

# --- fixed values: published per-channel results --------------------------
# channel: (sent, completed, completion rate %, revenue $)
PUBLISHED_CHANNELS = {
    "web": (50594, 25819, 51.03, 110648.0),
    "social": (37943, 18754, 49.43, 101648.0),
    "email": (63288, 28996, 45.82, 142418.0),
    "mobile": (56914, 26018, 45.71, 127528.0),
}
# discount offer type, per channel: completion rate % and mean hours
PUBLISHED_DISCOUNT_RATES = (70.72, 65.63, 60.87, 60.87)
PUBLISHED_DISCOUNT_HOURS = (76.26, 77.81, 85.73, 85.73)


def test_channel_rates_follow_from_counts(spark):
    from pyspark.sql import functions as F

    from perkspark.functions.numeric import pct

    df = spark.createDataFrame(
        [(c, s, d) for c, (s, d, _, _) in PUBLISHED_CHANNELS.items()], "channel string, sent long, done long"
    )
    got = {r.channel: r.rate for r in df.select("channel", pct(F.col("done"), F.col("sent")).alias("rate")).collect()}
    assert got == {c: v[2] for c, v in PUBLISHED_CHANNELS.items()}


def test_published_revenue_is_the_reward_fallback():
    # email carries every offer; the only completable offer without web is a
    # bogo with reward 10, the only one without mobile a discount with reward 5
    email, web, mobile = (PUBLISHED_CHANNELS[c] for c in ("email", "web", "mobile"))
    assert email[3] - web[3] == 10 * (email[1] - web[1])
    assert email[3] - mobile[3] == 5 * (email[1] - mobile[1])


def test_performance_levels_of_published_rates(spark):
    df = spark.createDataFrame(
        [(c, s, d, r, rev, 1) for c, (s, d, r, rev) in PUBLISHED_CHANNELS.items()],
        "channel string, total_offers_sent long, offers_completed long, completion_rate double, "
        "total_revenue_generated double, effectiveness_rank int",
    )
    levels = {r.channel: r.performance_level for r in views.channel_performance_view(df).collect()}
    assert levels == {"web": "High", "social": "Medium", "email": "Medium", "mobile": "Medium"}


def test_offer_summary_means_are_unweighted(spark):
    rows = [("discount", c, h, r, 1, 1) for c, h, r in zip("abcd", PUBLISHED_DISCOUNT_HOURS, PUBLISHED_DISCOUNT_RATES)]
    df = spark.createDataFrame(
        rows,
        "offer_type string, channel string, avg_completion_time_hours double, completion_rate double, "
        "total_completions long, total_received long",
    )
    got = views.offer_summary_view(df).collect()[0]
    assert (got.avg_completion_rate, got.avg_completion_time) == (64.52, 81.38)
