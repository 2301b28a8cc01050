"""Channel effectiveness (question 1): completion rate, time and revenue per channel.

Every measure of a channel is a sum over the offers sent on it, so the large
journey table is first reduced to one row per offer (partial aggregation,
one shuffle of at most #offers keys per task) and only then fanned out to
channels through the small exploded offer dimension.  The programme's order
(fan out every journey row by 2-4 channels, then aggregate) moves 2-4x the
rows through the shuffle for the same result.

Revenue: transactions of the member inside [received_time, completed_time]
(both ends inclusive) of a completed offer.  One aggregate of the events gives
both the journeys and the members' transaction hours (``period_money``); a
running sum per member over hours and interval ends gives each interval's sum
(``operators.interval_join``), which is then summed per channel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perkspark import schemas
from perkspark.constants import EVENT_COMPLETED, EVENT_RECEIVED, EVENT_TRANSACTION
from perkspark.functions.numeric import exact_sum, pct
from perkspark.operators.interval_join import POINT, dealt_marks, ends, interval_sums, mark, point_sums, range_join, swept
from perkspark.plans.broadcast import join_dimension
from perkspark.plans.skew import heavy_keys


def offer_channels(offers_enriched: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per (offer, channel); empty channel names are dropped."""
    return offers_enriched.select(
        "offer_id", *extra, F.explode("channels_list").alias("channel")
    ).filter(F.length("channel") > 0)


def distinct_offer_channels(offers_enriched: DataFrame) -> DataFrame:
    return offer_channels(offers_enriched).select("offer_id", "channel").distinct()


def _per_offer_reception(interactions: DataFrame) -> DataFrame:
    """Received journeys reduced to one row per offer."""
    done = F.col("is_completed")
    return (
        interactions.filter(F.col("is_received"))
        .groupBy("offer_id")
        .agg(
            F.count(F.lit(1)).alias("sent"),
            F.count_if(done).alias("completed"),
            F.sum(F.when(done, F.col("time_to_complete"))).alias("ttc_sum"),
            F.count(F.when(done, F.col("time_to_complete"))).alias("ttc_n"),
        )
    )


def channel_metrics(
    interactions: DataFrame, offers_enriched: DataFrame, dim_small: bool | None = None, with_rewards: bool = False
) -> DataFrame:
    """(channel, total_offers_sent, offers_completed, avg_completion_time_hours, completion_rate).

    ``with_rewards`` adds ``total_rewards_earned`` (rewards of completed
    offers; null for a channel without completions) from the same aggregate.
    """
    per_offer = _per_offer_reception(interactions)
    extra = ("reward",) if with_rewards else ()
    fanned = join_dimension(per_offer, offer_channels(offers_enriched, extra), "offer_id", small=dim_small)
    aggs = [
        F.sum("sent").alias("total_offers_sent"),
        F.sum("completed").alias("offers_completed"),
        (F.sum("ttc_sum") / F.sum("ttc_n")).alias("avg_completion_time_hours"),
    ]
    if with_rewards:
        completed = F.col("completed")
        aggs.append(F.sum(F.when(completed > 0, F.col("reward") * completed)).alias("total_rewards_earned"))
    return fanned.groupBy("channel").agg(*aggs).withColumn(
        "completion_rate", pct(F.col("offers_completed"), F.col("total_offers_sent"))
    )


def completed_intervals(interactions: DataFrame) -> DataFrame:
    """(customer_id, offer_id, received_time, completed_time) of received and completed journeys."""
    return interactions.filter(F.col("is_received") & F.col("is_completed")).select(
        "customer_id", "offer_id", "received_time", "completed_time"
    )


def transactions(events_processed: DataFrame) -> DataFrame:
    return events_processed.filter(F.col("event_type") == EVENT_TRANSACTION).select(
        "customer_id", "transaction_amount", "event_time_hours"
    )


def offer_period_revenue(
    interactions: DataFrame, events_processed: DataFrame, keep_empty: bool = True
) -> DataFrame:
    """Per completed (customer, offer): transactions inside the offer period.

    Columns: customer_id, offer_id, received_time, completed_time, matched,
    matched_values, value_sum.  ``keep_empty=False`` drops offers whose
    period holds no transaction.
    """
    return interval_sums(
        transactions(events_processed),
        completed_intervals(interactions),
        key="customer_id",
        point_col="event_time_hours",
        value_col="transaction_amount",
        lo_col="received_time",
        hi_col="completed_time",
        keep_empty=keep_empty,
        hot=heavy_keys(events_processed, "customer_id"),
    )


def period_money(events_processed: DataFrame) -> DataFrame:
    """``offer_period_revenue(..., keep_empty=False)`` from the events alone.

    One aggregate over the events holds a row for each journey and one for each
    member's transaction hour, so the events are read and shuffled once; only the
    count that finds heavy members reads their ids again.
    """
    member, kind, hour = F.col("customer_id"), F.col("event_type"), F.col("event_time_hours")
    sale = kind == EVENT_TRANSACTION
    used = events_processed.filter(member.isNotNull() & (F.col("offer_id").isNotNull() | sale))
    first = lambda event: F.min(F.when(kind == event, hour))
    timeline = used.groupBy("customer_id", "offer_id", F.when(sale, hour).alias("hour")).agg(
        first(EVENT_RECEIVED).alias("received_time"),
        first(EVENT_COMPLETED).alias("completed_time"),
        *(c.alias(n) for n, c in point_sums(F.when(sale, F.col("transaction_amount"))).items()),
    )
    offer = F.struct("offer_id", "received_time", "completed_time")
    of_hour = mark(F.col("hour"), POINT, F.when(F.lit(False), offer), {c: F.col(c) for c in point_sums(F.lit(0.0))})
    marks = F.when(F.col("hour").isNotNull(), F.array(of_hour)).otherwise(ends(F.col("received_time"), F.col("completed_time"), offer))
    rows = timeline.select("customer_id", marks.alias("marks"))
    sums = swept(dealt_marks(rows, "customer_id", heavy_keys(events_processed, "customer_id")), "customer_id", "deal")
    return sums.filter("matched > 0").select("customer_id", "interval.*", "matched", "matched_values", "value_sum")


def offer_period_transactions(interactions: DataFrame, events_processed: DataFrame, bin_width: int = 24) -> DataFrame:
    """The matching (transaction, completed offer) pairs themselves (binned range join)."""
    return range_join(
        transactions(events_processed),
        completed_intervals(interactions),
        key="customer_id",
        point_col="event_time_hours",
        lo_col="received_time",
        hi_col="completed_time",
        bin_width=bin_width,
    )


def channel_revenue(money: DataFrame, offers_enriched: DataFrame, dim_small: bool | None = None) -> DataFrame:
    """(channel, total_revenue_generated, offers_with_revenue, customers_with_revenue).

    ``money`` has the offer periods with a transaction (``period_money``).  Only
    channels with at least one of them appear; the sum is null when none of the
    transactions has an amount.

    One aggregate gives all three: a period is a row for its offer, with the sum,
    and a row for its member, so that both distinct counts are counts of groups.
    """
    offer = F.struct(F.lit(True).alias("is_offer"), F.col("offer_id").alias("id"), F.col("value_sum").alias("value"))
    member = F.struct(F.lit(False).alias("is_offer"), F.col("customer_id").alias("id"), F.lit(None).cast("double").alias("value"))
    each = money.select("offer_id", F.explode(F.array(offer, member)).alias("of"))
    fanned = join_dimension(each, offer_channels(offers_enriched), "offer_id", small=dim_small)
    ids = fanned.groupBy("channel", "of.is_offer", "of.id").agg(exact_sum(F.col("of.value")).alias("value"))
    return ids.groupBy("channel").agg(
        exact_sum("value").alias("total_revenue_generated"),
        F.count_if("is_offer").alias("offers_with_revenue"),
        F.count_if(~F.col("is_offer")).alias("customers_with_revenue"),
    )


def channel_rewards(interactions: DataFrame, offers_enriched: DataFrame, dim_small: bool | None = None) -> DataFrame:
    """(channel, total_rewards_earned): rewards of completed offers, per channel."""
    per_offer = _per_offer_reception(interactions).filter(F.col("completed") > 0)
    fanned = join_dimension(per_offer, offer_channels(offers_enriched, ("reward",)), "offer_id", small=dim_small)
    return fanned.groupBy("channel").agg(F.sum(F.col("reward") * F.col("completed")).alias("total_rewards_earned"))


def channel_effectiveness(
    interactions: DataFrame,
    money: DataFrame,
    offers_enriched: DataFrame,
    breakdown: bool = False,
    dim_small: bool | None = None,
) -> DataFrame:
    """The channel ranking (contract ``CHANNEL_EFFECTIVENESS``); ``money`` as in ``channel_revenue``.

    ``total_revenue_generated`` is the transaction sum, or when a channel has
    none, the sum of rewards, or 0 -- the programme's fallback.
    ``breakdown=True`` adds ``transaction_revenue``, ``reward_cost`` and
    ``revenue_source`` so the two measures stay distinguishable.
    """
    metrics = channel_metrics(interactions, offers_enriched, dim_small, with_rewards=True)
    revenue = channel_revenue(money, offers_enriched, dim_small).select(
        "channel", F.col("total_revenue_generated").alias("transaction_revenue")
    )
    revenue_total = F.coalesce(F.col("transaction_revenue"), F.col("total_rewards_earned").cast("double"), F.lit(0.0))
    # one row per channel: the window below runs on a handful of rows
    rank = F.rank().over(Window.orderBy(F.col("completion_rate").desc_nulls_last()))
    out = (
        metrics.join(revenue, "channel", "left")
        .withColumn("revenue_total", revenue_total)
        .select(
            "channel",
            "total_offers_sent",
            "offers_completed",
            "completion_rate",
            F.round("avg_completion_time_hours", 2).alias("avg_completion_time_hours"),
            F.round("revenue_total", 2).alias("total_revenue_generated"),
            F.when(F.col("offers_completed") > 0, F.round(F.col("revenue_total") / F.col("offers_completed"), 2))
            .otherwise(F.lit(0.0))
            .alias("avg_revenue_per_offer"),
            rank.alias("effectiveness_rank"),
            F.round("transaction_revenue", 2).alias("transaction_revenue"),
            F.col("total_rewards_earned").cast("double").alias("reward_cost"),
            F.when(F.col("transaction_revenue").isNotNull(), "transactions")
            .when(F.col("total_rewards_earned").isNotNull(), "rewards")
            .otherwise("none")
            .alias("revenue_source"),
        )
    )
    if breakdown:
        return out
    return schemas.enforce(out, schemas.CHANNEL_EFFECTIVENESS)
