"""Time from receipt to completion (question 3), by offer type and channel.

Journeys are first counted per (offer, hours), which is bounded by the offers
and the clock, and only these counts are fanned out to the offer's channels.
Mean, deviation, extremes and the exact discrete median all follow from the
counts per (type, channel, hours).  Distinct members come from one row per
(type, channel list, member), fanned out after that reduction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perkspark import schemas
from perkspark.plans.broadcast import join_dimension


def type_channels(offers_enriched: DataFrame) -> DataFrame:
    """(offer_id, offer_type, channel): the exploded offer dimension."""
    return offers_enriched.select("offer_id", "offer_type", F.explode("channels_list").alias("channel"))


def completion_analysis(interactions: DataFrame, offers_enriched: DataFrame, dim_small: bool | None = None) -> DataFrame:
    """Completed journeys, one row per channel of the offer."""
    completed = interactions.filter(F.col("is_completed")).select("offer_id", "customer_id", "time_to_complete")
    return join_dimension(completed, type_channels(offers_enriched), "offer_id", small=dim_small, hot=True)


def offer_completion_metrics(
    interactions: DataFrame, offers_enriched: DataFrame, dim_small: bool | None = None
) -> DataFrame:
    """Contract ``OFFER_COMPLETION_METRICS``.

    Pairs need at least one completion and one receipt -- the programme's
    inner join of the two sides -- so informational offers without completions
    have no row.
    """
    done, got = F.col("is_completed"), F.col("is_received")
    journeys = interactions.filter(done | got).select(
        "offer_id", "customer_id", F.when(done, F.col("time_to_complete")).alias("t"), "is_completed", "is_received"
    )
    keys = ["offer_type", "channel"]
    per_offer = journeys.groupBy("offer_id", "t").agg(F.count_if(done).alias("n_done"), F.count_if(got).alias("n_got"))
    hours = (
        join_dimension(per_offer, type_channels(offers_enriched), "offer_id", small=dim_small)
        .groupBy(*keys, "t")
        .agg(F.sum("n_done").alias("n_done"), F.sum("n_got").alias("n_got"))
        .withColumn("w", F.when(F.col("t").isNotNull(), F.col("n_done")).otherwise(0))
    )
    # a group has at most a row for each hour of the clock
    group = Window.partitionBy(*keys)
    t, w = F.col("t"), F.col("w")
    hours = (
        hours.withColumn("timed", F.sum("w").over(group))
        .withColumn("mean", F.try_divide(F.sum(w * t).over(group), F.col("timed")))
        .withColumn("reached", F.sum("w").over(group.orderBy(F.col("t").asc_nulls_last())))
    )
    timing = hours.groupBy(*keys).agg(
        F.first("mean").alias("avg_t"),
        F.min(F.when(2 * F.col("reached") >= F.col("timed"), t)).alias("med_t"),
        F.min(F.when(w > 0, t)).alias("min_t"),
        F.max(F.when(w > 0, t)).alias("max_t"),
        F.sqrt(F.try_divide(F.sum(w * (t - F.col("mean")) * (t - F.col("mean"))), F.sum("w") - 1)).alias("sd_t"),
        F.sum("n_done").alias("total_completions"),
        F.sum("n_got").alias("total_received"),
    )
    dims = offers_enriched.select("offer_id", "offer_type", "channels_list")
    reach = (
        join_dimension(journeys.filter(F.col("customer_id").isNotNull()), dims, "offer_id", small=dim_small, hot=True)
        .groupBy("offer_type", "channels_list", "customer_id")
        .agg(F.bool_or(done).alias("any_done"), F.bool_or(got).alias("any_got"))
        .select("offer_type", F.explode("channels_list").alias("channel"), "customer_id", "any_done", "any_got")
        .groupBy(*keys, "customer_id")
        .agg(F.bool_or("any_done").alias("any_done"), F.bool_or("any_got").alias("any_got"))
        .groupBy(*[F.col(k).alias(f"_r_{k}") for k in keys])
        .agg(F.count_if("any_done").alias("unique_customers"), F.count_if("any_got").alias("total_customers_targeted"))
    )
    # null-safe: an offer without a type is a group of its own on both sides
    on = [timing[k].eqNullSafe(reach[f"_r_{k}"]) for k in keys]
    stats = timing.join(reach, on, "left").fillna(0, ["unique_customers", "total_customers_targeted"])
    out = stats.filter((F.col("total_completions") > 0) & (F.col("total_received") > 0)).select(
        "offer_type",
        "channel",
        F.round("avg_t", 2).alias("avg_completion_time_hours"),
        F.col("med_t").cast("double").alias("median_completion_time_hours"),
        F.col("min_t").cast("double").alias("min_completion_time_hours"),
        F.col("max_t").cast("double").alias("max_completion_time_hours"),
        F.round("sd_t", 2).alias("std_dev_hours"),
        "total_completions",
        "total_received",
        F.round(F.col("total_completions") / F.col("total_received") * 100, 2).alias("completion_rate"),
        "unique_customers",
        "total_customers_targeted",
    )
    return schemas.enforce(out, schemas.OFFER_COMPLETION_METRICS)


def completion_avg_overall(
    interactions: DataFrame, offers_enriched: DataFrame, dim_small: bool | None = None
) -> DataFrame:
    """One row: mean completion time over the channel-fanned rows (as the
    programme reports it, an offer on 4 channels counts 4 times) and over
    journeys (each completed journey once)."""
    dims = offers_enriched.select("offer_id", F.size("channels_list").alias("n_ch"))
    per_offer = join_dimension(_per_offer_times(interactions), dims, "offer_id", small=dim_small)
    n = F.greatest(F.col("n_ch"), F.lit(0))
    # weighted by channel count == the mean over exploded rows
    return per_offer.agg(
        F.round(F.try_divide(F.sum(F.col("hours") * n), F.sum(F.when(F.col("timed") > 0, F.col("timed") * n))), 2).alias("avg_hours_channel_rows"),
        F.round(F.try_divide(F.sum("hours"), F.sum("timed")), 2).alias("avg_hours_per_journey"),
        F.coalesce(F.sum(F.col("journeys") * n), F.lit(0)).cast("bigint").alias("completions_channel_rows"),
        F.coalesce(F.sum("journeys"), F.lit(0)).cast("bigint").alias("completions_journeys"),
    )


def _per_offer_times(interactions: DataFrame) -> DataFrame:
    """Completed journeys reduced to one row per offer: hours in all, journeys with hours, journeys."""
    return (
        interactions.filter(F.col("is_completed"))
        .groupBy("offer_id")
        .agg(
            F.sum("time_to_complete").alias("hours"),
            F.count("time_to_complete").alias("timed"),
            F.count(F.lit(1)).alias("journeys"),
        )
    )


def _averages(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(
        F.try_divide(F.sum("hours"), F.sum("timed")).alias("avg_hours"), F.sum("journeys").alias("completions")
    )


def completion_avg_by(
    interactions: DataFrame, offers_enriched: DataFrame, key: str, dim_small: bool | None = None
) -> DataFrame:
    """(key, avg_hours, completions) over the channel-fanned completed rows,
    ordered by the mean (a handful of rows: types or channels)."""
    fanned = join_dimension(_per_offer_times(interactions), type_channels(offers_enriched), "offer_id", small=dim_small)
    return _averages(fanned, key).orderBy("avg_hours", key)


def completion_avg_by_type_unfanned(
    interactions: DataFrame, offers_enriched: DataFrame, dim_small: bool | None = None
) -> DataFrame:
    """(offer_type, avg_hours, completions) with each completed journey counted
    once, whatever the number of channels of its offer."""
    types = offers_enriched.select("offer_id", "offer_type")
    return _averages(join_dimension(_per_offer_times(interactions), types, "offer_id", small=dim_small), "offer_type")
