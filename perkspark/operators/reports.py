"""Reports over the metric tables (K14-K20): audits, matrices, top-k.

These are the data behind the programme's printed summaries and charts,
returned as DataFrames (drawing is left to the caller).  All inputs are
metric tables of a few dozen rows, except the audit, whose counts are
global aggregates over every layer.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perkspark.constants import (
    FLAG_VALID,
    LAYER_CLEANSED,
    LAYER_METRICS,
    LAYER_RAW,
    OFFER_EVENTS,
    STATUS_COMPLETED,
    STATUS_NOT_COMPLETED,
    UNNAMED_CHANNEL,
)
from perkspark.functions.numeric import exact_mean
from perkspark.plans.stored import stored


#: (name, SQL condition) of the audit's quality counts, by the table they are taken from.
QUALITY = {
    "customers_cleansed": ("customers_not_valid", f"data_quality_flag <> '{FLAG_VALID}'"),
    "events_processed": ("offer_events_unparsed", f"event_type IN {OFFER_EVENTS} AND offer_id IS NULL"),
}


def _lines(counts: DataFrame, lines: list[tuple[str, str, str]]) -> DataFrame:
    """One row of counts as (layer, table_name, row_count) rows; a null count is 0."""
    structs = [
        F.struct(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias("row_count"))
        for layer, name, c in lines
    ]
    return counts.select(F.inline(F.array(*structs)))


def layer_audit(
    customers_cleansed: DataFrame,
    offers_enriched: DataFrame,
    events_processed: DataFrame,
    offer_interactions: DataFrame,
    channel_effectiveness: DataFrame,
    age_distribution: DataFrame,
    offer_completion_metrics: DataFrame,
) -> DataFrame:
    """(layer, table_name, row_count) for every table and view, plus two
    quality lines: members not flagged valid, offer events without offer id.

    Cleansing keeps every row, so a raw table and its cleansed one are counted
    together, with their quality line; a view that groups a metric table is
    counted with it.  All counts of journeys are made to depend on receipt and
    completion, as the metrics do, so that their plans share one aggregate of the
    events: these are scanned twice in all.
    """
    rows = F.count(F.lit(1)).alias("n")
    parts = []
    for raw, cleansed, df in (
        ("customers", "customers_cleansed", customers_cleansed),
        ("offers", "offers_enriched", offers_enriched),
        ("events", "events_processed", events_processed),
    ):
        lines = [(LAYER_RAW, raw, "n"), (LAYER_CLEANSED, cleansed, "n")]
        counts = [rows]
        if cleansed in QUALITY:
            name, condition = QUALITY[cleansed]
            counts.append(F.count_if(F.expr(condition)).alias("q"))
            lines.append(("quality", name, "q"))
        parts.append(_lines(df.agg(*counts), lines))
    got, done = F.col("received_time").isNotNull(), F.col("completed_time").isNotNull()
    journeys = offer_interactions.agg((F.count_if(got) + F.count_if(~got & done) + F.count_if(~got & ~done)).alias("n"))
    parts.append(_lines(journeys, [(LAYER_CLEANSED, "offer_interactions", "n")]))
    channels = channel_effectiveness.agg(F.count("completion_rate").alias("n"))  # never null: a channel has receipts
    parts.append(_lines(channels, [(LAYER_METRICS, "channel_effectiveness", "n"), (LAYER_METRICS, "v_channel_performance", "n")]))
    for table, view, df, key in (
        ("age_distribution_analysis", "v_age_summary", age_distribution, "age_group"),
        ("offer_completion_metrics", "v_offer_summary", offer_completion_metrics, "offer_type"),
    ):
        groups = df.groupBy(key).agg(rows).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("groups"))
        parts.append(_lines(groups, [(LAYER_METRICS, table, "n"), (LAYER_METRICS, view, "groups")]))
    return reduce(DataFrame.unionByName, parts)


def channel_rates_sorted(channel_effectiveness: DataFrame) -> DataFrame:
    """Chart feed: channels by completion rate, ascending."""
    return channel_effectiveness.select("channel", "completion_rate", "avg_revenue_per_offer").orderBy(
        "completion_rate", "channel"
    )


def age_status_matrix(age_distribution: DataFrame) -> DataFrame:
    """age_group x completion status -> share of the status (percent)."""
    wide = (
        age_distribution.groupBy("age_group")
        .pivot("completion_status", [STATUS_COMPLETED, STATUS_NOT_COMPLETED])
        .agg(F.first("percentage"))
    )
    return wide.select(
        "age_group",
        F.col(STATUS_COMPLETED).alias("completed_pct"),
        F.col(f"`{STATUS_NOT_COMPLETED}`").alias("not_completed_pct"),
    )


def offer_type_summary(offer_completion_metrics: DataFrame) -> DataFrame:
    """Per offer type: mean of the channel rows' time and rate, summed counts."""
    return offer_completion_metrics.groupBy("offer_type").agg(
        exact_mean("avg_completion_time_hours").alias("avg_completion_time_hours"),
        exact_mean("completion_rate").alias("completion_rate"),
        F.sum("total_completions").alias("total_completions"),
        F.sum("total_received").alias("total_received"),
    )


def offer_type_insights(offer_completion_metrics: DataFrame) -> DataFrame:
    """The printed per-type insight: the summary's mean time and rate at one decimal."""
    summary = offer_type_summary(offer_completion_metrics)
    return summary.select(
        "offer_type",
        F.round("avg_completion_time_hours", 1).alias("avg_completion_time_hours"),
        F.round("completion_rate", 1).alias("completion_rate"),
    )


def offer_channel_matrix(offer_completion_metrics: DataFrame, measure: str) -> DataFrame:
    """offer_type x channel -> ``measure``; absent pairs are null.

    Every channel of the metric table is a column, in name order; offers
    without a channel name are under ``UNNAMED_CHANNEL``.  Which columns there are
    depends on the rows, so each type's cells are first stored as one map, from a
    single run of the metrics; the maps' keys then name the columns.
    """
    channel = F.when(F.length("channel") > 0, F.col("channel")).otherwise(UNNAMED_CHANNEL)
    cells = F.map_from_entries(F.collect_list(F.struct(channel.alias("channel"), F.col(measure).alias("value"))))
    maps = stored(offer_completion_metrics.groupBy("offer_type").agg(cells.alias("cells")), "offer-channel-cells")
    channels = maps.select(F.explode(F.map_keys("cells")).alias("channel")).distinct()
    names = sorted(r["channel"] for r in channels.collect())
    return maps.select("offer_type", *(F.col("cells").getItem(name).alias(name) for name in names))


def best_combinations(offer_completion_metrics: DataFrame, k: int = 5) -> DataFrame:
    """Top-k (type, channel) pairs by completion rate; ties by type, channel."""
    return (
        offer_completion_metrics.select("offer_type", "channel", "completion_rate", "avg_completion_time_hours")
        .orderBy(F.col("completion_rate").desc(), "offer_type", "channel")
        .limit(k)
    )


def fastest_combinations(offer_completion_metrics: DataFrame, k: int = 5) -> DataFrame:
    """Bottom-k (type, channel) pairs by mean completion time (nulls skipped)."""
    return (
        offer_completion_metrics.filter(F.col("avg_completion_time_hours").isNotNull())
        .select("offer_type", "channel", "avg_completion_time_hours", "completion_rate")
        .orderBy("avg_completion_time_hours", "offer_type", "channel")
        .limit(k)
    )


def channels_for_offer_type(offer_completion_metrics: DataFrame) -> DataFrame:
    """Per offer type, its channels in name order with their time and rate."""
    by_name = Window.partitionBy("offer_type").orderBy("channel")
    return offer_completion_metrics.select(
        "offer_type",
        "channel",
        F.row_number().over(by_name).alias("channel_position"),
        "avg_completion_time_hours",
        "completion_rate",
    )


def offer_types(offer_completion_metrics: DataFrame) -> DataFrame:
    return offer_completion_metrics.select("offer_type").distinct()


# fixed values: the order in which each result is presented; ties by the last columns
PRESENTED_BY = {
    "v_channel_performance": [("effectiveness_rank", "asc"), ("channel", "asc")],
    "v_age_summary": [("age_group", "asc")],
    "v_offer_summary": [("avg_completion_rate", "desc"), ("offer_type", "asc")],
    "age_distribution": [("completion_status", "asc"), ("age_group", "asc")],
    "offer_completion_metrics": [("offer_type", "asc"), ("avg_completion_time_hours", "asc"), ("channel", "asc")],
}


def presented(result: DataFrame, name: str) -> DataFrame:
    """``result`` (a few metric rows) in its presented order, with its ``position`` from 1; nulls come last."""
    keys = [F.col(c).desc_nulls_last() if way == "desc" else F.col(c).asc_nulls_last() for c, way in PRESENTED_BY[name]]
    return result.withColumn("position", F.row_number().over(Window.orderBy(*keys))).orderBy("position")
