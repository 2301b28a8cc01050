"""Registry of the user-facing queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query starts from the warehouse tables of ``sf_dir`` (through the raw
fixture relations) and runs the whole layer graph it needs, so its work
grows with the tables.  ``perkspark.oracle.queries`` holds the DuckDB text
of the same names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perkspark.functions.numeric import exact_sum
from perkspark.operators import age, channel, completion, distinct, reports, warehouse
from perkspark.plans.pipeline import LoyaltyPipeline
from perkspark.sources.csv import as_csv_lines, from_csv_lines
from perkspark.sources.tables import read_table

QueryFn = Callable[[SparkSession, str], DataFrame]


def temporals_as_text(df: DataFrame) -> DataFrame:
    """Dates as ``yyyy-MM-dd`` and timestamps as ``yyyy-MM-dd HH:mm:ss`` text.

    Query results leave the engine through pandas, where date and timestamp
    types differ between engines; ISO text compares the same everywhere.
    """
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DateType):
            cols.append(F.date_format(f.name, "yyyy-MM-dd").alias(f.name))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            cols.append(F.date_format(f.name, "yyyy-MM-dd HH:mm:ss").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(cols)


def _p(spark: SparkSession, sf_dir: str) -> LoyaltyPipeline:
    return LoyaltyPipeline.from_warehouse(spark, sf_dir)


def _offers_enriched_flat(spark, sf):
    return _p(spark, sf).offers_enriched.withColumn("channels_list", F.array_join("channels_list", ","))


def _interactions_pivot(spark, sf):
    from perkspark.operators import journey

    p = _p(spark, sf)
    return journey.build_interactions(p.events_processed, p.offers_enriched, pivot=True, dim_small=p.offers_small)


def _events_value_extract(spark, sf):
    p = _p(spark, sf)
    return p.events_processed.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.count("offer_id").alias("with_offer_id"),
        F.count_if(F.col("offer_id").isNull() & F.col("event_type").startswith("offer ")).alias("unparsed_offer_events"),
        F.count("transaction_amount").alias("with_amount"),
        F.round(exact_sum("transaction_amount"), 2).alias("amount_sum"),
        F.count("reward_amount").alias("with_reward"),
        F.count_distinct("event_id").alias("distinct_event_ids"),
        F.min("event_date").alias("first_date"),
        F.max("event_date").alias("last_date"),
    )


def _customer_quality_counts(spark, sf):
    return _p(spark, sf).customers_cleansed.groupBy("data_quality_flag").agg(F.count(F.lit(1)).alias("customers"))


def _channel_metrics(spark, sf):
    p = _p(spark, sf)
    return channel.channel_metrics(p.journeys, p.offers_enriched, p.offer_channels_small).withColumn(
        "avg_completion_time_hours", F.round("avg_completion_time_hours", 2)
    )


def _channel_revenue(spark, sf):
    p = _p(spark, sf)
    return channel.channel_revenue(p.period_money, p.offers_enriched, p.offer_channels_small).withColumn(
        "total_revenue_generated", F.round("total_revenue_generated", 2)
    )


def _channel_rewards(spark, sf):
    p = _p(spark, sf)
    return channel.channel_rewards(p.journeys, p.offers_enriched, p.offer_channels_small)


def _channel_breakdown(spark, sf):
    p = _p(spark, sf)
    return channel.channel_effectiveness(
        p.journeys, p.period_money, p.offers_enriched, breakdown=True, dim_small=p.offer_channels_small
    )


def _channel_effectiveness_completable(spark, sf):
    """The channel ranking over offers that can be completed (difficulty > 0):
    informational offers cannot complete and would only dilute the rates."""
    p = _p(spark, sf)
    completable = p.offers_enriched.filter(F.col("difficulty") > 0)
    return channel.channel_effectiveness(
        p.journeys, p.period_money, completable, dim_small=p.offer_channels_small
    )


def _completion_avg_by_type_unfanned(spark, sf):
    p = _p(spark, sf)
    return completion.completion_avg_by_type_unfanned(p.journeys, p.offers_enriched, p.offers_small)


def _completion_avg_overall(spark, sf):
    p = _p(spark, sf)
    return completion.completion_avg_overall(p.journeys, p.offers_enriched, p.offers_small)


def _completion_avg_by(key):
    def run(spark, sf):
        p = _p(spark, sf)
        return completion.completion_avg_by(p.journeys, p.offers_enriched, key, p.offer_channels_small)

    return run


def _customer_offer_status(spark, sf):
    return age.customer_offer_status(_p(spark, sf).journeys)


QUERIES: dict[str, QueryFn] = {
    # raw relations (harness parity)
    "raw_customers": lambda s, sf: _p(s, sf).customers,
    "raw_offers": lambda s, sf: _p(s, sf).offers,
    "raw_events": lambda s, sf: _p(s, sf).events,
    # cleansed layer
    "customers_cleansed": lambda s, sf: _p(s, sf).customers_cleansed,
    "customer_quality_counts": _customer_quality_counts,
    "offers_enriched": _offers_enriched_flat,
    "offer_channels": lambda s, sf: channel.distinct_offer_channels(_p(s, sf).offers_enriched),
    "events_parsed": lambda s, sf: _p(s, sf).events_processed,
    "event_value_extract": _events_value_extract,
    "offer_interactions": lambda s, sf: _p(s, sf).offer_interactions,
    "offer_interactions_pivot": _interactions_pivot,
    # question 1
    "channel_metrics": _channel_metrics,
    "channel_revenue": _channel_revenue,
    "channel_rewards": _channel_rewards,
    "channel_effectiveness": lambda s, sf: _p(s, sf).channel_effectiveness,
    "channel_revenue_breakdown": _channel_breakdown,
    "channel_effectiveness_completable": _channel_effectiveness_completable,
    "channel_reach": lambda s, sf: distinct.channel_reach(_p(s, sf).journeys, _p(s, sf).offers_enriched),
    # question 2
    "customer_offer_status": _customer_offer_status,
    "age_distribution": lambda s, sf: _p(s, sf).age_distribution,
    # question 3
    "offer_completion_metrics": lambda s, sf: _p(s, sf).offer_completion_metrics,
    "completion_avg_overall": _completion_avg_overall,
    "completion_avg_by_type": _completion_avg_by("offer_type"),
    "completion_avg_by_channel": _completion_avg_by("channel"),
    "completion_avg_by_type_unfanned": _completion_avg_by_type_unfanned,
    # views
    "v_channel_performance": lambda s, sf: _p(s, sf).v_channel_performance,
    "v_age_summary": lambda s, sf: _p(s, sf).v_age_summary,
    "v_offer_summary": lambda s, sf: _p(s, sf).v_offer_summary,
    # the same results in their presented order
    **{
        f"{name}_sorted": (lambda s, sf, name=name: reports.presented(getattr(_p(s, sf), name), name))
        for name in reports.PRESENTED_BY
    },
    # reports
    "layer_audit": lambda s, sf: _p(s, sf).layer_audit(),
    "contract_violations": lambda s, sf: _p(s, sf).contract_violations(),
    "channel_rates_sorted": lambda s, sf: reports.channel_rates_sorted(_p(s, sf).channel_effectiveness),
    "age_status_matrix": lambda s, sf: reports.age_status_matrix(_p(s, sf).age_distribution),
    "offer_type_summary": lambda s, sf: reports.offer_type_summary(_p(s, sf).offer_completion_metrics),
    "offer_type_insights": lambda s, sf: reports.offer_type_insights(_p(s, sf).offer_completion_metrics),
    "offer_channel_time_matrix": lambda s, sf: reports.offer_channel_matrix(
        _p(s, sf).offer_completion_metrics, "avg_completion_time_hours"
    ),
    "offer_channel_rate_matrix": lambda s, sf: reports.offer_channel_matrix(
        _p(s, sf).offer_completion_metrics, "completion_rate"
    ),
    "best_combinations": lambda s, sf: reports.best_combinations(_p(s, sf).offer_completion_metrics),
    "fastest_combinations": lambda s, sf: reports.fastest_combinations(_p(s, sf).offer_completion_metrics),
    "channels_for_offer_type": lambda s, sf: reports.channels_for_offer_type(_p(s, sf).offer_completion_metrics),
    "offer_types": lambda s, sf: reports.offer_types(_p(s, sf).offer_completion_metrics),
}


def _csv_round_trip(name: str):
    """Every row of a warehouse table written as CSV text and read back, typed."""

    def run(spark, sf):
        rows = read_table(spark, sf, name)
        return from_csv_lines(as_csv_lines(rows), rows.schema)

    return run


QUERIES.update({f"{name}_csv_round_trip": _csv_round_trip(name) for name in ("events", "part")})


def _t(spark, sf, name, cols):
    return read_table(spark, sf, name, cols)


_ORD = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]

QUERIES.update(
    {
        "tpch_segment_conditional_sums": lambda s, sf: warehouse.segment_conditional_sums(
            _t(s, sf, "customer", ["c_custkey", "c_mktsegment"]),
            _t(s, sf, "orders", ["o_custkey", "o_orderstatus", "o_totalprice"]),
        ),
        "tpch_orders_in_customer_interval": lambda s, sf: warehouse.orders_in_customer_interval(
            _t(s, sf, "orders", ["o_custkey", "o_orderdate", "o_totalprice"])
        ),
        "tpch_lines_sum_distinct": lambda s, sf: warehouse.lines_sum_distinct(
            _t(s, sf, "lineitem", ["l_returnflag", "l_quantity", "l_orderkey", "l_suppkey", "l_extendedprice"])
        ),
        "tpch_median_price_by_brand": lambda s, sf: warehouse.median_price_by_brand(
            _t(s, sf, "lineitem", ["l_partkey", "l_extendedprice"]), _t(s, sf, "part", ["p_partkey", "p_brand"])
        ),
        "tpch_customers_ranked_by_revenue": lambda s, sf: warehouse.customers_ranked_by_revenue(
            _t(s, sf, "orders", ["o_custkey", "o_totalprice"])
        ),
        "tpch_priority_pivot": lambda s, sf: warehouse.priority_pivot(
            _t(s, sf, "orders", ["o_custkey", "o_orderpriority", "o_orderdate"])
        ),
        "tpch_share_and_rank": lambda s, sf: warehouse.share_and_rank(
            _t(s, sf, "customer", ["c_custkey", "c_mktsegment", "c_nationkey"]),
            _t(s, sf, "orders", ["o_custkey", "o_orderstatus", "o_totalprice"]),
            _t(s, sf, "nation", ["n_nationkey", "n_name"]),
        ),
    }
)


def _presented(fn: QueryFn) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return temporals_as_text(fn(spark, sf_dir))

    return run


QUERIES = {name: _presented(fn) for name, fn in QUERIES.items()}
