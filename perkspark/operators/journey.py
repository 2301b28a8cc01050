"""Offer journey: one row per (customer, offer) with the first hour of each stage.

The default form takes three conditional minima in one aggregate: a single
shuffle on (customer_id, offer_id) with map-side partial aggregation, so a
member with millions of events is collapsed to one row per offer before
anything crosses the network.  ``pivot=True`` gives the same rows through
``groupBy().pivot()`` (two shuffles), the form the programme uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perkspark import schemas
from perkspark.constants import EVENT_COMPLETED, EVENT_RECEIVED, EVENT_VIEWED
from perkspark.plans.broadcast import join_dimension

_STAGES = ((EVENT_RECEIVED, "received_time"), (EVENT_VIEWED, "viewed_time"), (EVENT_COMPLETED, "completed_time"))


def stage_times(events_processed: DataFrame, pivot: bool = False) -> DataFrame:
    """(customer_id, offer_id, received_time, viewed_time, completed_time)."""
    # A journey needs a member and an offer (the contract declares both non-null).
    # Stating both here also keeps every plan branch over the journey identical,
    # so Spark reuses one shuffle instead of scanning the events again.
    offer_events = events_processed.filter(F.col("offer_id").isNotNull() & F.col("customer_id").isNotNull()).select(
        "customer_id", "offer_id", "event_type", "event_time_hours"
    )
    if pivot:
        wide = (
            offer_events.groupBy("customer_id", "offer_id")
            .pivot("event_type", [e for e, _ in _STAGES])
            .agg(F.min("event_time_hours"))
        )
        return wide.withColumnsRenamed({e: name for e, name in _STAGES})
    return offer_events.groupBy("customer_id", "offer_id").agg(
        *[F.min(F.when(F.col("event_type") == e, F.col("event_time_hours"))).alias(name) for e, name in _STAGES]
    )


def build_interactions(
    events_processed: DataFrame, offers_enriched: DataFrame, pivot: bool = False, dim_small: bool | None = None
) -> DataFrame:
    """The journey table (contract ``OFFER_INTERACTIONS``).

    ``time_to_*`` is the difference to the receipt (null if either side is
    missing, negative if the order is reversed).  ``completion_within_duration``
    is true when completed within the offer's duration, false when completed
    otherwise (also for unknown offers or an unknown receipt), null when not
    completed.  Unknown offer ids are kept (left join).
    """
    return interactions_from_stage_times(stage_times(events_processed, pivot), offers_enriched, dim_small)


def interactions_from_stage_times(
    stages: DataFrame, offers_enriched: DataFrame, dim_small: bool | None = None
) -> DataFrame:
    """The journey table from (customer_id, offer_id, received_time,
    viewed_time, completed_time) rows -- computed in batch or maintained by
    the incremental job in ``perkspark.streaming``."""
    journey = journeys_from_stage_times(stages)
    durations = offers_enriched.select("offer_id", "duration_hours")
    joined = join_dimension(journey, durations, "offer_id", how="left", small=dim_small, hot=True)
    within = (
        F.when(F.col("is_completed") & (F.col("time_to_complete") <= F.col("duration_hours")), True)
        .when(F.col("is_completed"), False)
        .otherwise(F.lit(None).cast("boolean"))
    )
    return schemas.enforce(joined.withColumn("completion_within_duration", within), schemas.OFFER_INTERACTIONS)


def journeys_from_stage_times(stages: DataFrame) -> DataFrame:
    """Journeys with their flags and times, without the offer's duration; the metrics need no more."""
    rec, view, comp = F.col("received_time"), F.col("viewed_time"), F.col("completed_time")
    return stages.select(
        "customer_id",
        "offer_id",
        "received_time",
        "viewed_time",
        "completed_time",
        rec.isNotNull().alias("is_received"),
        view.isNotNull().alias("is_viewed"),
        comp.isNotNull().alias("is_completed"),
        (view - rec).alias("time_to_view"),
        (comp - rec).alias("time_to_complete"),
    )
