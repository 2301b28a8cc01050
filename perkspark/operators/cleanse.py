"""Cleansed layer: members, offers and parsed events (narrow, no shuffle).

Each function is a pure ``DataFrame -> DataFrame`` plan ending in the
layer's schema contract.  All three are row-local (Project/Filter only), so
they stream through one stage and keep the input partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perkspark import schemas
from perkspark.constants import DEFAULT_AS_OF, DEFAULT_PERIOD_START
from perkspark.functions import buckets, parsing


def cleanse_customers(customers: DataFrame, as_of: str = DEFAULT_AS_OF) -> DataFrame:
    """Members with membership date, age / income buckets and a quality flag.

    No row is dropped.  A malformed ``yyyymmdd`` gives a null date (and a
    null duration) instead of failing the job; ``as_of`` fixes the day the
    membership duration is measured on, so reruns give the same table.
    """
    age, income, gender = F.col("age"), F.col("income"), F.col("gender")
    membership_date = F.try_to_date(F.col("became_member_on").cast("string"), "yyyyMMdd")
    df = customers.select(
        "customer_id",
        membership_date.alias("membership_date"),
        "gender",
        "age",
        buckets.age_group(age).alias("age_group"),
        "income",
        buckets.income_bracket(income).alias("income_bracket"),
        F.datediff(F.lit(as_of).cast("date"), membership_date).alias("membership_duration_days"),
        buckets.quality_flag(age, income, gender).alias("data_quality_flag"),
    )
    return schemas.enforce(df, schemas.CUSTOMERS_CLEANSED)


def enrich_offers(offers: DataFrame) -> DataFrame:
    """Offers with the channel list as an array, its size and the reward ratio."""
    channels = parsing.channels_array(F.col("channels"))
    difficulty = F.col("difficulty")
    df = (
        offers.withColumn("channels_list", channels)
        .withColumn("num_channels", F.size("channels_list"))
        .select(
            "offer_id",
            "offer_type",
            "difficulty",
            "reward",
            "duration",
            (F.col("duration") * 24).alias("duration_hours"),
            "channels_list",
            "num_channels",
            (F.col("num_channels") > 1).alias("is_multichannel"),
            F.when(difficulty > 0, F.col("reward") / difficulty).alias("roi_ratio"),
        )
    )
    return schemas.enforce(df, schemas.OFFERS_ENRICHED)


def parse_events(
    events: DataFrame,
    period_start: str = DEFAULT_PERIOD_START,
    strict_quotes: bool = False,
) -> DataFrame:
    """Typed events: offer id, amounts and the event clock as a timestamp.

    * ``event_id`` = customer, event and hour joined by ``_``; it is not
      unique (two offers received in one hour share it).
    * an offer event whose text does not parse gets a null offer id.
    * ``event_timestamp`` = ``period_start`` + ``time`` hours.
    """
    event, value = F.col("event"), F.col("value")
    # Regex captures in their own projection: each pattern then runs once per
    # row (``nullif`` reads its argument twice, and Catalyst does not inline
    # a non-trivial expression that is read twice).
    captured = events.select(
        "customer_id",
        "event",
        "time",
        parsing.offer_id_text(event, value).alias("_offer_text"),
        parsing.amount_text(event, value, strict_quotes).alias("_amount_text"),
        parsing.reward_text(event, value, strict_quotes).alias("_reward_text"),
    )
    ts = F.timestamp_add("HOUR", F.col("time"), F.lit(period_start).cast("timestamp_ntz"))
    df = captured.select(
        F.concat_ws("_", "customer_id", "event", "time").alias("event_id"),
        "customer_id",
        F.col("event").alias("event_type"),
        parsing.non_empty("_offer_text").alias("offer_id"),
        parsing.number_or_null("_amount_text").alias("transaction_amount"),
        parsing.number_or_null("_reward_text").alias("reward_amount"),
        F.col("time").alias("event_time_hours"),
        ts.alias("event_timestamp"),
        F.to_date(ts).alias("event_date"),
    )
    return schemas.enforce(df, schemas.EVENTS_PROCESSED)
