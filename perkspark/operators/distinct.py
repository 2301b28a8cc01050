"""Exact distinct counts as bitmaps, which merge by OR.

Values are long numbers.  A bitmap holds the values of one bucket of 32,768
numbers, so a group's values are a few bitmaps where its numbers lie close
together, built in the tasks before anything is shuffled.  Bitmaps of groups can be
OR-ed into larger groups at any time; the distinct count is the number of bits.

``numbered`` gives any values such numbers: the distinct values of a partition, in
order, get successive ones.  They depend on the values alone, so a retried task
gives the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perkspark.plans.broadcast import join_dimension
from perkspark.plans.stored import stored


def numbered(df: DataFrame, column: str, number: str = "number") -> DataFrame:
    """(column, number): each non-null value once, numbered closely within a partition."""
    values = df.select(column).filter(F.col(column).isNotNull()).distinct().sortWithinPartitions(column)
    return values.withColumn(number, F.monotonically_increasing_id())


def bitmap(number: Column, condition: Column | None = None) -> Column:
    """Aggregate: the bitmap of the numbers, all of one ``bitmap_bucket_number``, whose rows fulfil ``condition``."""
    position = F.bitmap_bit_position(number)
    return F.bitmap_construct_agg(position if condition is None else F.when(condition, position))


def bits(merged: Column) -> Column:
    """Aggregate over a group's buckets: distinct numbers."""
    return F.sum(F.bitmap_count(merged)).cast("bigint")


def distinct_counts(df: DataFrame, group: str, columns: dict[str, str]) -> DataFrame:
    """(group, a count for each entry of ``columns``: name -> long column), from one scan; nulls do not count."""
    each = F.array(*(F.struct(F.lit(name).alias("name"), F.col(c).cast("bigint").alias("number")) for name, c in columns.items()))
    values = df.select(F.col(group), F.explode(each).alias("of")).select(group, "of.name", "of.number")
    maps = values.groupBy(group, "name", F.bitmap_bucket_number("number").alias("bucket")).agg(bitmap(F.col("number")).alias("map"))
    return maps.groupBy(group).agg(*(bits(F.when(F.col("name") == name, F.col("map"))).alias(name) for name in columns))


#: Stages of a journey whose members ``channel_reach`` counts, and their flags.
REACHED = {"customers_received": "is_received", "customers_viewed": "is_viewed", "customers_completed": "is_completed"}


def reach_bitmaps(journeys: DataFrame, offers_enriched: DataFrame, dim_small: bool | None = None) -> DataFrame:
    """(channels_list, bucket, a bitmap of members for each stage): mergeable, a few rows however many journeys.

    Offers with the same channels share their bitmaps, since their members are
    only ever asked for by channel.  The journeys are computed once: what is left of
    them is stored, for the numbers and for the bitmaps.
    """
    of_offer = offers_enriched.select("offer_id", "channels_list")
    rows = join_dimension(journeys.select("customer_id", "offer_id", *REACHED.values()), of_offer, "offer_id", small=dim_small, hot=True)
    # a member once for each list of channels before the members are numbered
    once = stored(rows.groupBy("channels_list", "customer_id").agg(*(F.bool_or(flag).alias(flag) for flag in REACHED.values())), "reached")
    members = numbered(once, "customer_id")
    number = F.col("number")
    return (
        once.join(members, "customer_id")
        .groupBy("channels_list", F.bitmap_bucket_number(number).alias("bucket"))
        .agg(*(bitmap(number, F.col(flag)).alias(name) for name, flag in REACHED.items()))
    )


def channel_reach(journeys: DataFrame, offers_enriched: DataFrame, dim_small: bool | None = None) -> DataFrame:
    """(channel, distinct members who received, viewed and completed an offer sent on it)."""
    maps = reach_bitmaps(journeys, offers_enriched, dim_small)
    fanned = maps.select(F.explode("channels_list").alias("channel"), "bucket", *REACHED).filter(F.length("channel") > 0)
    merged = fanned.groupBy("channel", "bucket").agg(*(F.bitmap_or_agg(name).alias(name) for name in REACHED))
    return merged.groupBy("channel").agg(*(bits(F.col(name)).alias(name) for name in REACHED))
