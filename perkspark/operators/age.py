"""Age profile of members who complete offers (question 2).

Two aggregations: journeys -> one row per member (partial aggregation,
shuffle on customer_id), then members -> (age_group, status).  The member
join is key-unique on both sides, so no key can fan out; the last
aggregate has at most 7 x 2 groups and the share-of-status window runs on
those few rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perkspark import schemas
from perkspark.constants import FLAG_VALID, STATUS_COMPLETED, STATUS_NOT_COMPLETED
from perkspark.functions.numeric import exact_mean


def customer_offer_status(interactions: DataFrame) -> DataFrame:
    """(customer_id, offers_completed, offers_received, completion_status) over received journeys."""
    return (
        interactions.filter(F.col("is_received"))
        .groupBy("customer_id")
        .agg(
            F.count_if("is_completed").alias("offers_completed"),
            F.count(F.lit(1)).alias("offers_received"),
        )
        .withColumn(
            "completion_status",
            F.when(F.col("offers_completed") > 0, STATUS_COMPLETED).otherwise(STATUS_NOT_COMPLETED),
        )
    )


def age_distribution(customers_cleansed: DataFrame, interactions: DataFrame) -> DataFrame:
    """(age_group, completion_status) -> members, share within status, mean income and offers."""
    valid = customers_cleansed.filter(F.col("data_quality_flag") == FLAG_VALID).select(
        "customer_id", "age_group", "income"
    )
    members = valid.join(customer_offer_status(interactions), "customer_id", "inner")
    grouped = members.groupBy("age_group", "completion_status").agg(
        F.count(F.lit(1)).alias("customer_count"),
        exact_mean("income").alias("avg_income"),
        F.round(F.avg("offers_received"), 2).alias("avg_offers_received"),
    )
    in_status = Window.partitionBy("completion_status")
    out = grouped.withColumn(
        "percentage",
        F.round(F.col("customer_count") / F.sum("customer_count").over(in_status) * 100, 2),
    )
    return schemas.enforce(out, schemas.AGE_DISTRIBUTION)
