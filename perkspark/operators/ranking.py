"""Ranks and medians over large relations without a window that sees them whole.

``RANGES`` splitters, quantiles of the values, cut the value axis into ranges of
about equally many rows; which range a value lies in is a plain function of the
value, the same in every plan and on every retry.  Ranges are then ordered by a
window over one row a range, and only rows of one range are ordered among
themselves.  How well the splitters are chosen decides only how even the ranges
are, never the result.  Equal values are one row with their number before
anything is ordered, so a value that most rows share is no hot range.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Ranges a relation is cut into, rows of a range beyond which there are more, and the most.
RANGES, RANGE_ROWS, MOST_RANGES = 64, 1_000_000, 4096


def splitters(df: DataFrame, column: str, ranges: int | None = None) -> list[float]:
    """Rising values that cut ``column`` into about equal parts (an approximate quantile job over ``df``)."""
    if ranges is None:
        ranges = min(MOST_RANGES, max(RANGES, -(-df.count() // RANGE_ROWS)))
    if ranges < 2:
        return []
    numbers = df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    cuts = numbers.approxQuantile("v", [k / ranges for k in range(1, ranges)], 0.25 / ranges)
    return sorted({c for c in cuts if abs(c) != float("inf")})


def with_range(df: DataFrame, column: str, cuts: list[float]) -> DataFrame:
    """``df`` with ``range``, rising with ``column``; null for null."""
    number = df.withColumn("_number", F.col(column).cast("double"))
    if not cuts:
        return number.withColumn("range", F.when(F.col("_number").isNotNull(), F.lit(0.0))).drop("_number")
    found = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="_number", outputCol="_range", handleInvalid="keep").transform(number)
    return found.withColumn("range", F.when(F.col("_number").isNotNull(), F.col("_range"))).drop("_number", "_range")


def ranked(df: DataFrame, column: str, rank: str = "rank", cuts: list[float] | None = None) -> DataFrame:
    """``df`` with SQL ``RANK() OVER (ORDER BY column DESC NULLS LAST)``.

    Values are counted, and the counts of the ranges above and of the larger values
    in a value's own range are added.  Rows get the rank back by a join on the
    value, which Spark may split where a value is hot.
    """
    cuts = splitters(df, column) if cuts is None else cuts
    values = with_range(df.groupBy(F.col(column).alias("_value")).agg(F.count(F.lit(1)).alias("_n")), "_value", cuts)
    above = Window.orderBy(F.col("range").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    ranges = values.groupBy("range").agg(F.sum("_n").alias("_all"))  # at most MOST_RANGES rows and one for null
    ranges = ranges.select(F.col("range").alias("_range"), F.coalesce(F.sum("_all").over(above), F.lit(0)).alias("_above"))
    larger = Window.partitionBy("range").orderBy(F.col("_value").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(larger), F.lit(0))
    inside = values.withColumn("_before", before).join(F.broadcast(ranges), F.col("range").eqNullSafe(F.col("_range")))
    ranks = inside.select("_value", (F.col("_above") + F.col("_before") + 1).cast("bigint").alias(rank))
    return df.join(ranks, F.col(column).eqNullSafe(F.col("_value"))).drop("_value")


def medians(counts: DataFrame, group: str, value: str, n: str, cuts: list[float]) -> DataFrame:
    """(group, median, rows): the exact discrete median of ``value`` (null without one) and the number of rows.

    ``counts`` has ``n`` rows for each (group, value).  One window per group runs over
    its ranges, and one over its values in the range that holds the median.
    """
    counts = with_range(counts.select(F.col(group).alias("_group"), F.col(value).alias("_value"), F.col(n).alias("_n")), "_value", cuts)
    of_group = Window.partitionBy("_group")
    known = F.when(F.col("range").isNotNull(), F.col("_n")).otherwise(0)
    ranges = counts.groupBy("_group", "range").agg(F.sum("_n").alias("_n"))
    ranges = (
        ranges.withColumn("_rows", F.sum("_n").over(of_group))
        .withColumn("_known", F.sum(known).over(of_group))
        .withColumn("_reached", F.sum(known).over(of_group.orderBy(F.col("range").asc_nulls_last())))
    )
    # the first range in which half of the values are reached; the null range for groups without a value
    half = (2 * F.col("_reached") >= F.col("_known")) & (2 * (F.col("_reached") - F.col("_n")) < F.col("_known"))
    chosen = ranges.filter((F.col("range").isNotNull() & half) | (F.col("range").isNull() & (F.col("_known") == 0)))
    chosen = chosen.select(F.col("_group").alias("_g"), F.col("range").alias("_r"), (F.col("_reached") - F.col("_n")).alias("_before"), "_known", "_rows")
    inside = counts.join(chosen, F.col("_group").eqNullSafe(F.col("_g")) & F.col("range").eqNullSafe(F.col("_r")))
    reached = F.col("_before") + F.sum("_n").over(of_group.orderBy("_value"))
    return (
        inside.withColumn("_reached", reached)
        .groupBy("_group")
        .agg(F.min(F.when(2 * F.col("_reached") >= F.col("_known"), F.col("_value"))).alias("median"), F.first("_rows").alias("rows"))
        .withColumnRenamed("_group", group)
    )
