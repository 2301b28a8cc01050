"""Equi + closed-interval joins without per-key quadratic work.

Open-source Spark plans ``a.k = b.k AND lo <= t AND t <= hi`` as a
sort-merge join on ``k`` with the bounds as a residual: every interval of a
key is compared with every point of that key, all inside one task.  With
one key holding a third of the rows that is quadratic work in one task.

Two skew-proof forms are given here:

``range_join``     emits the matching (point, interval) pairs.  Intervals are
                   exploded over fixed-width bins of the point axis and the
                   join key becomes (key, bin), so one hot key is spread over
                   its bins; each point lies in exactly one bin, so no pair is
                   produced twice.

``interval_sums``  aggregates the points inside each interval (count, sum)
                   without joining the two: points are reduced to one row per
                   (key, position), interval ends become marks between them,
                   one running sum per key passes over both, and an interval's
                   sum is the running sum at its end less that at its start.
                   A key with very many rows is dealt over several running
                   sums: each takes a share of its intervals and all of its
                   positions, which the clock bounds (``hot``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perkspark.functions.numeric import sum_of_parts, sum_parts


def range_join(
    points: DataFrame,
    intervals: DataFrame,
    key: str,
    point_col: str,
    lo_col: str,
    hi_col: str,
    bin_width: int,
    max_bins: int = 1024,
) -> DataFrame:
    """Inner join of points and intervals on ``key`` with ``lo <= point <= hi``.

    ``point_col``, ``lo_col`` and ``hi_col`` must be integral (hours, days,
    epoch seconds ...).  Intervals with ``lo > hi`` match nothing.  Column
    names of both sides must differ except for ``key``.

    Bins are enumerated in chunks of at most ``max_bins`` (two nested
    explodes), so an interval of any length -- say a corrupt end hour near
    2^31 -- never becomes one giant array inside a task; its bin rows
    stream out and spread over the shuffle like any others.
    """
    w = F.lit(bin_width)
    first, last = F.floor(F.col(lo_col) / w), F.floor(F.col(hi_col) / w)
    chunk_start = first + F.col("_chunk") * max_bins
    binned_points = points.withColumn("_bin", F.floor(F.col(point_col) / w))
    binned_intervals = (
        intervals.filter(F.col(lo_col) <= F.col(hi_col))
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((last - first) / max_bins))))
        .withColumn("_bin", F.explode(F.sequence(chunk_start, F.least(last, chunk_start + (max_bins - 1)))))
        .drop("_chunk")
    )
    cond = [
        binned_points[key] == binned_intervals[key],
        binned_points["_bin"] == binned_intervals["_bin"],
        binned_points[point_col] >= binned_intervals[lo_col],
        binned_points[point_col] <= binned_intervals[hi_col],
    ]
    joined = binned_points.join(binned_intervals, cond, "inner")
    out_cols = [binned_points[key]] + [
        binned_points[c] for c in points.columns if c != key
    ] + [binned_intervals[c] for c in intervals.columns if c != key]
    return joined.select(*out_cols)


#: Marks at one position: an interval's start, the points there, an interval's end.
START, POINT, END = 0, 1, 2
_RUNNING = {"n": "bigint", "values": "bigint", "whole": "decimal(38,9)", "rest": "double", "odd": "bigint", "odd_sum": "double"}


def mark(pos: Column, kind: int, interval: Column, sums: dict[str, Column] | None = None) -> Column:
    """A mark of the sweep; ``sums`` are a point's."""
    parts = [F.coalesce((sums or {}).get(c, F.lit(0)).cast(t), F.lit(0).cast(t)).alias(c) for c, t in _RUNNING.items()]
    return F.struct(pos.cast("bigint").alias("pos"), F.lit(kind).alias("kind"), interval.alias("interval"), *parts)


def ends(lo: Column, hi: Column, interval: Column) -> Column:
    """The two marks of an interval that is not empty, else none."""
    return F.when(lo <= hi, F.array(mark(lo, START, interval), mark(hi, END, interval)))


def point_sums(value: Column) -> dict[str, Column]:
    """Aggregates of the points at one position."""
    return {"n": F.count(F.lit(1)), **sum_parts(value)}


def swept(marks: DataFrame, key: str, deal: str | None = None) -> DataFrame:
    """(key, interval, matched, matched_values, value_sum) from rows with a column ``mark``.

    Marks of one key (and one ``deal`` of a key) meet in one running sum; equal
    intervals are one.
    """
    keys = [key, deal] if deal else [key]
    order = Window.partitionBy(*keys).orderBy("mark.pos", "mark.kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = marks.select(*keys, "mark.kind", "mark.interval", *(F.sum(f"mark.{c}").over(order).cast(t).alias(c) for c, t in _RUNNING.items()))
    at_end = F.col("kind") == END
    inside = running.filter(F.col("kind") != POINT).groupBy(*keys, "interval").agg(
        *((F.max(F.when(at_end, F.col(c))) - F.max(F.when(~at_end, F.col(c)))).cast(t).alias(c) for c, t in _RUNNING.items())
    )
    return inside.select(
        key,
        "interval",
        F.col("n").alias("matched"),
        F.col("values").alias("matched_values"),
        sum_of_parts(*(F.col(c) for c in _RUNNING if c != "n")).alias("value_sum"),
    )


def interval_sums(
    points: DataFrame,
    intervals: DataFrame,
    key: str,
    point_col: str,
    value_col: str,
    lo_col: str,
    hi_col: str,
    keep_empty: bool = True,
    hot: DataFrame | None = None,
) -> DataFrame:
    """For each interval: points inside ``[lo, hi]`` of the same key.

    Returns the interval columns plus
      ``matched``        number of points inside (0 when none),
      ``matched_values`` number of non-null values inside,
      ``value_sum``      sum of the values inside (double), null when no
                         non-null value lies inside (SQL ``sum`` semantics).
    ``point_col``, ``lo_col``, ``hi_col`` are integral positions; the
    interval columns must identify an interval (duplicates are merged).
    ``keep_empty=False`` returns only intervals with a point inside.  ``hot``
    (key, deals), as of ``plans.skew.heavy_keys``, spreads heavy keys.

    Sums do not depend on the order of rows: values below 1e19 are added and
    subtracted exactly.  Only the sum of an interval that holds a larger or
    non-finite value is as good as the difference of two sums of doubles.
    """
    keyed = points.filter(F.col(key).isNotNull() & F.col(point_col).isNotNull())
    at = keyed.groupBy(key, F.col(point_col).alias("_pos")).agg(*(c.alias(f"_{n}") for n, c in point_sums(F.col(value_col)).items()))
    columns = [F.col(c) for c in intervals.columns if c != key]
    interval = F.struct(*columns)
    no_interval = F.lit(None).cast(intervals.select(interval.alias("i")).schema["i"].dataType)
    of_points = at.select(key, F.array(mark(F.col("_pos"), POINT, no_interval, {c: F.col(f"_{c}") for c in _RUNNING})).alias("marks"))
    of_intervals = intervals.filter(F.col(key).isNotNull()).select(key, ends(F.col(lo_col), F.col(hi_col), interval).alias("marks"))
    both = dealt_marks(of_points.unionByName(of_intervals), key, hot)
    sums = swept(both, key, "deal")
    found = sums.filter("matched > 0").select(key, *(F.col(f"interval.`{c}`").alias(c) for c in intervals.columns if c != key), "matched", "matched_values", "value_sum")
    measures = ["matched", "matched_values", "value_sum"]
    if not keep_empty:
        return found.select(*intervals.columns, *measures)
    # intervals without any point inside keep a row with zero counts
    back = found.select(*(F.col(c).alias(f"_{c}") for c in intervals.columns), *measures)
    same = [intervals[c].eqNullSafe(back[f"_{c}"]) for c in intervals.columns]
    return intervals.join(back, same, "left").select(
        *(intervals[c] for c in intervals.columns),
        F.coalesce(F.col("matched"), F.lit(0)).cast("bigint").alias("matched"),
        F.coalesce(F.col("matched_values"), F.lit(0)).cast("bigint").alias("matched_values"),
        "value_sum",
    )


def dealt_marks(rows: DataFrame, key: str, hot: DataFrame | None) -> DataFrame:
    """One row per mark of ``rows`` (key, marks), with its ``deal``.

    The points of a key in ``hot`` go to all of its deals, each interval to one.
    """
    if hot is None:
        return rows.select(key, F.lit(0).alias("deal"), F.explode("marks").alias("mark"))
    sized = rows.join(F.broadcast(hot.select(F.col(key).alias("_hot"), "deals")), F.col(key) == F.col("_hot"), "left")
    deals = F.coalesce(F.col("deals"), F.lit(1)).cast("int")
    marked = sized.select(key, deals.alias("deals"), F.explode("marks").alias("mark"))
    every = F.sequence(F.lit(0), F.col("deals") - 1)
    own = F.array(F.pmod(F.xxhash64("mark.interval"), F.col("deals").cast("bigint")).cast("int"))
    return marked.select(key, F.explode(F.when(F.col("mark.kind") == POINT, every).otherwise(own)).alias("deal"), "mark")
