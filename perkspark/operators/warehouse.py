"""The engine's operators at warehouse size (orders, lineitem, part, customer).

The loyalty tables are small by nature (a few offers, a month of events);
these queries run the same operator shapes -- conditional sums and means
over a fact-dimension join, an equi + range join, count-distincts next to
plain aggregates, an exact median over a join, a pivot of minima,
share-of-partition and rank windows, a rank over all customers -- over the big tables.

Plan shape: facts are reduced to one row per join key (partial
aggregation) before they meet a dimension whose size grows with the data
(customers), so the shuffle carries keys, not facts.  Money is summed by
``exact_sum``, which does not depend on the order of rows and fails on no amount.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perkspark.functions.numeric import exact_sum, exact_sum_over
from perkspark.operators.distinct import distinct_counts
from perkspark.operators.ranking import medians, ranked, splitters
from perkspark.plans.broadcast import join_dimension
from perkspark.plans.stored import stored

# --- fixed values: TPC-H order priorities and their column names ------------
PRIORITIES = (
    ("1-URGENT", "urgent"),
    ("2-HIGH", "high"),
    ("3-MEDIUM", "medium"),
    ("4-NOT SPECIFIED", "not_specified"),
    ("5-LOW", "low"),
)


def orders_per_customer(orders: DataFrame) -> DataFrame:
    """One row per customer key: order count, finished orders, money sums."""
    finished = F.col("o_orderstatus") == "F"
    return orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.count_if(finished).alias("n_finished"),
        exact_sum(F.when(finished, F.col("o_totalprice"))).alias("finished_price"),
        exact_sum("o_totalprice").alias("total_price"),
    )


def segment_conditional_sums(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """Per market segment: orders, finished orders (count-if), mean price of
    finished orders (conditional mean), total price, finished share."""
    per_cust = orders_per_customer(orders)
    joined = per_cust.join(customer.select("c_custkey", "c_mktsegment"), per_cust.o_custkey == F.col("c_custkey"))
    agg = joined.groupBy("c_mktsegment").agg(
        F.sum("n_orders").alias("orders"),
        F.sum("n_finished").alias("finished_orders"),
        exact_sum("finished_price").alias("_fp"),
        exact_sum("total_price").alias("_tp"),
    )
    return agg.select(
        "c_mktsegment",
        "orders",
        "finished_orders",
        F.round(F.try_divide(F.col("_fp"), F.col("finished_orders")), 2).alias("avg_finished_price"),
        F.round("_tp", 2).alias("total_price"),
        F.round(F.col("finished_orders") / F.col("orders") * 100, 2).alias("finished_share"),
    )


def orders_in_customer_interval(orders: DataFrame, days: int = 365) -> DataFrame:
    """Per customer: orders dated within [first order, first order + ``days``]
    (both ends inclusive) and their total price -- an equi + range join whose
    interval starts at the customer's own first row, so that it needs no join.

    Orders are first collapsed to one row per (customer, day) by partial
    aggregation, so a customer holding a third of all orders has at most a row for
    each day of the calendar in the window that finds the first day.
    """
    day = F.datediff(F.col("o_orderdate"), F.lit("1970-01-01").cast("date"))
    per_day = orders.filter(F.col("o_custkey").isNotNull()).groupBy(F.col("o_custkey"), day.alias("order_day")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        exact_sum("o_totalprice").alias("price"),
    )
    dated = per_day.withColumn("first_day", F.min("order_day").over(Window.partitionBy("o_custkey")))
    return dated.filter(F.col("order_day") <= F.col("first_day") + days).groupBy("o_custkey", "first_day").agg(
        F.sum("n_orders").alias("orders_first_year"),
        F.round(exact_sum("price"), 2).alias("revenue_first_year"),
    ).select(
        "o_custkey",
        F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.col("first_day")), "yyyy-MM-dd").alias(
            "first_order_date"
        ),
        "orders_first_year",
        "revenue_first_year",
    )


def lines_sum_distinct(lineitem: DataFrame) -> DataFrame:
    """Per return flag: lines, mean quantity, two exact distinct counts, and
    the sample standard deviation of the price.

    Both distinct counts come from one scan, as bitmaps (``operators.distinct``);
    the plain aggregates are a branch of their own, since a deviation cannot be put
    together from parts without loss.  The branches read different columns and are
    joined on the flag (a few rows each).
    """
    flag = "l_returnflag"
    plain = lineitem.groupBy(flag).agg(
        F.count(F.lit(1)).alias("line_count"),
        F.round(F.try_divide(exact_sum("l_quantity"), F.count("l_quantity")), 2).alias("avg_quantity"),
        F.round(F.stddev_samp("l_extendedprice"), 2).alias("price_stddev"),
    )
    counts = distinct_counts(lineitem, flag, {"distinct_orders": "l_orderkey", "distinct_suppliers": "l_suppkey"})
    counts = counts.withColumnRenamed(flag, "_flag")
    # null-safe: a null flag is a group of its own in both branches
    joined = plain.join(counts, plain[flag].eqNullSafe(counts["_flag"]), "left")
    return joined.fillna(0, ["distinct_orders", "distinct_suppliers"]).select(
        flag, "line_count", "avg_quantity", "distinct_orders", "distinct_suppliers", "price_stddev"
    )


def median_price_by_brand(lineitem: DataFrame, part: DataFrame, ranges: int | None = None) -> DataFrame:
    """Per part brand: exact discrete median line price and line count.

    Lines are counted per (brand, price), and the median is found among the counts
    of price ranges and then among the prices of one range (``operators.ranking``).
    """
    lines = lineitem.select("l_partkey", "l_extendedprice")
    brands = part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    counts = (
        join_dimension(lines, brands, "l_partkey", hot=True, plain=True)
        .groupBy("p_brand", F.col("l_extendedprice").alias("price"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    found = medians(counts, "p_brand", "price", "n", splitters(lineitem, "l_extendedprice", ranges))
    return found.select("p_brand", F.col("median").alias("median_price"), F.col("rows").alias("line_count"))


def customers_ranked_by_revenue(orders: DataFrame, ranges: int | None = None) -> DataFrame:
    """(o_custkey, revenue, revenue_rank) of every customer with orders; ties share a rank, null revenue is last.

    The sums are stored once, as both the splitters and the ranks read them.
    """
    sums = orders.groupBy("o_custkey").agg(exact_sum("o_totalprice").alias("revenue"))
    sums = stored(sums, "customer-revenue")
    return ranked(sums, "revenue", "revenue_rank", splitters(sums, "revenue", ranges)).select(
        "o_custkey", F.round("revenue", 2).alias("revenue"), "revenue_rank"
    )


def priority_pivot(orders: DataFrame, pivot: bool = False) -> DataFrame:
    """Per customer: first order date for each priority (null if none).

    Default: one conditional ``min`` per priority, one shuffle.  ``pivot=True``
    uses ``groupBy().pivot()`` (same rows, two aggregation phases).
    """
    if pivot:
        wide = orders.groupBy("o_custkey").pivot("o_orderpriority", [p for p, _ in PRIORITIES]).agg(
            F.min("o_orderdate")
        )
        cols = [F.col(f"`{p}`").alias(f"first_{name}") for p, name in PRIORITIES]
        out = wide.select("o_custkey", *cols)
    else:
        prio = F.col("o_orderpriority")
        out = orders.groupBy("o_custkey").agg(
            *[F.min(F.when(prio == p, F.col("o_orderdate"))).alias(f"first_{name}") for p, name in PRIORITIES]
        )
    return out.select(
        "o_custkey", *[F.date_format(f"first_{name}", "yyyy-MM-dd").alias(f"first_{name}") for _, name in PRIORITIES]
    )


def share_and_rank(customer: DataFrame, orders: DataFrame, nation: DataFrame) -> DataFrame:
    """Per (segment, nation): revenue, its share of the segment, the nation's
    rank within the segment (ties share a rank)."""
    per_cust = orders_per_customer(orders).select("o_custkey", "total_price")
    joined = per_cust.join(
        customer.select("c_custkey", "c_mktsegment", "c_nationkey"), per_cust.o_custkey == F.col("c_custkey")
    )
    per_nation = joined.groupBy("c_mktsegment", "c_nationkey").agg(exact_sum("total_price").alias("revenue"))
    seg = Window.partitionBy("c_mktsegment")
    ranked = per_nation.select(
        "c_mktsegment",
        "c_nationkey",
        F.round("revenue", 2).alias("revenue"),
        F.round(F.try_divide(F.col("revenue"), exact_sum_over("revenue", seg)) * 100, 2).alias("revenue_share"),
        F.rank().over(seg.orderBy(F.col("revenue").desc())).alias("nation_rank"),
    )
    names = nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return join_dimension(ranked, names, "c_nationkey", how="left")
