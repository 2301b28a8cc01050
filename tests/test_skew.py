"""A member holding a third of all events: results still equal the oracle.

The skewed copy of the warehouse ``events`` table is derived in both
engines by the same rule (every third event belongs to user 0); the other
tables are the sf0.01 ones.
"""

import os
import tempfile

import pytest

from oracle_check import compare, duck_connection
from perkspark.oracle.queries import ORACLE_SQL
from perkspark.plans.registry import QUERIES

SRC = "/root/testdata/sf0.01"
NAMES = [
    "offer_interactions",
    "channel_revenue",
    "channel_effectiveness",
    "age_distribution",
    "offer_completion_metrics",
]


@pytest.fixture(scope="module")
def skewed_dir(spark):
    from pyspark.sql import functions as F

    folder = tempfile.mkdtemp(prefix="perkspark-skew-")
    events = spark.read.parquet(os.path.join(SRC, "events.parquet"))
    skewed = events.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    skewed.write.parquet(os.path.join(folder, "events.parquet"))
    for name in os.listdir(SRC):
        if name != "events.parquet":
            os.symlink(os.path.join(SRC, name), os.path.join(folder, name))
    return folder


@pytest.mark.parametrize("name", NAMES)
def test_hot_member_matches_oracle(spark, skewed_dir, name):
    con = duck_connection(skewed_dir)
    hot = con.sql("SELECT COUNT(*) FILTER (WHERE user_id = 0) * 1.0 / COUNT(*) FROM events").fetchall()[0][0]
    assert hot > 0.33
    res = compare(QUERIES[name](spark, skewed_dir), ORACLE_SQL[name], con)
    assert res["match"], res


@pytest.mark.parametrize("name", ["channel_revenue", "channel_effectiveness"])
def test_hot_member_dealt_over_several_sweeps(spark, skewed_dir, name):
    spark.conf.set("perkspark.skew.heavyRows", "500")
    try:
        res = compare(QUERIES[name](spark, skewed_dir), ORACLE_SQL[name], duck_connection(skewed_dir))
    finally:
        spark.conf.unset("perkspark.skew.heavyRows")
    assert res["match"], res


@pytest.fixture(scope="module")
def skewed_orders_dir(spark):
    """Every third order belongs to customer 1 (a third of all orders)."""
    from pyspark.sql import functions as F

    folder = tempfile.mkdtemp(prefix="perkspark-skew-orders-")
    orders = spark.read.parquet(os.path.join(SRC, "orders.parquet"))
    skewed = orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("o_custkey")))
    skewed.write.parquet(os.path.join(folder, "orders.parquet"))
    for name in os.listdir(SRC):
        if name != "orders.parquet":
            os.symlink(os.path.join(SRC, name), os.path.join(folder, name))
    return folder


@pytest.mark.parametrize("name", ["tpch_orders_in_customer_interval", "tpch_segment_conditional_sums", "tpch_priority_pivot"])
def test_hot_customer_matches_oracle(spark, skewed_orders_dir, name):
    con = duck_connection(skewed_orders_dir)
    hot = con.sql("SELECT COUNT(*) FILTER (WHERE o_custkey = 1) * 1.0 / COUNT(*) FROM orders").fetchall()[0][0]
    assert hot > 0.33
    res = compare(QUERIES[name](spark, skewed_orders_dir), ORACLE_SQL[name], con)
    assert res["match"], res
