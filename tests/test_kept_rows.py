"""Nothing is dropped, rounded or aborted: odd channels, huge numbers, odd files, lost tables."""

import os
import tempfile

import pytest
from conftest import rows

from perkspark import schemas
from perkspark.functions.numeric import exact_mean, exact_sum
from perkspark.operators import reports
from perkspark.plans.pipeline import LoyaltyPipeline
from perkspark.plans.runner import LayerRunner
from perkspark.sources.csv import bad_cells, read_csv

HUGE = "9" * 40


@pytest.fixture
def pipeline(spark):
    customers = [("c1", 20200101, "F", 30, 50000.0), ("c2", 20200101, "M", 40, 1e30)]
    offers = [("o1", "bogo", 5, 5, 7, "['sms', 'email']"), ("o2", "bogo", 5, 5, 7, ""), ("o3", "discount", 5, 2, 7, "['web']")]
    events = []
    for c in ("c1", "c2"):
        for i, o in enumerate(("o1", "o2", "o3")):
            events += [(c, "offer received", f"{{'offer id': '{o}'}}", i), (c, "offer completed", f"{{'offer_id': '{o}', 'reward': 5}}", i + 10)]
        events.append((c, "transaction", '{"amount": 12.5}' if c == "c1" else f'{{"amount": {HUGE}}}', 5))
    return LoyaltyPipeline(
        spark.createDataFrame(customers, schemas.RAW_CUSTOMERS),
        spark.createDataFrame(offers, schemas.RAW_OFFERS),
        spark.createDataFrame(events, schemas.RAW_EVENTS),
    )


def test_every_channel_stays(pipeline):
    metrics = pipeline.offer_completion_metrics
    assert rows(metrics, "offer_type", "channel", "total_completions") == [
        ("bogo", "", 2), ("bogo", "email", 2), ("bogo", "sms", 2), ("discount", "web", 2),
    ]
    matrix = reports.offer_channel_matrix(metrics, "completion_rate")
    assert sorted(matrix.columns) == ["email", "offer_type", "sms", "unnamed", "web"]
    assert {r["offer_type"]: r["unnamed"] for r in matrix.collect()} == {"bogo": 100.0, "discount": None}
    assert [r["channel"] for r in pipeline.channel_effectiveness.orderBy("channel").collect()] == ["email", "sms", "web"]


def test_huge_numbers_abort_nothing(pipeline):
    revenue = {r["channel"]: r["total_revenue_generated"] for r in pipeline.channel_effectiveness.collect()}
    assert revenue["sms"] == pytest.approx(float(HUGE) + 12.5)
    income = [r["avg_income"] for r in pipeline.age_distribution.collect()]
    assert max(income) == 1e30


def test_exact_sums(spark):
    df = spark.createDataFrame([(1, 0.1), (1, 0.2), (1, 1e-12), (2, 1e300), (2, float("inf")), (3, None)], "k int, x double")
    got = {r["k"]: (r["s"], r["m"]) for r in df.groupBy("k").agg(exact_sum("x").alias("s"), exact_mean("x").alias("m")).collect()}
    assert got[1][0] == pytest.approx(0.3 + 1e-12, abs=1e-15)
    assert got[2][0] == float("inf") and got[3] == (None, None)


def test_csv_by_header_name(spark):
    folder = tempfile.mkdtemp(prefix="perkspark-csv-")
    path = os.path.join(folder, "events.csv")
    with open(path, "w") as fh:
        fh.write("time,customer_id,event,value\n4.0,c1,transaction,a\nabc,c2,transaction,b\n4.5,c3,transaction,c\n,c4,transaction,d\n")
    got = rows(read_csv(spark, path, schemas.RAW_EVENTS), "customer_id", "time", "value")
    assert got == [("c1", 4, "a"), ("c2", None, "b"), ("c3", None, "c"), ("c4", None, "d")]
    assert {r["column"]: r["bad"] for r in bad_cells(spark, path, schemas.RAW_EVENTS).collect()} == {"customer_id": 0, "event": 0, "value": 0, "time": 2}
    with open(os.path.join(folder, "short.csv"), "w") as fh:
        fh.write("time,customer_id\n1,c1\n")
    with pytest.raises(ValueError, match="event, value"):
        read_csv(spark, os.path.join(folder, "short.csv"), schemas.RAW_EVENTS)


def test_audit_reports_a_lost_table(spark, pipeline):
    runner = LayerRunner(spark, pipeline, databases={"bronze": "lost_bronze", "silver": "lost_silver", "gold": "lost_gold"})
    audit = {r["table_name"]: r for r in runner.run().collect()}
    assert audit["offer_events_unparsed"]["row_count"] == 0 and audit["customers_not_valid"]["error"] is None
    spark.sql("DROP TABLE lost_silver.customers_cleansed")
    again = {r["table_name"]: r for r in runner.audit().collect()}
    assert again["customers_not_valid"]["row_count"] is None and again["customers_not_valid"]["error"]
    assert again["events_processed"]["row_count"] == audit["events_processed"]["row_count"]
