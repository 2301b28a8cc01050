"""Layer runner over CSV sources: tables, views, audit, physical layout."""

import os
import tempfile

import pytest
from conftest import SF_SMALL, rows

from perkspark import schemas
from perkspark.plans.explain import physical_plan
from perkspark.plans.pipeline import LoyaltyPipeline
from perkspark.plans.runner import LayerRunner
from perkspark.sources.csv import load_raw_csv, read_csv, write_csv
from perkspark.sources.fixtures import FIXTURE_AS_OF, FIXTURE_PERIOD_START


def test_csv_doubled_quotes_are_read_back(spark):
    folder = tempfile.mkdtemp(prefix="perkspark-csv-")
    path = os.path.join(folder, "events.csv")
    with open(path, "w") as fh:
        fh.write('customer_id,event,value,time\n')
        fh.write('c1,transaction,"{""amount"": 1.5}",3\n')
        fh.write("c1,offer received,\"{'offer id': 'o1'}\",4\n")
    got = rows(read_csv(spark, path, schemas.RAW_EVENTS), "time", "value")
    assert got == [(3, '{"amount": 1.5}'), (4, "{'offer id': 'o1'}")]


@pytest.fixture(scope="module")
def run_from_csv(spark):
    src = LoyaltyPipeline.from_warehouse(spark, SF_SMALL)
    folder = tempfile.mkdtemp(prefix="perkspark-raw-")
    for name, df in (("customers", src.customers), ("offers", src.offers), ("events", src.events)):
        write_csv(df, os.path.join(folder, f"{name}.csv"))
    customers, offers, events = load_raw_csv(spark, folder)
    pipeline = LoyaltyPipeline(customers, offers, events, as_of=FIXTURE_AS_OF, period_start=FIXTURE_PERIOD_START)
    runner = LayerRunner(spark, pipeline)
    audit = runner.run()
    return src, runner, audit


def test_layers_equal_the_plans(spark, run_from_csv):
    src, runner, _ = run_from_csv
    for table, attr in [
        ("gold.channel_effectiveness", "channel_effectiveness"),
        ("gold.age_distribution_analysis", "age_distribution"),
        ("gold.offer_completion_metrics", "offer_completion_metrics"),
        ("silver.offer_interactions", "offer_interactions"),
    ]:
        stored = spark.table(table)
        plan = getattr(src, attr)
        assert stored.columns == plan.columns
        assert rows(stored, *stored.columns) == rows(plan, *plan.columns), table


def test_views_and_audit(spark, run_from_csv):
    src, runner, audit = run_from_csv
    got = {(r.layer, r.table_name): (r.row_count, r.error) for r in audit.collect()}
    assert got[("gold", "v_channel_performance")] == (src.channel_effectiveness.count(), None)
    assert got[("bronze", "events")][0] == src.events.count()
    assert all(err is None for _, err in got.values())
    v = spark.sql("SELECT * FROM gold.v_offer_summary")
    assert rows(v, *v.columns) == rows(src.v_offer_summary, *v.columns)


def test_bucketed_member_join_needs_no_shuffle(spark, run_from_csv):
    from perkspark.operators.age import age_distribution

    df = age_distribution(spark.table("silver.customers_cleansed"), spark.table("silver.offer_interactions"))
    plan = physical_plan(df)
    assert "hashpartitioning(customer_id" not in plan


def test_offer_csv_with_quoted_channel_list(spark):
    from perkspark.operators.cleanse import enrich_offers

    folder = tempfile.mkdtemp(prefix="perkspark-offers-")
    path = os.path.join(folder, "offers.csv")
    with open(path, "w") as fh:
        fh.write("offer_id,offer_type,difficulty,reward,duration,channels\n")
        fh.write("a1,bogo,10,10,7,\"['email', 'mobile', 'social']\"\n")
        fh.write("a2,informational,0,0,4,\"['web', 'email', 'mobile']\"\n")
    out = enrich_offers(read_csv(spark, path, schemas.RAW_OFFERS))
    got = rows(out, "offer_id", "channels_list", "num_channels", "duration_hours", "roi_ratio")
    assert got == [
        ("a1", ["email", "mobile", "social"], 3, 168, 1.0),
        ("a2", ["web", "email", "mobile"], 3, 96, None),
    ]


def test_audit_reports_an_unreadable_view_and_counts_the_rest(spark, run_from_csv):
    src, runner, _ = run_from_csv
    spark.sql("DROP VIEW gold.v_age_summary")
    try:
        got = {(r.layer, r.table_name): (r.row_count, r.error) for r in runner.audit().collect()}
        count, err = got[("gold", "v_age_summary")]
        assert count is None and err
        assert got[("silver", "offer_interactions")] == (src.offer_interactions.count(), None)
        assert got[("quality", "customers_not_valid")][0] >= 0
    finally:
        runner.create_views()


def test_layout_writes_one_file_per_bucket_and_per_partition_value(spark):
    from pyspark.sql import functions as F

    warehouse = spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")
    runner = LayerRunner(spark, pipeline=None, databases={"bronze": "layout_test"}, buckets=4)
    runner.spark.sql("CREATE DATABASE IF NOT EXISTS layout_test")
    # eight input tasks, each holding rows of every bucket and every day
    df = spark.range(0, 4000, 1, 8).select(
        F.concat(F.lit("c"), (F.col("id") % 97).cast("string")).alias("customer_id"),
        (F.col("id") % 3).alias("day"),
    )

    def parquet_files(name):
        root = os.path.join(warehouse, "layout_test.db", name)
        return sum(len([f for f in fs if f.endswith(".parquet")]) for _, _, fs in os.walk(root))

    runner.write(df, "bronze", "bucketed", bucket_by="customer_id")
    runner.write(df, "bronze", "by_day", partition_by="day", sort_by=("customer_id",))
    assert parquet_files("bucketed") == 4
    assert parquet_files("by_day") == 3
    assert spark.table("layout_test.bucketed").count() == spark.table("layout_test.by_day").count() == 4000
