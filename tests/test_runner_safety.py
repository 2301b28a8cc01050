"""Overwrites that fail, rejected CSV rows, line breaks in quotes, nulls against the contract, audits without scans."""

import os
import re
import tempfile

import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from perkspark import schemas
from perkspark.plans.explain import physical_plan
from perkspark.plans.pipeline import LoyaltyPipeline
from perkspark.plans.registry import QUERIES
from perkspark.plans.runner import LayerRunner
from perkspark.sources.csv import CsvFiles, as_csv_lines, from_csv_lines, raw_csv_files, read_csv


@pytest.fixture(scope="module")
def runner(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS safety")
    return LayerRunner(spark, pipeline=None, databases={"bronze": "safety"}, buckets=2)


def numbers(spark, n, fail_at=None):
    df = spark.range(0, n, 1, 4).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("customer_id"), "id")
    if fail_at is None:
        return df
    return df.withColumn("id", F.when(F.col("id") == fail_at, F.raise_error(F.lit("half-way"))).otherwise(F.col("id")))


@pytest.mark.parametrize("layout", [{}, {"bucket_by": "customer_id"}, {"partition_by": "part"}])
def test_a_failed_overwrite_leaves_the_old_table(spark, runner, layout):
    name = f"t{len(layout)}{''.join(layout)}"
    with_part = lambda df: df.withColumn("part", F.length("customer_id"))
    runner.write(with_part(numbers(spark, 100)), "bronze", name, **layout)
    with pytest.raises(Exception, match="half-way"):
        runner.write(with_part(numbers(spark, 5000, fail_at=4321)), "bronze", name, **layout)
    assert spark.table(f"safety.{name}").count() == 100 and not spark.catalog.tableExists(f"safety.{name}__staging")
    stored = runner.write(with_part(numbers(spark, 70)), "bronze", name, **layout)
    assert stored.count() == 70 and not spark.catalog.tableExists(f"safety.{name}__previous")
    assert runner.observed["bronze", name] == {"rows": 70}


def test_a_table_may_be_overwritten_from_itself(spark, runner):
    runner.write(numbers(spark, 30), "bronze", "itself")
    assert runner.write(spark.table("safety.itself").filter("id < 7"), "bronze", "itself").count() == 7


def test_a_swap_broken_off_between_its_renames_is_put_back(spark, runner):
    runner.write(numbers(spark, 9), "bronze", "broken")
    spark.sql("ALTER TABLE safety.broken RENAME TO safety.broken__previous")
    with pytest.raises(Exception, match="half-way"):
        runner.write(numbers(spark, 50, fail_at=3), "bronze", "broken")
    assert spark.table("safety.broken").count() == 9


EVENTS = """time,customer_id,event,value
1,c1,offer received,"{'offer id': 'o1'}"
4.0,c1,transaction,"{""amount"": 2.5}"
soon,c2,transaction,"{""amount"": 1}"
7,c3
8,c4,transaction,"{""amount"": 3}",extra
,,transaction,"{""amount"": 4}"
"""


def write(folder, name, text):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)
    return path


def test_rejects_have_file_columns_and_text(spark):
    folder = tempfile.mkdtemp(prefix="perkspark-rejects-")
    write(folder, "events/a.csv", EVENTS)
    write(folder, "events/b.csv", EVENTS.split("\n")[0] + "\nlate,c9,transaction,x\n")
    files = CsvFiles(spark, os.path.join(folder, "events"), schemas.RAW_EVENTS)
    assert files.rows().count() == 7  # nothing is dropped
    got = {(os.path.basename(r["file"]), tuple(r["columns"]), r["line"]) for r in files.rejects().collect()}
    assert got == {
        ("a.csv", ("time",), 'soon,c2,transaction,"{""amount"": 1}"'),
        ("a.csv", (), "7,c3"),
        ("a.csv", (), '8,c4,transaction,"{""amount"": 3}",extra'),
        ("b.csv", ("time",), "late,c9,transaction,x"),
    }


def test_line_breaks_inside_quotes_are_found_and_read(spark):
    folder = tempfile.mkdtemp(prefix="perkspark-breaks-")
    write(folder, "events/a.csv", 'customer_id,event,time,value\nc1,transaction,1,"{""amount"":\n 2.5}"\nc2,transaction,2,"{""amount"": 1}"\n')
    write(folder, "events/b.csv", "customer_id,event,time,value\nc3,transaction,3,plain\n")
    got = rows(read_csv(spark, os.path.join(folder, "events"), schemas.RAW_EVENTS), "customer_id", "time", "value")
    assert got == [("c1", 1, '{"amount":\n 2.5}'), ("c2", 2, '{"amount": 1}'), ("c3", 3, "plain")]
    split = read_csv(spark, os.path.join(folder, "events"), schemas.RAW_EVENTS, multiline=False)
    assert split.count() == 4


def test_audit_shows_rejects_by_file_and_nulls_by_contract(spark):
    folder = tempfile.mkdtemp(prefix="perkspark-audit-")
    write(folder, "events.csv", EVENTS)
    write(folder, "offers.csv", "offer_id,offer_type,difficulty,reward,duration,channels\no1,bogo,5,5,7,['web']\n")
    write(folder, "customers.csv", "customer_id,became_member_on,gender,age,income\nc1,20170101,F,30,50000\n,20170101,M,40,1\n")
    files = raw_csv_files(spark, folder)
    pipeline = LoyaltyPipeline(*(files[n].rows() for n in ("customers", "offers", "events")))
    names = {layer: f"audit_{layer}" for layer in ("bronze", "silver", "gold")}
    runner = LayerRunner(spark, pipeline, names, csv_files=files)
    audit = {(r["layer"], os.path.basename(r["table_name"])): (r["row_count"], r["error"]) for r in runner.run().collect()}
    assert audit["rejects", "events.csv"] == (3, None) and audit["rejects", "offers.csv"] == audit["rejects", "customers.csv"] == (0, None)
    assert audit["bronze", "rejects"] == (3, None) and audit["bronze", "events"] == (6, None)
    assert audit["contract", "customers.customer_id"] == (1, None) and audit["contract", "events.time"] == (2, None)
    assert audit["contract", "customers_cleansed"] == (1, None) and audit["contract", "offers"] == (0, None)
    assert audit["contract", "events.customer_id"] == (1, None) and ("contract", "offers.offer_id") not in audit
    # the counts are those observed while writing: nothing is scanned again
    spark.sql("INSERT INTO audit_bronze.offers SELECT * FROM audit_bronze.offers")
    again = {(r["layer"], r["table_name"]): r["row_count"] for r in runner.audit().collect()}
    assert again["bronze", "offers"] == 1 and spark.table("audit_bronze.offers").count() == 2


def test_csv_lines_keep_every_value(spark):
    data = [("a,b", 1.5, None), ('say ""x""', -0.0, "2024-01-02 03:04:05.000678"), ("two\nlines", 1e300, "1999-12-31 00:00:00"), ("", None, None), (None, 0.1, None), (" pad ", 3.0, None)]
    df = spark.createDataFrame(data, "s string, d double, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    back = from_csv_lines(as_csv_lines(df), df.schema)
    want = df.withColumn("s", F.nullif("s", F.lit("")))  # an empty text is an empty cell
    assert back.dtypes == df.dtypes and back.exceptAll(want).count() == 0 and want.exceptAll(back).count() == 0


def test_the_audit_query_scans_the_events_twice(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = physical_plan(QUERIES["layer_audit"](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len([s for s in re.findall(r"ReadSchema: struct<([^>]*)>", plan) if "user_id" in s or "props" in s]) <= 2
