"""Incremental journey: two arrivals of event files give the batch journey."""

import os
import tempfile

import pytest
from conftest import SF_SMALL, rows

from perkspark.operators.journey import interactions_from_stage_times
from perkspark.plans.pipeline import LoyaltyPipeline
from perkspark.sources.fixtures import FIXTURE_PERIOD_START
from perkspark.streaming.journey_stream import read_stage_times, start_journey_stream


def _append(df, path, fmt):
    if fmt == "csv":
        df.write.mode("append").option("header", True).option("escape", '"').csv(path)
    else:
        df.write.mode("append").parquet(path)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_incremental_journey_equals_batch(spark, fmt):
    batch = LoyaltyPipeline.from_warehouse(spark, SF_SMALL)
    work = tempfile.mkdtemp(prefix="perkspark-stream-")
    source, sink, ckpt = (os.path.join(work, d) for d in ("source", "sink", "ckpt"))
    events = batch.events
    early, late = events.filter("time < 400"), events.filter("time >= 400")

    _append(early, source, fmt)
    q = start_journey_stream(spark, source, sink, ckpt, source_format=fmt, period_start=FIXTURE_PERIOD_START)
    q.awaitTermination()
    first = read_stage_times(spark, sink).count()

    _append(late, source, fmt)
    q = start_journey_stream(spark, source, sink, ckpt, source_format=fmt, period_start=FIXTURE_PERIOD_START)
    q.awaitTermination()

    incremental = interactions_from_stage_times(read_stage_times(spark, sink), batch.offers_enriched)
    cols = batch.offer_interactions.columns
    assert 0 < first < incremental.count()
    assert rows(incremental, *cols) == rows(batch.offer_interactions, *cols)


def test_replayed_epoch_overwrites_its_own_partition_only(spark):
    from perkspark.streaming.journey_stream import EpochPartitionWriter

    sink = os.path.join(tempfile.mkdtemp(prefix="perkspark-sink-"), "stages")
    write = EpochPartitionWriter(sink)
    schema = "customer_id string, offer_id string, received_time int, viewed_time int, completed_time int"
    write(spark.createDataFrame([("c1", "o1", 5, None, None)], schema), 0)
    write(spark.createDataFrame([("c2", "o1", 9, None, None)], schema), 1)
    # epoch 0 is replayed after a failure, with the same keys recomputed
    write(spark.createDataFrame([("c1", "o1", 4, 6, None)], schema), 0)
    got = rows(spark.read.parquet(sink), "epoch", "customer_id", "received_time", "viewed_time")
    assert got == [(0, "c1", 4, 6), (1, "c2", 9, None)]
    assert rows(read_stage_times(spark, sink), "customer_id", "received_time") == [("c1", 4), ("c2", 9)]
