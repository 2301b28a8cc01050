"""Incremental offer journey with Structured Streaming.

New raw event files are parsed with the same expressions as the batch
layer, and the first hour of each stage per (customer, offer) is kept as a
streaming aggregate in ``update`` mode: ``min`` is mergeable, so each
micro-batch only touches the keys it saw and the state store holds one
row per (customer, offer) -- the size of the journey table itself.

Sink: ``foreachBatch`` writes the updated keys of epoch ``e`` to the folder
partition ``epoch=e`` (dynamic partition overwrite).  A replayed epoch
rewrites the same partition, so the sink is idempotent.  Stage minima only
ever decrease, so the current table is the ``min`` over all partitions
(``read_stage_times``); ``compact`` folds the partitions into one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from perkspark import schemas
from perkspark.constants import DEFAULT_PERIOD_START
from perkspark.operators.cleanse import parse_events
from perkspark.operators.journey import stage_times
from perkspark.sources.csv import csv_stream

KEYS = ("customer_id", "offer_id")
STAGES = ("received_time", "viewed_time", "completed_time")
_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class EpochPartitionWriter:
    """``foreachBatch`` sink writing each epoch to its own partition."""

    def __init__(self, sink_dir: str):
        self.sink_dir = sink_dir

    def __call__(self, batch: DataFrame, epoch_id: int) -> None:
        (
            batch.withColumn("epoch", F.lit(epoch_id).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("epoch")
            .parquet(self.sink_dir)
        )


def stage_minima_stream(events: DataFrame, period_start: str = DEFAULT_PERIOD_START, strict_quotes: bool = False) -> DataFrame:
    """Streaming (customer_id, offer_id, received/viewed/completed minima)."""
    return stage_times(parse_events(events, period_start, strict_quotes))


def start_journey_stream(
    spark: SparkSession,
    source_dir: str,
    sink_dir: str,
    checkpoint_dir: str,
    source_format: str = "parquet",
    period_start: str = DEFAULT_PERIOD_START,
    strict_quotes: bool = False,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the incremental journey over raw event files in ``source_dir``.

    ``checkpoint_dir`` must be on shared storage (offsets and state live
    there).  With ``available_now`` the query processes what is present and
    stops, which suits scheduled runs.  CSV files have their columns in any
    order, the same in all files; the header of the files present at the start
    names them.
    """
    if spark.conf.get(_STATE_STORE, None) is None:
        spark.conf.set(_STATE_STORE, _ROCKSDB)  # state larger than memory
    reader = spark.readStream.format(source_format)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if source_format == "csv":
        events = csv_stream(reader, spark, source_dir, schemas.RAW_EVENTS)
    else:
        events = reader.schema(schemas.RAW_EVENTS).load(source_dir)
    stages = stage_minima_stream(events, period_start, strict_quotes)
    writer = (
        stages.writeStream.outputMode("update")
        .foreachBatch(EpochPartitionWriter(sink_dir))
        .option("checkpointLocation", checkpoint_dir)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_stage_times(spark: SparkSession, sink_dir: str) -> DataFrame:
    """Current stage minima: ``min`` over every epoch partition."""
    return (
        spark.read.parquet(sink_dir)
        .groupBy(*KEYS)
        .agg(*[F.min(c).alias(c) for c in STAGES])
    )


def compact(spark: SparkSession, sink_dir: str, target_dir: str) -> DataFrame:
    """Write the folded stage minima to ``target_dir`` and return them."""
    read_stage_times(spark, sink_dir).write.mode("overwrite").parquet(target_dir)
    return spark.read.parquet(target_dir)
