"""Spark session defaults for the loyalty engine.

The engine never owns the cluster configuration: on a cluster the session
comes from the platform and only the settings below that are *unset* are
filled in.  Tests and the benchmark build a local session with the same
function.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the plans rely on.  AQE re-plans joins from runtime sizes, merges
# small shuffle partitions and splits skewed ones; the session zone is pinned
# so timestamps never depend on the machine.
#
# Broadcast policy: a side is broadcast only on proof of its size.  Static
# broadcast from *estimated* plan sizes is off; AQE may still broadcast a
# side whose *measured* shuffle output is small, and dimensions proven small
# by ``perkspark.plans.broadcast`` are hinted explicitly.
DEFAULT_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Settings that only take effect when the session is built (static configs);
# a session handed over by a driver or notebook keeps its own values.
BUILD_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # PySpark 4 records the Python call site of every Column function (four
    # JVM round trips per call) for error messages; plans here are built from
    # hundreds of such calls, so building one would cost about a second.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # One session serves many different plans (every layer, view and report);
    # with the default of 100 compiled whole-stage classes they evict each
    # other and are compiled again on every run.
    "spark.sql.codegen.cache.maxEntries": "1000",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "perkspark",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {**DEFAULT_CONF, **BUILD_CONF}
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Fill in the engine's SQL settings that the session leaves unset.

    Runtime SQL settings are session scoped, so this is safe to call on a
    session handed over by a driver or a notebook host.
    """
    for key, value in DEFAULT_CONF.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark
