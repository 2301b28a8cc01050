"""Intermediate results kept in the cluster's shared folder.

``spark.checkpoint.dir`` names the folder; only a local session without the
setting uses a temporary one.  Executors can be lost: what is stored is not
computed again.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if folder is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the cluster shares")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="perkspark-shared-"))
    return sc.getCheckpointDir()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df``, computed now and read from a Parquet table in the shared folder."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
