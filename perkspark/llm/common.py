"""Helpers shared by the operators: words, chunks, table access, checkpoints."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

#: Words are maximal runs of characters outside these (bytes.split() cuts at the same ones).
ASCII_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
#: UTF-8 continuation bytes; a text has as many code points as other bytes.
CONTINUATION = bytes(range(0x80, 0xC0))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a batch between Spark and Python, where the session sets no number.
BATCH_ROWS = "1000"
BATCH_ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, with small Arrow batches in a session that leaves their size open.

    Spark's own default of 10,000 rows of text would be tens of megabytes several
    times over in every task.
    """
    conf = df.sparkSession.conf
    if BATCH_ROWS_KEY not in conf.getAll:
        conf.set(BATCH_ROWS_KEY, BATCH_ROWS)
    return df


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one where none is set (a local session, as in tests)."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = sc.getConf().get("spark.checkpoint.dir")
        if shared is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the cluster shares")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="perkspark-checkpoint-"))
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once; Spark removes the files when nothing refers to them any more."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, for what is too large for uncompressed rows.

    The tables stay until the folder is cleared, since the result reads them.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Spark's bound on the buckets of a table.
MOST_BUCKETS = 100_000
#: Removes a query's shuffle files when it ends; what it computed is in a table by then.
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, write: Callable) -> None:
    """``write`` a table of ``df``; the shuffle files of this query are removed when it ends."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP_KEY, None)
    conf.set(CLEANUP_KEY, "true")
    try:
        write(df.write.mode("append").format("parquet").option("compression", "zstd"))
    finally:
        if before is None:
            conf.unset(CLEANUP_KEY)
        else:
            conf.set(CLEANUP_KEY, before)


def bucketed(df: DataFrame, name: str, column: str, buckets: int) -> DataFrame:
    """``df`` as a table in the shared folder, one file for each bucket of ``column``, so that groups of it need no shuffle any more."""
    name = f"{name}_{uuid.uuid4().hex}"
    path = f"{shared_folder(df.sparkSession)}/{name}"
    saved(df.repartition(buckets, column), lambda out: out.option("path", path).bucketBy(buckets, column).saveAsTable(name))
    return df.sparkSession.table(name)


def crc_remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


@pandas_udf(T.LongType())
def word_count(text: pd.Series) -> pd.Series:
    """Words of binary texts; 0 for null."""
    return pd.Series([0 if t is None else len(t.split()) for t in text], dtype="int64")


def byte_chunks(batches: Iterable[pa.RecordBatch], max_bytes: int = 8 << 20) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of Arrow batches with their ``text`` as a list of UTF-8 bytes (None: null).

    A slice holds at most ``max_bytes`` of text, or one longer text.
    """
    for batch, column in text_chunks(batches, max_bytes):
        yield batch, column.to_pylist()


def text_chunks(batches: Iterable[pa.RecordBatch], max_bytes: int) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """``byte_chunks`` with the texts as an Arrow array."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index("text")).cast(pa.large_string()).cast(pa.large_binary())
        sizes = np.diff(np.frombuffer(column.buffers()[1], dtype=np.int64, count=len(column) + 1 + column.offset)[column.offset :]) if len(column) else []
        start, size = 0, 0
        for i, n in enumerate(sizes):
            if size and size + n > max_bytes:
                yield batch.slice(start, i - start), column.slice(start, i - start)
                start, size = i, 0
            size += int(n)
        if start < len(column):
            yield batch.slice(start), column.slice(start)


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit mixer (the finaliser of splitmix64)."""
    x = x.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes], cache: dict[bytes, int], limit: int = 200_000) -> np.ndarray:
    """64-bit hashes of words; ``cache`` holds those of frequent ones and is emptied at ``limit``."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    if len(cache) > limit:
        cache.clear()
    if not cache and len(words) == len(set(words)):  # distinct words need no cache
        return np.fromiter(map(digest, words), dtype=np.uint64, count=len(words))
    for w in set(words).difference(cache):
        cache[w] = digest(w)
    return np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))
