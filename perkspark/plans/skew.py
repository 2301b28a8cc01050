"""Heavy keys, found by a count, so that their rows can be treated apart.

A key outside the ``MOST_KEYS`` most frequent ones holds less than one part in
``MOST_KEYS`` of all rows, so the list is bounded whatever the data, and small
enough to broadcast.  The count is a partial count per task and a top-k; nothing
runs while the plan is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys treated apart at most, and rows that make a key heavy.
MOST_KEYS = 1000
HEAVY_ROWS = 1_000_000
_CONF_KEY = "perkspark.skew.heavyRows"


def heavy_rows(df: DataFrame) -> int:
    value = df.sparkSession.conf.get(_CONF_KEY, None)
    return int(value) if value else HEAVY_ROWS


def heavy_keys(df: DataFrame, key: str, most_keys: int = MOST_KEYS) -> DataFrame:
    """(key, deals) of the keys with more than ``heavy_rows`` rows; ``deals`` shares of about that many rows."""
    rows = heavy_rows(df)
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    heavy = counts.filter(F.col("_rows") > rows).orderBy(F.col("_rows").desc(), key).limit(most_keys)
    return heavy.select(key, F.least(F.ceil(F.col("_rows") / rows), F.lit(most_keys)).cast("int").alias("deals"))
