"""Broadcast only behind a proven size bound.

``F.broadcast`` overrides Spark's own size estimate, so the engine hints a
side only after proving it small with an exact row count.  A count is a
partial count per task and one row per task through the shuffle, and for a
parquet scan projected to a few columns it reads only the file footers.
(``limit(n + 1).count()`` would be worse at scale: every partition sends up
to ``n + 1`` rows into a single task.)  A derived dimension is first
checked through a relation that cannot have more rows (the table it is
derived from, see ``LoyaltyPipeline``), so a big table is rejected from its
own cheap count.

Above the bound the join is left to Spark (sort-merge, or a runtime
broadcast that AQE picks from the real shuffle size).  Where the fact side may have
hot keys, these are found by a count (``plans.skew``) and joined apart: their slice
of the dimension is small enough to broadcast, so that the rows of a hot key stay
where they are, and only the others are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perkspark.plans.skew import heavy_keys
from perkspark.plans.stored import stored

# Dimension sides are a few narrow columns (ids, short labels, small
# numbers): 1M rows stay around 50 MB once broadcast.
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
_CONF_KEY = "perkspark.broadcast.maxRows"


def max_broadcast_rows(df: DataFrame) -> int:
    value = df.sparkSession.conf.get(_CONF_KEY, None)
    return int(value) if value else DEFAULT_MAX_BROADCAST_ROWS


def has_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (an exact count)."""
    return df.count() <= max_rows


def maybe_broadcast(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """``broadcast(df)`` if it is proven small, else ``df`` unchanged."""
    bound = max_broadcast_rows(df) if max_rows is None else max_rows
    return F.broadcast(df) if has_at_most(df, bound) else df


def join_dimension(
    fact: DataFrame,
    dim: DataFrame,
    on,
    how: str = "inner",
    max_rows: int | None = None,
    small: bool | None = None,
    hot: bool = False,
    plain: bool = False,
) -> DataFrame:
    """Join a fact relation to a dimension, broadcasting the dimension when
    it is proven small (the build side of an inner / left join).

    ``small`` passes a proof made earlier (e.g. once per pipeline for a
    dimension derived row-by-row from a checked table); ``None`` proves here.
    ``hot`` says that the fact side may have most rows on a few keys; ``plain``, that
    it is columns of a table, as cheap to read again as a stored copy.
    """
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        return fact.join(dim, on, how)
    bound = max_broadcast_rows(dim) if max_rows is None else max_rows
    if small is None:
        small = has_at_most(dim, bound)
    if small:
        return fact.join(F.broadcast(dim), on, how)
    return _join_heavy_apart(fact if plain else stored(fact, "join-fact"), dim, on, how, bound) if hot else fact.join(dim, on, how)


def _join_heavy_apart(fact: DataFrame, dim: DataFrame, key: str, how: str, bound: int) -> DataFrame:
    heavy = F.broadcast(heavy_keys(fact, key).select(F.col(key).alias("_heavy")))  # bounded by its limit
    of_heavy = dim.join(heavy, F.col(key) == F.col("_heavy"), "left_semi")
    if not has_at_most(of_heavy, bound):
        return fact.join(dim, key, how)
    marked = fact.join(heavy, F.col(key) == F.col("_heavy"), "left")
    apart = marked.filter(F.col("_heavy").isNotNull()).drop("_heavy").join(F.broadcast(of_heavy), key, how)
    others = marked.filter(F.col("_heavy").isNull()).drop("_heavy").join(dim, key, how)
    return apart.unionByName(others)
