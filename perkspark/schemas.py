"""Schema registry: every layer table has one contract, and it is enforced.

``enforce(df, CONTRACT)`` ends each layer function: it selects the contract's
columns in the contract's order and casts each to the contract's type, so a
drifting expression type (``count`` giving bigint, an integer median, a
decimal literal) can never leak into a written table.  A null in a column that
the contract declares non-null is no error, since no row may be lost for it; it
is counted (``violations``), by the runner while it writes the table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _s(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()

# ---------------------------------------------------------------- raw layer
RAW_CUSTOMERS = _s(
    ("customer_id", S, False),
    ("became_member_on", I, True),
    ("gender", S, True),
    ("age", I, True),
    ("income", D, True),
)
RAW_OFFERS = _s(
    ("offer_id", S, False),
    ("offer_type", S, False),
    ("difficulty", I, False),
    ("reward", I, False),
    ("duration", I, False),
    ("channels", S, False),
)
RAW_EVENTS = _s(
    ("customer_id", S, False),
    ("event", S, False),
    ("value", S, True),
    ("time", I, False),
)

# ----------------------------------------------------------- cleansed layer
CUSTOMERS_CLEANSED = _s(
    ("customer_id", S, False),
    ("membership_date", T.DateType(), True),
    ("gender", S, True),
    ("age", I, True),
    ("age_group", S, True),
    ("income", D, True),
    ("income_bracket", S, True),
    ("membership_duration_days", I, True),
    ("data_quality_flag", S, False),
)
OFFERS_ENRICHED = _s(
    ("offer_id", S, False),
    ("offer_type", S, False),
    ("difficulty", I, False),
    ("reward", I, False),
    ("duration", I, False),
    ("duration_hours", I, False),
    ("channels_list", T.ArrayType(S), True),
    ("num_channels", I, True),
    ("is_multichannel", B, True),
    ("roi_ratio", D, True),
)
EVENTS_PROCESSED = _s(
    ("event_id", S, False),
    ("customer_id", S, False),
    ("event_type", S, False),
    ("offer_id", S, True),
    ("transaction_amount", D, True),
    ("reward_amount", D, True),
    ("event_time_hours", I, False),
    ("event_timestamp", T.TimestampNTZType(), False),
    ("event_date", T.DateType(), False),
)
OFFER_INTERACTIONS = _s(
    ("customer_id", S, False),
    ("offer_id", S, False),
    ("received_time", I, True),
    ("viewed_time", I, True),
    ("completed_time", I, True),
    ("is_received", B, False),
    ("is_viewed", B, False),
    ("is_completed", B, False),
    ("time_to_view", I, True),
    ("time_to_complete", I, True),
    ("completion_within_duration", B, True),
)

# ------------------------------------------------------------ metrics layer
CHANNEL_EFFECTIVENESS = _s(
    ("channel", S, False),
    ("total_offers_sent", L, False),
    ("offers_completed", L, False),
    ("completion_rate", D, False),
    ("avg_completion_time_hours", D, True),
    ("total_revenue_generated", D, True),
    ("avg_revenue_per_offer", D, True),
    ("effectiveness_rank", I, False),
)
AGE_DISTRIBUTION = _s(
    ("age_group", S, True),
    ("completion_status", S, False),
    ("customer_count", L, False),
    ("percentage", D, False),
    ("avg_income", D, True),
    ("avg_offers_received", D, True),
)
OFFER_COMPLETION_METRICS = _s(
    ("offer_type", S, False),
    ("channel", S, False),
    ("avg_completion_time_hours", D, True),
    ("median_completion_time_hours", D, True),
    ("min_completion_time_hours", D, True),
    ("max_completion_time_hours", D, True),
    ("std_dev_hours", D, True),
    ("total_completions", L, False),
    ("total_received", L, False),
    ("completion_rate", D, False),
    ("unique_customers", L, False),
    ("total_customers_targeted", L, False),
)

#: Of tables without a contract (rejected rows).
NO_CONTRACT = T.StructType([])

CONTRACTS: dict[str, T.StructType] = {
    "customers": RAW_CUSTOMERS,
    "offers": RAW_OFFERS,
    "events": RAW_EVENTS,
    "customers_cleansed": CUSTOMERS_CLEANSED,
    "offers_enriched": OFFERS_ENRICHED,
    "events_processed": EVENTS_PROCESSED,
    "offer_interactions": OFFER_INTERACTIONS,
    "channel_effectiveness": CHANNEL_EFFECTIVENESS,
    "age_distribution_analysis": AGE_DISTRIBUTION,
    "offer_completion_metrics": OFFER_COMPLETION_METRICS,
}


def enforce(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Project ``df`` onto ``contract``: contract order, contract types.

    Missing columns are an error (a contract is a promise, not a hint).
    """
    missing = [f.name for f in contract.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} required by the contract are missing")
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in contract.fields])


def violations(contract: T.StructType) -> dict[str, Column]:
    """For each non-null column of ``contract``, the aggregate that counts its nulls."""
    return {f.name: F.count_if(F.col(f"`{f.name}`").isNull()) for f in contract.fields if not f.nullable}


def contract_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, violations) of every non-null contract column; one aggregate a table."""
    parts = []
    for name, df in tables.items():
        counts = violations(CONTRACTS[name])
        lines = [F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("violations")) for c in counts]
        parts.append(df.agg(*(v.alias(c) for c, v in counts.items())).select(F.inline(F.array(*lines))))
    return reduce(DataFrame.unionByName, parts)
