"""Raw loyalty relations derived from the warehouse test tables.

The programme's own ``customers.csv`` and ``events.csv`` are not public, so
the raw layer is generated from the given parquet tables by fixed formulas
(FIXTURES.md section 3).  Every row of the source table becomes one raw row:
nothing is filtered away, so the work grows with the tables.

* customers  <- ``customer``  (one member per customer key)
* offers     <- ``part``      (one offer per part key)
* events     <- ``events``    (every event; its type picks the loyalty event)

The same formulas exist as DuckDB SQL in ``perkspark.oracle.fixture_sql``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perkspark import schemas
from perkspark.sources.tables import read_table

# Start of the 30-day window of the ``events`` table (its clock origin).
FIXTURE_PERIOD_START = "2024-01-01 00:00:00"
# Membership durations of the fixture are measured on this date.
FIXTURE_AS_OF = "2024-02-01"


def customers_from_warehouse(customer: DataFrame) -> DataFrame:
    n = F.col("c_custkey")
    bal = F.col("c_acctbal")
    unknown = n % 8 == 0
    df = customer.select(
        F.concat(F.lit("c"), n.cast("string")).alias("customer_id"),
        ((n % 6 + 2013) * 10000 + (n % 12 + 1) * 100 + (n % 28 + 1)).alias("became_member_on"),
        F.when(unknown | (n % 11 == 0), F.lit(None))
        .when(n % 3 == 0, "F")
        .when(n % 3 == 1, "M")
        .otherwise("O")
        .alias("gender"),
        F.when(unknown, F.lit(118)).otherwise(n % 90 + 16).alias("age"),
        F.when(unknown, F.lit(None)).when(bal < 0, bal).otherwise(bal * 10 + 30000).alias("income"),
    )
    return schemas.enforce(df, schemas.RAW_CUSTOMERS)


# --- fixed values: channel lists of the generated offers, by key % 4 --------
CHANNEL_TEXT_BY_KEY_MOD4 = (
    "['email', 'mobile', 'social']",
    "['web', 'email', 'mobile', 'social']",
    "['web', 'email']",
    "['web', 'email', 'mobile']",
)


def offers_from_warehouse(part: DataFrame) -> DataFrame:
    n = F.col("p_partkey")
    kind = n % 5
    informational = kind == 4
    channels = F.when(n % 4 == 0, CHANNEL_TEXT_BY_KEY_MOD4[0])
    for i in (1, 2, 3):
        channels = channels.when(n % 4 == i, CHANNEL_TEXT_BY_KEY_MOD4[i])
    df = part.select(
        F.concat(F.lit("o"), n.cast("string")).alias("offer_id"),
        F.when(kind <= 1, "bogo").when(kind <= 3, "discount").otherwise("informational").alias("offer_type"),
        F.when(informational, 0).otherwise((n % 4 + 1) * 5).alias("difficulty"),
        F.when(informational, 0)
        .when(kind <= 1, (n % 4 + 1) * 5)
        .otherwise(n % 4 + 2)
        .alias("reward"),
        (n % 8 + 3).alias("duration"),
        channels.alias("channels"),
    )
    return schemas.enforce(df, schemas.RAW_OFFERS)


def events_from_warehouse(events: DataFrame) -> DataFrame:
    et = F.col("event_type")
    # Offer referenced by a warehouse event: ``$.k`` of ``props``.
    # Computed in its own projection: the JSON parse then runs once per row
    # (Catalyst does not inline a non-trivial expression used several times).
    keyed = events.select(
        "event_id", "ts", "user_id", "value", et, F.get_json_object("props", "$.k").try_cast("int").alias("k")
    )
    k = F.col("k")
    named = keyed.withColumn(
        "event",
        F.when(et == "signup", "offer received")
        .when(et.isin("view", "error"), "offer viewed")
        # informational offers (key % 5 == 4) cannot complete: a click is a view
        .when((et == "click") & (k % 5 == 4), "offer viewed")
        .when(et == "click", "offer completed")
        .when(et == "purchase", "transaction")
        .otherwise(et),
    )
    event = F.col("event")
    offer = F.concat(F.lit("o"), k.cast("string"))
    amount = F.col("value").cast("decimal(12,2)").cast("string")
    value = (
        F.when(et == "error", F.lit("{}"))
        .when(
            event.isin("offer received", "offer viewed"),
            F.concat(F.lit("{'offer id': '"), offer, F.lit("'}")),
        )
        .when(
            event == "offer completed",
            F.concat(F.lit("{'offer_id': '"), offer, F.lit("', 'reward': "), (k % 4 + 2).cast("string"), F.lit("}")),
        )
        .when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"amount": '), amount, F.lit("}")))
        .otherwise(F.concat(F.lit("{'amount': "), amount, F.lit("}")))
    )
    hours = F.timestamp_diff("HOUR", F.lit(FIXTURE_PERIOD_START).cast("timestamp"), F.col("ts"))
    time = (
        hours
        + F.when(event == "offer viewed", 24).otherwise(0)
        + F.when(event == "offer completed", 168).otherwise(0)
    )
    df = named.select(
        F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("customer_id"),
        event,
        value.alias("value"),
        time.alias("time"),
    )
    return schemas.enforce(df, schemas.RAW_EVENTS)


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers_from_warehouse(read_table(spark, sf_dir, "customer", ["c_custkey", "c_acctbal"]))


def raw_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offers_from_warehouse(read_table(spark, sf_dir, "part", ["p_partkey"]))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_from_warehouse(
        read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    )
