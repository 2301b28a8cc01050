"""The layer graph as lazy plans: raw -> cleansed -> metrics.

``LoyaltyPipeline`` only builds DataFrames; it runs nothing.  Each property
is computed once per object, so queries built from one object share plan
fragments (and Spark may reuse their exchanges).  The writer in
``perkspark.plans.runner`` materialises the layers as tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perkspark import schemas
from perkspark.constants import DEFAULT_AS_OF, DEFAULT_PERIOD_START
from perkspark.operators import age, channel, cleanse, completion, journey, reports, views
from perkspark.plans.broadcast import has_at_most, max_broadcast_rows


Raw = DataFrame | Callable[[], DataFrame]


def _raw_relation(name: str) -> property:
    """A raw relation given as a DataFrame or as a zero-argument loader.

    A loader runs on first use, so a query that needs only the events never
    builds the member or offer plans.
    """

    def get(self: "LoyaltyPipeline") -> DataFrame:
        value = self._raw[name]
        if callable(value):
            value = self._raw[name] = value()
        return value

    def set_(self: "LoyaltyPipeline", df: Raw) -> None:
        self._raw[name] = df

    return property(get, set_)


class LoyaltyPipeline:
    customers = _raw_relation("customers")
    offers = _raw_relation("offers")
    events = _raw_relation("events")

    def __init__(
        self,
        customers: Raw,
        offers: Raw,
        events: Raw,
        as_of: str = DEFAULT_AS_OF,
        period_start: str = DEFAULT_PERIOD_START,
        strict_quotes: bool = False,
    ):
        self._raw: dict[str, Raw] = {"customers": customers, "offers": offers, "events": events}
        self.as_of = as_of
        self.period_start = period_start
        self.strict_quotes = strict_quotes

    @classmethod
    def from_warehouse(cls, spark: SparkSession, sf_dir: str) -> "LoyaltyPipeline":
        from perkspark.sources import fixtures

        return cls(
            lambda: fixtures.raw_customers(spark, sf_dir),
            lambda: fixtures.raw_offers(spark, sf_dir),
            lambda: fixtures.raw_events(spark, sf_dir),
            as_of=fixtures.FIXTURE_AS_OF,
            period_start=fixtures.FIXTURE_PERIOD_START,
        )

    @cached_property
    def offers_small(self) -> bool:
        """Proof, made once, that the offer-keyed dimensions may be broadcast.

        Those dimensions (durations, types, channel counts) have one row per
        offer, so the raw offer count bounds them; for parquet it reads only
        the file footers.
        """
        return has_at_most(self.offers, max_broadcast_rows(self.offers))

    @cached_property
    def offer_channels_small(self) -> bool:
        """Proof, made once, that the channel-fanned offer dimensions may be broadcast.

        They have one row per (offer, channel).  ``explode_outer`` of the
        channel lists has at least as many rows as any of them (one row for
        an offer without channels), so a bound on it bounds them all,
        whatever the lists hold.  A big offer table is rejected from its own
        count before anything is exploded.
        """
        if not self.offers_small:
            return False
        widest = self.offers_enriched.select("offer_id", F.explode_outer("channels_list").alias("channel"))
        return has_at_most(widest, max_broadcast_rows(self.offers))

    # ------------------------------------------------------------ cleansed
    @cached_property
    def customers_cleansed(self) -> DataFrame:
        return cleanse.cleanse_customers(self.customers, self.as_of)

    @cached_property
    def offers_enriched(self) -> DataFrame:
        return cleanse.enrich_offers(self.offers)

    @cached_property
    def events_processed(self) -> DataFrame:
        return cleanse.parse_events(self.events, self.period_start, self.strict_quotes)

    @cached_property
    def offer_interactions(self) -> DataFrame:
        return journey.build_interactions(self.events_processed, self.offers_enriched, dim_small=self.offers_small)

    @cached_property
    def journeys(self) -> DataFrame:
        """The journeys as the metrics need them: no join to the offers' durations."""
        return journey.journeys_from_stage_times(journey.stage_times(self.events_processed))

    @cached_property
    def period_money(self) -> DataFrame:
        return channel.period_money(self.events_processed)

    def journeys_are_stored(self, stored: DataFrame) -> None:
        """From now on the metrics read the stored journey table."""
        self.__dict__["offer_interactions"] = self.__dict__["journeys"] = stored
        self.__dict__["period_money"] = channel.offer_period_revenue(stored, self.events_processed, keep_empty=False)

    # ------------------------------------------------------------- metrics
    @cached_property
    def channel_effectiveness(self) -> DataFrame:
        return channel.channel_effectiveness(
            self.journeys, self.period_money, self.offers_enriched, dim_small=self.offer_channels_small
        )

    @cached_property
    def age_distribution(self) -> DataFrame:
        return age.age_distribution(self.customers_cleansed, self.journeys)

    @cached_property
    def offer_completion_metrics(self) -> DataFrame:
        return completion.offer_completion_metrics(
            self.journeys, self.offers_enriched, self.offer_channels_small
        )

    # --------------------------------------------------------------- views
    @cached_property
    def v_channel_performance(self) -> DataFrame:
        return views.channel_performance_view(self.channel_effectiveness)

    @cached_property
    def v_age_summary(self) -> DataFrame:
        return views.age_summary_view(self.age_distribution)

    @cached_property
    def v_offer_summary(self) -> DataFrame:
        return views.offer_summary_view(self.offer_completion_metrics)

    # ------------------------------------------------------------- reports
    def layer_audit(self) -> DataFrame:
        return reports.layer_audit(
            self.customers_cleansed,
            self.offers_enriched,
            self.events_processed,
            self.offer_interactions,
            self.channel_effectiveness,
            self.age_distribution,
            self.offer_completion_metrics,
        )

    def contract_violations(self) -> DataFrame:
        """Nulls where the raw and cleansed contracts declare none."""
        names = ("customers", "offers", "events", "customers_cleansed", "offers_enriched", "events_processed", "offer_interactions")
        return schemas.contract_violations({name: getattr(self, name) for name in names})
