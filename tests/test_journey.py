"""Offer journey edge cases (FIXTURES.md section 4)."""

from conftest import rows

from perkspark import schemas
from perkspark.operators.cleanse import enrich_offers, parse_events
from perkspark.operators.journey import build_interactions


def _build(spark, events, pivot=False):
    offers = spark.createDataFrame(
        [("o1", "bogo", 5, 5, 1, "['web', 'email']")], schemas.RAW_OFFERS
    )  # duration 1 day = 24 hours
    ev = parse_events(spark.createDataFrame(events, schemas.RAW_EVENTS))
    return build_interactions(ev, enrich_offers(offers), pivot=pivot)


def _rec(c, o, t):
    return (c, "offer received", f"{{'offer id': '{o}'}}", t)


def _view(c, o, t):
    return (c, "offer viewed", f"{{'offer id': '{o}'}}", t)


def _done(c, o, t):
    return (c, "offer completed", f"{{'offer_id': '{o}', 'reward': 5}}", t)


EVENTS = [
    _rec("a", "o1", 10), _rec("a", "o1", 5), _done("a", "o1", 29),  # two receipts: earliest; done at 24h
    _rec("b", "o1", 0), _done("b", "o1", 25),  # one hour too late
    _view("c", "o1", 3),  # viewed only
    _done("d", "o1", 7),  # completed, never received
    _rec("e", "o9", 1), _done("e", "o9", 2),  # unknown offer: kept, within false
    _rec("f", "o1", 50), _done("f", "o1", 40),  # completed before receipt: negative time
    ("g", "transaction", "{'amount': 3}", 1),  # no offer id: not in the journey
]

EXPECTED = [
    # customer, offer, received, viewed, completed, ttc, within
    ("a", "o1", 5, None, 29, 24, True),
    ("b", "o1", 0, None, 25, 25, False),
    ("c", "o1", None, 3, None, None, None),
    ("d", "o1", None, None, 7, None, False),
    ("e", "o9", 1, None, 2, 1, False),
    ("f", "o1", 50, None, 40, -10, True),
]


def test_journey_rows(spark):
    out = _build(spark, EVENTS)
    cols = ("customer_id", "offer_id", "received_time", "viewed_time", "completed_time", "time_to_complete",
            "completion_within_duration")
    assert rows(out, *cols) == EXPECTED
    flags = {r.customer_id: (r.is_received, r.is_viewed, r.is_completed) for r in out.collect()}
    assert flags["c"] == (False, True, False) and flags["d"] == (False, False, True)


def test_pivot_form_gives_same_rows(spark):
    cols = _build(spark, EVENTS).columns
    a = rows(_build(spark, EVENTS), *cols)
    b = rows(_build(spark, EVENTS, pivot=True), *cols)
    assert a == b


def test_contract_schema(spark):
    out = _build(spark, EVENTS)
    assert [f.name for f in out.schema.fields] == [f.name for f in schemas.OFFER_INTERACTIONS.fields]
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in schemas.OFFER_INTERACTIONS.fields]
