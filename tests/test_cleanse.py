"""Edge cases of the cleansed layer (FIXTURES.md section 4)."""

from conftest import rows

from perkspark import schemas
from perkspark.operators.cleanse import cleanse_customers, enrich_offers, parse_events


def _customers(spark, data):
    return spark.createDataFrame(data, schemas.RAW_CUSTOMERS)


def test_age_buckets_and_flags(spark):
    ages = [17, 18, 24, 25, 64, 65, 101, 102]
    data = [(f"c{a}", 20170101, "F", a, 50000.0) for a in ages]
    out = cleanse_customers(_customers(spark, data), as_of="2018-01-01")
    got = {r.age: (r.age_group, r.data_quality_flag) for r in out.collect()}
    assert got == {
        17: ("<18", "invalid_age"),
        18: ("18-24", "valid"),
        24: ("18-24", "valid"),
        25: ("25-34", "valid"),
        64: ("55-64", "valid"),
        65: ("65+", "valid"),
        101: ("65+", "valid"),
        102: ("65+", "invalid_age"),
    }


def test_income_brackets_and_flags(spark):
    incomes = [-1.0, 0.0, 39999.99, 40000.0, 80000.0, 120000.0]
    data = [(f"c{i}", 20170101, "M", 30, v) for i, v in enumerate(incomes)]
    out = cleanse_customers(_customers(spark, data))
    got = [(r.income, r.income_bracket, r.data_quality_flag) for r in out.orderBy("income").collect()]
    assert got == [
        (-1.0, "Low", "invalid_income"),
        (0.0, "Low", "valid"),
        (39999.99, "Low", "valid"),
        (40000.0, "Medium", "valid"),
        (80000.0, "High", "valid"),
        (120000.0, "Very High", "valid"),
    ]


def test_nulls_stay_null_and_incomplete_wins(spark):
    data = [
        ("a", 20170101, "F", None, 50000.0),
        ("b", 20170101, "F", 30, None),
        ("c", 20170101, None, 118, 50000.0),
    ]
    out = cleanse_customers(_customers(spark, data))
    got = rows(out, "customer_id", "age_group", "income_bracket", "data_quality_flag")
    assert got == [
        ("a", None, "Medium", "incomplete"),
        ("b", "25-34", None, "incomplete"),
        ("c", "65+", "Medium", "incomplete"),
    ]


def test_bad_member_date_gives_null_not_failure(spark):
    out = cleanse_customers(_customers(spark, [("x", 20171345, "O", 40, 1.0), ("y", 20170115, "O", 40, 1.0)]), "2017-02-01")
    got = rows(out, "customer_id", "membership_date", "membership_duration_days")
    assert got[0][0] == "x" and got[0][1] is None and got[0][2] is None
    assert got[1][2] == 17


def _offers(spark, channel_texts, difficulty=10):
    data = [(f"o{i}", "bogo", difficulty, 5, 7, t) for i, t in enumerate(channel_texts)]
    return spark.createDataFrame(data, schemas.RAW_OFFERS)


def test_channel_list_shapes(spark):
    texts = ["['web', 'email']", '["web","email"]', "['web','email']", "", "[]"]
    out = enrich_offers(_offers(spark, texts)).orderBy("offer_id").collect()
    assert [r.channels_list for r in out] == [["web", "email"]] * 3 + [[""], [""]]
    assert [r.num_channels for r in out] == [2, 2, 2, 1, 1]
    assert [r.is_multichannel for r in out] == [True, True, True, False, False]
    assert all(r.duration_hours == 168 for r in out)


def test_roi_null_when_difficulty_zero(spark):
    out = enrich_offers(_offers(spark, ["['email']"], difficulty=0)).collect()[0]
    assert out.roi_ratio is None
    out = enrich_offers(_offers(spark, ["['email']"], difficulty=10)).collect()[0]
    assert out.roi_ratio == 0.5


def _events(spark, data):
    return spark.createDataFrame(data, schemas.RAW_EVENTS)


def test_event_parsing(spark):
    data = [
        ("c1", "transaction", '{"amount": 1.5}', 1),
        ("c1", "transaction", "{'amount': 2.25}", 2),
        ("c1", "transaction", "{'amount': 1.2.3}", 3),
        ("c1", "transaction", "{}", 4),
        ("c1", "offer completed", "{'offer id': 'o1', 'reward': 5}", 5),
        ("c1", "offer completed", "{'offer_id': 'o2', 'reward': 5}", 6),
        ("c1", "offer received", "{'offer id': 'o3'}", 7),
        ("c1", "offer received", "{'offer id': 'o4'}", 7),
    ]
    out = parse_events(_events(spark, data), period_start="2018-01-01 00:00:00")
    got = rows(out, "event_time_hours", "offer_id", "transaction_amount", "reward_amount")
    assert got == [
        (1, None, 1.5, None),
        (2, None, 2.25, None),
        (3, None, None, None),
        (4, None, None, None),
        (5, None, None, 5.0),  # wrong key: unparsed offer id, reward still read
        (6, "o2", None, 5.0),
        (7, "o3", None, None),
        (7, "o4", None, None),
    ]
    ids = [r.event_id for r in out.filter("event_time_hours = 7").collect()]
    assert ids == ["c1_offer received_7", "c1_offer received_7"]  # not unique, as in the source
    ts = out.filter("event_time_hours = 5").collect()[0]
    assert str(ts.event_timestamp) == "2018-01-01 05:00:00" and str(ts.event_date) == "2018-01-01"


def test_strict_quotes_reads_only_double_quoted_amounts(spark):
    data = [("c1", "transaction", '{"amount": 1.5}', 1), ("c1", "transaction", "{'amount': 2.5}", 2)]
    out = parse_events(_events(spark, data), strict_quotes=True)
    assert rows(out, "event_time_hours", "transaction_amount") == [(1, 1.5), (2, None)]
