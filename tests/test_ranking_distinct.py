"""Ranks, medians, bitmaps and hot dimension joins against brute force, with hot values and few or bad splitters."""

import random
import re
import tempfile
from collections import Counter, defaultdict

import pytest
from conftest import SF_SMALL, rows

from perkspark.operators import distinct, journey, reports
from perkspark.operators.ranking import medians, ranked, splitters
from perkspark.operators.warehouse import customers_ranked_by_revenue, median_price_by_brand
from perkspark.plans.explain import physical_plan
from perkspark.plans.pipeline import LoyaltyPipeline


@pytest.fixture()
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def values(seed, n):
    """A third of all rows share a value; some are null, huge or close together."""
    rng = random.Random(seed)
    pick = lambda: rng.choice([7.0, 7.0, rng.randrange(50) / 10, 1e300, -1e300, None, 3 + rng.random() * 1e-9])
    return [(i, pick()) for i in range(n)]


@pytest.mark.parametrize("cuts", [None, [], [7.0], [-1e300, 0.0, 3.0, 3.0000000005, 7.0, 7.1], [1e301]])
def test_ranks_against_brute_force(spark, cuts):
    data = values(1, 400)
    df = spark.createDataFrame(data, "id int, v double")
    got = {r["id"]: r["place"] for r in ranked(df, "v", "place", cuts).collect()}
    known = [v for _, v in data if v is not None]
    assert got == {i: 1 + (len(known) if v is None else sum(x > v for x in known)) for i, v in data}


def test_ranks_of_an_empty_relation_and_of_equal_rows(spark):
    assert ranked(spark.createDataFrame([], "id int, v double"), "v").count() == 0
    same = spark.createDataFrame([(i, 2.5) for i in range(500)], "id int, v double")
    assert {r["rank"] for r in ranked(same, "v").collect()} == {1}
    assert splitters(same, "v", 16) == [2.5]


def test_no_window_sees_all_customers(spark, static_plans):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_custkey", "o_totalprice")
    plan = physical_plan(customers_ranked_by_revenue(orders))
    windows = re.findall(r"Window \[.*\], \[?([^\[\]]*)\]?, \[", plan)
    assert len(re.findall(r"\bWindow \[", plan)) == 2
    # the one unpartitioned window is over ranges: below it stands their aggregate
    single = plan[plan.index("Exchange SinglePartition") :].splitlines()[:4]
    assert any("HashAggregate(keys=[range#" in line for line in single), single
    assert windows is not None


@pytest.mark.parametrize("ranges", [1, 4, 64])
def test_medians_with_all_prices_inside_one_unit(spark, ranges):
    rng = random.Random(3)
    price = lambda b: None if b == "none" or rng.random() < 0.1 else (41.5 if b == "hot" and rng.random() < 0.6 else 41 + rng.randrange(5000) / 5000)
    brand = lambda i: rng.choice(["hot", "hot", "b1", "b2", "none", None])
    lines = [(i, brand(i)) for i in range(600)]
    lines = [(i, b, price(b)) for i, b in lines]
    part = spark.createDataFrame([(i, b) for i, b, _ in lines], "p_partkey int, p_brand string")
    items = spark.createDataFrame([(i, p) for i, _, p in lines], "l_partkey int, l_extendedprice double")
    by = defaultdict(list)
    for _, b, p in lines:
        by[b].append(p)
    want = {b: (sorted(x for x in ps if x is not None), len(ps)) for b, ps in by.items()}
    got = {r["p_brand"]: (r["median_price"], r["line_count"]) for r in median_price_by_brand(items, part, ranges).collect()}
    assert got == {b: (ps[(len(ps) - 1) // 2] if ps else None, n) for b, (ps, n) in want.items()}


def test_medians_of_weighted_counts(spark):
    counts = spark.createDataFrame([("a", 1.0, 3), ("a", 2.0, 3), ("b", 5.0, 1), ("b", None, 9), ("c", None, 2)], "g string, v double, n long")
    for cuts in ([], [1.0], [1.0, 2.0, 5.0], [1.5]):
        assert {tuple(r) for r in medians(counts, "g", "v", "n", cuts).collect()} == {("a", 1.0, 6), ("b", 5.0, 10), ("c", None, 2)}


def test_bitmap_counts_against_sets(spark, static_plans):
    rng = random.Random(4)
    pick = lambda: rng.choice([None, rng.randrange(40), rng.randrange(10**6), 2**62 + rng.randrange(5), -rng.randrange(70000)])
    data = [(rng.choice(["x", "x", "x", "y", None]), pick(), pick()) for _ in range(900)] + [("only nulls", None, None)]
    df = spark.createDataFrame(data, "g string, a long, b long")
    out = distinct.distinct_counts(df, "g", {"n_a": "a", "n_b": "b"})
    got = {r["g"]: (r["n_a"], r["n_b"]) for r in out.collect()}
    assert got == {g: tuple(len({r[k] for r in data if r[0] == g and r[k] is not None}) for k in (1, 2)) for g in {r[0] for r in data}}
    lineitem = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    counts = physical_plan(distinct.distinct_counts(lineitem, "l_returnflag", {"o": "l_orderkey", "s": "l_suppkey"}))
    assert counts.count("FileScan") == 1


def test_numbers_are_unique_close_and_repeatable(spark):
    df = spark.createDataFrame([(f"c{i % 300}",) for i in range(1000)] + [(None,)], "k string")
    first, again = ({r["k"]: r["number"] for r in distinct.numbered(df, "k").collect()} for _ in range(2))
    assert first == again and len(first) == len(set(first.values())) == 300
    assert len({n >> 15 for n in first.values()}) <= 4


def test_reach_counts_members_once_over_many_offers(spark):
    journeys = spark.createDataFrame(
        [("a", "o1", True, True, False), ("a", "o2", True, False, True), ("b", "o2", True, False, False), ("c", "o3", False, True, False)],
        "customer_id string, offer_id string, is_received boolean, is_viewed boolean, is_completed boolean",
    )
    offers = spark.createDataFrame([("o1", ["web", "sms"]), ("o2", ["web"]), ("o3", ["", "sms"])], "offer_id string, channels_list array<string>")
    assert rows(distinct.channel_reach(journeys, offers), "channel", *distinct.REACHED) == [("sms", 1, 2, 0), ("web", 2, 1, 1)]


@pytest.mark.parametrize("bound", ["1000", "1"])
def test_reach_computes_the_journeys_once(spark, bound):
    """Whether the offers are small or not: no branch of the plan, and no count before it, reads the events again."""
    read = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    schema = "customer_id string, offer_id string, is_received boolean, is_viewed boolean, is_completed boolean"
    rows_of = [(f"c{i % 70}", "hot" if i % 2 else f"o{i % 9}", True, i % 3 == 0, i % 5 == 0) for i in range(500)]
    journeys = spark.createDataFrame(rows_of, schema).mapInArrow(counting, schema)
    offers = spark.createDataFrame([("hot", ["web"])] + [(f"o{i}", ["web", "sms"][i % 2 :]) for i in range(9)], "offer_id string, channels_list array<string>")
    spark.conf.set("perkspark.broadcast.maxRows", bound)
    spark.conf.set("perkspark.skew.heavyRows", "100")
    try:
        got = rows(distinct.channel_reach(journeys, offers), "channel", *distinct.REACHED)
    finally:
        spark.conf.unset("perkspark.broadcast.maxRows")
        spark.conf.unset("perkspark.skew.heavyRows")
    channels = {r["offer_id"]: r["channels_list"] for r in offers.collect()}
    sets = defaultdict(lambda: [set(), set(), set()])
    for member, offer, *flags in rows_of:
        for channel in channels[offer]:
            for members, flag in zip(sets[channel], flags, strict=True):
                members.update([member] if flag else [])
    assert got == sorted((c, *map(len, s)) for c, s in sets.items())
    assert read.value == len(rows_of)


def test_hot_offers_are_joined_apart(spark, static_plans):
    """Above the broadcast bound the rows of a hot offer are not shuffled to its dimension row."""
    stages = [(f"c{i}", "hot", 1, None, 5) for i in range(400)] + [(f"c{i}", f"o{i % 90}", 2, 3, None) for i in range(200)] + [("x", "unknown", 1, 1, 1)]
    stages = spark.createDataFrame(stages, "customer_id string, offer_id string, received_time int, viewed_time int, completed_time int")
    offers = spark.createDataFrame([("hot", 3)] + [(f"o{i}", i) for i in range(90)], "offer_id string, duration_hours int")
    want = journey.interactions_from_stage_times(stages, offers, dim_small=True)
    spark.conf.set("perkspark.broadcast.maxRows", "1")
    spark.conf.set("perkspark.skew.heavyRows", "100")
    try:
        got = journey.interactions_from_stage_times(stages, offers, dim_small=False)
        plan = physical_plan(got)
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    finally:
        spark.conf.unset("perkspark.broadcast.maxRows")
        spark.conf.unset("perkspark.skew.heavyRows")
    assert re.search(r"BroadcastHashJoin \[offer_id#\d+\], \[offer_id#\d+\], LeftOuter", plan), plan
    shuffled = plan[: plan.index("SortMergeJoin [offer_id")].count("SortMergeJoin") + plan.count("SortMergeJoin [offer_id")
    assert shuffled == 1 and "isnull(_heavy" in plan


def test_a_matrix_runs_the_metrics_once(spark):
    p = LoyaltyPipeline.from_warehouse(spark, SF_SMALL)
    matrix = reports.offer_channel_matrix(p.offer_completion_metrics, "completion_rate")
    assert "events.parquet" not in physical_plan(matrix)  # what is left reads the stored cells
    cells = {(r["offer_type"], c): r[c] for r in matrix.collect() for c in matrix.columns if c != "offer_type"}
    assert {k: v for k, v in cells.items() if v is not None} == {(r["offer_type"], r["channel"]): r["completion_rate"] for r in p.offer_completion_metrics.collect()}


def test_csv_stream_finds_columns_by_name(spark):
    import os

    from perkspark.streaming.journey_stream import read_stage_times, start_journey_stream

    work = tempfile.mkdtemp(prefix="perkspark-stream-")
    os.makedirs(f"{work}/in")
    with open(f"{work}/in/a.csv", "w") as fh:
        fh.write("time,value,customer_id,event\n5,{'offer id': 'o1'},c1,offer received\n9.0,{'offer_id': 'o1'},c1,offer completed\n")
    start_journey_stream(spark, f"{work}/in", f"{work}/out", f"{work}/ckpt", source_format="csv").awaitTermination()
    assert rows(read_stage_times(spark, f"{work}/out"), "customer_id", "offer_id", "received_time", "completed_time") == [("c1", "o1", 5, 9)]
