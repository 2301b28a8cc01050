"""Interval operators against brute force, including a hot key."""

import random

from perkspark.operators.interval_join import interval_sums, range_join


def _data(seed=7, keys=6, points=400, intervals=120):
    rnd = random.Random(seed)
    # key k0 holds about a third of all rows (hot key)
    def key():
        return "k0" if rnd.random() < 0.34 else f"k{rnd.randint(1, keys)}"

    pts = [(key(), rnd.randint(0, 200), None if rnd.random() < 0.1 else round(rnd.uniform(0, 50), 2)) for _ in range(points)]
    ivs = []
    for i in range(intervals):
        lo = rnd.randint(-5, 200)
        hi = lo + rnd.randint(-10, 90)  # some empty (hi < lo)
        ivs.append((key(), f"i{i}", lo, hi))
    return pts, ivs


def test_range_join_matches_brute_force(spark):
    pts, ivs = _data()
    p = spark.createDataFrame(pts, "k string, t int, v double")
    i = spark.createDataFrame(ivs, "k string, iid string, lo int, hi int")
    key = lambda x: (x[0], x[1], -1.0 if x[2] is None else x[2], x[3])
    got = sorted(((r.k, r.t, r.v, r.iid) for r in range_join(p, i, "k", "t", "lo", "hi", bin_width=7).collect()), key=key)
    want = sorted(
        ((pk, t, v, iid) for pk, t, v in pts for ik, iid, lo, hi in ivs if pk == ik and lo <= t <= hi), key=key
    )
    assert len(want) > 100
    assert got == want


def test_interval_sums_matches_brute_force(spark):
    pts, ivs = _data(seed=11)
    p = spark.createDataFrame(pts, "k string, t int, v double")
    i = spark.createDataFrame(ivs, "k string, iid string, lo int, hi int")
    out = {r.iid: (r.matched, r.matched_values, r.value_sum) for r in interval_sums(p, i, "k", "t", "v", "lo", "hi").collect()}
    assert len(out) == len(ivs)
    for k, iid, lo, hi in ivs:
        inside = [v for pk, t, v in pts if pk == k and lo <= t <= hi]
        vals = [v for v in inside if v is not None]
        n, nn, s = out[iid]
        assert n == len(inside) and nn == len(vals)
        if vals:
            assert abs(s - sum(vals)) < 1e-9
        else:
            assert s is None


def test_heavy_keys_are_dealt_over_several_running_sums(spark):
    from perkspark.plans.skew import heavy_keys

    pts, ivs = _data(seed=13, points=900, intervals=400)
    p = spark.createDataFrame(pts, "k string, t int, v double")
    i = spark.createDataFrame(ivs, "k string, iid string, lo int, hi int")
    spark.conf.set("perkspark.skew.heavyRows", "30")
    try:
        hot = heavy_keys(i, "k")
        assert {r.k: r.deals for r in hot.collect()}["k0"] >= 4
        got = interval_sums(p, i, "k", "t", "v", "lo", "hi", hot=hot).collect()
    finally:
        spark.conf.unset("perkspark.skew.heavyRows")
    want = interval_sums(p, i, "k", "t", "v", "lo", "hi").collect()
    key = lambda r: r.iid
    assert sorted(got, key=key) == sorted(want, key=key) and len(got) == len(ivs)


def test_sums_of_odd_values_and_keys(spark):
    """Money is exact beside huge amounts; nulls match nothing; equal intervals are one."""
    pts = [("a", 1, 1e25), ("a", 2, 0.1), ("a", 3, 0.2), ("a", 4, 1e-12), ("b", 1, float("inf")), ("b", 2, 5.0), ("b", 3, None), (None, 2, 1.0), ("a", None, 1.0)]
    ivs = [("a", "later", 2, 3), ("a", "tiny", 2, 4), ("a", "all", 0, 9), ("b", "with", 0, 2), ("b", "after", 2, 3), (None, "none", 0, 9), ("a", "open", None, 3)]
    p = spark.createDataFrame(pts, "k string, t int, v double")
    i = spark.createDataFrame([*ivs, ivs[0]], "k string, iid string, lo int, hi int")
    out = {}
    for r in interval_sums(p, i, "k", "t", "v", "lo", "hi").collect():
        out.setdefault(r.iid, []).append((r.matched, r.matched_values, r.value_sum))
    assert out["later"] == [(2, 2, 0.3)] * 2 and out["all"] == [(4, 4, 1e25)]
    assert out["tiny"][0][:2] == (3, 3) and abs(out["tiny"][0][2] - 0.300000000001) < 1e-15
    assert out["with"] == [(2, 2, float("inf"))] and out["after"] == [(2, 1, 5.0)]
    assert out["none"] == out["open"] == [(0, 0, None)]
    some = interval_sums(p, i, "k", "t", "v", "lo", "hi", keep_empty=False)
    assert some.columns[:4] == i.columns and {r.iid for r in some.collect()} == {"later", "tiny", "all", "with", "after"}


def test_interval_bounds_are_inclusive(spark):
    p = spark.createDataFrame([("c", 10, 1.0), ("c", 20, 2.0), ("c", 9, 4.0), ("c", 21, 8.0)], "k string, t int, v double")
    i = spark.createDataFrame([("c", "x", 10, 20), ("c", "y", 15, 14)], "k string, iid string, lo int, hi int")
    got = {r.iid: (r.matched, r.value_sum) for r in interval_sums(p, i, "k", "t", "v", "lo", "hi").collect()}
    assert got == {"x": (2, 3.0), "y": (0, None)}


def test_long_intervals_are_binned_in_chunks_and_match_brute_force(spark):
    pts, ivs = _data(seed=5)
    # intervals far longer than max_bins bins: enumerated in many chunks
    ivs += [("k0", "long0", -10, 10_000), ("k1", "long1", 3, 200_000), ("k2", "long2", 50, 5_000)]
    p = spark.createDataFrame(pts, "k string, t int, v double")
    i = spark.createDataFrame(ivs, "k string, iid string, lo int, hi int")
    key = lambda x: (x[0], x[1], -1.0 if x[2] is None else x[2], x[3])
    got = sorted(
        ((r.k, r.t, r.v, r.iid) for r in range_join(p, i, "k", "t", "lo", "hi", bin_width=7, max_bins=16).collect()),
        key=key,
    )
    want = sorted(
        ((pk, t, v, iid) for pk, t, v in pts for ik, iid, lo, hi in ivs if pk == ik and lo <= t <= hi), key=key
    )
    assert any(r[3].startswith("long") for r in want)
    assert got == want
