"""Near duplicates and kNN against brute force, components, and the pipeline's invariants."""

import math
import random
from collections import Counter

from llm_docs import SF_SMALL, docs_of, empty, messy, prose  # noqa: F401

import corpus_pipeline
from perkspark.llm import op5_tensored_minhash as op5
from perkspark.llm import op6_voronoi_knn as op6
from perkspark.llm.components import components


def plain_components(rows, width, percent=80):
    def shingles(text):
        w = (text or "").encode().lower().split()
        if not w:
            return frozenset()
        return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1)))

    sets = [(i, shingles(t)) for i, t, _ in rows]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return Counter((i, len(s), root(i)) for i, s in sets)


def edited(text, share, seed):
    rng = random.Random(seed)
    return " ".join(w if rng.random() > share else f"x{rng.randrange(999)}" for w in text.split())


def test_near_copies_against_brute_force(spark):
    """A large group of copies of one text, edited so that many pairs lie about the threshold."""
    text, other = prose(50, 200), prose(51, 90)
    rows = [(i, edited(text, 0.05 + 0.03 * (i % 3), i), "a") for i in range(100, 220)]
    rows += [(i, edited(other, 0.02, i), "b") for i in range(300, 330)] + [(i, prose(i, 60), "c") for i in range(400, 450)]
    rows += [(10, text, "a"), (11, text.upper(), "a"), (12, "", "a"), (13, None, "a"), (14, "one", "a"), (15, "ONE", "a"), (16, "one two", "a")]
    for width in (2, 5):
        got = op5.near_duplicates(docs_of(spark, rows), width).collect()
        assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == plain_components(rows, width)
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_copies_below_the_threshold_make_no_pairs(spark):
    """300 copies of one text, most of them too far apart, and some chains among them; tiny blocks."""
    text = prose(77, 150)
    rows = [(i, edited(text, 0.06 + 0.02 * (i % 7), i), "a") for i in range(1, 301)]
    rows += [(1000 + i, edited(rows[250 + i][1], 0.01, i), "a") for i in range(30)]
    docs = docs_of(spark, rows)
    want = plain_components(rows, 2)
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in op5.near_duplicates(docs, 2).collect())
    assert sum((want - got).values()) <= 3  # each miss has a probability of 7e-4 at most
    assert 40 < len({c for *_, c in want}) < 320
    whole = op5.BLOCK
    try:
        op5.BLOCK = 900
        assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in op5.near_duplicates(docs, 2).collect()) == got
    finally:
        op5.BLOCK = whole


def test_deduplicated_rows_with_clashing_names(spark):
    names = "doc_id long, text string, _id long, _nth int, node string, row string, h int, `a.b` int"
    docs = spark.createDataFrame([(1, "one two three", 5, 1, "n", "r", 3, 4), (2, "one two three", 6, 1, "n", "r", 3, 4), (None, "x", 7, 1, "n", "r", 3, 4)], names)
    kept = op5.deduplicated(docs)
    assert kept.columns == docs.columns and {(r["doc_id"], r["_id"], r["a.b"]) for r in kept.collect()} == {(1, 5, 4), (None, 7, 4)}


def test_near_duplicates_of_messy_rows(messy, empty):
    got = Counter((r["doc_id"], r["component_id"], r["kept"]) for r in op5.near_duplicates(messy, 2).collect())
    assert sum(got.values()) == messy.count()
    assert got[6, 5, False] == 2 and got[9, 5, False] == 1 and got[None, 5, False] == 1 and got[1, 1, True] == 1
    kept = op5.deduplicated(messy)
    assert kept.columns == messy.columns
    assert Counter(r["doc_id"] for r in kept.collect())[11] == 1
    assert op5.near_duplicates(empty, 2).count() == 0 and op5.deduplicated(empty).count() == 0


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1200)] + [(5, 5), (7, 8)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 1000 for i in range(1000, 1200)}


def test_knn_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(80)]  # ties beyond k
    rows += [(2000, None), (2001, [1.0, None, 2.0, 0.0, 0.0, 1.0]), (2020, [float("nan")] * 6), (None, [1.0] * 6), (2040, [1.0, 2.0]), (2041, [2.0, 1.0]), (40, rows[40][1])]
    frame = spark.createDataFrame([(i, v, i, 0) for i, v in rows], "vec_id long, embedding array<float>, rank long, score int")
    import numpy as np

    whole = [(i, np.floor(64 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    want = Counter()
    for q, a in whole:
        if q % 20 == 0:
            scored = sorted((-int(a @ b), i) for i, b in whole if i != q and len(a) == len(b))[:20]
            want.update((q, n + 1, i, -s) for n, (s, i) in enumerate(scored))
    for pivots, block in ((8, 40), (64, 8192)):
        got = op6.top_k(frame, "vec_id % 20 = 0", pivots=pivots, block=block).collect()
        assert Counter(map(tuple, got)) == want
    assert op6.top_k(frame.limit(0), "vec_id % 20 = 0").count() == 0


def test_knn_of_an_id_with_a_third_of_the_rows(spark):
    """Its own rows fill the nearest cells, and none of them is a neighbour of it."""
    rng = random.Random(4)
    rows = [(20, [30.0 + rng.gauss(0, 0.1) if d == 0 else rng.gauss(0, 0.1) for d in range(4)]) for _ in range(100)]
    rows += [(1000 + 2 * i + 1, [rng.gauss(0, 3) for _ in range(4)]) for i in range(200)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = [(i, [math.floor(64 * x) for x in v]) for i, v in rows]
    want = Counter()
    for q, a in whole:
        if q == 20:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in whole if i != q)[:20]
            want.update((q, n + 1, i, -s) for n, (s, i) in enumerate(scored))
    got = op6.top_k(frame, "vec_id % 20 = 0", pivots=300, block=64).collect()
    assert Counter(map(tuple, got)) == want


def test_knn_of_large_vectors(spark):
    """Finite vectors whose products float64 does not hold, among ordinary ones; what no long holds is at its bounds."""
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 3) for _ in range(4)]) for i in range(300)]
    rows += [(400, [3e6, 1.0, 0.0, 0.0]), (401, [3e6 + 1 / 64, 1.0, 0.0, 0.0]), (402, [3e6, 1.0 + 1 / 64, 0.0, 0.0]), (420, [-4e7, 2.0, 1e3, 5.0]), (403, [7e7, 0.25, 3.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = [(i, [math.floor(64 * x) for x in v]) for i, v in rows]
    want = Counter()
    for q, a in whole:
        if q % 20 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in whole if i != q)[:20]
            want.update((q, n + 1, i, -s) for n, (s, i) in enumerate(scored))
    for pivots, block in ((8, 40), (None, 8192)):
        assert Counter(map(tuple, op6.top_k(frame, "vec_id % 20 = 0", pivots=pivots, block=block).collect())) == want
    huge = spark.createDataFrame([(20, [1e300, 1.0]), (1, [1e300, 0.0]), (2, [-1e300, 0.0]), (3, [1.0, 1.0])], "vec_id long, embedding array<double>")
    got = [(r["vec_id"], r["score"]) for r in op6.top_k(huge, "vec_id = 20").orderBy("rank").collect()]
    assert [i for i, _ in got] == [1, 3, 2] and got[0][1] == 2**63 - 1 and got[2][1] == -(2**63)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_duplicates", "secrets", "mixing", "packing"]
    good = stages["quality"](spark, docs, SF_SMALL)
    assert good.columns == docs.columns and good.exceptAll(docs).count() == 0
    single = stages["near_duplicates"](spark, docs, SF_SMALL)
    want = plain_components([(r["doc_id"], r["text"], None) for r in docs.collect()], 5)
    assert {r["doc_id"] for r in single.collect()} == {i for i, _, c in want if i == c}
    masked = stages["secrets"](spark, docs, SF_SMALL)
    assert masked.count() == docs.count() and masked.filter("text rlike '[0-9a-f]{24}'").count() == 0
    mixed = stages["mixing"](spark, docs, SF_SMALL)
    assert mixed.columns == docs.columns and mixed.groupBy("doc_id").count().filter("count > 2").count() == 0
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert rows and all(1 <= r["length"] <= 2048 for r in rows)
