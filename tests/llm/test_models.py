"""Learned operators: held-out accuracy, degenerate inputs, and the suffix tree against a plain one."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_docs import SF_SMALL, empty, messy  # noqa: F401

from perkspark.llm import op2_quality_cnn as op2
from perkspark.llm import op3_toxicity_ftrl as op3
from perkspark.llm import op8_suffix_tree as op8
from perkspark.llm.convnet import ConvNet

SF = "/root/testdata/sf0.1"


def held_out(scored, labels, column):
    rows = scored.filter("held_out").join(labels, "doc_id").select(column, "predicted").collect()
    hit = Counter((r[0], r[1]) for r in rows)
    return hit[1, 1] / max(1, hit[1, 0] + hit[1, 1]), hit[0, 1] / max(1, hit[0, 0] + hit[0, 1])


def test_quality_on_the_held_out_fold(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    scored = op2.quality_scores(docs, labels, sample=2000)
    kept, junk = held_out(scored, labels, "quality")
    assert kept > 0.97 and junk < 0.25


def test_quality_learns_from_every_labelled_text(spark, monkeypatch):
    """More labelled documents than any sample, the only ones of label 0 longer than 64 KB; in rounds over shards, however the rows lie."""
    rng = np.random.default_rng(6)
    good, junk = ("the river runs past an old mill and the town sleeps ".split(), "$$$ 9x9 BUY>> #1!! %%% <<now ~~~ 77$".split())
    ids = [i for i in range(9000) if zlib.crc32(str(i).encode()) % 3 != 1][:4400]
    held = [i for i in range(9000) if zlib.crc32(str(i).encode()) % 3 == 1][:60]
    bad = {*ids[::400], *held[::2]}
    rows = [(i, " ".join(rng.choice(junk, 16_000) if i in bad and i in ids else rng.choice(junk if i in bad else good, 30))) for i in [*ids, *held]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i not in bad)) for i in [*ids, *held]], "doc_id long, quality int")
    assert min(len(t) for i, t in rows if i in bad and i in ids) > 1 << 16
    dealt = op2.dealt_texts(op2.labelled_texts(docs.union(docs.filter("doc_id % 9 = 0")), labels, "quality"), 3)  # copies teach once
    assert dealt.groupBy("shard").applyInArrow(lambda rows: rows.slice(0, 1), dealt.schema)._jdf.queryExecution().executedPlan().toString().count("Exchange") == 0
    learned = dealt.collect()
    assert len(learned) == len(ids)
    # ids too many to be sent: the same texts, and lengths without a shuffle of them
    monkeypatch.setattr("perkspark.llm.training.SENT_IDS", 10)
    monkeypatch.setattr("perkspark.llm.training.MOST_BUCKETS", 2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = op2.labelled_texts(docs, labels, "quality")
        sizes = shuffled.groupBy("doc_id").agg({"_bytes": "max"})._jdf.queryExecution().optimizedPlan().toString()
        assert "_text" not in sizes
        assert sorted(op2.dealt_texts(shuffled, 3).collect()) == sorted(learned)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.undo()
    assert {(r["doc_id"], bytes(r["_text"]).decode()) for r in learned} == {(i, t) for i, t in rows if i in ids}
    monkeypatch.setattr(op2, "SHARD_BYTES", 1 << 19)
    scores = [{r["doc_id"]: r["score"] for r in op2.quality_scores(d, labels).collect()} for d in (docs, docs.repartition(7))]
    assert scores[0] == pytest.approx(scores[1], abs=1e-6)
    assert all((scores[0][i] >= 0.5) == (i not in bad) for i in held)


def test_long_batches_are_learned_in_parts(monkeypatch):
    rng = np.random.default_rng(7)
    items = [rng.integers(1, 9, n).astype(np.uint8) for n in (5, 900, 40, 3000, 1, 700)]
    labels, weights = np.array([0, 1, 0, 1, 1, 0]), np.array([1.0, 2, 1, 2, 2, 1])
    net = ConvNet(9, 4, 64, 1, seed=2)
    whole = net._batch_gradients(items, labels, weights)
    monkeypatch.setattr("perkspark.llm.convnet.PART_BYTES", 1000)
    parts = net._batch_gradients(items, labels, weights)
    assert all(np.allclose(whole[k], parts[k], atol=1e-6) for k in net.params)


def test_toxicity_on_the_held_out_fold(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    caught, wrong = held_out(op3.toxicity_scores(docs, labels), labels, "toxic")
    assert caught > 0.7 and wrong < 0.005


def plain_ftrl(texts, labels):
    """FTRL-proximal by the published update, one coordinate at a time, over named features."""
    def features(text):
        words = [w.lower().strip(op3.EDGES) for w in text.split()]
        return {(0, w) for w in words} | {(1, *p) for p in zip(words, words[1:], strict=False)} | {(2, *p) for p in zip(words, words[2:], strict=False)}

    n, z = defaultdict(float), defaultdict(float)

    def weight(f):
        bias = f == "bias"
        l1, l2 = (0, 0) if bias else (op3.L1, op3.L2)
        return 0.0 if abs(z[f]) <= l1 else -(z[f] - math.copysign(l1, z[f])) / ((op3.BETA + math.sqrt(n[f])) / op3.ALPHA + l2)

    shuffle = np.random.default_rng(3)
    for _ in range(op3.EPOCHS):
        for i in shuffle.permutation(len(texts)):
            now = {f: weight(f) for f in [*sorted(features(texts[i])), "bias"]}
            p = 1 / (1 + math.exp(-max(-30, min(30, sum(now.values())))))
            g = (op3.POSITIVE_WEIGHT if labels[i] else 1.0) * (p - labels[i])
            for f, w in now.items():
                z[f] += g - (math.sqrt(n[f] + g * g) - math.sqrt(n[f])) / op3.ALPHA * w
                n[f] += g * g
    return lambda text: 1 / (1 + math.exp(-max(-30, min(30, sum(weight(f) for f in [*sorted(features(text)), "bias"])))))


def test_toxicity_against_plain_ftrl():
    """A few labelled texts are enough to learn from: L1 alone selects."""
    rng = np.random.default_rng(5)
    words = [f"w{i}".encode() for i in range(30)]
    texts = [b" ".join(rng.choice(words, 25)) + (b" Awful, thing" if i % 6 == 0 else b"") for i in range(54)]
    labels = np.array([int(i % 6 == 0) for i in range(54)])
    score, plain = op3.fit_scorer(texts, labels), plain_ftrl(texts, labels)
    fresh = [b"w1 w2 awful thing", b"w1 w2 w3", b"", texts[0], texts[1]]
    assert np.allclose(score(fresh), [plain(t) for t in fresh], atol=1e-9)
    assert score(fresh)[0] > score(fresh)[1] + 0.2


def test_long_texts_are_learned_within_the_sample(spark):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    docs = spark.createDataFrame([(i, "x " * (50_000 if i == ids[0] else 10)) for i in ids] + [(ids[1], "other")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int")
    texts, y = op3.labelled_sample(docs, labels, "toxic", 1000, total_bytes=1 << 20)
    assert len(texts) == len(y) == len(ids) and max(map(len, texts)) == 100_000
    short, _ = op3.labelled_sample(docs, labels, "toxic", 1000, total_bytes=200)
    assert 0 < len(short) and sum(map(len, short)) <= 200


@pytest.mark.parametrize("score", [op2.quality_scores, op3.toxicity_scores])
def test_scores_of_messy_rows(spark, messy, empty, score):
    labels = spark.createDataFrame([(5, 1, 0), (7, 0, 1), (11, 1, 1), (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    rows = score(messy, labels).collect()
    assert len(rows) == messy.count() and all(0 <= r["score"] <= 1 for r in rows)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(b"" if r["doc_id"] is None else str(r["doc_id"]).encode()) % 3 == 1)
    assert score(empty, labels).count() == 0
    none = score(messy, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}


def test_accepted_documents(spark, messy, empty):
    labels = spark.createDataFrame([(5, 1, 0), (7, 0, 1)], "doc_id long, quality int, toxic int")
    out = op2.good_documents(messy, labels)
    assert out.columns == messy.columns and out.count() <= messy.count()
    assert op2.good_documents(messy, labels.limit(0)).count() == messy.count()
    assert op2.good_documents(empty, labels).count() == 0


END, START = "<end>", "<start>"


class PlainTree:
    def __init__(self, texts):
        seqs = [[*(t or b"").lower().split(), END] for t in texts]
        self.c = Counter(w for s in seqs for w in s)
        self.n, self.v = sum(self.c.values()), len(self.c)
        follow = [defaultdict(Counter) for _ in range(op8.DEPTH)]
        for s in seqs:
            before = [START, *s[:-1]]
            for i, w in enumerate(s):
                for k in range(1, op8.DEPTH + 1):
                    if i + 1 - k >= 0:
                        follow[k - 1][tuple(before[i + 1 - k : i + 1])][w] += 1
        frequent, least = op8.CONTEXT_LEAST, op8.LEAST
        total = {(w,): n for w, n in self.c.items() if w != END and n >= frequent}
        if len(seqs) >= frequent:
            total[(START,)] = len(seqs)
        self.states = {}
        for k in range(op8.DEPTH):
            found, longer = {}, {}
            for ctx, n in total.items():
                entries = {w: x for w, x in follow[k][ctx].items() if x >= least}
                divergence, listed, below = 0.0, 0.0, 0.0
                for w, x in entries.items():
                    q = self.p(ctx, w, k)
                    divergence += x / n * math.log(x / n / q)
                    listed, below = listed + x / n, below + q
                    if x >= frequent and w != END:
                        longer[(*ctx, w)] = x
                left = max(0, 1 - listed)
                if left > 1e-12:
                    divergence += left * math.log(left / max(1 - below, 1e-12))
                if n * divergence >= op8.SIGNIFICANCE:
                    mass = {w: (x - op8.DISCOUNT) / n for w, x in entries.items()}
                    found[ctx] = (mass, 1 - sum(mass.values()))
            self.states |= found
            total = longer

    def base(self, w):
        return (self.c[w] + 0.1) / (self.n + 0.1 * (self.v + 1))

    def p(self, ctx, w, below):
        p = self.base(w)
        for k in range(1, below + 1):
            if ctx[-k:] in self.states and len(ctx) >= k:
                mass, rest = self.states[ctx[-k:]]
                p = mass.get(w, 0) + rest * p
        return p

    def score(self, text):
        s = [*(text or b"").lower().split(), END]
        before = [START, *s[:-1]]
        return [sum(math.log10(self.base(w)) for w in s), sum(math.log10(self.p(tuple(before[max(0, i + 1 - op8.DEPTH) : i + 1]), w, min(i + 1, op8.DEPTH))) for i, w in enumerate(s))]


def compare_scores(docs, split_bytes):
    rows = [(r["doc_id"], None if r["text"] is None else r["text"].encode()) for r in docs.select("doc_id", "text").collect()]
    fold = {i: zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0 for i, _ in rows}
    tree = PlainTree([t for i, t in rows if not fold[i]])
    got = Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5), round(r["score"], 5)) for r in op8.suffix_tree_scores(docs, split_bytes).collect())
    want = Counter()
    for i, t in rows:
        s = [*(t or b"").lower().split(), END]
        base, score = tree.score(t)
        want[(i, fold[i], len(s), sum(tree.c[w] > 0 for w in s), tree.n, round(base, 5), round(score, 5))] += 1
    assert got == want


def test_suffix_tree_against_plain(spark):
    compare_scores(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), 1 << 16)


def test_what_the_suffix_tree_keeps_does_not_fall_with_the_corpus(spark):
    """A passage found three times lifts its own score, however many other words there are."""
    passage = " ".join(f"rare{i}" for i in range(30))
    train = [i for i in range(20_000) if zlib.crc32(str(i).encode()) % 10 != 0]
    rows = [(i, " ".join(f"w{(i * 31 + k * k) % 997}" for k in range(60))) for i in train[3:8000]] + [(i, passage) for i in train[:3]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in op8.suffix_tree_scores(docs).collect()}
    assert got[train[0]]["score"] > got[train[0]]["base_score"] / 4


def test_packed_keys_are_whole_and_small():
    """Ten thousand sorted 64-bit keys of a hundredth of the hash space take less than six bytes each, small counts a fraction of one."""
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(-(2**63), 2**63 - 1, 1_000_000))
    counts = rng.geometric(0.7, len(keys))
    packed = op8._packed(7, False, keys, counts, 101)
    assert np.array_equal(np.sort(np.concatenate(op8._keys(packed.column("keys").to_pylist()))), keys)
    merged = op8.Merged(packed, np.int64)
    assert dict(zip(merged.keys.tolist(), merged.values[0].tolist(), strict=True)) == dict(zip(keys.tolist(), counts.tolist(), strict=True))
    assert sum(map(len, packed.column("keys").to_pylist())) < 6 * len(keys) and sum(map(len, packed.column("data").to_pylist())) < 0.3 * len(keys)
    values = rng.random((5, 300)).reshape(-1)
    assert np.array_equal(op8._numbers([op8._planes(values), op8._planes(values[:0])], np.float64)[0], values)
    edges = np.array([-(2**63), -1, 0, 2**63 - 1])
    assert np.array_equal(op8._keys([op8._gaps(edges)])[0], edges) and len(op8._keys([op8._gaps(edges[:0])])[0]) == 0


def test_keys_are_ordered_by_hash_then_place():
    """Equal keys as they come, and keys that differ in their last bits alone."""
    rng = np.random.default_rng(8)
    keys = np.concatenate([rng.integers(-(2**63), 2**63 - 1, 3000), np.arange(-5, 300), np.arange(300, -5, -1), [-1, -2, 0]])
    keys = np.concatenate([keys, keys[::3]])
    want = np.argsort(keys.view(np.uint64), kind="stable")
    assert np.array_equal(op8._order(keys), want) and len(op8._order(keys[:0])) == 0
    distinct, first, where = op8._distinct(keys)
    assert np.array_equal(distinct, np.unique(keys.view(np.uint64)).view(np.int64)) and np.array_equal(distinct[where], keys)
    assert all(f == np.flatnonzero(keys == k)[0] for k, f in zip(distinct.tolist(), first.tolist(), strict=True))


def test_splits_are_told_no_keys():
    """What a range sends back for ten thousand keys of each split, with those found three times kept, takes less than a byte and a half a key."""
    rng = np.random.default_rng(9)
    keys, ranges = np.unique(rng.integers(-(2**63), 2**63 - 1, 20_000)), 3
    parts = [np.sort(rng.choice(keys, 10_000, replace=False)) for _ in range(4)]
    packed = op8.pa.concat_tables([op8._packed(i, False, part, np.ones(len(part), np.int64), ranges) for i, part in enumerate(parts)])
    total = Counter(k for part in parts for k in part.tolist())
    told = [op8._totals(packed.filter(op8.pa.compute.field("range") == r), 1, 3) for r in range(ranges)]
    told = op8.pa.concat_tables(told)
    size = sum(len(x) for name in ("keep", "data", "owner", "ranks") for x in told.column(name).to_pylist())
    assert size < 1.5 * sum(map(len, parts))
    names = defaultdict(set)
    for i, part in enumerate(parts):
        own = told.filter(op8.pa.compute.field("split") == i).sort_by("range")
        part = part[np.argsort(part.view(np.uint64))]
        keep, values = op8._flags(own.column("keep").to_pylist()), np.concatenate(op8._numbers(own.column("data").to_pylist(), np.int64))
        assert dict(zip(part[keep].tolist(), values.tolist(), strict=True)) == {k: total[k] for k in part.tolist() if total[k] >= 3}
        ranks = zip(np.repeat(own.column("range").to_numpy(), [len(x) for x in op8._keys(own.column("ranks").to_pylist())]).tolist(), np.concatenate(op8._keys(own.column("ranks").to_pylist())).tolist(), strict=True)
        for k, name in zip(part[keep].tolist(), ranks, strict=True):
            names[name].add(k)
    assert all(len(x) == 1 for x in names.values()) and len(names) == sum(n >= 3 for n in total.values())


def test_suffix_tree_leaves_no_merged_rows(spark):
    """What the ranges give out is dropped once the splits have it."""
    before = {r["tableName"] for r in spark.sql("SHOW TABLES").collect()}
    op8.suffix_tree_scores(spark.createDataFrame([(i, "a b c d " * (i % 5)) for i in range(60)], "doc_id long, text string")).count()
    left = {r["tableName"] for r in spark.sql("SHOW TABLES").collect()} - before
    assert sorted(name.rsplit("_", 1)[0] for name in left) == ["suffix_dealt", "suffix_known"]


def test_suffix_tree_of_messy_rows(messy, empty, spark):
    compare_scores(messy, 1 << 14)
    assert op8.suffix_tree_scores(empty).count() == 0
    untrained = spark.createDataFrame([(i, "some words here") for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0], "doc_id long, text string")
    assert {(r["n_known"], r["train_tokens"], r["score"]) for r in op8.suffix_tree_scores(untrained).collect()} == {(0, 0, 0.0)}


def plain_forward(net, item):
    """One item's probability, window by window, with zeros around it."""
    width, p = len(net.params["table"]), net.params
    rows = max(1, -(-len(item) // net.hop))
    padded = np.concatenate([item, np.zeros(rows * net.hop + width - len(item), np.uint8)])
    best = [[sum(p["table"][k][padded[r * net.hop + i + k]] for k in range(width)) for i in range(0, net.hop, net.stride)] for r in range(rows)]
    best = np.array(best).max(axis=1)
    chunks = [np.maximum(np.maximum(best[r], best[min(r + 1, rows - 1)]) + p["shift"], 0) for r in range(max(1, rows - 1))]
    logit = np.mean(chunks, axis=0) @ p["mean"] + np.max(chunks, axis=0) @ p["max"] + p["bias"][0]
    return 1 / (1 + math.exp(-logit))


@pytest.mark.parametrize(("hop", "stride"), [(32, 1), (16, 2)])
def test_a_score_depends_on_its_own_item_alone(hop, stride):
    rng = np.random.default_rng(2)
    net = ConvNet(12, 5, hop, stride, seed=3)
    items = [rng.integers(1, 12, n).astype(np.uint8) for n in [0, 1, *range(hop - 9, hop + 3), 2 * hop - 7, 2 * hop, 5 * hop - 1]]
    together = net.score(items)
    # up to the last bits: the products of a batch may be summed in another order
    assert np.allclose(together, [net.score([x])[0] for x in items], rtol=0, atol=1e-7)
    assert np.allclose(together, net.score(items[::-1])[::-1], rtol=0, atol=1e-7)
    assert np.allclose(together, [plain_forward(net, x) for x in items], atol=1e-5)


def test_quality_reads_every_byte_offset():
    assert op2.STRIDE == 1
