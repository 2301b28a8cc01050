"""Cube mixing and vector packing: contracts, balance and round trips."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_docs import SF_SMALL, docs_of, empty, messy  # noqa: F401
from pyspark.sql import functions as F

from perkspark.llm import op1_cube_mixing as op1
from perkspark.llm import op7_packing as op7
from perkspark.llm.queries import QUERIES


def wanted_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    """Targets by resharing the excess round by round."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * level > cap * sizes[s]}
        if not above:
            target |= {s: weight[s] * level for s in open_}
            break
        for s in above:
            target[s] = cap * sizes[s]
            left -= target[s]
        open_ -= above
    return target


def test_mix_meets_targets(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = op1.cube_mix(docs, block=16).collect()
    sizes, taken = Counter(), Counter()
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    targets = wanted_targets(sizes)
    for r in rows:
        assert r["target"] == pytest.approx(targets[r["source"]]) and r["source_size"] == sizes[r["source"]]
    for s, target in targets.items():
        assert abs(taken[s] - target) <= 0.02 * target + 5
    again = op1.cube_mix(docs.repartition(7), block=16).collect()
    key = ("doc_id", "taken")
    assert sorted(tuple(r[k] for k in key) for r in rows) == sorted(tuple(r[k] for k in key) for r in again)


def test_flight_holds_both_totals():
    rng = np.random.default_rng(0)
    size = rng.integers(0, 500, 400).astype(float).tolist()
    out = op1.flight([0.37] * 400, size, np.random.default_rng(1))
    assert sum(0 < p < 1 for p in out) <= 2
    assert sum(out) == pytest.approx(0.37 * 400)
    assert np.dot(out, size) == pytest.approx(0.37 * sum(size))
    mean = np.mean([np.array(op1.flight([0.3] * 40, size[:40], np.random.default_rng(s))) for s in range(400)], axis=0)
    assert abs(mean - 0.3).max() < 0.12  # each keeps its inclusion probability


def test_mix_of_messy_rows(messy, empty):
    rows = op1.cube_mix(messy).collect()
    assert len(rows) == messy.count()
    assert {r["taken"] for r in rows if r["size"] == 0} == {0}
    mixed = op1.mixed_documents(messy)
    assert mixed.columns == messy.columns
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter({i: n for i, n in Counter({i: sum(r["times"] for r in rows if r["doc_id"] == i) for i in {r["doc_id"] for r in rows}}).items() if n})
    assert op1.cube_mix(empty).count() == 0 and op1.mixed_documents(empty).count() == 0


def test_mix_deals_equal_rows_to_many_blocks(spark):
    """A third of the rows are one row; their numbers tell them apart, and reruns still agree."""
    rows = [(7, "the same few words", "a")] * 30_000 + [(100 + i, "word " * (i % 50), "ab"[i % 2]) for i in range(2_000)]
    docs = docs_of(spark, rows).select("doc_id", "text", "source")
    sized = docs.select("doc_id", "source", F.length("text").alias("size"), F.xxhash64("text").alias("text_hash"))
    numbered = op1._numbered(sized)
    assert numbered.filter("doc_id = 7").select("nth").distinct().count() == 30_000 and numbered.count() == 32_000
    first = op1.cube_mix(docs)
    taken = Counter((r["doc_id"], r["taken"]) for r in first.collect())
    assert sum(taken.values()) == 32_000 and taken == Counter((r["doc_id"], r["taken"]) for r in op1.cube_mix(docs.repartition(5)).collect())
    sums = first.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r["taken"] - r["target"]) <= 0.02 * r["target"] + 5 for r in sums)


def check_packed(rows, texts, capacity):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for doc_id, text in texts:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for s in range(0, len(ids), capacity):
            piece = ids[s : s + capacity]
            want[(doc_id, s, len(piece), zlib.crc32(piece.tobytes()), len(ids))] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return sequences


def test_packing_round_trip(spark, messy, empty):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    sequences = check_packed(op7.pack_documents(docs).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()], 2048)
    used = sum(n for s in sequences.values() for _, n in s)
    assert used / (2048 * len(sequences)) > 0.97
    check_packed(op7.pack_documents(messy, capacity=64).collect(), [(r["doc_id"], r["text"]) for r in messy.collect()], 64)
    assert op7.pack_documents(empty).count() == 0


def test_words_as_the_tokenizer_cuts_them():
    import public_tokenizers

    ids = op7.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    text = "Don't STOP!! L'ÉTÉ ÀÖß×÷ÿ 東京 áb <|endoftext|> İI ΣΑΣ 12ab34 ''s'll ªº²µ !'s x y"
    text += " foo<|endoftext|>bar <|startoftext|> <|ENDOFTEXT|> <|endoftext|><|endoftext|> \u3000x\u00a0y "
    words, ends = op7.split_words(pa.array([b"", text.encode(), None, b" \t a\n"]))
    tokens, counts = ids.encode(words)
    plain = [ids.tokenizer.encode(t, add_special_tokens=False).ids for t in (text, "a")]
    assert tokens.tolist() == plain[0] + plain[1] and 49407 in plain[0]
    assert ends.tolist() == [0, len(text.encode().split()), len(text.encode().split()), len(text.encode().split()) + 1]


def test_equal_rows_are_dealt_over_blocks(spark):
    rows = op7.pack_documents(docs_of(spark, [(1, "the same text", "a")] * 4000), capacity=16, max_segments=8).collect()
    check_packed(rows, [(1, "the same text")] * 4000, 16)
    many = spark.range(40_000).select(F.lit(1).cast("long").alias("tokens"), F.lit(1).cast("long").alias("segments"), F.lit(0).cast("long").alias("loss_tokens"), F.xxhash64(F.monotonically_increasing_id()).alias("_h"))
    blocks = op7.pack_examples(many, 8, 8, 8, block=1000).groupBy((F.col("sequence_id") / (1 << 32)).cast("long")).count()
    assert blocks.count() == 40 and blocks.agg(F.max("count")).first()[0] < 1300


def test_three_limits_hold(spark):
    turns = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    examples = op7.conversation_examples(turns)
    packed = op7.pack_examples(examples, max_tokens=600, max_segments=12, max_loss_tokens=250, block=64)
    assert packed.count() == examples.count()
    over = packed.groupBy("sequence_id").agg(F.sum("tokens").alias("t"), F.sum("segments").alias("s"), F.sum("loss_tokens").alias("l"), F.count("*").alias("n"))
    assert over.filter("n > 1 and (t > 600 or s > 12 or l > 250)").count() == 0
    assert over.count() < examples.count()


def test_registered_queries_cover_their_tables(spark):
    n = spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    assert QUERIES["op1_cube_mixing"](spark, SF_SMALL).count() == n


def test_words_kept_by_a_task_stay_few():
    """A task's memory does not grow with the distinct words that it meets, and the ids stay the same."""
    import corpus_pipeline
    import public_tokenizers

    words = op7.WordIds(public_tokenizers.path("word_bpe_49k.json"), corpus_pipeline.CACHE_WORDS)
    for k in range(14):
        words.encode(pa.array([b"w%d" % i for i in range(k * 50_000, (k + 1) * 50_000)], pa.large_binary()))
        assert len(words.words.number) <= corpus_pipeline.CACHE_WORDS + 50_000 < 400_000
    ids, _ = words.encode(pa.array([b"w3", b"w699999"], pa.large_binary()))
    assert ids.tolist() == [i for w in ("w3", "w699999") for i in words.tokenizer.encode(w, add_special_tokens=False).ids]
