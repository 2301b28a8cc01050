"""The Merkle manifest against a plain version and its SQL."""

import hashlib
from collections import Counter, defaultdict

import duckdb
from llm_docs import SF_SMALL, docs_of, empty, messy  # noqa: F401
from pyspark.sql import functions as F

from perkspark.llm import op12_merkle_manifest as op12

LOWER = str.maketrans(op12.UPPER, op12.LOWER)


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_levels(digests, fanout):
    levels = [digests]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest(*below[i : i + fanout]) for i in range(0, len(below), fanout)])
    return levels


def plain_path(levels, at, fanout):
    """(before, after) of each level from the leaf up."""
    path = []
    for level in levels[:-1]:
        first = at - at % fanout
        path.append(("".join(level[first:at]), "".join(level[at + 1 : first + fanout])))
        at //= fanout
    return path


def plain_manifest(rows, fanout, altered):
    by_source = defaultdict(list)
    for row in rows:
        by_source[row["source"]].append((row["doc_id"], plain_leaf(row, row["text"]), plain_leaf(row, altered(row["text"]))))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for leaves in by_source.values():
        leaves.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = {s: plain_levels([leaf for _, leaf, _ in by_source[s]], fanout) for s in order}
    crown = plain_levels([trees[s][-1][0] for s in order], fanout)
    out = Counter()
    for k, source in enumerate(order):
        for i, (doc_id, leaf, found) in enumerate(by_source[source]):
            path = plain_path(trees[source], i, fanout) + plain_path(crown, k, fanout)
            node = found
            for before, after in path:
                node = digest(before, node, after)
            root = crown[-1][0]
            out[doc_id, leaf, trees[source][-1][0], root, digest(*(a + b for a, b in path)), node, node == root] += 1
    return out


def altered(text):
    return text.translate(LOWER) if text is not None else None


def check(docs, fanout):
    got = op12.manifest(docs, F.translate("text", op12.UPPER, op12.LOWER), fanout)
    assert Counter(map(tuple, got.collect())) == plain_manifest(docs.collect(), fanout, altered)


def test_manifest_of_messy_rows(messy, empty):
    for fanout in (2, 3, 16):
        check(messy, fanout)
    assert op12.manifest(empty).count() == 0
    assert op12.manifest(messy).filter("not verified").count() == 0


def test_hot_source_and_sources_of_one_row(spark):
    rows = [(i, f"Text {i % 50}", "hot") for i in range(700)] + [(2000 + i, "Own", f"s{i:03d}") for i in range(300)]
    rows += [(3000, "A", None), (3001, "a", "é"), (3002, "a", "z"), (3003, "a", "")] + [(4000 + i, "B", "run") for i in range(17)]
    check(docs_of(spark, rows), 16)
    check(docs_of(spark, rows[:1]), 16)


def test_equal_rows(spark):
    check(docs_of(spark, [(7, "Same", "a")] * 3000 + [(8, "other", "a")]), 16)


def test_only_requested_leaves_are_descended_to(spark):
    leaves = spark.range(500).select(F.lit("t").alias("tree"), F.sha2(F.col("id").cast("string"), 256).alias("digest"), F.lit(500).alias("size"), F.col("id").alias("rank"))
    forest = op12.Forest(op12.runs_of(leaves, 16), 16)
    tops = forest.tops.select("tree", "size", "rank", "digest", F.array().cast(op12.NO_PATH).alias("path"))
    wanted = spark.createDataFrame([("t", 3), ("t", 499)], "tree string, rank long")
    got = {r["rank"]: (r["digest"], len(r["path"])) for r in forest.descend(tops, wanted).collect()}
    assert got == {i: (digest(str(i)), 3) for i in (3, 499)}


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    got = op12.op12_merkle_manifest(spark, SF_SMALL)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({op12.ORACLE_SQL})").fetchall()
    rows = Counter(map(tuple, got.collect()))
    assert rows == Counter(want) and {r[-1] for r in rows} == {True, False}
