"""MinHash near-dedup with tensored banding.

A document is the set of its word shingles as 64-bit hashes.  Documents with
equal sets are one class, linked without any comparison.  Each class gets
``COLLECTIONS`` collections of ``ROWS`` minhashes.  A table's key is a pair of
collections, so that 14 collections (42 minhashes) make 91 tables of six
minhashes each, which would otherwise take 546.  Two sets of similarity 0.8 miss
all tables with probability 7e-4, of 0.85 with 4e-5.

Classes that share a key are candidates.  Within a key every class is first
compared with the smallest one (a star, not all pairs).  Links that pass the
test on full sets give components.  Where classes of one key are still in
different components, the largest of these stands for the key, and the key's other
classes are questions to it: all questions to a component are compared with its
classes and with each other, in blocks of about ``BLOCK`` shingles a side, so that a
task holds two blocks of sets and gives out only the pairs that agree.  No pair of
classes is a row before it is a link, so a group of copies, whether its members
agree or not, makes rows for its members alone; and every candidate pair is compared
or already linked.

Defined cases: null or empty text (or text without words) has no shingle and
links with nothing; a null doc_id ranks after all others, and rows of null ids
alone have a null component_id and are kept; equal rows have equal results; rows
that share a doc_id are one node; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded_batches, byte_chunks, checkpointed, mix64, table, word_hashes, written
from .components import components

COLLECTIONS = 14
ROWS = 3
SEED = 55
#: Ids of texts to compare that are sent to every task at most (16 bytes each).
BROADCAST_NODES = 1_000_000
#: Shingles of a block of sets, and the most of sets that one task compares with another block.
BLOCK = 200_000
#: Texts agree when 100 * intersection >= PERCENT * union.
PERCENT = 80

SIGNATURE = "doc_id long, n_shingles long, f1 long, f2 long, sig binary"


def shingle_sets(texts: list[bytes], width: int, cache: dict[bytes, int]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = [t.lower().split() for t in texts]
    counts = np.array([len(ws) for ws in words], np.int64)
    h = word_hashes([w for ws in words for w in ws], cache)
    ends = np.cumsum(counts)
    out = []
    rolled, reach = h, 1
    while reach < width and len(rolled) > 1:
        rolled = mix64(rolled[:-1], reach) + h[reach:]
        reach += 1
    rolled = mix64(rolled, 99)
    for end, n in zip(ends.tolist(), counts.tolist(), strict=True):
        if n >= width:
            out.append(np.unique(rolled[end - n : end - width + 1]))
        elif n:  # the whole sequence as one
            one = h[end - n : end - n + 1]
            for k in range(1, n):
                one = mix64(one, k) + h[end - n + k : end - n + k + 1]
            out.append(mix64(one, 1000 + n))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def collections_of(sets: list[np.ndarray], count: int, rows: int) -> np.ndarray:
    """One 32-bit value for each set and collection."""
    rng = np.random.default_rng(SEED)
    sizes = np.array([len(s) for s in sets], np.int64)
    out = np.zeros((len(sets), count), np.uint32)
    some = np.flatnonzero(sizes)
    if not len(some):
        return out
    flat = np.concatenate([sets[i] for i in some])
    starts = np.cumsum(sizes[some]) - sizes[some]
    for c in range(count):
        value = np.zeros(len(some), np.uint64)
        for _ in range(rows):
            a = np.uint64(int(rng.integers(0, 1 << 63)) * 2 + 1)
            b = np.uint64(int(rng.integers(0, 1 << 63)))
            value = mix64(value + np.minimum.reduceat(flat * a + b, starts), c)
        out[some, c] = (value >> np.uint64(32)).astype(np.uint32)
    return out


def _signatures(width: int, count: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, int] = {}
        for batch, texts in byte_chunks(batches, 2 << 20):
            sets = shingle_sets([t or b"" for t in texts], width, cache)
            sig = collections_of(sets, count, rows)
            f1 = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            f2 = np.array([mix64(s, 7).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(f1), pa.array(f2), pa.array([r.tobytes() for r in sig], pa.binary())],
                names=[p.split()[0] for p in SIGNATURE.split(", ")],
            )

    return run


def _table_keys(count: int):
    """(class, signature) -> a row for each table: its key, the class."""
    pairs = list(combinations(range(count), 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 2048):
                part = batch.slice(a, 2048)
                node = part.column(0).to_numpy()
                sig = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint32).reshape(len(node), count).astype(np.uint64)
                keys = [mix64((sig[:, i] << np.uint64(32)) | sig[:, j], 100 + t) for t, (i, j) in enumerate(pairs)]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.tile(node, len(pairs)))], names=["key", "node"])

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, int] = {}
        for batch, texts in byte_chunks(batches, 2 << 20):
            sets = shingle_sets([t or b"" for t in texts], width, cache)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "members"])

    return run


def _agree(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            keep = []
            for x, y in zip(left, right, strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def sets_of(nodes: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """(node, members) for the texts (doc_id, text) of the distinct ``nodes`` (doc_id)."""
    if nodes.count() <= BROADCAST_NODES:  # else texts are shuffled to their ids
        nodes = F.broadcast(nodes)
    return texts.join(nodes, "doc_id", "left_semi").mapInArrow(_sets(width), "node long, members binary")


def verified(pairs: DataFrame, sizes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Of distinct node pairs (a, b), those whose full sets agree.

    ``sizes`` has (node, n_shingles); ``texts`` has (doc_id, text), one row of
    each node's set at least.
    """
    n = sizes.select("node", "n_shingles")
    near = pairs.join(n.withColumnsRenamed({"node": "a", "n_shingles": "na"}), "a").join(n.withColumnsRenamed({"node": "b", "n_shingles": "nb"}), "b")
    near = checkpointed(near.filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).select("a", "b"))
    nodes = checkpointed(near.select(F.col("a").alias("doc_id")).unionByName(near.select(F.col("b").alias("doc_id"))).distinct())
    sets = sets_of(nodes, texts, width)
    x = sets.withColumnsRenamed({"node": "a", "members": "x"})
    y = sets.withColumnsRenamed({"node": "b", "members": "y"})
    both = near.join(x, "a").join(y, "b").select("a", "b", "x", "y")
    return checkpointed(both.mapInArrow(_agree(percent), "a long, b long").distinct())


def _agree_in_blocks(percent: int, count: int):
    """Pairs of a question and another class, of different components, that share a table's key and agree."""

    def parts(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        sig = np.frombuffer(b"".join(rows["sig"].to_pylist()), np.uint32).reshape(rows.num_rows, count)
        return rows["node"].to_numpy(), rows["component"].to_numpy(), sig, [np.frombuffer(m, np.uint64) for m in rows["members"].to_pylist()]

    def run(asked: pa.Table, others: pa.Table) -> pa.Table:
        found: list[tuple[int, int]] = []
        if asked.num_rows and others.num_rows:
            node, component, sig, sets = parts(others.rename_columns([c.removeprefix("o_") for c in others.column_names]))
            sizes = np.array([len(s) for s in sets], np.int64)
            starts = np.cumsum(sizes) - sizes
            tokens, inverse = np.unique(np.concatenate(sets), return_inverse=True)
            for a, c, s, own in zip(*parts(asked), strict=True):
                # two equal collections are an equal key
                fits = (component != c) & ((sig == s).sum(axis=1) >= 2) & (100 * np.minimum(sizes, len(own)) >= percent * np.maximum(sizes, len(own)))
                if not fits.any():
                    continue
                at = np.minimum(np.searchsorted(tokens, own), len(tokens) - 1)
                held = np.zeros(len(tokens), bool)
                held[at[tokens[at] == own]] = True
                both = np.add.reduceat(held[inverse], starts, dtype=np.int64)
                agree = fits & (100 * both >= percent * (sizes + len(own) - both))
                found += [(min(a, b), max(a, b)) for b in node[agree].tolist()]
        found = sorted(set(found))
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return run


def links_across(members: DataFrame, found: DataFrame, classes: DataFrame, texts: DataFrame, width: int, percent: int, count: int, block: int = BLOCK) -> DataFrame:
    """Links between classes that share a key of ``members`` and are in different components."""
    placed = members.join(found, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    held = placed.groupBy("key", "component").agg(F.count("*").alias("n"))
    largest = held.groupBy("key").agg(F.max_by("component", F.struct("n", -F.col("component"))).alias("hub"), F.count("*").alias("parts"))
    asks = F.col("component") != F.col("hub")
    rows = placed.join(largest.filter("parts > 1"), "key").select("hub", "node", "component", asks.alias("asks")).distinct()
    info = classes.groupBy("node").agg(F.min("sig").alias("sig"), F.max("n_shingles").alias("n"))
    rows = written(rows.join(info, "node"), "minhash-apart")
    sides = rows.groupBy("hub").agg(F.ceil(F.sum(F.when(F.col("asks"), F.col("n"))) / block).alias("nq"), F.ceil(F.sum("n") / block).alias("nd"))
    sets = sets_of(checkpointed(rows.select(F.col("node").alias("doc_id")).distinct()), texts, width)
    full = rows.join(sides, "hub").join(sets, "node")
    deal = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    columns = ["hub", "node", "component", "sig", "members"]
    asked = full.filter("asks").select(*columns, deal("nq").alias("q"), every("nd").alias("d"))
    others = full.select(*(F.col(c).alias(f"o_{c}") for c in columns), deal("nd").alias("o_d"), every("nq").alias("o_q"))
    pairs = asked.groupBy("hub", "q", "d").cogroup(others.groupBy("o_hub", "o_q", "o_d")).applyInArrow(_agree_in_blocks(percent, count), "a long, b long")
    return checkpointed(pairs.distinct())


def near_duplicates(docs: DataFrame, width: int, percent: int = PERCENT, count: int = COLLECTIONS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``."""
    texts = bounded_batches(docs).select("doc_id", "text")
    every = written(texts.mapInArrow(_signatures(width, count, rows), SIGNATURE), "minhash-rows")
    classes = every.filter(F.col("n_shingles") > 0).groupBy("f1", "f2", "n_shingles").agg(F.min("doc_id").alias("node"), F.min("sig").alias("sig"))
    classes = written(classes.filter(F.col("node").isNotNull()), "minhash-classes")

    rows_of = classes.select("node", "sig").mapInArrow(_table_keys(count), "key long, node long")
    heads = rows_of.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("last"))
    heads = heads.filter(F.col("head") != F.col("last"))
    members = written(rows_of.join(heads, "key"), "minhash-members")
    first = checkpointed(members.filter("node != head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct())
    links = verified(first, classes, texts, width, percent)
    found = checkpointed(components(links))

    # keys of two classes are done; in others, classes that no chain of links has joined yet
    where = F.coalesce(F.col("component"), F.col("node"))
    large = members.join(members.filter("node != head and node != last").select("key").distinct(), "key", "left_semi").select("key", "node")
    more = links_across(large, found, classes, texts, width, percent, count, BLOCK)
    if not more.isEmpty():
        found = checkpointed(components(links.unionByName(more)))

    named = classes.join(found, "node", "left").select("f1", "f2", "n_shingles", where.alias("component_id"))
    out = every.select("doc_id", "n_shingles", "f1", "f2").join(named, ["f1", "f2", "n_shingles"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def deduplicated(docs: DataFrame, width: int = 5, percent: int = PERCENT) -> DataFrame:
    """The documents that stay, one of each component, with all their columns.

    Of rows that share a doc_id one stays; rows without an id take no part and stay.
    """
    # whole rows in one column, so that no name of theirs can clash
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = docs.select(row, F.col("doc_id").alias("node"), F.xxhash64("text").alias("h"))
    named = rows.filter(F.col("node").isNotNull())
    found = near_duplicates(docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull()), width, percent)
    stay = found.filter("kept").select(F.col("doc_id").alias("node")).distinct()
    one = named.withColumn("nth", F.row_number().over(Window.partitionBy("node").orderBy("h"))).filter("nth = 1")
    one = one.join(stay, "node", "left_semi").select("row")
    return one.unionByName(rows.filter(F.col("node").isNull()).select("row")).select("row.*")


def op5_tensored_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=2)


ORACLE_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM texts
), sized AS MATERIALIZED (
  SELECT doc_id, s, len(s)::BIGINT AS n FROM sets
), near AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n + b.n AS total, len(list_intersect(a.s, b.s)) AS common
  FROM sized a JOIN sized b ON a.doc_id < b.doc_id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n AND a.n > 0
), links AS (
  SELECT a, b FROM near WHERE 100 * common >= 80 * (total - common) UNION ALL SELECT b, a FROM near WHERE 100 * common >= 80 * (total - common)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM sized UNION SELECT x, b FROM reach JOIN links ON y = a
)
SELECT doc_id, n AS n_shingles, lowest AS component_id, doc_id = lowest AS kept
FROM sized JOIN (SELECT x, min(y) AS lowest FROM reach GROUP BY x) ON x = doc_id
"""
