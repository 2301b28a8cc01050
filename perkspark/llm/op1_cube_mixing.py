"""Mixing sources to target weights: cube-method balanced sampling.

A source's target is its share of the wanted words by weight, cut at ``cap``
times its size, with the excess shared again by weight among the others.  Every
document of a source is taken floor(target / size) times for sure; the
remaining fraction is its inclusion probability in a balanced sample.  The
flight phase of the cube method moves these probabilities through the null space
of two constraints (words taken, documents taken), three documents at a time,
until each is 0 or 1 but for at most two of a block.  Blocks are hash groups of
at most about ``block`` documents of one source, so a hot source is many tasks;
what blocks leave undecided is dealt to fewer blocks of the next round, until a
source is one block.  ``LANDING`` documents of it wait for the flight's last one
or two: the landing problem takes their 0/1 choice nearest to the words wanted,
by enumeration.

Defined cases: null text has size 0; null sources are one source, last in order;
a source without words has target 0; an empty table gives an empty result.
Equal rows are separate documents.  Ties of hash and size are equal rows, so
that reruns agree.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, checkpointed, table, word_count

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
CAP = 2.0
BLOCK = 4096
#: Equal rows that one task makes out of their count at once.
COPIES = 10_000
SEED = 20260
#: Documents of a source, last in hash order, that join the landing problem.
LANDING = 12
EPS = 1e-9


def source_targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, rank, source_size, n_docs, target), one row per source."""
    spark = sized.sparkSession
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    totals = checkpointed(totals.orderBy(F.col("source").asc_nulls_last()))
    ranked = totals.rdd.zipWithIndex().map(lambda x: (x[0][0], x[1], x[0][1], x[0][2]))
    schema = T.StructType([sized.schema["source"], *(T.StructField(n, T.LongType()) for n in ("rank", "source_size", "n_docs"))])
    sources = spark.createDataFrame(ranked, schema)
    weight = F.lit(float(weights[-1]))
    for i, w in reversed(list(enumerate(weights[:-1]))):
        weight = F.when(F.col("rank") % len(weights) == i, F.lit(float(w))).otherwise(weight)
    sources = checkpointed(sources.withColumn("weight", weight).withColumn("most", F.lit(cap) * F.col("source_size")))
    first = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    wanted = share * (first[0] or 0)
    level = wanted / first[1] if first[1] else 0.0
    while True:  # a level rises only when one more source reaches its cap
        above = F.col("weight") * F.lit(level) > F.col("most")
        fixed, free = sources.agg(F.sum(F.when(above, F.col("most"))), F.sum(F.when(~above, F.col("weight")))).first()
        raised = (wanted - (fixed or 0.0)) / free if free else level
        if raised <= level:
            break
        level = raised
    target = F.least(F.col("most"), F.col("weight") * F.lit(level))
    return sources.select("source", "rank", "source_size", "n_docs", target.alias("target"))


def flight(pi: list[float], size: list[float], rng: np.random.Generator) -> list[float]:
    """Move probabilities with their sum and their size-weighted sum held; at most two stay between 0 and 1."""
    pi = [0.0 if p <= EPS else 1.0 if p >= 1 - EPS else p for p in pi]
    coins = iter(rng.random(len(pi) + 1).tolist())
    active: list[int] = []
    rest = iter(i for i, p in enumerate(pi) if 0.0 < p < 1.0)
    while True:
        while len(active) < 3 and (i := next(rest, None)) is not None:
            active.append(i)
        s = [size[i] for i in active]
        if len(active) == 3 and not s[0] == s[1] == s[2]:
            u = [s[1] - s[2], s[2] - s[0], s[0] - s[1]]
            most = max(abs(x) for x in u)
            u = [x / most for x in u]
        elif len(active) >= 2 and s[0] == s[1]:
            u = [1.0, -1.0, 0.0][: len(active)]
        else:
            return pi
        p = [pi[i] for i in active]
        up = min((1 - a) / b if b > 0 else a / -b for a, b in zip(p, u, strict=True) if b)
        down = min(a / b if b > 0 else (1 - a) / -b for a, b in zip(p, u, strict=True) if b)
        step = up if next(coins, 0.5) * (up + down) < down else -down
        kept = []
        for i, a, b in zip(active, p, u, strict=True):
            a += step * b
            pi[i] = 0.0 if a <= EPS else 1.0 if a >= 1 - EPS else a
            if 0.0 < pi[i] < 1.0:
                kept.append(i)
        active = kept


def land(pi: list[float], size: list[float]) -> list[float]:
    """Round the few undecided so that the words, then the documents, are nearest to what was wanted."""
    left = [i for i, p in enumerate(pi) if 0.0 < p < 1.0]
    choices = (np.arange(1 << len(left))[:, None] >> np.arange(len(left))) & 1
    moved = choices - np.array([pi[i] for i in left])
    words = np.abs(moved @ np.array([size[i] for i in left])).round(6)
    best = np.lexsort((np.abs(moved.sum(axis=1)).round(6), words))[0]
    out = list(pi)
    for i, chosen in zip(left, choices[best], strict=True):
        out[i] = float(chosen)
    return out


def _settle(seed: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["h", "size", "pi"], kind="stable").reset_index(drop=True)
        first = group.iloc[0]
        rng = np.random.default_rng([seed, int(first["rank"]), int(first["block"]), int(first["blocks"])])
        size = group["size"].astype(float).tolist()
        pi = group["pi"].tolist()
        if first["blocks"] == 1:
            waiting = [i for i, p in enumerate(pi) if EPS < p < 1 - EPS][-LANDING:]
            held = [pi[i] for i in waiting]
            for i in waiting:
                pi[i] = 0.0
            pi = flight(pi, size, rng)
            for i, p in zip(waiting, held, strict=True):
                pi[i] = p
            pi = land(pi, size)
        else:
            pi = flight(pi, size, rng)
        group["pi"] = pi
        return group

    return run


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``nth``, from 0, among those equal to them, so that a great many equal rows are dealt to many blocks.

    Equal rows are counted, which partial aggregates do well, and made rows again ``COPIES`` at a time.
    """
    counted = rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(COPIES).cast("long"))).alias("first")
    parts = counted.select("*", first).repartition("doc_id", "text_hash", "first")
    return parts.select(*rows.columns, F.explode(F.sequence("first", F.least(F.col("first") + COPIES, F.col("n")) - 1)).alias("nth"))


def cube_mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, times, text_hash, source, sure.

    ``sure`` of the ``times`` are taken whatever the sample.
    """
    text = F.col("text").cast("binary")
    rows = bounded_batches(docs).select("doc_id", "source", word_count(text).alias("size"), F.xxhash64("text").alias("text_hash"))
    sized = checkpointed(_numbered(rows))
    sources = source_targets(sized, weights, share, cap)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    sure = F.floor(F.col("ratio") + F.lit(EPS))
    todo = (
        sized.alias("d")
        .join(sources.withColumnRenamed("source", "source_name"), F.col("d.source").eqNullSafe(F.col("source_name")))
        .withColumn("ratio", ratio)
        .withColumn("sure", sure.cast("long"))
        .withColumn("pi", F.greatest(F.col("ratio") - F.col("sure"), F.lit(0.0)))
        .withColumn("h", F.xxhash64("doc_id", "text_hash", "nth"))
        .select("doc_id", "source", "size", "text_hash", "rank", "source_size", "n_docs", "target", "sure", "pi", "h")
    )
    decided = []
    number = 0
    while True:
        cut = todo.withColumn("blocks", F.ceil(F.col("n_docs") / F.lit(block)).cast("long"))
        cut = cut.withColumn("block", F.pmod(F.xxhash64("h", F.lit(number)), F.col("blocks"))).drop("n_docs")
        moved = checkpointed(cut.groupBy("rank", "block").applyInPandas(_settle(seed + number), cut.schema))
        decided.append(moved.filter((F.col("pi") == 0) | (F.col("pi") == 1)))
        left = moved.filter((F.col("pi") > 0) & (F.col("pi") < 1)).drop("blocks", "block")
        counts = checkpointed(left.groupBy("rank").agg(F.count("*").alias("n_docs")))
        if counts.isEmpty():
            break
        todo = left.join(counts, "rank")
        number += 1
    out = decided[0]
    for part in decided[1:]:
        out = out.unionByName(part)
    times = F.col("sure") + F.col("pi").cast("long")
    return out.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * times).alias("taken"), times.alias("times"), "text_hash", "source", "sure"
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix with all their columns, each as often as it is taken.

    Rows that agree in id, source and text share what was decided for them.
    """
    plan = cube_mix(docs, **options).withColumn("place", F.xxhash64("doc_id", "source"))
    counts = plan.groupBy("place", "text_hash").agg(F.first("sure").alias("sure"), F.sum(F.col("times") - F.col("sure")).alias("more"))
    # whole rows in one column, so that no name of theirs can clash
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = docs.select(row, F.xxhash64("doc_id", "source").alias("place"), F.xxhash64("text").alias("text_hash"))
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy("place", "text_hash").orderBy(F.lit(0))))
    times = F.col("sure") + (F.col("nth") <= F.col("more")).cast("long")
    rows = rows.join(counts, ["place", "text_hash"]).withColumn("times", times).filter(F.col("times") > 0)
    return rows.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select("row.*")


def op1_cube_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = cube_mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")
