"""Labelled documents: all of them, for networks fitted in the tasks, and bounded samples for fitting on the driver."""

from __future__ import annotations

import copy
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MOST_BUCKETS, bucketed, crc_remainder
from .convnet import ConvNet

#: A row is held out (its label is never learned) when its id's remainder is this.
FOLDS, HELD_OUT = 3, 1
#: Labelled ids that go to every task, so that other texts are not shuffled; of more, the texts are shuffled to them.
SENT_IDS = 1_000_000


FITTED = "shard long, weight long, params binary"


def _fitted(shard: int, weight: int, params: np.ndarray) -> pa.Table:
    """A row of ``FITTED``."""
    values = zip((shard, weight, params.tobytes()), (pa.int64(), pa.int64(), pa.binary()), strict=True)
    return pa.table([pa.array([v], t) for v, t in values], names=[c.split()[0] for c in FITTED.split(", ")])


def _weighted(parts: list[tuple[int, int, bytes]]) -> tuple[int, np.ndarray]:
    """The sum of the weights of (place, weight, parameters) rows, and their mean in the order of places."""
    weight = sum(n for _, n, _ in parts)
    return weight, sum(np.frombuffer(p, np.float64) * (n / max(weight, 1)) for _, n, p in sorted(parts))


def fit_in_rounds(net: ConvNet, dealt: DataFrame, shards: int, rounds: int, fit: Callable[[ConvNet, pa.Table, int], int]) -> ConvNet:
    """``net`` fitted further, in so many rounds, by all ``shard``s of ``dealt``; a round's networks are averaged, weighted by their items.

    ``fit`` takes a network of its own, a shard's rows and the number of the round, and returns how many items it learned.
    """
    groups = int(np.ceil(np.sqrt(shards)))

    def further(common: ConvNet, nth: int) -> Callable[[pa.Table], pa.Table]:
        def run(rows: pa.Table) -> pa.Table:
            own = copy.deepcopy(common)  # a task may have several shards
            weight = fit(own, rows, nth)
            return _fitted(rows.column("shard")[0].as_py(), weight, np.concatenate([v.ravel() for v in own.params.values()]).astype(np.float64))

        return run

    def merged(rows: pa.Table) -> pa.Table:
        parts = [tuple(r.values()) for r in rows.to_pylist()]
        return _fitted(parts[0][0] % groups, *_weighted(parts))

    for nth in range(rounds):
        fitted = dealt.groupBy("shard").applyInArrow(further(net, nth), FITTED)
        means = fitted.groupBy(F.col("shard") % groups).applyInArrow(merged, FITTED)
        weight, mean = _weighted([tuple(r) for r in means.collect()])
        if not weight:
            break
        at = 0
        for name, old in net.params.items():
            net.params[name] = mean[at : at + old.size].reshape(old.shape).astype(np.float32)
            at += old.size
    return net


def _known(labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, _label) of the labels that may be learned."""
    known = labels.select("doc_id", F.col(column).alias("_label"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("_label").isin(0, 1) & (crc_remainder(F.col("doc_id"), FOLDS) != HELD_OUT))
    return known.groupBy("doc_id").agg(F.min("_label").alias("_label"))


def labelled_texts(docs: DataFrame, labels: DataFrame, column: str, most_rows: int | None = None) -> DataFrame:
    """(doc_id, _text, _bytes, _label) of all rows of ``docs`` with a text, of any length, and a label outside the held-out fold."""
    known = _known(labels, column)
    if most_rows is not None:
        known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)
    if known.count() <= SENT_IDS:
        known = F.broadcast(known)
    # the length is taken before the join, so that counting lengths shuffles no text
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("_text"), F.octet_length("text").alias("_bytes"))
    return texts.filter(F.col("_bytes").isNotNull()).join(known, "doc_id")


def dealt_texts(rows: DataFrame, shards: int) -> DataFrame:
    """``labelled_texts`` dealt to shards by id and stored so; of a document with several texts the first in hash order."""
    # more buckets than shards, so that few share one
    buckets = min(MOST_BUCKETS, 4 * shards)
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards))).repartition(buckets, "shard")
    one = F.min(F.struct(F.xxhash64("_text").alias("_h"), "_text")).alias("_one")
    rows = rows.groupBy("shard", "doc_id", "_label").agg(one).select("shard", "doc_id", "_label", F.col("_one._text").alias("_text"))
    return bucketed(rows, "labelled_texts", "shard", buckets)


def _within(texts: DataFrame, known: DataFrame, total_bytes: int) -> DataFrame:
    """Of the ``known`` ids (few) the first in hash order whose texts come to ``total_bytes`` at most."""
    sizes = texts.join(F.broadcast(known), "doc_id").groupBy("doc_id", "_label").agg(F.max(F.octet_length("_text")).alias("n"))
    left, chosen = total_bytes, []
    for r in sizes.filter(F.col("n") <= total_bytes).select(F.xxhash64("doc_id").alias("h"), "doc_id", "_label", "n").orderBy("h", "doc_id").collect():
        left -= r["n"]
        if left < 0:
            break
        chosen.append((r["doc_id"], r["_label"]))
    return texts.sparkSession.createDataFrame(chosen, known.schema)


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, most_rows: int, most_bytes: int | None = None, total_bytes: int | None = None) -> tuple[list[bytes], np.ndarray]:
    """Texts and labels of at most ``most_rows`` documents outside the held-out fold.

    The first ids in hash order are taken: of those the texts of at most
    ``most_bytes``, or, whatever their lengths, as many as ``total_bytes`` hold
    together (a text above that bound alone is passed over).  Null labels and ids
    are left out, a document labelled twice differently has its smaller label, a
    document with several texts the first in hash order.
    """
    known = _known(labels, column).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("_text"))
    texts = texts.filter(F.col("_text").isNotNull())
    if total_bytes is None:
        texts = texts.filter(F.octet_length("_text") <= most_bytes)
    else:
        known = _within(texts, known, total_bytes)
    one = F.min(F.struct(F.xxhash64("_text").alias("_h"), "_text")).alias("_one")
    found = texts.join(F.broadcast(known), "doc_id").groupBy("doc_id", "_label").agg(one)
    rows = found.select("doc_id", F.col("_one._text").alias("_text"), "_label").collect()
    rows.sort(key=lambda r: (hash(r["doc_id"]), bytes(r["_text"])))
    return [bytes(r["_text"]) for r in rows], np.array([r["_label"] for r in rows], np.int64)
