"""Quality classifier: a byte-level convolutional network in numpy.

Bytes become 62 symbols (letters by case, digits, white space, kinds of
punctuation, UTF-8 lead and continuation bytes).  Learned filters of eight
symbols slide over chunks of 512 bytes that overlap by half and cover the whole
text; see :mod:`convnet`.  The network is fitted in the tasks on all labelled
documents outside the held-out fold, whole: up to ``SHARD_BYTES`` of them by one
task; more are dealt by hash to shards of about that size, and in each of
``ROUNDS`` rounds every shard fits the common network further, whose means are the
next common network.  Its size does not depend on the data, and every task scores
whole texts with it.

Defined cases: null text is scored as empty text; without labelled documents,
or with one class alone, every score is that class's share (0.5 without any);
equal texts have equal scores; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, byte_chunks, crc_remainder, table
from .convnet import ConvNet
from .training import FOLDS, HELD_OUT, dealt_texts, fit_in_rounds, labelled_texts

#: Labelled text that one task fits; with more shards than one, rounds of EPOCHS // ROUNDS epochs.
SHARD_BYTES = 8 << 20
ROUNDS = 6
FILTERS = 16
EPOCHS = 14
HOP = 256
STRIDE = 1
THRESHOLD = 0.5
#: Weight of the rarer class: the ratio of the classes to this power.
BALANCE = 0.7


def byte_symbols() -> np.ndarray:
    """Symbol of each byte value; 0 is padding."""
    symbol = np.full(256, 1, np.uint8)  # other control bytes
    symbol[ord("a") : ord("z") + 1] = 2 + np.arange(26)
    symbol[ord("A") : ord("Z") + 1] = 28 + np.arange(26)
    symbol[ord("0") : ord("9") + 1] = 54
    for kind, members in ((55, b" \t\x0b\x0c\r"), (56, b"\n"), (57, b".,;:"), (58, b"!?")):
        symbol[list(members)] = kind
    rest = [c for c in range(33, 127) if symbol[c] == 1]
    symbol[rest] = 59
    symbol[0x80:0xC0] = 60
    symbol[0xC0:] = 61
    return symbol


SYMBOLS = 62


def new_network() -> ConvNet:
    return ConvNet(SYMBOLS, FILTERS, HOP, STRIDE, seed=1)


def coded(texts: list[bytes]) -> list[np.ndarray]:
    symbol = byte_symbols()
    return [symbol[np.frombuffer(t, np.uint8)] for t in texts]


def class_weights(labels: np.ndarray, share: float) -> np.ndarray:
    """Weight of each label, where so large a share of all is 1."""
    ratio = max(share, 1 - share) / min(share, 1 - share)
    return np.where(labels == int(share < 0.5), ratio**BALANCE, 1.0)


def scorer_of(net: ConvNet) -> Callable[[list[bytes]], np.ndarray]:
    return lambda texts: net.score(coded(texts))


def constant(share: float) -> Callable[[list[bytes]], np.ndarray]:
    return lambda texts: np.full(len(texts), share)


def fit_scorer(texts: list[bytes], labels: np.ndarray) -> Callable[[list[bytes]], np.ndarray]:
    """A function from texts to probabilities of label 1, learned from a few texts at once."""
    share = float(labels.mean()) if len(labels) else 0.5
    if share in (0.0, 1.0) or not len(labels):
        return constant(share)
    return scorer_of(new_network().fit(coded(texts), labels, EPOCHS, weights=class_weights(labels, share)))


def learned_scorer(docs: DataFrame, labels: DataFrame, sample: int | None = None) -> Callable[[list[bytes]], np.ndarray]:
    """A function from texts to probabilities of label 1, learned from all labelled documents (or the first ``sample`` in hash order)."""
    rows = labelled_texts(docs, labels, "quality", sample)
    sizes = rows.groupBy("doc_id", "_label").agg(F.max("_bytes").alias("bytes"))
    size = sizes.agg(F.count("*").alias("n"), F.sum("_label").alias("ones"), F.sum("bytes").alias("bytes")).first()
    share = size["ones"] / size["n"] if size["n"] else 0.5
    if share in (0.0, 1.0) or not size["n"]:
        return constant(share)
    shards = max(1, -(-size["bytes"] // SHARD_BYTES))
    rounds = 1 if shards == 1 else ROUNDS
    dealt = dealt_texts(rows, shards)

    def fit(own: ConvNet, rows: pa.Table, nth: int) -> int:
        rows = rows.sort_by("doc_id")
        y = rows.column("_label").to_numpy().astype(np.int64)
        own.fit(coded(rows.column("_text").to_pylist()), y, EPOCHS // rounds, weights=class_weights(y, share), seed=nth, done=nth / rounds, share=1 / rounds)
        return len(y)

    return scorer_of(fit_in_rounds(new_network(), dealt, shards, rounds, fit))


def score_texts(docs: DataFrame, scorer: Callable[[list[bytes]], np.ndarray], max_bytes: int = 4 << 20) -> DataFrame:
    """(doc_id, score) of every document's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in byte_chunks(batches, max_bytes):
            scores = scorer([t or b"" for t in texts])
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return bounded_batches(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, sample: int | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    scorer = learned_scorer(docs, labels, sample)
    scored = score_texts(docs, scorer)
    return scored.select(
        "doc_id", (crc_remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def good_documents(docs: DataFrame, labels: DataFrame, sample: int | None = None) -> DataFrame:
    """The documents that the classifier accepts, with all their columns and rows."""
    scorer = learned_scorer(docs, labels, sample)

    @F.pandas_udf("double")
    def score(text):  # noqa: ANN001, ANN202 - a Series of binary texts
        import pandas as pd

        out, block, size = [], [], 0
        for t in text:
            block.append(t or b"")
            size += len(block[-1])
            if size > 4 << 20:
                out.extend(scorer(block))
                block, size = [], 0
        if block:
            out.extend(scorer(block))
        return pd.Series(out, dtype="float64")

    return bounded_batches(docs).filter(score(F.col("text").cast("binary")) >= THRESHOLD)


def op2_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
