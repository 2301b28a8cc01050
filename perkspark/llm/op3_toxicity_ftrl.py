"""Toxicity: FTRL-proximal logistic regression over word n-grams and skip-grams.

Words are lower-cased (A-Z) and stripped of characters that are not letters or
digits at both ends.  Features are the distinct hashes of words, of pairs of
neighbours and of pairs with one word between them, in ``2 ** BITS`` slots.
FTRL-proximal gives each coordinate its own learning rate and, by its L1 term,
leaves nearly all weights at exactly zero; the few others (at most
``2 ** BITS``) go to every task; no other rule selects features.  The model is
fitted on the driver on a bounded sample of labelled documents outside the
held-out fold (``SAMPLE`` documents of at most ``SAMPLE_BYTES`` in all).

Defined cases: null text is scored as empty text (the intercept alone); without
labelled documents, or with one class alone, every score is that class's share
(0.5 without any); equal texts have equal scores; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_remainder, mix64, table
from .op2_quality_cnn import score_texts
from .training import FOLDS, HELD_OUT, labelled_sample

BITS = 24
SAMPLE = 12000
SAMPLE_BYTES = 48 << 20
EPOCHS = 6
ALPHA, BETA, L1, L2 = 4.0, 1.0, 8.0, 1.0
#: Weight of a toxic document in learning.
POSITIVE_WEIGHT = 3.0
THRESHOLD = 0.7
#: Bytes that are not part of a word at its ends.
EDGES = bytes(c for c in range(33, 127) if not chr(c).isalnum())


class Features:
    """Slots of the features of texts, with the hashes of frequent words kept."""

    def __init__(self, bits: int):
        self.shift = np.uint64(64 - bits)
        self.known: dict[bytes, int] = {}

    def _words(self, words: list[bytes]) -> np.ndarray:
        import xxhash

        if len(self.known) > 400_000:
            self.known.clear()
        for w in set(words).difference(self.known):
            self.known[w] = xxhash.xxh64_intdigest(w.lower().strip(EDGES))
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))

    def slots(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Slots of all features of all texts, and the text of each; a text may repeat a slot."""
        split = [t.split() for t in texts]
        h = self._words([w for ws in split for w in ws])
        doc = np.repeat(np.arange(len(texts)), [len(ws) for ws in split])
        slots, owners = [mix64(h, 1) >> self.shift], [doc]
        for gap in (1, 2):
            if len(h) > gap:
                same = doc[gap:] == doc[:-gap]
                pair = mix64(h[:-gap][same], 10 + gap) + h[gap:][same]
                slots.append(mix64(pair, 20 + gap) >> self.shift)
                owners.append(doc[gap:][same])
        return np.concatenate(slots).astype(np.int64), np.concatenate(owners)


def fit_weights(texts: list[bytes], labels: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, float]:
    """Slots with a weight, their weights, and the intercept."""
    features = Features(bits)
    known = [np.unique(features.slots([t])[0]).astype(np.int32) for t in texts]
    present = np.zeros(1 << bits, bool)
    for x in known:
        present[x] = True
    learned = np.flatnonzero(present)
    index = np.cumsum(present, dtype=np.int32) - 1
    for i, x in enumerate(known):
        known[i] = index[x]
    del index, present
    n, z = np.zeros(len(learned)), np.zeros(len(learned))
    n0 = z0 = 0.0

    def weights_at(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    shuffle = np.random.default_rng(3)
    for _ in range(EPOCHS):
        for i in shuffle.permutation(len(texts)):
            x = known[i]
            zx, nx = z[x], n[x]
            weight = weights_at(zx, nx)
            w0 = -z0 / ((BETA + n0**0.5) / ALPHA)
            logit = np.clip(weight.sum() + w0, -30, 30)
            g = (POSITIVE_WEIGHT if labels[i] else 1.0) * (1 / (1 + np.exp(-logit)) - labels[i])
            z[x] = zx + g - (np.sqrt(nx + g * g) - np.sqrt(nx)) / ALPHA * weight
            n[x] = nx + g * g
            z0 += g - ((n0 + g * g) ** 0.5 - n0**0.5) / ALPHA * w0
            n0 += g * g
    used = np.flatnonzero(np.abs(z) > L1)
    return learned[used], weights_at(z[used], n[used]), float(-z0 / ((BETA + n0**0.5) / ALPHA))


def fit_scorer(texts: list[bytes], labels: np.ndarray) -> Callable[[list[bytes]], np.ndarray]:
    """A function from texts to probabilities of label 1."""
    share = float(labels.mean()) if len(labels) else 0.5
    if share in (0.0, 1.0) or not len(labels):
        return lambda items: np.full(len(items), share)
    kept, values, intercept = fit_weights(texts, labels)
    bits = BITS
    state: dict = {}

    def score(items: list[bytes]) -> np.ndarray:
        if not state:
            state["has_weight"] = np.zeros(1 << bits, bool)
            state["has_weight"][kept] = True
            state["features"] = Features(bits)
        slots, owner = state["features"].slots(items)
        used = np.flatnonzero(state["has_weight"][slots])
        one = np.unique((owner[used] << bits) + slots[used])
        found = values[np.searchsorted(kept, one & ((1 << bits) - 1))]
        logits = np.bincount(one >> bits, found, len(items)) + intercept
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))

    return score


def toxicity_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    scorer = fit_scorer(*labelled_sample(docs, labels, "toxic", sample, total_bytes=SAMPLE_BYTES))
    scored = score_texts(docs, scorer)
    return scored.select(
        "doc_id", (crc_remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def op3_toxicity_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
