"""LM scoring: a probabilistic suffix tree over words.

The texts are read once: every split of the corpus (about ``SPLIT_BYTES`` of one
input partition, however its rows are keyed) numbers its distinct words and is
stored as lists of numbers beside its words' hashes, in a table bucketed by split.
Whatever a split has to know later (the corpus-wide counts of its own words and
sequences, the states among its own contexts) is appended to a second table with the
same buckets, so that no pass shuffles documents or that knowledge again, and no
vocabulary or tree is ever in one place.  Shuffled are, to ranges of the hash space
(one for each ``RANGE_BYTES`` of text, so that a range's size does not grow with the
corpus, and a key is there once a split, however frequent), the sorted keys and counts
of a split's words, sequences and contexts, packed by range (keys as the gaps between
them, all compressed).  Back go no keys: a bit for each key, in the order in which the
split listed them, and of those that are kept the values and the ranks in the range.  A
split lists the same keys again whenever it reads that, from the same tokens and what it
knew then, and names its contexts by range and rank, which lie closer than hashes.  The
first levels, which list the most, do so in ``ROUNDS``, every one for its share of the ranges.

The tree: a context of one to ``DEPTH`` words counts when it occurs ``CONTEXT_LEAST``
times in the training texts, a symbol after it when the two occur ``LEAST`` times;
these counts do not rise with the corpus.  A sequence that is found ``LEAST`` times
has a suffix that is, so each level lists, split by split, only sequences whose
context and suffix were found at the level before.  That needs no states, so one pass
lists a level's contexts with their sums and the next level's sequences.  Sequences are known by 64-bit
hashes.  A context stays a state when the divergence of its next-symbol distribution
from that of its longest retained suffix, times its occurrences, is ``SIGNIFICANCE``
nats or more (the log likelihood that it gains).  Distributions are smoothed by
absolute discounting: what a state's symbols give up goes to the distribution of
its suffix, the root's being the base distribution.  A text is scored with the
longest suffix state before each token, a start mark counting as a word.

Defined cases: null text is empty text, the end token alone; without training
documents N and V are 0 and every token has probability 1; rows without an id
fall into a fold by the empty text; equal texts have equal scores; a text of any
length is one row of its split; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Callable, Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import MOST_BUCKETS, bounded_batches, byte_chunks, crc_remainder, mix64, saved, shared_folder, table, word_hashes

FOLDS = 10
SPLIT_BYTES = 16 << 20
#: A split of very short words ends earlier, at so many of them.
SPLIT_TOKENS = 3 << 20
#: Text for each range of the hash space; its keys are merged by one task.
RANGE_BYTES = 16 << 20
#: Rounds in which the sequences of a first level go to the ranges, so that a part of them is on disk at a time.
ROUNDS = 2
DEPTH = 3
#: Occurrences that a context, and a symbol after it, must have; no share of the corpus is asked.
CONTEXT_LEAST = 3
LEAST = 2
SIGNIFICANCE = 10.0
DISCOUNT = 0.5
#: Hashes of the end token and of the mark before the first word.
END, START = -1, -2

SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
PACKED = "range long, split long, state boolean, keys binary, data binary"
KNOWN = "split long, level int, state boolean, range long, keep binary, data binary, owner binary, ranks binary, n long, v long"
DEALT = "split long, doc_id long, held_out boolean, ids binary, words binary, counts binary"


class SplitTable:
    """A table under the shared folder, bucketed by split and appended to."""

    def __init__(self, spark: SparkSession, name: str, buckets: int):
        self.spark, self.buckets = spark, buckets
        self.name = f"{name}_{uuid.uuid4().hex}"
        self.path = f"{shared_folder(spark)}/{self.name}"

    def append(self, df: DataFrame) -> None:
        saved(df, lambda out: out.option("path", self.path).bucketBy(self.buckets, "split").saveAsTable(self.name))

    def gather(self, df: DataFrame) -> None:
        """Append rows that a shuffle computes, with one file a bucket.

        They are first put into a table of their own, dropped at the end, so that
        the shuffle to them and the one to the buckets never lie on disk together.
        """
        held = f"{self.name}_{uuid.uuid4().hex[:8]}"
        saved(df, lambda out: out.saveAsTable(held))
        try:
            self.append(self.spark.table(held).repartition(self.buckets, "split"))
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {held}")

    def read(self) -> DataFrame:
        return self.spark.table(self.name)


def numbered(words: list[bytes], known: dict[bytes, int], learn: Callable[[list[bytes]], Iterable[int]]) -> np.ndarray:
    """The number that ``known`` has for each word; ``learn`` gives those of new words, in one go."""
    out = np.fromiter(map(known.get, words, repeat(-2)), np.int64, len(words))
    new = np.flatnonzero(out == -2)
    if len(new):
        fresh = list({words[i] for i in new.tolist()})
        known.update(zip(fresh, learn(fresh), strict=True))
        out[new] = [known[words[i]] for i in new.tolist()]
    return out


def _deal(split_bytes: int):
    """Documents as numbers of their words, and after the last of a split a row of its words' hashes and training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        part, size, tokens, trained = 0, 0, 0, 0
        number: dict[bytes, int] = {}
        counts = np.zeros(0, np.int64)
        schema = pa.schema([("split", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("ids", pa.binary()), ("words", pa.binary()), ("counts", pa.binary())])

        def dictionary() -> pa.RecordBatch:
            h = np.append(word_hashes(list(number), {}).view(np.int64), END)
            c = np.append(counts, trained).astype(np.int64)
            return pa.RecordBatch.from_pylist([{"split": first | part, "words": h.tobytes(), "counts": c.tobytes()}], schema)

        for batch, texts in byte_chunks(batches, 4 << 20):
            words = [(t or b"").lower().split() for t in texts]
            at = numbered([w for ws in words for w in ws], number, lambda new: range(len(number), len(number) + len(new)))
            lengths = np.array([len(ws) for ws in words], np.int64)
            train = ~batch.column("held_out").to_numpy(zero_copy_only=False)
            seen = np.bincount(at[np.repeat(train, lengths)], minlength=len(number))
            seen[: len(counts)] += counts
            counts, trained = seen, trained + int(train.sum())
            offsets = np.concatenate([[0], np.cumsum(lengths * 4)]).astype(np.int32)
            ids = pa.Array.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(offsets), pa.py_buffer(at.astype(np.int32))])
            none = pa.nulls(len(words), pa.binary())
            columns = [pa.array(np.full(len(words), first | part, np.int64)), batch.column("doc_id").cast(pa.int64()), batch.column("held_out"), ids, none, none]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
            size, tokens = size + sum(len(t or b"") for t in texts), tokens + len(at)
            if size >= split_bytes or tokens >= SPLIT_TOKENS:
                yield dictionary()
                part, size, tokens, trained, number, counts = part + 1, 0, 0, 0, {}, np.zeros(0, np.int64)
        if len(number) or trained:
            yield dictionary()

    return run


def _planes(values: np.ndarray) -> bytes:
    """How many numbers, then their first bytes, their second ones and so on, which are alike, each compressed after its size (zeros: size 0)."""
    planes = np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T)
    packed = [pa.compress(plane, codec="zstd", asbytes=True) if plane.any() else b"" for plane in planes]
    return struct.pack("<q", len(values)) + b"".join(struct.pack("<i", len(x)) + x for x in packed)


def _numbers(packed: list[bytes], kind: type) -> list[np.ndarray]:
    """The numbers of each of ``_planes``."""
    out = []
    for whole in packed:
        (n,), at = struct.unpack_from("<q", whole), 8
        numbers = np.zeros((n, np.dtype(kind).itemsize), np.uint8)
        for k in range(numbers.shape[1]):
            (size,) = struct.unpack_from("<i", whole, at)
            if size:
                numbers[:, k] = np.frombuffer(pa.decompress(whole[at + 4 : at + 4 + size], n, codec="zstd"), np.uint8)
            at += 4 + size
        out.append(numbers.reshape(-1).view(kind))
    return out


def _bits(flags: np.ndarray) -> bytes:
    """How many flags, then a bit for each, compressed."""
    return struct.pack("<q", len(flags)) + pa.compress(np.packbits(flags), codec="zstd", asbytes=True)


def _flags(packed: list[bytes]) -> np.ndarray:
    """The flags of all ``_bits``, one after the other."""
    out = [np.zeros(0, np.uint8)]
    for whole in packed:
        (n,) = struct.unpack_from("<q", whole)
        out.append(np.unpackbits(np.frombuffer(pa.decompress(whole[8:], -(-n // 8), codec="zstd"), np.uint8), count=n))
    return np.concatenate(out).view(np.bool_)


def _gaps(keys: np.ndarray) -> bytes:
    """Keys in order as the first one and the gaps between them, modulo 2 ** 64: dense ones have many zero bytes."""
    return _planes(np.diff(keys.view(np.uint64), prepend=np.uint64(0)))


def _keys(packed: list[bytes]) -> list[np.ndarray]:
    """The keys of each of ``_gaps``."""
    return [np.cumsum(x, dtype=np.uint64).view(np.int64) for x in _numbers(packed, np.uint64)]


def _order(keys: np.ndarray) -> np.ndarray:
    """Places of 64-bit keys in their order, equal ones as they come.

    Their first bits are sorted with their places in the last ones as single numbers,
    which takes a fraction of the time of sorting places.
    """
    keys, bits = keys.view(np.uint64), np.uint64(len(keys).bit_length())
    both = keys >> bits
    both <<= bits
    both |= np.arange(len(keys), dtype=np.uint64)
    both.sort()
    both &= np.uint64((1 << int(bits)) - 1)
    order = both.view(np.int64)
    ranked = keys[order]
    if (ranked[1:] < ranked[:-1]).any():  # different keys that begin alike, of which there are few
        order = order[np.argsort(ranked, kind="stable")]
    return order


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the place of each one's first, and the number among them of every key."""
    order = _order(keys)
    ranked = keys.view(np.uint64)[order]
    new = np.ones(len(keys), bool)
    np.not_equal(ranked[1:], ranked[:-1], out=new[1:])
    where = np.empty(len(keys), np.int64)
    where[order] = np.cumsum(new) - 1
    return ranked[new].view(keys.dtype), order[new], where


def _packed(split: int, state: bool, keys: np.ndarray, values: np.ndarray, ranges: int, turn: int = 0, turns: int = 1) -> pa.Table:
    """Distinct keys, each with a value or a row of them, as a row for each range of the hash space that has its turn; values lie column by column."""
    order = _order(keys)
    keys, values = keys.view(np.uint64)[order], values[order]
    which = (((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)
    starts = np.flatnonzero(np.diff(which, prepend=-1))
    spans = [(i, j) for i, j in zip(starts.tolist(), np.append(starts, len(keys))[1:].tolist(), strict=True) if which[i] % turns == turn]
    starts = starts[which[starts] % turns == turn]
    return pa.table({
        "range": which[starts], "split": np.full(len(starts), split, np.int64), "state": np.full(len(starts), state),
        "keys": pa.array([_gaps(keys[i:j]) for i, j in spans], pa.binary()), "data": pa.array([_planes(values[i:j].T.reshape(-1)) for i, j in spans], pa.binary()),
    })


def _split_words(ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _packed(row["split"], False, np.frombuffer(row["words"], np.int64), np.frombuffer(row["counts"], np.int64), ranges).to_batches()

    return run


class Merged:
    """The packed rows of a range: its keys and values, and for each the number of its key and its row."""

    def __init__(self, rows: pa.Table, kind: type, columns: int = 1):
        rows = rows.sort_by([("split", "ascending"), ("range", "ascending")])
        self.splits, self.ranges = rows.column("split").to_numpy(), rows.column("range").to_numpy()
        packed = _keys(rows.column("keys").to_pylist())
        self.keys = np.concatenate(packed)
        self.values = np.concatenate([d.reshape(columns, -1) for d in _numbers(rows.column("data").to_pylist(), kind)], axis=1)
        self.edges = np.concatenate([[0], np.cumsum([len(k) for k in packed])])
        self.distinct, self.first, self.where = _distinct(self.keys)

    def rows(self, level: int, state: bool, keep: np.ndarray, values: np.ndarray, owner: np.ndarray) -> pa.Table:
        """Rows of ``KNOWN``: which of each split's keys to ``keep``, and of those the values, the ones it owns, and the ranks if they may be contexts."""
        out, contexts = [], not state and level < DEPTH
        rank = (np.cumsum(keep[self.first], dtype=np.uint64) - np.uint64(1))[self.where]
        for split, of, i, j in zip(self.splits.tolist(), self.ranges.tolist(), self.edges[:-1].tolist(), self.edges[1:].tolist(), strict=True):
            kept = values[i:j][keep[i:j]]
            mine = owner[i:j][keep[i:j]]
            out.append((split, level, state, of, _bits(keep[i:j]), _planes(kept), _bits(mine), _gaps(rank[i:j][keep[i:j]]) if contexts else None, int(kept[mine].sum()), int((kept[mine] > 0).sum())))
        kinds = [pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
        names = [column.split()[0] for column in KNOWN.split(", ")]
        return pa.table({name: pa.array([row[i] for row in out], kind) for i, (name, kind) in enumerate(zip(names, kinds, strict=True))})


def _totals(rows: pa.Table, level: int, least: int) -> pa.Table:
    """What each split is to know of its keys in a range: the whole corpus's counts of ``least`` and more, and whether it is the key's owner, the first split with it."""
    merged = Merged(rows, np.int64)
    total = np.bincount(merged.where, merged.values[0], len(merged.distinct)).astype(np.int64)[merged.where]
    owner = np.zeros(len(total), bool)
    owner[merged.first] = True
    return merged.rows(level, False, total >= least, total, owner)


def _states(rows: pa.Table, level: int) -> pa.Table:
    """What each split is to know of its contexts in a range: those that stay states, and the mass of their symbols in discounts."""
    merged = Merged(rows, np.float64, 5)
    # a context's owners send its count with their sums, others ask
    total = np.ones(len(merged.distinct))
    np.maximum.at(total, merged.where, merged.values[0])
    seen, symbols, listed, lower = (np.bincount(merged.where, v, len(total)) for v in merged.values[1:])
    # the symbols listed, and all others as one
    left = 1 - seen / total
    others = np.where(left > 1e-12, left * np.log(np.maximum(left, 1e-12) / np.maximum(1 - lower, 1e-12)), 0.0)
    keep = total * (listed + others) >= SIGNIFICANCE
    mass = (seen / DISCOUNT - symbols).astype(np.int64)  # in units of the discount
    return merged.rows(level, True, keep[merged.where], mass[merged.where], np.zeros(len(merged.keys), bool))


def _merge(level: int, least: int):
    """The rows of ``KNOWN`` of a range: states of this level, counts of the sequences after it."""

    def run(rows: pa.Table) -> pa.Table:
        state = rows.column("state")
        contexts, sequences = rows.filter(state), rows.filter(pa.compute.invert(state))
        out = [_states(contexts, level)] if contexts.num_rows else []
        if sequences.num_rows:
            out.append(_totals(sequences, level + 1, least))
        return pa.concat_tables(out)

    return run


class Split:
    """A split's tokens (each text's words and its end), and what it knows of them at a level of the tree.

    That is each token's context at the level (by its place among ``names``, the last
    of which stands for none), the contexts' counts, whether the sequence of the level
    before that the token ends is found ``LEAST`` times, and the token's probability by
    the states of the levels before.
    """

    def __init__(self, docs: pa.Table, known: pa.Table, n_tokens: int, n_words: int):
        self.known = known.sort_by("range")
        self.id = docs.column("split")[0].as_py()
        words = [w for w in docs.column("words").to_pylist() if w is not None]
        self.hashes = np.frombuffer(words[0], np.uint64)
        self.docs = docs.filter(pa.compute.is_valid(docs.column("ids")))
        self.lengths = pa.compute.binary_length(self.docs.column("ids")).to_numpy().astype(np.int64) // 4 + 1
        ends = np.cumsum(self.lengths) - 1
        self.starts = ends + 1 - self.lengths
        self.number = np.full(int(self.lengths.sum()), len(self.hashes) - 1, np.int32)  # the end token is the last of the words
        inner = np.ones(len(self.number), bool)
        inner[ends] = False
        self.number[inner] = np.frombuffer(b"".join(self.docs.column("ids").to_pylist()), np.int32)
        self.counts = np.empty(len(self.hashes), np.int64)
        self.counts[_order(self.hashes)] = self.told(0, False)[1]  # all words are kept
        self.base = (self.counts + 0.1) / max(n_tokens + 0.1 * (n_words + 1), 0.1)
        self.p = self.base[self.number]
        # the contexts of the first level are the words and the start mark
        self.depth, self.names = 0, np.concatenate([self.hashes, np.array([START, 0]).view(np.uint64)])
        self.totals = np.concatenate([self.counts, self.counts[-1:], [0]])
        self.context = self.shifted(self.number, len(self.hashes))
        self.again = (self.counts >= LEAST)[self.number]

    def told(self, level: int, state: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of the keys that the split listed at a level are kept, and of those the values and the ones it owns."""
        rows = self.known.filter((pa.compute.field("level") == level) & (pa.compute.field("state") == state))
        values = _numbers(rows.column("data").to_pylist(), np.int64)
        return _flags(rows.column("keep").to_pylist()), np.concatenate([np.zeros(0, np.int64), *values]), _flags(rows.column("owner").to_pylist())

    def short_names(self, ranges: int) -> np.ndarray:
        """For each context of the level its range's first key and its rank there as one key, in the order of the names."""
        rows = self.known.filter((pa.compute.field("level") == self.depth) & ~pa.compute.field("state"))
        kept = np.flatnonzero(_flags(rows.column("keep").to_pylist()))
        firsts = [np.uint64(-(-(of << 32) // ranges) << 32) for of in rows.column("range").to_pylist()]
        out = np.zeros(len(self.names), np.uint64)
        keys = [x.view(np.uint64) + first for x, first in zip(_keys(rows.column("ranks").to_pylist()), firsts, strict=True)]
        out[kept if self.depth else _order(self.hashes)[kept]] = np.concatenate([np.zeros(0, np.uint64), *keys])
        if not self.depth:
            out[len(self.hashes)] = self.names[len(self.hashes)]  # the start mark, after all ranks of the last range
        return out

    def shifted(self, entry: np.ndarray, first: int) -> np.ndarray:
        """For each token what the one before has, ``first`` at the start of a text."""
        out = np.empty_like(entry)
        out[1:] = entry[:-1]
        out[self.starts] = first
        return out

    def listed(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens after a context of the level that may end a sequence in the tree, the hashes of these sequences in order, and for each such token the number of its own."""
        at = np.flatnonzero((self.totals >= CONTEXT_LEAST)[self.context] & self.again)
        keys = mix64(self.names, 2)[self.context[at]]
        keys ^= self.hashes[self.number[at]]
        keys, _, where = _distinct(mix64(keys, 3))
        return at, keys, where

    def asked(self) -> np.ndarray:
        """Places of the contexts whose states the split needs, in the order of their names."""
        seen = np.zeros(len(self.names), bool)
        seen[self.context] = True
        at = np.flatnonzero(seen & (self.totals >= CONTEXT_LEAST))
        return at[_order(self.names[at])]

    def follow(self) -> np.ndarray:
        """Count each listed sequence, and find for each token the one that it ends (the number after the last: none); returns those kept that the split owns."""
        at, self.keys, where = self.listed()
        keep, counts, owner = self.told(self.depth + 1, False)
        kept = np.flatnonzero(keep)
        self.found = np.zeros(len(self.keys) + 1, np.int64)
        self.found[kept] = counts
        self.entry = np.full(len(self.number), len(self.keys), np.int32)
        self.entry[at] = where
        return kept[owner]

    def smooth(self) -> None:
        """Take the states of the level into the probabilities."""
        keep, mass, _ = self.told(self.depth + 1, True)
        states = self.asked()[keep]
        rest, total = np.ones(len(self.names)), np.zeros(len(self.names))
        rest[states], total[states] = 1 - mass * DISCOUNT / self.totals[states], self.totals[states]
        at = np.flatnonzero((total > 0)[self.context])
        context = self.context[at]
        self.p[at] = self.p[at] * rest[context] + np.maximum(self.found - DISCOUNT, 0)[self.entry[at]] / total[context]

    def descend(self) -> None:
        """The sequences of this level are the contexts of the next one."""
        self.names, self.totals = np.append(self.keys, np.uint64(0)), self.found
        self.context = self.shifted(self.entry, len(self.keys))
        self.again = (self.found >= LEAST)[self.entry]
        self.depth += 1

    def walk(self, levels: int) -> None:
        for _ in range(levels):
            self.follow()
            self.smooth()
            self.descend()


def _listed(level: int, n_tokens: int, n_words: int, ranges: int, turn: int, turns: int):
    """What a split lists for the ranges that have their turn when sequences up to this level are known.

    Its contexts of this level (above 0): their counts, and what the sequences it owns add to the sums of their
    divergence.  Its sequences of the next level (up to ``DEPTH``) that may be in the tree, with their training counts.
    """

    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        split, out = Split(docs, known, n_tokens, n_words), []
        split.walk(level - 1)
        if level:
            own = split.follow()
            of, lower = np.zeros(len(split.found), np.int32), np.ones(len(split.found))
            of[split.entry], lower[split.entry] = split.context, split.p
            of, lower, c, asked = of[own], lower[own], split.found[own], split.asked()
            share = c / split.totals[of]
            seen, symbols, listed, below = (np.bincount(of, v, len(split.names)) for v in (c, np.ones(len(c)), share * np.log(share / lower), lower))
            values = np.column_stack([x[asked] for x in (np.where(symbols > 0, split.totals, 0), seen, symbols, listed, below)]).astype(np.float64)
            out.append(_packed(split.id, True, split.short_names(ranges)[asked], values, ranges, turn, turns))
            split.descend()
        if level < DEPTH:
            at, keys, where = split.listed()
            train = np.repeat(~split.docs.column("held_out").to_numpy(), split.lengths)[at]
            out.append(_packed(split.id, False, keys, np.bincount(where, train, len(keys)).astype(np.int64), ranges, turn, turns))
        return pa.concat_tables(out)

    return run


def _score(n_tokens: int, n_words: int):
    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        split = Split(docs, known, n_tokens, n_words)
        split.walk(DEPTH)
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        schema = pa.schema(list(zip([column.split()[0] for column in SCORES.split(", ")], kinds, strict=True)))
        n_known, base, score = (np.add.reduceat(x, split.starts) for x in ((split.counts > 0).astype(np.int64)[split.number], np.log10(split.base)[split.number], np.log10(split.p)))
        columns = [split.docs.column("doc_id").combine_chunks(), split.docs.column("held_out").combine_chunks(), split.lengths, n_known, np.full(len(base), n_tokens, np.int64), base, score]
        return pa.table([pa.array(x) if isinstance(x, np.ndarray) else x for x in columns], schema=schema)

    return run


def suffix_tree_scores(docs: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """One row per document: the columns of ``SCORES``."""
    spark = docs.sparkSession
    rows = bounded_batches(docs).select("doc_id", "text", (crc_remainder(F.col("doc_id"), FOLDS) == 0).alias("held_out"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    # twice the splits expected, so that few share a bucket
    buckets = min(MOST_BUCKETS, 2 * max(4, -(-size // split_bytes)))
    ranges = max(4, -(-size // RANGE_BYTES))
    dealt, known = (SplitTable(spark, name, buckets) for name in ("suffix_dealt", "suffix_known"))
    dealt.append(rows.mapInArrow(_deal(split_bytes), DEALT))

    def learn(packed: DataFrame, merge) -> None:
        known.gather(packed.repartition(min(ranges, MOST_BUCKETS), "range").groupBy("range").applyInArrow(merge, KNOWN))

    learn(dealt.read().filter("words is not null").select("split", "words", "counts").mapInArrow(_split_words(ranges), PACKED), _merge(-1, 0))
    sizes = known.read().agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    for level in range(DEPTH + 1):
        turns = ROUNDS if level < DEPTH - 1 else 1  # the last levels list the least
        for turn in range(turns):
            splits = dealt.read().groupBy("split").cogroup(known.read().groupBy("split"))
            learn(splits.applyInArrow(_listed(level, *sizes, ranges, turn, turns), PACKED), _merge(level, LEAST))
    return dealt.read().groupBy("split").cogroup(known.read().groupBy("split")).applyInArrow(_score(*sizes), SCORES)


def op8_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree_scores(table(spark, sf_dir, "documents"))
