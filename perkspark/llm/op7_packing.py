"""Packing: vector bin packing with the dot-product heuristic.

Examples with three sizes (tokens, segments, loss-bearing tokens) go into
sequences with a limit on each.  An open sequence takes, among the examples that
still fit, the one whose sizes have the largest weighted dot product with what
is left of the limits; it is closed when none fits.  Blocks are hash groups of
about ``BLOCK`` examples, packed one per task; each leaves at most a few
part-filled sequences.

For documents, texts are tokenised once and cut every ``capacity`` ids; full
pieces are sequences of their own, the last pieces are packed.  Tokens are found
word by word: the tokenizer's added tokens have no white space, and its normaliser
and splitter never look across any, so ids of a text are those of its words in
order.  Words are split and told apart in Arrow, each distinct one is tokenised once.

Defined cases: null or empty text is the end id alone; text that spells an added
token has that token's id, as in the tokenizer's plain call; an empty table gives an
empty result; equal rows are separate documents, dealt to blocks by their place; very
long texts are tokenised whole, one at a time; an example beyond a limit by itself
gets a sequence of its own; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, checkpointed, table, text_chunks

CAPACITY = 2048
MAX_SEGMENTS = 1024
END_ID = 1
BLOCK = 8192
#: Words whose ids a task keeps between chunks of text (some 500 bytes each, with their parts).
CACHE_WORDS = 600_000

#: Latin-1 letters, and those in lower case.
LATIN_LETTERS = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
LATIN_LOWER = "\u00df-\u00f6\u00f8-\u00ff"

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class Runs:
    """Numbered runs of ids: each key's ids, found once."""

    def __init__(self):
        self.number: dict = {}
        self.ids = np.zeros(0, "<u4")
        self.starts = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)

    def add(self, keys: list, ids: np.ndarray, counts: np.ndarray) -> None:
        self.number.update(zip(keys, range(len(self.counts), len(self.counts) + len(keys)), strict=True))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.ids = np.concatenate([self.ids, ids])

    def numbers(self, keys: list) -> np.ndarray:
        return np.fromiter(map(self.number.__getitem__, keys), np.int64, len(keys))

    def of(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the numbered keys in a row, and how many each has."""
        counts = self.counts[index]
        ends = np.cumsum(counts)
        place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[index] - (ends - counts), counts)
        return self.ids[place], counts


class WordIds:
    """Ids of words, each distinct word tokenised once.

    Words of printable ASCII and Latin-1 letters, which any normalisation but
    lower case leaves alone, are split here by the tokenizer's own pattern, all new
    ones in one go, and each distinct part goes through its merges once; other words
    go through the whole tokenizer.
    """

    def __init__(self, tokenizer_file: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.merge = self.tokenizer.model.tokenize
        self.plain = re.compile(f"[!-~{LATIN_LETTERS}]+")
        self.plain_words = re.compile(f"[ -~{LATIN_LETTERS}]*")
        self.parts = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{LATIN_LOWER}]+|[0-9]| |[^ a-z0-9{LATIN_LOWER}]+")
        as_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        self.to_bytes = {c: as_bytes.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100) if c != 0xF7}
        self.cache_words = cache_words
        self.words, self.of_parts = Runs(), Runs()

    def _is_plain(self, word: str) -> bool:
        return self.plain.fullmatch(word) is not None and not any(t in word for t in self.added)

    def _plain_words(self, joined: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words joined by single spaces, and each word's number of them."""
        parts = self.parts.findall(joined.lower())
        new = list(set(parts).difference(self.of_parts.number))
        flat: list[int] = []
        counts = np.zeros(len(new), np.int64)
        for i, part in enumerate(new):
            if part != " ":
                tokens = self.merge(part if part.isascii() else part.translate(self.to_bytes))
                flat += [t.id for t in tokens]
                counts[i] = len(tokens)
        self.of_parts.add(new, np.array(flat, "<u4"), counts)
        index = self.of_parts.numbers(parts)
        ids, each = self.of_parts.of(index)
        gaps = index == self.of_parts.number.get(" ", -1)
        word = np.cumsum(gaps)
        return ids, np.bincount(word, each, int(gaps.sum()) + 1).astype(np.int64)

    def _add(self, new: list[bytes]) -> None:
        joined = b" ".join(new).decode()
        if self.plain_words.fullmatch(joined) and not any(t in joined for t in self.added):
            self.words.add(new, *self._plain_words(joined))
            return
        texts = [w.decode() for w in new]
        plain = [self._is_plain(t) for t in texts]
        if any(plain):
            some = [w for w, yes in zip(new, plain, strict=True) if yes]
            self.words.add(some, *self._plain_words(b" ".join(some).decode()))
        others = [w for w, yes in zip(new, plain, strict=True) if not yes]
        found = [self.tokenizer.encode(w.decode(), add_special_tokens=False).ids for w in others]
        self.words.add(others, np.array([i for ids in found for i in ids], "<u4"), np.array([len(ids) for ids in found], np.int64))

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words (binary) in a row, and how many each word has."""
        if len(self.words.number) > self.cache_words:
            self.words, self.of_parts = Runs(), Runs()
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        new = [w for w in distinct if w not in self.words.number]
        if new:
            self._add(new)
        return self.words.of(self.words.numbers(distinct)[coded.indices.to_numpy()])


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts (UTF-8 bytes) in a row, and the number of words up to each text's end."""
    lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    words = lists.flatten()  # white space at either end leaves an empty word
    some = pc.greater(pc.binary_length(words), 0)
    up_to = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))])
    offsets = lists.offsets.to_numpy()
    return words.filter(some).cast(pa.large_binary()), up_to[offsets[1:] - offsets[0]]


def _tokenise(tokenizer_file: str, capacity: int, end_id: int, cache_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_ids = None
        for batch, texts in text_chunks(batches, 2 << 20):
            words_ids = words_ids or WordIds(tokenizer_file, cache_words)
            words, word_ends = split_words(texts)
            ids, counts = words_ids.encode(words)
            ends = np.concatenate([[0], np.cumsum(counts)])[word_ends]
            out: list[tuple] = []
            begin = 0
            for doc_id, end in zip(batch.column(0).to_pylist(), ends.tolist(), strict=True):
                own = np.append(ids[begin:end], np.uint32(end_id)).astype("<u4")
                begin = end
                for start in range(0, len(own), capacity):
                    piece = own[start : start + capacity]
                    out.append((doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(own)))
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[p.split()[0] for p in PIECES.split(", ")])

    return run


def dot_product_pack(sizes: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset (in the first size) of each row of ``sizes``; rows are tried in the given order on ties."""
    n = len(sizes)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    alone = (sizes > limits).any(axis=1)
    bins[alone] = np.arange(alone.sum())
    number = int(alone.sum())
    full = ~alone & (sizes[:, 0] == limits[0])
    bins[full] = number + np.arange(full.sum())
    number += int(full.sum())
    rest = np.flatnonzero(~alone & ~full)
    items = sizes[rest] / limits
    weights = items.mean(axis=0) if len(rest) else np.ones(sizes.shape[1])
    # equal sizes wait in one line: the scan is over distinct sizes
    kinds, kind_of = np.unique(sizes[rest], axis=0, return_inverse=True)
    order = np.argsort(kind_of.reshape(-1), kind="stable")
    ahead = np.searchsorted(kind_of.reshape(-1)[order], np.arange(len(kinds) + 1))
    head, left = ahead[:-1].copy(), np.diff(ahead)
    scaled = kinds / limits * weights
    remaining = len(rest)
    while remaining:
        room, used = limits.astype(float).copy(), 0
        while remaining:
            fits = (left > 0) & (kinds <= room).all(axis=1)
            if not fits.any():
                break
            best = int(np.argmax(np.where(fits, scaled @ (room / limits), -1.0)))
            i = rest[order[head[best]]]
            head[best] += 1
            left[best] -= 1
            bins[i], offsets[i] = number, used
            used += int(sizes[i, 0])
            room -= sizes[i]
            remaining -= 1
        number += 1
    return bins, offsets


def _pack_block(limits: tuple[int, int, int]):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["_h", "tokens", "segments", "loss_tokens"], kind="stable").reset_index(drop=True)
        sizes = group[["tokens", "segments", "loss_tokens"]].to_numpy(np.int64)
        bins, offsets = dot_product_pack(sizes, np.array(limits, np.int64))
        group["sequence_id"] = (int(group["_block"].iloc[0]) << 32) + bins
        group["offset"] = offsets
        return group

    return run


def pack_examples(examples: DataFrame, max_tokens: int, max_segments: int, max_loss_tokens: int, block: int = BLOCK) -> DataFrame:
    """``examples`` (any columns, with tokens, segments and loss_tokens as long) plus sequence_id and offset.

    ``_h`` must tell the rows apart well enough to deal them out evenly.
    """
    n = examples.count()
    blocks = max(1, -(-n // block))
    cut = examples.withColumn("_block", F.pmod(F.xxhash64("_h", F.lit(7)), F.lit(blocks)))
    schema = T.StructType([*cut.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return cut.groupBy("_block").applyInPandas(_pack_block((max_tokens, max_segments, max_loss_tokens)), schema).drop("_block", "_h")


def pack_documents(docs: DataFrame, tokenizer_file: str | None = None, capacity: int = CAPACITY, max_segments: int = MAX_SEGMENTS, max_loss_tokens: int = CAPACITY, cache_words: int = CACHE_WORDS) -> DataFrame:
    """Pieces of all documents with their place: the columns of ``PIECES``, sequence_id and offset.

    In pre-training text every token bears loss, so both token limits agree.
    """
    if tokenizer_file is None:
        import public_tokenizers

        tokenizer_file = public_tokenizers.path("word_bpe_49k.json")
    pieces = bounded_batches(docs).select("doc_id", "text").mapInArrow(_tokenise(tokenizer_file, capacity, END_ID, cache_words), PIECES)
    sized = checkpointed(pieces).withColumns(
        {"tokens": F.col("length"), "segments": F.lit(1).cast("long"), "loss_tokens": F.col("length"), "_h": F.xxhash64("doc_id", "start", "ids_crc32", F.monotonically_increasing_id())}
    )
    packed = pack_examples(sized, capacity, max_segments, max_loss_tokens)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def conversation_examples(turns: DataFrame, trained_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One example per conversation: words as tokens, one segment per turn, loss on the trained roles' words."""
    from .common import word_count

    counted = turns.select("conv_id", "role", word_count(F.col("text").cast("binary")).alias("n"))
    loss = F.when(F.col("role").isin(*trained_roles), F.col("n")).otherwise(F.lit(0))
    examples = counted.groupBy("conv_id").agg(F.sum("n").alias("tokens"), F.count("*").alias("segments"), F.sum(loss).alias("loss_tokens"))
    return examples.withColumn("_h", F.xxhash64("conv_id"))


def op7_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
