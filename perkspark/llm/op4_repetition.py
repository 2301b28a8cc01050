"""Quality rules: repetition coverage by rolling hashes.

Words of a text get 64-bit values; n-gram hashes of the lengths
``NGRAMS`` roll over them in numpy (H_n[i] = H_{n-1}[i] * B + h[i+n-1]), many
texts at a time.  A word is covered for n when it lies in an n-gram that the
same text holds twice or more; coverage is the share of the text's word
characters that are covered.  The same is measured for repeated lines.

Defined cases: null or empty text has no words, all counts 0, base_failed
true, kept false.  Texts are read whole.  Equal rows give equal results, a null
doc_id is passed through, other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import ASCII_SPACE, CONTINUATION, bounded_batches, byte_chunks, mix64, table

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Length of n-grams: greatest share of word characters inside duplicated ones.
NGRAMS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: Greatest share of word characters in lines that repeat an earlier one.
MAX_LINE_SHARE = 0.20

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "dup_line_chars long, "
    + ", ".join(f"dup_chars_{n} long" for n in NGRAMS)
    + ", base_failed boolean, kept boolean"
)


def covered_words(ids: np.ndarray, doc: np.ndarray, lengths: tuple[int, ...]) -> dict[int, np.ndarray]:
    """For each n: which words lie in an n-gram found twice or more in their own text.

    ``ids`` number the words (equal words, equal numbers), ``doc`` their texts.
    """
    base = np.uint64(0x9E3779B97F4A7C15)
    value, own = mix64(ids, 1), mix64(doc, 2)
    rolled, out = value.copy(), {}
    for n in range(2, max(lengths) + 1):
        if len(ids) < n:
            out.update({k: np.zeros(len(ids), bool) for k in lengths if k >= n})
            break
        rolled = rolled[:-1] * base + value[n - 1 :]
        if n not in lengths:
            continue
        inside = np.flatnonzero(doc[: len(rolled)] == doc[n - 1 :])
        keys = mix64(rolled[inside], n) + own[inside]
        order = np.argsort(keys)
        ranked = keys[order]
        same = ranked[1:] == ranked[:-1]
        repeated = np.zeros(len(keys), bool)
        repeated[order[1:][same]] = True
        repeated[order[:-1][same]] = True
        starts = inside[repeated]
        edge = np.zeros(len(ids) + 1, np.int64)
        edge[starts] += 1
        np.subtract.at(edge, starts + n, 1)
        out[n] = np.cumsum(edge[:-1]) > 0
    return out


def word_char_counts(buffer: bytes, n_words: int) -> np.ndarray:
    """Code points of each word of ``buffer``."""
    if not n_words:
        return np.zeros(0, np.int64)
    data = np.frombuffer(buffer, np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    bounds = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]])))
    return points[bounds[1::2]] - points[bounds[::2]]


def repeated_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and the characters of their words."""
    seen: set[bytes] = set()
    n = chars = 0
    for line in text.split(b"\n"):
        if line in seen:
            n += 1
            chars += len(line.translate(None, ASCII_SPACE + CONTINUATION))
        elif line.strip(ASCII_SPACE):
            seen.add(line)
    return n, chars


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lengths = (3, *NGRAMS)
    for batch, texts in byte_chunks(batches):
        texts = [t or b"" for t in texts]
        buffer = b"\n".join(texts)
        words = buffer.split()
        numbers: dict[bytes, int] = {}
        fresh = count().__next__
        ids = np.fromiter((numbers[w] if w in numbers else numbers.setdefault(w, fresh()) for w in words), np.int64, len(words))
        n_words = np.array([len(t.split()) for t in texts], np.int64)
        doc = np.repeat(np.arange(len(texts)), n_words)
        chars = word_char_counts(buffer, len(words))

        def total(values: np.ndarray) -> np.ndarray:
            return np.bincount(doc, values, len(texts)).astype(np.int64)

        covered = covered_words(ids, doc, lengths)
        word_chars = total(chars)
        lines = np.array([repeated_lines(t) for t in texts], np.int64).reshape(-1, 2)
        n_repeat = total(covered[3])
        dup = {n: total(chars * covered[n]) for n in NGRAMS}
        failed = (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words)
        kept = ~failed & (lines[:, 1] <= MAX_LINE_SHARE * word_chars)
        for n, most in NGRAMS.items():
            kept &= dup[n] <= most * word_chars
        symbols = [len(t) - len(t.translate(None, SYMBOLS)) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).cast(pa.int64()), pa.array(n_words), pa.array(word_chars), pa.array(symbols, pa.int64()),
                pa.array(lines[:, 0]), pa.array(n_repeat), pa.array(lines[:, 1]), *(pa.array(dup[n]) for n in NGRAMS),
                pa.array(failed), pa.array(kept),
            ],
            names=[part.split()[0] for part in SCHEMA.split(", ")],
        )


def repetition_rules(docs: DataFrame) -> DataFrame:
    """One row per document: base counts, covered characters by length, verdict."""
    return bounded_batches(docs).select("doc_id", "text").mapInArrow(_measure, SCHEMA)


def op4_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_rules(table(spark, sf_dir, "documents"))


_W = r"[^\x20\x09-\x0D]+"
ORACLE_SQL = f"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_W}') AS words,
         row_number() OVER () AS r
  FROM documents
), pos AS (
  SELECT r, i, words[i] AS w FROM (SELECT r, words, unnest(range(1, len(words) + 1)) AS i FROM base)
), grams AS (
  SELECT b.r, n, p.i, array_to_string(b.words[p.i : p.i + n - 1], ' ') AS g
  FROM base b JOIN pos p USING (r), (SELECT unnest([3, {', '.join(map(str, NGRAMS))}]) AS n) l
  WHERE p.i + n - 1 <= len(b.words)
), again AS (
  SELECT r, n, i FROM (SELECT *, count(*) OVER (PARTITION BY r, n, g) AS c FROM grams) WHERE c > 1
), cover AS (
  SELECT DISTINCT r, n, unnest(range(i, i + n)) AS i FROM again
), covered AS (
  SELECT r, n, count(*) AS c, sum(length(w)) AS chars FROM cover JOIN pos USING (r, i) GROUP BY r, n
), lines AS (
  SELECT r, k, l, row_number() OVER (PARTITION BY r, l ORDER BY k) AS nth
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS l, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS k FROM base)
  WHERE regexp_matches(l, '{_W}')
), dup_lines AS (
  SELECT r, count(*) AS n, sum(length(regexp_replace(l, '[\\x20\\x09-\\x0D]+', '', 'g'))) AS chars FROM lines WHERE nth > 1 GROUP BY r
), counts AS (
  SELECT b.r, b.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(d.n, 0) AS n_dup_lines, coalesce(d.chars, 0) AS dup_line_chars,
         coalesce((SELECT c FROM covered x WHERE x.r = b.r AND x.n = 3), 0) AS n_repeat_words,
         {', '.join(f'coalesce((SELECT chars FROM covered x WHERE x.r = b.r AND x.n = {n}), 0) AS dup_chars_{n}' for n in NGRAMS)}
  FROM base b LEFT JOIN dup_lines d USING (r)
), judged AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counts
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, dup_line_chars::BIGINT AS dup_line_chars,
       {', '.join(f'dup_chars_{n}::BIGINT AS dup_chars_{n}' for n in NGRAMS)}, base_failed,
       NOT base_failed AND dup_line_chars <= {MAX_LINE_SHARE}::DOUBLE * word_chars
       AND {' AND '.join(f'dup_chars_{n} <= {m}::DOUBLE * word_chars' for n, m in NGRAMS.items())} AS kept
FROM judged
"""
