"""Line dedup with two Bloom filters: only lines suspected of repeating are shuffled.

1. Each task hashes the distinct line keys of its documents, keeps two sightings of
   a hash at most, and deals the hashes (eight bytes each, packed) by segments of
   the hash space.
2. A segment streams its hashes through a pair of filters: a hash already in the
   *once* filter goes into the *twice* filter.  The twice filter is folded to ten bits an entry,
   and further if need be to its share of ``FILTER_BYTES``; the once filter is
   dropped.  The segments' twice filters together, ``FILTER_BYTES`` at most whatever
   the table's size, are broadcast.  Folding only makes more lines suspects, it loses
   none.
3. A second scan sends each document's suspected keys, whole, to be confirmed:
   grouped by the text of the key, with partial minima in the tasks, they give the
   first document of each key.  Grouped by that document, they are its list of
   suspects to keep.
4. A suspected line is dropped unless its key is on its document's list.  (A key that
   only one document holds is first there, so a false suspect drops nothing.)

Defined cases: a null or empty text is one empty line; only the ASCII white space of
``common.ASCII_SPACE`` is stripped and only A-Z lower-cased; lines with short keys
always stay; a document's own repeats of a first line stay; documents are told apart
by doc_id, so rows that share an id share what they keep (an id's list has as many
keys at most as its rows have lines); rows with a null id have no place in the order, so they lose nothing and
nothing is lost for them; very long texts are taken whole, one at a time; an empty
table gives no rows; columns but doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ASCII_SPACE, CONTINUATION, bounded_batches, byte_chunks, mix64, table, written
from .op12_merkle_manifest import LOWER, UPPER

#: Keys of fewer code points never count as repeats.
LEAST = 10
#: All twice filters together, as they are broadcast.
FILTER_BYTES = 64 << 20
#: Lines of a segment, bits an entry and bits set by an entry.
SEGMENT_LINES, ENTRY_BITS, PROBES = 1 << 18, 10, 4
#: Hashes a task gathers before it sends them.
SENT_TOGETHER = 1 << 19


def line_key(line: bytes, least: int = LEAST) -> bytes | None:
    """The line's key, None if it is too short."""
    key = line.strip(ASCII_SPACE).lower()
    if len(key) < least or (len(key) < 4 * least and len(key.translate(None, CONTINUATION)) < least):
        return None
    return key


def key_hashes(keys: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, keys), dtype=np.uint64, count=len(keys))


def positions(hashes: np.ndarray, mask: np.ndarray | int) -> Iterator[np.ndarray]:
    """The bits of each hash in a filter of ``mask`` + 1 bits."""
    mixed = mix64(hashes, 1)
    first, step = mixed & np.uint64(0xFFFFFFFF), mixed >> np.uint64(32)
    for i in range(PROBES):
        yield (first + np.uint64(i) * step) & np.asarray(mask, np.uint64)


class FilterPair:
    """Filters of the hashes seen once and twice, for about ``lines`` of them."""

    def __init__(self, lines: int):
        self.size = 1 << max(6, (max(1, lines) * 2 * ENTRY_BITS - 1).bit_length())
        self.once, self.twice = np.zeros(self.size, bool), np.zeros(self.size, bool)
        self.entries = 0

    def add(self, hashes: np.ndarray) -> None:
        values, counts = np.unique(hashes, return_counts=True)
        again = counts > 1
        seen = np.ones(len(values), bool)
        for at in positions(values, self.size - 1):
            seen &= self.once[at]
        again |= seen
        for at in positions(values, self.size - 1):
            self.once[at] = True
        for at in positions(values[again], self.size - 1):
            self.twice[at] = True
        self.entries += int(again.sum())

    def folded(self, most_bits: int) -> np.ndarray:
        """The twice filter's bytes, as small as its entries and ``most_bits`` allow."""
        bits = self.twice
        while len(bits) > 8 and (len(bits) > most_bits or len(bits) >= 2 * ENTRY_BITS * (self.entries + 1)):
            half = len(bits) // 2
            bits = bits[:half] | bits[half:]
        return np.packbits(bits, bitorder="little")


class Suspects:
    """The twice filters of all segments in one array."""

    def __init__(self, segments: int, parts: dict[int, bytes]):
        sizes = np.array([len(parts.get(s, b"\0")) for s in range(segments)], np.int64)
        self.starts = np.cumsum(sizes) - sizes
        self.masks = (sizes * 8 - 1).astype(np.uint64)
        self.bits = np.frombuffer(b"".join(parts.get(s, b"\0") for s in range(segments)), np.uint8)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        segment = (hashes % np.uint64(len(self.masks))).astype(np.int64)
        start, found = self.starts[segment], np.ones(len(hashes), bool)
        for at in positions(hashes, self.masks[segment]):
            found &= (self.bits[start + (at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found


def _hashes(segments: int, least: int):
    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        values = np.repeat(values, np.minimum(counts, 2))  # more sightings tell nothing new
        segment = values % np.uint64(segments)
        order = np.argsort(segment, kind="stable")
        values, segment = values[order], segment[order]
        edges = np.flatnonzero(np.diff(segment, prepend=np.uint64(segments)))
        parts = [v.tobytes() for v in np.split(values, edges[1:])]
        return pa.RecordBatch.from_arrays([pa.array(segment[edges].astype(np.int64)), pa.array(parts, pa.binary())], names=["segment", "hashes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, texts in byte_chunks(batches):
            for text in texts:
                keys = {line_key(x, least) for x in text.split(b"\n")} if text else set()
                keys.discard(None)
                if keys:
                    held.append(key_hashes(list(keys)))
                    size += len(keys)
                    if size >= SENT_TOGETHER:
                        yield packed(held)
                        held, size = [], 0
        if held:
            yield packed(held)

    return run


def _filters(lines: int, most_bits: int):
    """Rows of a segment follow each other; only one pair of filters is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, pair = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([pair.folded(most_bits).tobytes()], pa.binary())], names=["segment", "twice"])

        for batch in batches:
            for segment, hashes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if segment != now:
                    if pair is not None and pair.entries:
                        yield done()
                    now, pair = segment, FilterPair(lines)
                pair.add(np.frombuffer(hashes, np.uint64))
        if pair is not None and pair.entries:
            yield done()

    return run


def suspects_of(docs: DataFrame, least: int, filter_bytes: int, segment_lines: int) -> Suspects:
    """The filter of keys that two rows hold (and, rarely, of others)."""
    lines = docs.agg(F.sum(F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)).first()[0] or 0
    segments = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-lines // segment_lines))
    most_bits = max(8, filter_bytes * 8 // segments)
    hashes = docs.select("text").mapInArrow(_hashes(segments, least), "segment long, hashes binary")
    dealt = hashes.repartition("segment").sortWithinPartitions("segment")
    twice = dealt.mapInArrow(_filters(-(-lines // segments), most_bits), "segment long, twice binary")
    return Suspects(segments, {r["segment"]: bytes(r["twice"]) for r in twice.collect()})


def _suspected_keys(shared, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suspects = shared.value
        for batch, texts in byte_chunks(batches):
            ids, keys = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                own = {line_key(x, least) for x in text.split(b"\n")} if text else set()
                own.discard(None)
                ids += [doc_id] * len(own)
                keys += own
            if keys:
                found = pa.array(suspects(key_hashes(keys)))
                out = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], names=["doc_id", "key"])
                yield out.filter(found)

    return run


def _without_repeats(shared, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suspects = shared.value
        for batch, texts in byte_chunks(batches):
            ids, first = batch.column(0).to_pylist(), batch.column(2)
            totals, drops, out = [], [], []
            for i, text in enumerate(texts):
                lines = (text or b"").split(b"\n")
                keys = [line_key(x, least) for x in lines] if ids[i] is not None else []
                at = [j for j, key in enumerate(keys) if key is not None]
                dropped = set()
                if at:
                    found = suspects(key_hashes([keys[j] for j in at]))
                    if found.any():
                        keep = set(first[i].as_py() or ())
                        dropped = {j for j, yes in zip(at, found.tolist(), strict=True) if yes and keys[j] not in keep}
                totals.append(len(lines))
                drops.append(len(dropped))
                out.append(b"\n".join(x for j, x in enumerate(lines) if j not in dropped) if dropped else text or b"")
            columns = [batch.column(0), pa.array(totals, pa.int64()), pa.array(drops, pa.int64()), pa.array(out, pa.large_binary()).cast(pa.large_string()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_lines", "n_dropped", "text"])

    return run


def deduplicated_lines(docs: DataFrame, least: int = LEAST, filter_bytes: int = FILTER_BYTES, segment_lines: int = SEGMENT_LINES) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text) of every row: lines before dropping, dropped ones, and the text without them."""
    docs = bounded_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    named = docs.filter(F.col("doc_id").isNotNull())
    shared = docs.sparkSession.sparkContext.broadcast(suspects_of(named, least, filter_bytes, segment_lines))
    suspected = named.mapInArrow(_suspected_keys(shared, least), "doc_id long, key binary")
    first = suspected.groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    kept = written(first.groupBy("doc_id").agg(F.collect_list("key").alias("first")), "line-firsts")
    # rows without an id, which have no list, are dealt by their text
    deal = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(0)
    joined = docs.withColumn("deal", deal).join(kept.withColumn("deal", F.lit(0).cast("long")), ["doc_id", "deal"], "left")
    return joined.select("doc_id", "text", "first").mapInArrow(_without_repeats(shared, least), "doc_id long, n_lines long, n_dropped long, text string")


def op11_line_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` without the lines that an earlier document holds; the text as its digest."""
    rows = deduplicated_lines(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL = f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM t),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM l),
g AS (SELECT key, min(doc_id) AS first_id FROM k WHERE length(key) >= {LEAST} GROUP BY key HAVING count(DISTINCT doc_id) > 1),
m AS (SELECT k.*, coalesce(g.first_id < k.doc_id, false) AS gone FROM k LEFT JOIN g ON k.key = g.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY r"""
