"""Secret scans: base patterns, and a character network over every candidate.

Three fixed patterns give the base spans.  Candidates are the base spans and all
other runs of key-like characters (``CANDIDATE``) that do not lie inside one, each
seen with ``CONTEXT`` characters on both sides.  Windows of ``INNER`` characters
slide over a longer candidate by ``STEP``, and its score is their greatest.  A character convolutional network
(:mod:`convnet`; symbols tell characters inside the candidate from its context)
is trained on labelled findings: the base spans of all documents,
also in variants with other alphabets, without their context and in the middle of
joined words, against the other candidates and long words of these
documents.  Since these may be unnamed secrets, a network
fitted without them scores them first, and those that it takes for findings are not
learned.  The threshold is the highest that keeps
``RECALL`` of the findings set aside for calibration.  Candidates that reach it are added as kind ``net``, also where they reach
beyond a base span that they touch; base spans always stay.

The findings are learned where Spark deals them.  One pass cuts their windows; each
distinct text teaches once, whatever its copies.  Up to ``SHARD_WINDOWS`` windows are
fitted by one task.  More are dealt by hash to shards of about that many: in each of
``ROUNDS`` rounds every shard fits the common network further on all its windows, and
the networks' means, weighted by windows, are the next common network.  The driver holds
one network and counts; the threshold is ranked by counts of the scores' digits.

Defined cases: null text is empty text, without spans; offsets are code points
with exclusive ends; a table without base findings trains nothing and adds
nothing; equal texts have equal spans; other columns are not read.
"""

from __future__ import annotations

import hashlib
import pickle
import re
import struct
from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import accumulate, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, byte_chunks, table, written
from .convnet import ConvNet
from .training import fit_in_rounds

KINDS = ("assign", "access", "hex", "net")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Lower-case ASCII bytes of which an assignment has at least one.
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")
LEAST_VALUE, LEAST_ACCESS = 6, 20

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
CONTEXT = 24
INNER = 40
STEP = 10
WINDOW = 2 * CONTEXT + INNER
#: Windows scored at a time.
SCORED = 8192
SAMPLE = 2000
SAMPLE_BYTES = 1 << 16
FILTERS = 16
EPOCHS = 30
RECALL = 0.95
#: Windows that one task fits, at most ``CHUNK`` of a text in a row; with more shards than one, rounds of EPOCHS // ROUNDS epochs.
SHARD_WINDOWS = 1 << 15
CHUNK = 1024
ROUNDS = 6
#: Texts from which on whole ones are set aside by hash.
MANY_TEXTS = 64
LEARNED = "key binary, chunk int, n long, windows binary, labels binary, unsure binary"

SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def base_spans(text: str, raw: bytes) -> list[tuple[int, int, int]]:
    """(start, kind number, end), sorted; ``raw`` is ``text`` in UTF-8."""
    found = []
    low = raw.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if b"AKIA" in raw:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def other_candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Key-like runs that do not lie inside a base span."""
    out, at, reach = [], 0, 0
    for m in CANDIDATE.finditer(text):
        while at < len(taken) and taken[at][0] <= m.start():  # the farthest end of spans that start before the run does
            reach = max(reach, taken[at][2])
            at += 1
        if reach < m.end():
            out.append((m.start(), m.end()))
    return out


def char_symbols() -> np.ndarray:
    """Symbol of each character up to 127; others share the last one."""
    symbol = np.full(129, 1, np.uint8)
    symbol[ord("a") : ord("z") + 1] = 2 + np.arange(26)
    symbol[ord("A") : ord("Z") + 1] = 28
    symbol[ord("0") : ord("9") + 1] = 29
    for kind, members in ((30, " \t\n\r"), (31, ".,;!?"), (32, ":="), (33, "\"'"), (34, "+/"), (35, "_-"), (36, "@")):
        symbol[[ord(c) for c in members]] = kind
    symbol[128] = 37
    return symbol


OUTSIDE = 38
CHAR_SYMBOLS = char_symbols()


def window(text: str, start: int, end: int) -> np.ndarray:
    """Symbols of at most ``INNER`` characters of a candidate between their contexts; context symbols are shifted."""

    def coded(s: str) -> np.ndarray:
        return CHAR_SYMBOLS[np.minimum(np.frombuffer(s.encode("utf-32-le"), np.uint32), 128)]

    inner = text[start:end]
    out = np.zeros(WINDOW, np.uint8)
    before = coded(text[max(0, start - CONTEXT) : start]) + OUTSIDE
    after = coded(text[end : end + CONTEXT]) + OUTSIDE
    out[CONTEXT - len(before) : CONTEXT] = before
    out[CONTEXT : CONTEXT + len(inner)] = coded(inner)
    out[CONTEXT + len(inner) : CONTEXT + len(inner) + len(after)] = after
    return out


def windows_of(text: str, start: int, end: int) -> list[np.ndarray]:
    """Windows that cover a candidate, ``STEP`` apart; the last one ends with it."""
    return [window(text, a, min(end, a + INNER)) for a in window_starts(start, end)]


def window_starts(start: int, end: int) -> list[int]:
    last = max(start, end - INNER)
    return [*range(start, last, STEP), last]


ALPHABETS = {
    "hex": "0123456789abcdef",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
    "mixed": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}


def labelled_windows(text: str, rng: np.random.Generator) -> Iterator[tuple[list[np.ndarray], int, bool]]:
    """Windows of one text with their label and whether it is uncertain: secrets as found, secrets in other alphabets, and what is none or just not named."""
    spans = base_spans(text, text.encode())
    for start, kind, end in spans:
        value = ASSIGN.match(text, start).start(2) if kind == 0 and ASSIGN.match(text, start) else start
        yield windows_of(text, value, end), 1, False
        for letters in ALPHABETS.values():
            size = int(rng.integers(16, 44))
            made = "".join(letters[i] for i in rng.integers(0, len(letters), size))
            # in the middle of a long run: the window that has most of it, against those that have none
            if len(near := re.findall(r"[A-Za-z]+", text[max(0, start - 200) : start])[-8:]) == 8:
                joint = "/-_"[int(rng.integers(3))]
                left, right = joint.join(near[:4]) + joint, joint + joint.join(near[4:])
                whole, begin, until = left + made + right, len(left), len(left) + size
                held = {a: min(until, a + INNER) - max(begin, a) for a in window_starts(0, len(whole))}
                most = max(held, key=held.get)
                yield [window(whole, most, min(len(whole), most + INNER))], 1, False
                yield [window(whole, a, min(len(whole), a + INNER)) for a, n in held.items() if n <= 0], 0, False
            for context in (text[max(0, start - CONTEXT) : start], text[max(0, value - CONTEXT) : value]):
                whole = context + made + text[end : end + CONTEXT]
                yield windows_of(whole, len(context), len(context) + size), 1, False
    starts, ends = [s for s, _, _ in spans], list(accumulate((e for *_, e in spans), max))
    none = other_candidates(text, spans) + [m.span() for m in islice(re.finditer(r"\S{12,}", text), 6)]
    for start, end in none:
        before = bisect_left(starts, end)  # the spans that start before its end
        if not before or ends[before - 1] <= start:
            yield windows_of(text, start, end), 0, True
    # what a run of words or numbers looks like when it is long enough to be a candidate
    pieces = [w for w in re.findall(r"[A-Za-z]+", text[:2000]) if w]
    for joint in ("-", "_", "/", ""):
        if len(pieces) < 4:
            break
        at = int(rng.integers(0, len(pieces) - 3))
        made = joint.join([*pieces[at : at + 3], str(rng.integers(0, 2100))])
        if len(made) >= 16:
            yield windows_of(f"{pieces[0]} {made} {pieces[-1]}", len(pieces[0]) + 1, len(pieces[0]) + 1 + len(made)), 0, False
    number = "".join(str(d) for d in rng.integers(0, 10, int(rng.integers(16, 21))))
    yield [window(f"{' '.join(pieces[:3])} {number} {' '.join(pieces[3:6])}", len(" ".join(pieces[:3])) + 1, len(" ".join(pieces[:3])) + 1 + len(number))], 0, False


def labelled_findings(texts: list[str], seed: int = 9) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Windows, labels, which labels are uncertain, and each window's text."""
    rng = np.random.default_rng(seed)
    windows, labels, unsure, owners = [], [], [], []
    for owner, text in enumerate(texts):
        for found, label, uncertain in labelled_windows(text, rng):
            windows.extend(found)
            labels.extend([label] * len(found))
            unsure.extend([uncertain] * len(found))
            owners.extend([owner] * len(found))
    return windows, np.array(labels, np.int64), np.array(unsure, bool), np.array(owners, np.int64)


def new_network() -> ConvNet:
    return ConvNet(2 * OUTSIDE, FILTERS, WINDOW, 1, seed=5)


def without_doubtful(net: ConvNet, windows: list[np.ndarray], unsure: np.ndarray, learned: np.ndarray) -> np.ndarray:
    """``learned`` without the uncertain windows that ``net`` takes for findings."""
    doubtful, out = np.flatnonzero(unsure), learned.copy()
    if len(doubtful):
        out[doubtful[net.score([windows[i] for i in doubtful]) >= 0.5]] = False
    return out


def fit_windows(windows: list[np.ndarray], labels: np.ndarray, unsure: np.ndarray, owners: np.ndarray) -> tuple[ConvNet, float] | None:
    """The network and its calibrated threshold; None without findings."""
    if not labels.any():
        return None
    having = np.unique(owners[labels == 1])
    # whole texts are set aside, so that no secret is both learned and calibrated on; of too few texts, every fourth window
    aside = np.isin(owners, having[3::4]) if len(having) > 3 else np.arange(len(labels)) % 4 == 3

    def fitted(which: np.ndarray) -> ConvNet:
        return new_network().fit([windows[i] for i in which], labels[which], EPOCHS, rate=0.02)

    learned = ~aside
    if unsure.any():
        learned = without_doubtful(fitted(np.flatnonzero(~aside & ~unsure)), windows, unsure, learned)
    net = fitted(np.flatnonzero(learned))
    scores = np.sort(net.score([windows[i] for i in np.flatnonzero(aside & (labels == 1))]))
    kept = float(scores[int((1 - RECALL) * len(scores))]) if len(scores) else 1.0
    return net, kept


def fit_detector(texts: list[str]) -> tuple[ConvNet, float] | None:
    """``fit_windows`` on the findings of a few texts."""
    return fit_windows(*labelled_findings(texts))


def learning_windows(docs: DataFrame) -> DataFrame:
    """``LEARNED`` rows: the labelled windows of each distinct text that has a base finding, by chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for _, texts in byte_chunks(batches, 4 << 20):
            for raw in texts:
                if not raw or not base_spans(text := raw.decode(), raw):
                    continue
                key = hashlib.blake2b(raw, digest_size=16).digest()
                if key in seen:
                    continue
                if len(seen) > 100_000:  # copies are dropped after the shuffle as well
                    seen.clear()
                seen.add(key)
                yield from chunks(key, text)

    def chunks(key: bytes, text: str) -> Iterator[pa.RecordBatch]:
        chunk, windows, labels, unsure = 0, [], [], []

        def packed(n: int) -> pa.RecordBatch:
            row = {"key": key, "chunk": chunk, "n": n, "windows": np.stack(windows[:n]).tobytes(), "labels": bytes(labels[:n]), "unsure": bytes(unsure[:n])}
            kinds = [pa.binary(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_pylist([row], pa.schema(list(zip(row, kinds, strict=True))))

        for found, label, uncertain in labelled_windows(text, np.random.default_rng(struct.unpack("<Q", key[:8])[0])):
            windows += found
            labels += [label] * len(found)
            unsure += [uncertain] * len(found)
            while len(windows) >= CHUNK:
                yield packed(CHUNK)
                chunk, windows, labels, unsure = chunk + 1, windows[CHUNK:], labels[CHUNK:], unsure[CHUNK:]
        if windows:
            yield packed(len(windows))

    return bounded_batches(docs).select("text").mapInArrow(run, LEARNED).dropDuplicates(["key", "chunk"])


def _unpacked(rows: pa.Table, many: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows, labels, which are uncertain, the key of each, and which are set aside, in the order of keys and chunks.

    Set aside are the windows of every fourth text by its key, or of too few texts every fourth one of a row.
    """
    rows = rows.sort_by([("key", "ascending"), ("chunk", "ascending")])
    windows, labels, unsure = (np.frombuffer(b"".join(rows.column(c).to_pylist()), np.uint8) for c in ("windows", "labels", "unsure"))
    keys, n = rows.column("key").to_pylist(), rows.column("n").to_numpy()
    aside = np.repeat([k[-1] % 4 == 3 for k in keys], n) if many else np.concatenate([np.arange(i) % 4 == 3 for i in n])
    return windows.reshape(-1, WINDOW), labels.astype(np.int64), unsure.astype(bool), np.repeat([k.hex() for k in keys], n), aside


def _common(rows: DataFrame, shards: int, many: bool, sure: ConvNet | None = None) -> ConvNet:
    """A network fitted in rounds by all shards; on certain labels alone, or without what ``sure`` doubts."""
    shard = F.pmod(F.xxhash64("key", "chunk"), F.lit(shards))
    # more partitions than shards, so that few share one
    dealt = rows.withColumn("shard", shard).repartition(4 * shards, "shard")

    def fit(own: ConvNet, rows: pa.Table, nth: int) -> int:
        windows, labels, unsure, _, aside = _unpacked(rows, many)
        at = np.flatnonzero(~aside & ~unsure if sure is None else without_doubtful(sure, windows, unsure, ~aside))
        if len(at):
            own.fit([windows[i] for i in at], labels[at], EPOCHS // ROUNDS, rate=0.02, seed=nth, done=nth / ROUNDS, share=1 / ROUNDS)
        return len(at)

    return fit_in_rounds(new_network(), dealt, shards, ROUNDS, fit)


def ranked_score(scores: DataFrame, share: float) -> float:
    """The score (column ``bits``, a double's) below which lies so large a share; 1 without scores.  Counts by 16 bits at a time."""
    found, left = 0, None
    for shift in (48, 32, 16, 0):
        digit = F.shiftright("bits", shift)
        counts = scores.filter(F.shiftright("bits", shift + 16) == found).groupBy(digit.alias("digit")).count() if shift < 48 else scores.groupBy(digit.alias("digit")).count()
        counts = sorted((r["digit"], r["count"]) for r in counts.collect())
        if left is None:
            left = int(share * sum(n for _, n in counts))
        for found, n in counts:
            if left < n:
                break
            left -= n
    return struct.unpack("<d", struct.pack("<q", found))[0] if counts else 1.0


def learned_detector(docs: DataFrame) -> tuple[ConvNet, float] | None:
    """The network and its threshold, learned from the base findings of all documents; None without any."""
    rows = written(learning_windows(docs), "secret-windows")
    size = rows.agg(F.sum("n").alias("windows"), F.count_if(F.col("chunk") == 0).alias("texts")).first()
    if not size["windows"]:
        return None
    shards = -(-size["windows"] // SHARD_WINDOWS)
    many = size["texts"] >= MANY_TEXTS
    if shards == 1:

        def alone(rows: pa.Table) -> pa.Table:
            windows, labels, unsure, keys, _ = _unpacked(rows)
            net, kept = fit_windows(list(windows), labels, unsure, keys)
            return pa.table({"net": pa.array([pickle.dumps(net.params)], pa.binary()), "kept": pa.array([kept], pa.float64())})

        fitted = rows.groupBy(F.lit("all")).applyInArrow(alone, "net binary, kept double").first()
        net = new_network()
        net.params = pickle.loads(fitted["net"])
        return net, fitted["kept"]
    net = _common(rows, shards, many, sure=_common(rows, shards, many))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 8):
                windows, labels, _, _, aside = _unpacked(pa.Table.from_batches([batch.slice(i, 8)]), many)
                scores = net.score(list(windows[aside & (labels == 1)]))
                yield pa.RecordBatch.from_arrays([pa.array(scores.view(np.int64))], names=["bits"])

    scores = written(bounded_batches(rows).mapInArrow(scored, "bits long"), "secret-scores")
    return net, ranked_score(scores, 1 - RECALL)


def finding_sample(docs: DataFrame, sample: int = SAMPLE) -> list[str]:
    """At most ``sample`` texts (of at most ``SAMPLE_BYTES``) with a base finding, to be looked at on the driver; no query learns from them alone."""
    text = F.col("text")
    chosen = docs.select("doc_id", "text").filter(
        (F.octet_length("text") <= SAMPLE_BYTES)
        & (text.rlike(r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]") | text.rlike("AKIA[A-Z0-9]{16}") | text.rlike("[0-9a-f]{24}"))
    )
    ids = chosen.select(F.xxhash64("doc_id", "text").alias("h")).distinct().orderBy("h").limit(sample)
    rows = chosen.withColumn("h", F.xxhash64("doc_id", "text")).join(F.broadcast(ids), "h").dropDuplicates(["h"]).select("h", "text").collect()
    return [r["text"] for r in sorted(rows, key=lambda r: r["h"])]


def span_finder(detector: tuple[ConvNet, float] | None) -> Callable[[list[bytes | None]], list[list[tuple[int, int, int]]]]:
    """A function from texts to their sorted spans."""

    def reaching(windows: list[np.ndarray], places: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        net, threshold = detector
        return [place for place, p in zip(places, net.score(windows), strict=True) if p >= threshold]

    def find(raws: list[bytes | None]) -> list[list[tuple[int, int, int]]]:
        out, windows, places = [], [], []
        reached: set[tuple[int, int, int]] = set()
        for raw in raws:
            raw = raw or b""
            text = raw.decode()
            spans = base_spans(text, raw)
            out.append(spans)
            if detector:
                for start, end in other_candidates(text, spans):
                    seen = windows_of(text, start, end)
                    windows += seen
                    places += [(len(out) - 1, start, end)] * len(seen)
                    if len(windows) >= SCORED:
                        reached.update(reaching(windows, places))
                        windows, places = [], []
        if windows:
            reached.update(reaching(windows, places))
        for i, start, end in reached:
            out[i].append((start, 3, end))
        return [sorted(spans) for spans in out]

    return find


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Counts, digest of the base spans and all spans of every document."""
    find = span_finder(learned_detector(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in byte_chunks(batches, 4 << 20):
            found = find(texts)
            counts = [[sum(k == kind for _, k, _ in spans) for spans in found] for kind in range(3)]
            base = [joined([x for x in spans if x[1] < 3]) for spans in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()), *(pa.array(c, pa.int64()) for c in counts),
                    pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()), pa.array([joined(s) for s in found], pa.string()),
                ],
                names=[part.split()[0] for part in SCHEMA.split(", ")],
            )

    return bounded_batches(docs).select("doc_id", "text").mapInArrow(run, SCHEMA)


def redact(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    """``text`` with each maximal run of overlapping spans replaced."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redacted_documents(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """All documents with their columns, secrets in ``text`` replaced by ``mark``; ``n_chars`` follows where it exists."""
    find = span_finder(learned_detector(docs))

    @F.pandas_udf(T.StringType())
    def clean(texts: pd.Series) -> pd.Series:
        out: list[str | None] = []
        for a in range(0, len(texts), 256):
            raws = list(texts.iloc[a : a + 256])
            out += [None if r is None else r.decode() if not s else redact(r.decode(), s, mark) for r, s in zip(raws, find(raws), strict=True)]
        return pd.Series(out, dtype=object)

    # whole rows in one column, so that no name of theirs can clash
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    cleaned = bounded_batches(docs).select(row, clean(F.col("text").cast("binary")).alias("clean"))
    columns = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        changed = ~F.col("clean").eqNullSafe(F.col("row.text"))
        columns["n_chars"] = F.when(changed, F.length("clean").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    return cleaned.select(*(columns.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))


def op9_secrets_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))
