"""Line dedup against a plain version and its SQL; the filters lose no repeat."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from llm_docs import SF_SMALL, docs_of, empty, messy, prose  # noqa: F401

from perkspark.llm import op11_line_bloom as op11

STRIP = re.compile(r"\A[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\Z")


def key_of(line):
    key = STRIP.sub("", line).translate(str.maketrans(op11.UPPER, op11.LOWER))
    return key if len(key) >= op11.LEAST else None


def plain(rows):
    holders = defaultdict(set)
    for doc_id, text in rows:
        if doc_id is not None:
            for line in (text or "").split("\n"):
                holders[key_of(line)].add(doc_id)
    out = Counter()
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc_id is None or key_of(x) is None or min(holders[key_of(x)]) >= doc_id]
        out[doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    return out


def check(docs, **options):
    got = op11.deduplicated_lines(docs, **options).collect()
    assert Counter(map(tuple, got)) == plain([(r["doc_id"], r["text"]) for r in docs.collect()])
    return got


def texts(seed, n):
    """Documents of lines from a small stock, with case, space and length variants."""
    rng = random.Random(seed)
    stock = [prose(i, rng.randrange(1, 9)) for i in range(60)] + ["ÜBERLÄNGE ä", "東京東京東京東京東京", "東京東京東京東京東", "abcdefghij", "abcdefghi", "", "  "]
    rows = []
    for i in range(n):
        lines = [rng.choice(stock) if rng.random() < 0.6 else f"line {rng.randrange(10**6)} of its own" for _ in range(rng.randrange(1, 14))]
        lines = [x.upper() if rng.random() < 0.2 else f"\t{x} \r" if rng.random() < 0.2 else x for x in lines]
        rows.append((rng.randrange(2 * n), "\n".join(lines), "a"))
    return rows


@pytest.mark.parametrize("options", [{}, {"filter_bytes": 16}, {"segment_lines": 7}, {"filter_bytes": 1, "segment_lines": 50}])
def test_lines_against_brute_force(spark, options):
    check(docs_of(spark, texts(3, 150)), **options)


def test_lines_of_messy_rows(messy, empty):
    check(messy)
    assert op11.deduplicated_lines(empty).count() == 0


def test_hot_lines_and_equal_rows(spark):
    rows = [(i, f"a very common line\nown line number {i}\nA VERY COMMON LINE ", "a") for i in range(4000)]
    got = check(docs_of(spark, [*rows, *[(9000, "the same row again", "a")] * 3000, *[(None, "a very common line", "a")] * 500]))
    assert sum(r["n_dropped"] for r in got) == 2 * 3999


def test_filters_keep_every_repeat_and_few_others():
    rng = np.random.default_rng(5)
    values = rng.integers(0, 1 << 63, 30_000).astype(np.uint64)
    pair = op11.FilterPair(50_000)
    for part in np.array_split(np.concatenate([values, values[:3000], values[:500]]), 9):
        pair.add(part)
    filters = op11.Suspects(1, {0: pair.folded(1 << 30).tobytes()})
    assert filters(values[:3000]).all() and filters(values[3000:]).mean() < 0.03
    assert 3000 <= pair.entries < 4200 and len(pair.folded(1 << 30)) < 3000 * 2 * op11.ENTRY_BITS
    assert len(pair.folded(64)) == 8 and op11.Suspects(1, {0: pair.folded(64).tobytes()})(values[:3000]).all()


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    got = op11.op11_line_bloom(spark, SF_SMALL)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({op11.ORACLE_SQL})").fetchall()
    rows = Counter(map(tuple, got.collect()))
    assert rows == Counter(want) and sum(r[2] for r in rows) > 0
