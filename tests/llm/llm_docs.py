"""Small document tables for the tests of this folder; test modules import the fixtures they use."""

import pytest

SF_SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, score double, node long, block int, h long, `odd.name` string, _hash long, _row long, _nth long, _id long, _clean string, row string, clean string, place long, nth long, times long"
WORDS = "the of and to in is that it for on was with as by this are at from be an river stone cloud lamp green quiet".split()


def prose(seed: int, n: int) -> str:
    import random

    rng = random.Random(seed)
    out = []
    for i in range(n):
        out.append(rng.choice(WORDS) + str(rng.randrange(40)) if rng.random() < 0.5 else rng.choice(WORDS))
        if i % 12 == 11:
            out[-1] += ".\n"
    return " ".join(out)


def docs_of(spark, rows):
    """Documents from (doc_id, text, source) rows, with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t), 7, 0.5, 3, 1, 9, "x", 4, 4, 4, 4, "c", "r", "c", 4, 4, 4) for i, t, s in rows], SCHEMA)


def messy_rows():
    """Nulls in every column, empty and very long texts, repeated rows, ids and texts."""
    same = prose(1, 120)
    return [
        (1, None, "a"), (2, "", None), (3, "single", "b"), (4, " \t\n\x0b ", "b"), (5, same, "a"), (6, same, "a"), (6, same, "a"),
        (7, prose(2, 30_000), "c"), (8, "Ünïcode naïve — 東京   words " * 30, "é"), (None, same, "a"), (None, None, None),
        (9, same.upper(), "a"), (10, "\n".join([prose(3, 20)] * 8), "b"), (11, prose(4, 200), "b"), (11, prose(5, 200), "b"),
    ]


@pytest.fixture(scope="session")
def messy(spark):
    return docs_of(spark, messy_rows())


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
