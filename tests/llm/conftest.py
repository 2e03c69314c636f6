import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, score double, size long, host string, id long, h long, key string, label int, kept boolean"
EXTRA = ("x", 1.0, 1, "h", 1, 1, "k", 1, True)


def documents(spark, rows):
    """rows (doc_id, text[, source]) with columns whose names the operators use themselves."""
    return spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0, *EXTRA) for r in rows], SCHEMA)


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty, blank, very long and repeated rows."""
    rng = random.Random(4)
    long_text = prose(rng, 60_000, 5000)
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, long_text), (6, long_text), (7, "a b c d e f"), (7, "a b c d e f"), (None, "a b c d e f"), (None, None, None), (8, "é ß \U0001f600 x", None), (9, prose(rng, 50), None)]
    return documents(spark, rows)


@pytest.fixture(scope="session")
def none(spark):
    return documents(spark, [])


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)] + [(None, 1, None), (3, None, 1)], "doc_id long, quality int, toxic int")
