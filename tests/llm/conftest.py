import random

import pytest

EDGE_SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "ids string, decoded string, mix_pass string, quality_score string, class string, token string, body string, digest string, row string"
)


def edge_rows():
    """Nulls in every column, empty and blank texts, a very long text, ties and repeated rows."""
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "Epsilon", "zeta", "eta", "théta", "iota", "kappa", "42", "x|y"]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    base = " ".join(rng.choice(words) for _ in range(60))
    texts = [
        (1, base, "s0"),
        (2, base.upper().replace("É", "é"), "s0"),
        (3, base + " tail", "s1"),
        (4, None, "s1"),
        (5, "", None),
        (6, " \t\n ", "s1"),
        (7, long, "s0"),
        (8, long, "s2"),
        (9, "one", "s2"),
        (10, "One", None),
        (10, "One", None),
        (11, "a b\n\nc 😀 d.\nMIT é", "s0"),
        (12, base.replace("alpha", "omega", 1), "s0"),
        (None, base, "s0"),
        (13, "Released under the MIT License.", None),
    ]
    return [(i, t, "en" if i and i % 2 else None, s, None, "i", None, "7", "q", "c", None, "b", "d", "r") for i, t, s in texts]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), EDGE_SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)


@pytest.fixture(scope="session")
def edge_texts():
    return [(r[0], r[1]) for r in edge_rows()]
