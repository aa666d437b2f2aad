import random

import pytest

#: Columns of documents, and extra ones with names the operators use themselves.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, score double, fp long, words array<string>, label int"


def prose(seed, n=40):
    rng = random.Random(seed)
    parts = "the of and ing tion er an re th on at en or es".split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n))


def documents(spark, texts, langs=None, sources=None, ids=None):
    n = len(texts)
    langs, sources, ids = langs or ["en"] * n, sources or ["s"] * n, ids or list(range(1, n + 1))
    rows = [(i, t, lg, s, len(t or ""), 7, 0.5, 3, ["x"], 1) for i, t, lg, s in zip(ids, texts, langs, sources, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def ugly(spark):
    """Nulls in any column, empty and long texts, repeated rows, odd characters."""
    texts = [None, "", " \n\t ", prose(1), prose(1), prose(2, 30_000), "é" * 500, "​퟿ \U0001f600 ok", "MIT License", prose(3) + " MIT\tLICENSE.",
             "a", "password = 'Zx81kQ0pLm73Ttw9'", "0123456789abcdef" * 3]
    ids = [1, 2, 3, 4, 4, 5, 6, 7, 8, 9, None, 11, 12]
    df = documents(spark, texts, ["en", None] + ["en"] * 11, [None, "b"] + ["a"] * 6 + [None] * 5, ids)
    return df


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
