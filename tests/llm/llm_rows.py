"""Rows that the operators' tests share."""

import random

import pytest


def prose(rng, n):
    """``n`` invented words."""
    return " ".join("".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="session")
def docs_rows():
    """(doc_id, text): copies, near copies, shared passages, long, empty, null and repeated rows."""
    rng = random.Random(5)
    base, shared = prose(rng, 120), prose(rng, 70)
    near = base.split()
    near[60] = "changed"
    rows = [(1, base), (2, prose(rng, 30)), (3, base), (4, " ".join(near)), (5, ""), (6, None), (7, "   \n\t "),
            (8, prose(rng, 40) + " " + shared + " " + prose(rng, 20)), (9, shared + "\n" + prose(rng, 55)), (10, prose(rng, 9000)),
            (11, base.upper()), (12, "one two"), (13, "one two"), (None, base), (None, prose(rng, 10)), (14, "ê日本語😀 " * 60), (15, "x" + "ê日本語😀 " * 30),
            (2, None), (16, shared.replace(" ", "\n"))]
    return rows + [rows[1]]


@pytest.fixture(scope="session")
def docs(spark, docs_rows):
    """The rows with columns that clash with the operators' own names."""
    clash = "id long, chunk long, n int, key string, score double, ids string, bucket int, source string, lang string"
    return spark.createDataFrame([(i, t, 1, 2, 3, "k", 0.5, "z", 4, "s", "en") for i, t in docs_rows], "doc_id long, text string, " + clash)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
