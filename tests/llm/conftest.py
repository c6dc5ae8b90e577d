import random

import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, label string"


@pytest.fixture(scope="session")
def edge_rows():
    """Null, empty, blank, long, tied and repeated texts, and a clashing extra column."""
    rnd = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "Épée", "straße", "数据", "x", "the", "of"]
    long = " ".join(rnd.choice(words) for _ in range(6000))
    some = " ".join(rnd.choice(words) for _ in range(80))
    rows = [(1, None), (2, ""), (3, " \n\t \n"), (4, long), (5, some), (5, some), (6, some + " more"),
            (7, "one"), (8, "a\n\na\nA\n###\n"), (None, some), (9, "Kelvin K MIT License MIT License"),
            (10, "x" * 5000), (11, long[:3000] + some)]
    return [(i, t, None if n % 4 == 0 else "en", None, None, "z") for n, (i, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
