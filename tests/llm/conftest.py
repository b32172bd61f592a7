import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    from curveloom.llm.common import read

    return read(spark, SMALL, "documents")


@pytest.fixture(scope="session")
def texts(docs):
    """``[(doc_id, text)]`` of the small table."""
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def odd(spark):
    """Missing values, empty and very long texts, repeated rows, and columns whose names operators add."""
    from curveloom.llm.common import prepare

    prepare(spark)
    long = " ".join(f"w{i}" for i in range(30_000)) + " " + "x" * 200_000
    rows = [(1, None, None), (2, "", "a"), (3, "a b c", "b"), (3, "a b c", "b"), (None, "a b c", None), (None, None, None),
            (4, long, "s"), (5, long, "s"), (6, " \n\t ", "s"), (7, "one", "s")]
    return spark.createDataFrame(
        [(d, t, "en", s, 1, "x", 0.5, "y", "z") for d, t, s in rows],
        "doc_id long, text string, lang string, source string, n_chars long, spans string, score double, _key string, base string")


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
