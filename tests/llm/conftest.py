import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("the driver's tables are not here")
    return SF


@pytest.fixture
def odd_docs(spark):
    """Nulls, empty and white texts, ties, repeated rows, a long text, and columns with clashing names."""
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
    rows = [
        (5, "a  b\tc", "s"),
        (3, "a b c", None),
        (3, "a b c", None),
        (9, None, "s"),
        (7, "", "s"),
        (8, " \n ", "t"),
        (11, " ", "t"),
        (None, "a b c", "t"),
        (None, "lonely", "t"),
        (20, long, "s"),
        (21, long, "t"),
        (22, long + " end", "t"),
        (-4, "é ß 中 😀 " * 30, "u"),
    ]
    clashing = ["id", "row", "kept", "keep_id", "score", "epoch", "block", "position", "n", "key", "hash", "label", "component"]
    schema = "doc_id long, text string, source string, " + ", ".join(f"`{c}` string" for c in clashing)
    return spark.createDataFrame([(*r, *clashing) for r in rows], schema)


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.limit(0)
