"""Fixtures of the tests of the training-data operators."""

import pytest

from salesmart.llm.common import let_workers_import

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, _key int"


@pytest.fixture(autouse=True)
def importable(spark):
    let_workers_import(spark)


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text, source); `_key` is a column with a clashing name."""

    def build(*rows):
        full = [(i, text, "en", source, len(text or ""), 7) for i, text, source in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(3)

    return build


@pytest.fixture
def odd_rows():
    """NULLs, empty and long texts, repeated rows, no ids."""
    long = " ".join(f"w{i % 97}x{i % 89}" for i in range(30_000))
    return [
        (1, "a b c", "s1"), (1, "a b c", "s1"), (2, None, "s1"), (3, "", None), (None, "x y", "s2"),
        (None, None, None), (4, long, "s2"), (5, " \t\n\r ", "s2"), (6, "é ü 漢字 🙂\nend", "s3"),
    ]
