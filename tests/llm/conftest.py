from __future__ import annotations

import pytest

ODD_TEXTS = [None, "", " \n\t", "a", "the the the", "Ünï çödé 😀 <|endoftext|> x", "\x1c\x85  odd spaces"]
SCHEMA = "doc_id bigint, text string, row string, words string, mark int, label double, key string, n string"


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and very long texts, repeated rows and ids, and extra columns with names that operators use."""
    texts = [*ODD_TEXTS, "long words " * 30_000, "x" * 100_000]
    rows = [(i, text) for i, text in enumerate(texts)]
    rows += [rows[3], rows[3], (3, "another text of the same id"), (None, "no id"), (None, "no id"), (None, None)]
    return spark.createDataFrame([(i, t, "r", None, 1, 0.5, "k", "n") for i, t in rows], SCHEMA)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def sf(spark):
    return lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
