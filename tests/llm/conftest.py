from __future__ import annotations

from pathlib import Path

import pytest

SF_DIR = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    if not SF_DIR.exists():
        pytest.skip("driver tables not present")
    return str(SF_DIR)


@pytest.fixture(scope="session")
def tokenizer():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


@pytest.fixture
def odd_documents(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, and columns named like what operators add."""
    rows = [
        (1, "The same old text, said once more and then again to all.", "en", "a", 7, "x"),
        (2, "The same old text, said once more and then again to all.", "en", "a", 7, "x"),
        (2, "The same old text, said once more and then again to all.", "en", "a", 7, "x"),
        (None, "No id here, but words enough to make a shingle or two.", "en", None, None, None),
        (None, None, None, None, None, None),
        (5, "", "fr", "b", 0, ""),
        (6, None, "de", "b", 1, "y"),
        (7, " \n\t ", "de", "b", 1, "y"),
        (8, "Wörter und Zahlen 12 34, " * 3000, "de", "c", 2, "z"),
        (9, "x" * 50_000, "es", "c", 2, "z"),
        (10, "two words", "es", "d", 3, "z"),
        (11, "😀 émoji and \x00 signs", "fr", "d", 3, "z"),
    ]
    kinds = "doc_id long, text string, lang string, source string, size long, shard string"
    return spark.createDataFrame(rows, kinds)


@pytest.fixture
def no_documents(odd_documents):
    return odd_documents.limit(0)
