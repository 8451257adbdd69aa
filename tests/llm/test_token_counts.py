from __future__ import annotations

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from pricefold.llm.token_counts import PrefixCounter, longest_within, prefix_counts, unpacked

SIGNS = list("abcdeht'' \n\t.,=-0123é日😀  \x1c\x85_<|>") + ["'re", " the", "ing", "<|endoftext|>", "  ", "\n\n"]


@pytest.fixture(scope="module")
def library(tokenizer):
    return Tokenizer.from_file(tokenizer)


def count(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def test_every_prefix_has_its_exact_count(tokenizer, library):
    counter, chance = PrefixCounter(tokenizer), random.Random(1)
    for _ in range(400):
        text = "".join(chance.choice(SIGNS) for _ in range(chance.randint(0, 24)))
        found = [0, *np.cumsum(counter.steps_of(text), dtype=int).tolist()]
        assert found == [count(library, text[:end]) for end in range(len(text) + 1)], repr(text)


def test_every_token_is_one_token(tokenizer):
    merges = PrefixCounter(tokenizer).merges
    assert all(merges.prefix_counts(token)[-1] == 1 for token in merges.bytes[::37])


def test_longest_prefix_within_a_budget(tokenizer, library):
    text = "Sooner or later, the shortest prefixes were  enough.\n\n" * 4
    steps = PrefixCounter(tokenizer).steps_of(text)
    for budget in (0, 1, 7, 20, 1000):
        wanted = max(end for end in range(len(text) + 1) if count(library, text[:end]) <= budget)
        assert longest_within(steps, budget) == wanted


def test_documents_of_all_kinds(spark, odd_documents, no_documents, tokenizer, library):
    rows = prefix_counts(odd_documents, tokenizer, budget=5).collect()
    texts = [row.text or "" for row in odd_documents.collect()]
    assert sorted((row.n_bytes, row.n_tokens) for row in rows) == sorted(
        (len(text.encode()), count(library, text)) for text in texts
    )
    assert all(unpacked(row.prefixes)[-1] == row.n_tokens for row in rows)
    assert all(unpacked(row.prefixes)[row.within_budget] <= 5 for row in rows)
    assert prefix_counts(no_documents, tokenizer).collect() == []


def test_query_equals_the_library(spark, sf_dir, library):
    from pricefold.llm.queries import op1_token_counts, table

    texts = {row.doc_id: row.text or "" for row in table(spark, sf_dir, "documents").collect()}
    for row in op1_token_counts(spark, sf_dir).collect():
        tokens = count(library, texts[row.doc_id])
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(texts[row.doc_id].encode()), tokens, tokens > 512)
