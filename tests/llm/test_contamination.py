from __future__ import annotations

import hashlib
import re
import sys
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from pricefold.llm import contamination
from pricefold.llm.contamination import Phrases, Segment, words_of

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(sign) + 32) if "A" <= sign <= "Z" else sign for sign in text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        found = words(text)
        width = min(10, len(found))
        for start in range(len(found) - width + 1):
            if width:
                windows.setdefault(tuple(found[start : start + width]), set()).add("null" if item is None else str(item))
    rows = []
    for doc, text in docs:
        found, hit, named = words(text), set(), set()
        for width in {len(window) for window in windows}:
            for start in range(len(found) - width + 1):
                if match := windows.get(tuple(found[start : start + width])):
                    hit.update(range(start, start + width))
                    named |= match
        digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        rows.append((doc, len(found), len(hit), len(named), digest, bool(hit)))
    return sorted(rows, key=repr)


def test_words():
    text = "Größe x1\x00Y_z É!a b 10%"
    assert [word.decode() for word in words_of(text.encode())] == words(text)
    assert words_of(None) == []


def test_query_equals_brute_force(spark, sf_dir):
    from pricefold.llm.queries import op7_contamination, table

    docs = [(row.doc_id, row.text) for row in table(spark, sf_dir, "documents").collect()]
    items = [(row.item_id, row.text) for row in table(spark, sf_dir, "benchmark").collect()]
    rows = sorted((tuple(row) for row in op7_contamination(spark, sf_dir).collect()), key=repr)
    assert rows == brute(docs, items) and any(row[-1] for row in rows)


def test_odd_documents_and_items_in_one_block_and_several(spark, odd_documents, no_documents):
    items = [
        (1, "Said ONCE more"), (1, "two words"), (2, "two words"), (None, "a shingle"), (4, None), (5, "..."), (10, "two"),
        (6, "zahlen 12 34 wörter und zahlen 12 34 wörter und zahlen 12"), (7, "zahlen 12 34 zahlen"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("seen", F.lit(1))
    docs = odd_documents.withColumn("seen", F.lit("x")).withColumn("hits", F.lit(0))
    wanted = brute([(row.doc_id, row.text) for row in odd_documents.collect()], items)
    for size in (1 << 20, 20):
        found = contamination.contaminated(docs, benchmark, block_bytes=size).drop("seen")
        assert sorted((tuple(row) for row in found.collect()), key=repr) == wanted
    assert contamination.contaminated(no_documents, benchmark).collect() == []
    clean = contamination.contaminated(odd_documents, benchmark.limit(0)).collect()
    assert len(clean) == odd_documents.count() and not any(row.contaminated for row in clean)


def test_proximity_equals_brute_force():
    chance = np.random.default_rng(2)
    phrases = Phrases.of([("x", b"a b c")])
    for _ in range(200):
        texts = [chance.integers(0, 7, size) for size in (12, 0, 9)]
        numbers = np.concatenate([np.append(np.where(text < 3, text, -1), -1) for text in texts])
        known = np.flatnonzero(numbers >= 0)
        order = np.argsort(numbers[known], kind="stable")
        present, starts = np.unique(numbers[known][order], return_index=True)
        segment = Segment({
            "positions": known[order].astype("<i4").tobytes(), "terms": present.tolist(), "starts": starts.tolist(),
            "lengths": [len(text) for text in texts],
        }, 3)
        if len(present) < 3:
            continue
        wanted, first = [], 0
        for text in texts:
            for start in range(len(text)):
                if text[start] < 3 and {0, 1, 2} <= set(text[start : start + 5].tolist()):
                    wanted.append(first + start)
            first += len(text) + 1
        assert segment.near(phrases.window(0), 2).tolist() == wanted


def test_windows_equal_a_plain_table_of_them():
    chance = np.random.default_rng(4)
    for size, terms in ((0, 3), (1, 3), (40, 2), (40, 4), (300, 3)):
        items = [(f"i{n % 7}", " ".join(map(str, chance.integers(0, terms, chance.integers(0, 30)))).encode()) for n in range(size)]
        wanted = {}
        for item, text in items:
            found = words_of(text)
            for start in range(max(1, len(found) - 9)):
                if found:
                    wanted.setdefault(tuple(found[start : start + 10]), set()).add(item)
        phrases = Phrases.of(items)
        words = list(phrases.terms)
        made = [(tuple(words[term] for term in phrases.window(place)), phrases.named(place)) for place in range(len(phrases.starts))]
        assert len(made) == len(wanted) and {window: set(names) for window, names in made} == wanted
        assert all(len(names) == len(set(names)) for _, names in made)
        for some in (range(terms), range(0, terms, 2), []):
            present = [phrases.terms[word] for word in (b"%d" % term for term in some) if word in phrases.terms]
            segment = Segment({"positions": b"\0" * 4 * len(present), "terms": present, "starts": list(range(len(present))), "lengths": [9]}, max(1, len(words)))
            holding = {place for place in range(len(made)) if set(phrases.window(place).tolist()) <= set(present)}
            assert sorted(segment.possible(phrases).tolist()) == sorted(holding)


def test_a_block_of_benchmark_texts_takes_bounded_memory():
    """4 MiB of text with next to no repeated window, whose words are few or many."""
    chance = np.random.default_rng(6)
    for terms in (3000, 10**6):
        words = chance.integers(0, terms, 600_000)
        items = [(f"i{n}", " ".join(map(str, words[n * 300 : n * 300 + 300])).encode()) for n in range(2000)]
        size = sum(len(text) for _, text in items)
        tracemalloc.start()
        phrases = Phrases.of(items)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        names = sum(sys.getsizeof(word) + 100 for word in phrases.terms)
        assert len(phrases.starts) > 500_000 and peak - names < 24 * size
