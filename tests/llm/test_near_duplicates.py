from __future__ import annotations

import random

import numpy as np
import pytest

from pricefold.llm import near_duplicates
from pricefold.llm.components import components


def sets(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(zip(words, words[1:], words[2:], words[3:], words[4:]))


def brute(docs):
    found = [sets(text) for _, text in docs]
    root = list(range(len(docs)))

    def find(row):
        while root[row] != row:
            row = root[row]
        return row

    for a in range(len(docs)):
        for b in range(a):
            if found[a] and found[b] and 100 * len(found[a] & found[b]) >= 75 * len(found[a] | found[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    least = {}
    for row, (doc, _) in enumerate(docs):
        if doc is not None:
            least[find(row)] = min(least.get(find(row), doc), doc)
    return sorted(
        ((doc, len(found[row]), least.get(find(row)), doc is not None and doc == least.get(find(row)))
         for row, (doc, _) in enumerate(docs)), key=repr,
    )


def corpus():
    """Groups of near copies of all degrees, exact copies, and a passage that many documents share."""
    chance = random.Random(4)
    word = lambda: f"w{chance.randint(0, 5000)}"
    passage = [word() for _ in range(40)]
    docs = []
    for _ in range(12):
        base = [word() for _ in range(chance.choice([6, 30, 120]))]
        for _ in range(6):
            docs.append([word() if chance.random() < 0.03 else old for old in base])
        docs += [base, base]
    docs += [[word() for _ in range(80)] + passage for _ in range(60)]
    return [(row, " ".join(words)) for row, words in enumerate(docs)]


@pytest.mark.parametrize("part", [2048, 4])
def test_equals_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(near_duplicates, "_PART", part)
    docs = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = near_duplicates.near_duplicates(frame).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, rows), key=repr) == brute(docs)


def test_without_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "_FEW", 0)
    docs = corpus()[:40]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = near_duplicates.near_duplicates(frame).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, rows), key=repr) == brute(docs)


def test_all_signatures_within_reach_share_a_key():
    chance = np.random.default_rng(1)
    one = chance.integers(0, 1 << 16, (500, near_duplicates.SYMBOLS), dtype=np.uint16)
    other = one.copy()
    for row in range(500):
        at = chance.choice(near_duplicates.SYMBOLS, near_duplicates.REACH, replace=False)
        other[row, at] ^= 1
    assert (near_duplicates._shared_slot(one, other) >= 0).all()
    errors = (one != other).reshape(500, near_duplicates.CHUNKS, near_duplicates.WIDTH).sum(axis=2)
    assert (errors.min(axis=1) <= 1).all()


def test_documents_of_all_kinds(spark, odd_documents, no_documents):
    clash = odd_documents.selectExpr("*", "1 as seen", "2 as digest", "3 as cls")
    rows = near_duplicates.near_duplicates(clash).collect()
    wanted = brute([(row.doc_id, row.text) for row in odd_documents.collect()])
    assert sorted(((row.doc_id, row.n_shingles, row.component_id, row.kept) for row in rows), key=repr) == wanted
    groups = {row.seen: row.group for row in rows}
    assert len(groups) == len(rows) and all(groups[group] == group for group in groups.values())
    assert near_duplicates.near_duplicates(no_documents).collect() == []


def test_query_equals_brute_force(spark, sf_dir):
    from pricefold.llm.queries import op10_near_duplicates, table

    docs = [(row.doc_id, row.text) for row in table(spark, sf_dir, "documents").collect()]
    assert sorted(map(tuple, op10_near_duplicates(spark, sf_dir).collect()), key=repr) == brute(docs)


def test_components(spark):
    chance = random.Random(2)
    links = [(chance.randint(0, 300), chance.randint(0, 300)) for _ in range(150)] + [(n, n + 1) for n in range(400, 460)]
    links += [(500, n) for n in range(501, 700)] + [(3, 3)]
    root = {}

    def find(vertex):
        while root.setdefault(vertex, vertex) != vertex:
            vertex = root[vertex]
        return vertex

    for a, b in links:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {row.vertex: row.root for row in found} == {vertex: find(vertex) for vertex in root} and len(found) == len(root)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_similar_sets_beyond_reach_are_linked_if_they_meet(spark):
    """Two pairs with six of eight shingles in common, whose signatures differ in 24 symbols and share a key."""
    docs = []
    for number in (730, 6333):
        words = [f"w{number}x{place}" for place in range(11)]
        docs += [(len(docs), " ".join(words)), (len(docs) + 1, " ".join([*words[:-1], f"v{number}"]))]
    hashes = near_duplicates.WordHashes()
    signs = [np.frombuffer(near_duplicates.signature(near_duplicates.shingles(text.encode(), hashes)), "<u2") for _, text in docs]
    assert all((signs[row] != signs[row + 1]).sum() > near_duplicates.REACH for row in (0, 2))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = near_duplicates.near_duplicates(frame).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, rows), key=repr) == brute(docs)
    assert len({row.component_id for row in rows}) == 2
