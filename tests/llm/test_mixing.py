from __future__ import annotations

import re
from collections import defaultdict

from pricefold.llm import mixing

WORD = re.compile("[^\x20\x09-\x0D]+")


def shares(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda name: (name is None, name or ""))
    weight = {name: weights[place % len(weights)] for place, name in enumerate(names)}
    target, rest, todo = {}, share * sum(sizes.values()), set(names)
    while todo:
        level = rest / sum(weight[name] for name in todo)
        full = {name for name in todo if level * weight[name] > most * sizes[name]}
        if not full:
            target |= {name: level * weight[name] for name in todo}
            break
        target |= {name: most * sizes[name] for name in full}
        rest -= sum(most * sizes[name] for name in full)
        todo -= full
    return target


def test_targets_equal_repeated_sharing(spark):
    for sizes in ({"a": 100, "b": 10, None: 1000, "c": 50, "é": 7}, {"a": 0, "b": 0}, {"x": 5}, {"a": 1, "b": 1, "c": 1}):
        rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        found = {row.source: row.target for row in mixing.targets(rows, (5, 2, 1), 1.5, 2).collect()}
        wanted = shares(sizes)
        assert found.keys() == wanted.keys()
        assert all(abs(found[name] - wanted[name]) <= 1e-9 * max(1, wanted[name]) for name in wanted)


def checked(docs, rows, block=64):
    sizes, sources = defaultdict(int), {}
    for row in docs:
        sizes[row.source] += len(WORD.findall(row.text or ""))
        sources[row.doc_id] = row.source
    target, taken = shares(sizes), defaultdict(int)
    for row in rows:
        source = sources[row.doc_id]
        assert row.source_size == sizes[source] and abs(row.target - target[source]) <= 1e-6 * max(1, row.target)
        assert 0 <= row.taken <= 2 * row.size
        taken[source] += row.taken
    assert all(abs(taken[name] - target[name]) <= 4 * block for name in target)


def test_query_meets_its_targets_and_reruns_agree(spark, sf_dir):
    from pricefold.llm.queries import op6_mixing, table

    docs = table(spark, sf_dir, "documents").collect()
    rows = op6_mixing(spark, sf_dir).collect()
    assert {row.doc_id: row.size for row in rows} == {row.doc_id: len(WORD.findall(row.text or "")) for row in docs}
    checked(docs, rows)
    assert sorted(rows) == sorted(op6_mixing(spark, sf_dir).collect())


def test_documents_of_all_kinds(spark, odd_documents, no_documents):
    rows = mixing.mixed(odd_documents, block=4).collect()
    assert len(rows) == odd_documents.count()
    assert sum(row.size for row in rows) == sum(len(WORD.findall(row.text or "")) for row in odd_documents.collect())
    assert all(0 <= row.taken <= 2 * row.size for row in rows)
    assert mixing.mixed(no_documents).collect() == []
    wordless = mixing.mixed(odd_documents.where("doc_id in (5, 6, 7)")).collect()
    assert [(row.size, row.target, row.taken) for row in wordless] == [(0, 0.0, 0)] * 3


def test_a_hot_source(spark):
    docs = spark.range(3000).selectExpr(
        "id as doc_id", "if(id % 3 = 0, 'hot', concat('s', id % 50)) as source", "repeat('w ', cast(id % 40 as int)) as text"
    )
    checked(docs.collect(), mixing.mixed(docs).collect())


def test_small_sources_reach_their_targets(spark):
    """One large source, sources of 1 to 200 words, and many of 30: none vanishes, each gives its target."""
    texts = [("large", 3000)] * 100 + [(f"of{n}", n) for n in range(1, 201)] + [(f"s{n}", 30) for n in range(200)]
    rows = [(place, source, "w " * words) for place, (source, words) in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    target, taken = {}, defaultdict(int)
    for row in mixing.mixed(docs).collect():
        source = texts[row.doc_id][0]
        target[source] = row.target
        taken[source] += row.taken
        assert 0 <= row.taken <= 2 * row.size
    assert all(target[name] <= taken[name] < target[name] + 1 for name in target)


def test_the_schedule_holds_each_quota(spark):
    rows = [(number, slots) for number, slots in enumerate([5000, 0, 1, 1, 2, 70_000, 3, 1])]
    sources = spark.createDataFrame(rows, "number int, slots long")
    found = defaultdict(list)
    positions = defaultdict(list)
    for number, rank, position in sorted(mixing.schedule(sources, True).collect()):
        found[number].append(rank)
        positions[number].append(position)
    assert all(sorted(places) == places for places in positions.values())
    assert {number: sorted(ranks) for number, ranks in found.items()} == {n: list(range(k)) for n, k in rows if k}


def test_every_prefix_of_the_schedule_holds_the_shares(spark):
    """After any number of slots each source has had its share of them, but for a few."""
    slots = [4000, 2500, 1200, 300, 37, 1]
    sources = spark.createDataFrame(list(enumerate(slots)), "number int, slots long")
    found = mixing.schedule(sources, True).collect()
    had = [0] * len(slots)
    order = [row.number for row in sorted(found, key=lambda row: (row.position, row.number))]
    for n, number in enumerate(order, 1):
        had[number] += 1
        assert all(abs(count - n * whole / sum(slots)) <= 6 for count, whole in zip(had, slots))


def test_documents_equal_a_plain_walk_of_the_schedule(spark):
    """Each source's shuffled words, laid out and cut by hand, are dealt to its slots one after the other."""
    block = 8
    docs = spark.range(400).selectExpr(
        "id as doc_id", "if(id % 3 = 0, 'hot', concat('s', id % 7)) as source", "repeat('w ', cast(id * 7 % 23 as int)) as text"
    )
    keys = {row.doc_id: row.key for row in docs.selectExpr("doc_id", "xxhash64(doc_id, text) as key").collect()}
    rows = {row.doc_id: row for row in mixing.mixed(docs, block=block).collect()}
    sizes = docs.selectExpr("source", "cast(length(text) / 2 as long) as n").groupBy("source").agg({"n": "sum"})
    sizes = sizes.toDF("source", "source_size")
    sources = mixing.quotas(mixing.targets(sizes, (5, 2, 1), 1.5, 2), 2, block).cache()
    names = {row.number: row for row in sources.collect()}
    words = defaultdict(list)
    for row in sorted(docs.collect(), key=lambda row: (keys[row.doc_id] % 2**64, row.doc_id)):
        words[row.source] += [(row.doc_id, word) for word in range(len(row.text) // 2)]
    taken, slots, left = defaultdict(int), defaultdict(list), {name.number: name.words for name in names.values()}
    for number, rank, position in sorted(mixing.schedule(sources, True).collect()):
        name = names[number]
        at = rank % name.blocks * block
        chosen = words[name.source][at : at + block][: left[number]]
        left[number] -= len(chosen)
        for doc, word in chosen:
            taken[doc] += 1
            if word == 0:
                slots[doc].append(position)
    assert not any(left.values())
    assert all(row.taken == taken[doc] and row.slots == slots[doc] for doc, row in rows.items())
    assert max(map(len, slots.values())) == 2
