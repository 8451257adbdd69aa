from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pricefold.llm import prefix_trie

KIND = "conv_id long, turn long, role string, text string, depth string, path string"


def digest(role: str, text: str) -> str:
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]


def brute_paths(rows) -> dict[int, list[tuple[str, str]]]:
    own = defaultdict(list)
    for conv_id, turn, role, text, *_ in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    own = {conv_id: [turn[3:] for turn in sorted(turns)] for conv_id, turns in own.items()}
    made = {}
    for conv_id, turns in own.items():
        h = zlib.crc32(str(conv_id).encode()) % 6
        base = conv_id - (conv_id % 100 if conv_id >= 0 else -(-conv_id % 100))
        made[conv_id] = own.get(base, [])[:h] + turns[h:]
    return made


def brute_trie(paths):
    members, children, leaves, saved = defaultdict(list), Counter(), Counter(), Counter()
    for conv_id, path in paths.items():
        for depth in range(len(path) + 1):
            members[tuple(path[:depth])].append(conv_id)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, those in members.items():
        for depth in range(len(node) + 1):
            leaves[node[:depth]] += node not in children
            saved[node[:depth]] += (len(those) - 1) * len(node[-1][1]) if node else 0
    for node, those in members.items():
        ends = ",".join(str(c) for c in sorted(those) if len(paths[c]) == len(node))
        yield (
            min(those), len(node), min(members[node[:-1]]) if node else None, len(those), children[node], leaves[node],
            saved[node], hashlib.sha256(ends.encode()).hexdigest(),
        )


def conversations():
    rows = []
    for c in range(0, 400):
        for t in range(c % 7):
            rows.append((c, t, ("user", "assistant")[t % 2], f"turn {t} of {c % (3 + t)}", "x", "y"))
    # A third shares one long conversation, others its first turns.
    for c in range(1000, 1200):
        rows += [(c, t, "user", f"shared {t} ü😀", None, None) for t in range(9 if c % 4 else 5)]
    rows += [(c, 0, "user", f"shared {c % 2}", None, None) for c in range(2000, 2040)]
    rows += [
        (-5, 0, None, "negative", None, None), (-105, 0, "user", None, None, None), (-100, 3, "a", "b", None, None),
        (None, 0, "user", "no conversation", None, None), (-7, None, "user", "null turn first", None, None),
        (-7, -9, "user", "then this", None, None), (3, 0, "user", "turn 0 of 0", None, None), (3, 0, "user", "turn 0 of 0", None, None),
        (2**62, 1, "", "x" * 50_000, None, None), (2**62, 0, "x" * 10, "", None, None), (5, 0, None, None, None, None),
    ]
    return rows


@pytest.mark.parametrize("shard_rows", [3, 40, 10_000])
def test_equals_brute_force_for_any_shards(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(prefix_trie, "_CHUNK", 7)
    rows = conversations()
    paths = prefix_trie.rebuilt(spark.createDataFrame(rows, KIND).repartition(4))
    found = prefix_trie.trie(paths, shard_rows=shard_rows).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, brute_trie(brute_paths(rows))))


def test_a_shared_conversation_is_cut_between_its_copies(spark):
    rows = [(c, t, "user", f"same {t}", None, None) for c in range(900) for t in range(4)]
    paths = prefix_trie.as_stored(spark.createDataFrame(rows, KIND))
    cuts = prefix_trie.splitters(paths, 900, shard_rows=100)
    assert len(cuts) == 8 and len({path for path, _ in cuts}) == 1
    found = prefix_trie.trie(paths, shard_rows=100).collect()
    plain = {c: [("user", f"same {t}") for t in range(4)] for c in range(900)}
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, brute_trie(plain)))
    shards = prefix_trie._nodes(paths, cuts).where("kind = 'part'").groupBy("depth").agg(F.max("n_convs").alias("n"), F.count("*").alias("m"))
    assert all(row.n < 300 and row.m == 9 for row in shards.collect())


def test_splitters_are_no_deeper_than_their_neighbours_share(spark):
    rows = [(c, t, "user", f"{c if t else 'same'} {t}", None, None) for c in range(300) for t in range(30)]
    cuts = prefix_trie.splitters(prefix_trie.as_stored(spark.createDataFrame(rows, KIND)), 300, shard_rows=20)
    assert cuts and all(len(path) == 2 * prefix_trie.TURN for path, _ in cuts)


def test_no_conversations(spark):
    assert prefix_trie.conversation_trie(spark.createDataFrame([], KIND)).collect() == []
    only = spark.createDataFrame([(None, 0, "user", "x", None, None)], KIND)
    assert prefix_trie.conversation_trie(only).collect() == []


def test_turnless_conversations_are_members_of_the_root(spark):
    # Conversation 41 takes its first turns from 0, which is absent.
    lone = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 >= 1)
    found = prefix_trie.conversation_trie(spark.createDataFrame([(lone, 0, "user", "x", None, None)], KIND)).collect()
    assert [tuple(row) for row in found] == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]
