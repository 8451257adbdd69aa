"""Operator 13: the prefix trie of conversations, by a skeleton of range-partition splitters.

A conversation is the path of its turns' digests. Splitters cut the order of (path, conversation) into shards of bounded
size. A node whose conversations all lie between two splitters belongs to one shard; a node in more than one shard is a
prefix of a splitter. The trie of the splitters' paths, the skeleton, is broadcast. Each shard streams its sorted paths
and finishes all its other nodes alone; of skeleton nodes it sends partial aggregates, which are summed by node and then
up the skeleton. So a first turn or a whole conversation that a third of the conversations share is spread over shards.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricefold.llm.common import counted, stored

#: Signs of a path for each turn: 128 bits of a SHA-256, in hexadecimal.
TURN = 32
#: Conversations a shard is meant to have, the most shards, and sampled conversations a shard.
SHARD_ROWS, SHARDS, SAMPLED = 2_000, 4_096, 16
#: Bytes of sampled paths that go to the driver at most, about.
SAMPLE_BYTES = 64 << 20
_BASE_TURNS = 6
_CHUNK = 4_096


def _turns(rows: DataFrame) -> DataFrame:
    """conv_id and turns: structs of turn, digest and code points, in order (null turns first, ties by digest)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.left(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256), F.lit(TURN))
    turns = rows.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        digest.alias("digest"), F.char_length(text).cast("bigint").alias("chars"),
    )
    grouped = turns.groupBy("conv_id").agg(F.collect_list(F.struct("turn", "digest", "chars")).alias("turns"))
    return grouped.select("conv_id", F.sort_array("turns").alias("turns"))


def _path(turns: Column) -> tuple[Column, Column]:
    return F.array_join(F.transform(turns, lambda turn: turn.digest), ""), F.transform(turns, lambda turn: turn.chars)


def as_stored(conversations: DataFrame) -> DataFrame:
    """conv_id, path and chars of each conversation as it is."""
    path, chars = _path(F.col("turns"))
    return _turns(conversations).select("conv_id", path.alias("path"), chars.alias("chars"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, path and chars of each conversation with its head replaced.

    Of conversation c, the first h turns are those of c - c % 100 (all if it has fewer, none if it is absent), h being the
    unsigned CRC-32 of the decimal c modulo 6; its own turns after its first h follow. At most 199 conversations share a
    base.
    """
    own = _turns(conversations)
    bases = own.where("conv_id % 100 = 0").select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, _BASE_TURNS - 1).alias("base_turns")
    )
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % _BASE_TURNS).cast("int")
    own = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % 100).withColumn("head", head)
    both = own.join(bases, "base", "left")
    none = F.slice("turns", 1, 0)
    turns = F.concat(
        F.slice(F.coalesce("base_turns", none), F.lit(1), F.col("head")),
        F.slice("turns", F.col("head") + 1, F.size("turns")),
    )
    path, chars = _path(F.col("new"))
    return both.select("conv_id", turns.alias("new")).select("conv_id", path.alias("path"), chars.alias("chars"))


def _shared(one: str, other: str) -> int:
    """The turns that two paths share at their start."""
    low, high = 0, min(len(one), len(other)) // TURN
    while low < high:
        middle = (low + high + 1) // 2
        if one[: middle * TURN] == other[: middle * TURN]:
            low = middle
        else:
            high = middle - 1
    return low


_FIRST = -(1 << 63)


def splitters(paths: DataFrame, rows: int, shards: int = SHARDS, shard_rows: int = SHARD_ROWS) -> list[tuple[str, int]]:
    """Ascending places (path, conversation) at which a new shard begins, from a sample bounded in rows and bytes.

    A splitter is cut to the shortest prefix that is above the sampled path before it, so the skeleton is no deeper than
    what neighbouring paths share, and one turn. Between equal paths the conversation decides. The sample bears on the
    sizes of shards only, on no result.
    """
    shards = min(shards, -(-rows // shard_rows))
    if shards < 2:
        return []
    size = paths.agg(F.sum(F.length("path") + 16)).first()[0]
    share = min(1.0, shards * SAMPLED / rows, SAMPLE_BYTES / size)
    key = F.shiftrightunsigned(F.xxhash64("conv_id"), 12)
    drawn = paths.where(key <= int(share * (1 << 52))).select("path", "conv_id").collect()
    drawn = sorted((row.path, row.conv_id) for row in drawn)
    found = []
    for k in range(1, shards):
        at = k * len(drawn) // shards
        if 0 < at < len(drawn):
            (before, _), (path, conv_id) = drawn[at - 1], drawn[at]
            if path == before:
                found.append((path, conv_id))
            else:
                found.append((path[: (_shared(before, path) + 1) * TURN], _FIRST))
    return sorted(set(found))


@dataclass
class _Node:
    """What is known of a node while its conversations pass by."""

    depth: int
    key: str
    chars: int
    skeleton: bool
    least: int
    members: int = 0
    children: int = 0
    leaves: int = 0
    saved: int = 0
    ends: object = None
    chunk: list[int] = field(default_factory=list)
    chunks: int = 0
    below: list[tuple] = field(default_factory=list)


_OUT = pa.schema([
    ("kind", pa.string()), ("key", pa.string()), ("parent", pa.string()), ("conv_id", pa.int64()),
    ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
    ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends", pa.string()), ("chars", pa.int64()),
    ("shard", pa.int64()), ("chunk", pa.int64()),
])
_OUT_KIND = (
    "kind string, key string, parent string, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends string, chars long, shard long, chunk long"
)


class _Shard:
    """The nodes of one shard, from its conversations in order; ``before`` and ``after`` are the splitters at its ends.

    Rows come out as tuples in the order of ``_OUT``: kind ``node`` is finished but for a parent in the skeleton, named by
    its key; kind ``part`` is what the shard knows of a skeleton node, and kind ``ends`` some of the conversations that
    end there, in order. Only the nodes on the current path are open, and of nodes that are not in the skeleton the
    finished ones below them, which are rows of this shard.
    """

    def __init__(self, number: int, before: str, after: str):
        self.number, self.bounds, self.open, self.path = number, (before, after), [], ""

    def add(self, conv_id: int, path: str, chars: list[int]) -> Iterator[tuple]:
        shared = _shared(self.path, path) if self.open else -1
        yield from self._close(shared + 1)
        skeleton = max(_shared(bound, path) for bound in self.bounds)
        for depth in range(shared + 1, len(path) // TURN + 1):
            # A digest of the parent's key and the turn names a node, whatever its depth.
            above = self.open[-1].key if self.open else ""
            key = hashlib.sha256((above + path[(depth - 1) * TURN : depth * TURN]).encode()).hexdigest()[:TURN] if depth else ""
            node = _Node(depth, key, chars[depth - 1] if depth else 0, depth <= skeleton, conv_id)
            if not node.skeleton:
                node.ends = hashlib.sha256()
            self.open.append(node)
        self.path = path
        for node in self.open:
            node.members += 1
            node.least = min(node.least, conv_id)
        yield from self._end(self.open[-1], conv_id)

    def _end(self, node: _Node, conv_id: int) -> Iterator[tuple]:
        node.chunk.append(conv_id)
        if len(node.chunk) == _CHUNK:
            yield from self._ends(node)

    def _ends(self, node: _Node) -> Iterator[tuple]:
        if not node.chunk:
            return
        text = ",".join(map(str, node.chunk))
        if node.skeleton:
            row = dict.fromkeys(_OUT.names) | {
                "kind": "ends", "key": node.key, "depth": node.depth, "ends": text, "shard": self.number,
                "chunk": node.chunks,
            }
            yield tuple(row.values())
        else:
            node.ends.update(("," if node.chunks else "").encode() + text.encode())
        node.chunks, node.chunk = node.chunks + 1, []

    def _close(self, down_to: int) -> Iterator[tuple]:
        while len(self.open) > down_to:
            node = self.open.pop()
            yield from self._ends(node)
            above = self.open[-1] if self.open else None
            parent = above.key if above else None
            if node.skeleton:
                yield (
                    "part", node.key, parent, node.least, node.depth, None, node.members, node.children, node.leaves,
                    node.saved, None, node.chars, self.number, None,
                )
                continue
            node.saved += (node.members - 1) * node.chars
            node.leaves = node.leaves or 1
            above.children += 1
            above.leaves += node.leaves
            above.saved += node.saved
            own = (
                "node", None, parent, node.least, node.depth, None, node.members, node.children, node.leaves, node.saved,
                node.ends.hexdigest(), None, None, None,
            )
            # Those below now know their parent; this one waits for its own, unless that is in the skeleton.
            finished = ((*row[:5], node.least, *row[6:]) if row[5] is None else row for row in node.below)
            if above.skeleton:
                yield own
                yield from finished
            else:
                above.below.append(own)
                above.below.extend(finished)

    def finish(self) -> Iterator[tuple]:
        yield from self._close(0)


def _batches(rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == 10_000:
            yield _batch(held)
            held = []
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), _OUT.types, strict=True)], schema=_OUT
    )


def _nodes(paths: DataFrame, cuts: list[tuple[str, int]]) -> DataFrame:
    """The rows of all shards, see ``_Shard``."""
    held = paths.sparkSession.sparkContext.broadcast(cuts)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(batch.column(1).to_pylist(), batch.column(0).to_pylist(), strict=True)
            shards = pa.array([bisect_right(held.value, key) for key in keys], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, shards], names=["conv_id", "path", "chars", "shard"])

    def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            shard = None
            for batch in batches:
                for number, path, conv_id, chars in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if shard is None or shard.number != number:
                        if shard:
                            yield from shard.finish()
                        ends = ["", *(path for path, _ in held.value), ""]
                        shard = _Shard(number, ends[number], ends[number + 1])
                    yield from shard.add(conv_id, path, chars)
            if shard:
                yield from shard.finish()

        return _batches(rows())

    if cuts:
        paths = paths.mapInArrow(placed, "conv_id long, path string, chars array<long>, shard long")
    else:
        paths = paths.withColumn("shard", F.lit(0).cast("bigint"))
    dealt = paths.select("shard", "path", "conv_id", "chars").repartition("shard").sortWithinPartitions("shard", "path", "conv_id")
    return dealt.mapInArrow(grown, _OUT_KIND)


def _digests(ends: DataFrame) -> DataFrame:
    """key and ends_sha256: the digest of a node's conversations, whose pieces stream through one hash in order.

    SHA-256 takes its input in order, so the pieces of a node (of up to ``_CHUNK`` numbers each) meet in one task. It holds
    one piece at a time.
    """
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            keys, digests = [], []
            for at, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if at != key:
                    if digest:
                        keys.append(key)
                        digests.append(digest.hexdigest())
                    key, digest = at, hashlib.sha256(text.encode())
                else:
                    digest.update(b"," + text.encode())
            yield pa.record_batch({"key": pa.array(keys, pa.string()), "ends_sha256": pa.array(digests, pa.string())})
        if digest:
            yield pa.record_batch({"key": [key], "ends_sha256": [digest.hexdigest()]})

    dealt = ends.select("key", "ends", "shard", "chunk").repartition("key").sortWithinPartitions("key", "shard", "chunk")
    return dealt.select("key", "ends").mapInArrow(hashed, "key string, ends_sha256 string")


def _skeleton(parts: DataFrame) -> list[tuple]:
    """Skeleton nodes (key, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens), finished.

    The partial aggregates are summed by node. What lies below a node is summed up the skeleton on the driver: it has no
    more nodes than the splitters' paths have turns.
    """
    summed = parts.groupBy("key", "parent", "depth", "chars").agg(
        F.min("conv_id").alias("conv_id"),
        *[F.sum(name).alias(name) for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    ).collect()
    nodes = {row.key: row.asDict() for row in summed}
    for node in sorted(nodes.values(), key=lambda node: -node["depth"]):
        node["saved_tokens"] += (node["n_convs"] - 1) * node["chars"]
        node["n_leaves"] = node["n_leaves"] or 1
        if above := nodes.get(node["parent"]):
            above["n_children"] += 1
            above["n_leaves"] += node["n_leaves"]
            above["saved_tokens"] += node["saved_tokens"]
    return [
        (
            key, node["conv_id"], node["depth"], nodes[node["parent"]]["conv_id"] if node["depth"] else None,
            node["n_convs"], node["n_children"], node["n_leaves"], node["saved_tokens"],
        )
        for key, node in nodes.items()
    ]


def trie(paths: DataFrame, shards: int = SHARDS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row for each node of the trie of ``paths`` (conv_id, path, chars; each conversation once).

    conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256. The root
    has depth 0, no text and no parent, and all conversations as members, those without turns too. saved_tokens is the sum over
    the subtree of (n_convs - 1) times the code points of the node's last text. No conversations give no rows.

    Paths and nodes are each written once to the shared folder. A path is one row, 32 bytes a turn and no text.
    """
    paths, rows = counted(paths, "conversation-paths")
    spark = paths.sparkSession
    cuts = splitters(paths, rows, shards, shard_rows)
    found = stored(_nodes(paths, cuts), "trie-nodes")
    skeleton = spark.createDataFrame(
        _skeleton(found.where("kind = 'part'")),
        "key string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long",
    )
    columns = ["depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    none = F.lit(hashlib.sha256().hexdigest())
    # The skeleton is bounded by the splitters; its nodes' digests are no more.
    digests = _digests(found.where("kind = 'ends'"))
    top = skeleton.join(digests, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", none))
    parents = skeleton.select(F.col("key").alias("parent"), F.col("conv_id").alias("above"))
    rest = found.where("kind = 'node'").join(F.broadcast(parents), "parent", "left").withColumns({
        "parent_conv_id": F.coalesce("parent_conv_id", "above"), "ends_sha256": F.col("ends"),
    })
    return rest.select("conv_id", *columns).unionByName(top.select("conv_id", *columns))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of rebuilt conversations, see ``rebuilt`` and ``trie``.

    ``conversations`` has conv_id, turn, role and text; other columns play no part. Turns go by their number, null first, of
    equal ones by a digest of role and text; a null role or text is empty; repeated turns count each. Rows without a conv_id
    belong to no conversation and are left out. Texts of any length are read whole.
    """
    return trie(rebuilt(conversations))
