"""Operator 10: near duplicates by MinHash signatures and a multi-index Hamming join.

A signature has ``CHUNKS`` chunks of ``WIDTH`` symbols, each the low 16 bits of a minimum over the document's shingles.
Two signatures that differ in at most ``REACH`` symbols agree, by the pigeonhole principle, in some chunk up to one
symbol. So each signature is entered under each of its chunks with each symbol left out, which enumerates all chunk
errors there may be, and every such pair meets under a key. Every pair that meets, also of signatures that differ in
more, is confirmed or not on the full sets of shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricefold.llm.common import counted, place, stored
from pricefold.llm.components import components
from pricefold.llm.pieces import forget_kept

CHUNKS, WIDTH = 12, 4
SYMBOLS = CHUNKS * WIDTH
# One error in each chunk, and then one fewer than it takes to put a second one in every chunk. A pair of sets with a
# similarity of 0.75 differs in 12 of the 48 symbols on average, and in more than 23 with a probability of 1 in 10,000.
REACH = 2 * CHUNKS - 1
SHINGLE = 5
SIMILARITY = 75
_FEW = 1_000_000
# Rows of one key that meet in one task; the rows of a key that has more meet part by part.
_PART = 2048
_MOST_REMEMBERED = 200_000

_rng = np.random.default_rng(20240229)
_FACTORS = _rng.integers(0, 1 << 63, SYMBOLS, np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _rng.integers(0, 1 << 63, SYMBOLS, np.uint64)
_PLACES = _rng.integers(0, 1 << 63, SHINGLE + 1, np.uint64) * np.uint64(2) + np.uint64(1)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MOST_REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _spread(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingles(text: bytes | None, hashes: WordHashes) -> np.ndarray:
    """The set of shingles of a text as sorted 64-bit hashes.

    Words are parted by ASCII white space and A-Z count as a-z. A text of fewer than five words has one shingle, all of
    its words; one without words has none.
    """
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    values = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(SHINGLE, len(words))
    total = np.full(len(words) - width + 1, _PLACES[SHINGLE] * np.uint64(width), np.uint64)
    for place in range(width):
        total += values[place : place + len(total)] * _PLACES[place]
    return np.unique(_spread(total))


def signature(found: np.ndarray) -> bytes:
    """The symbols of a set that is not empty."""
    least = np.full(SYMBOLS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(found), 4096):
        mixed = found[start : start + 4096, None] * _FACTORS + _OFFSETS
        np.minimum(least, mixed.min(axis=0), out=least)
    return least.astype("<u2").tobytes()


def sketches(docs: DataFrame) -> DataFrame:
    """seen, n_shingles, digest of the set, signature for rows of (seen, text as bytes). One pass over the texts."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        hashes = WordHashes()
        for batch in batches:
            sizes, digests, signatures = [], [], []
            for text in batch.column("text"):
                found = shingles(text.as_py(), hashes)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                signatures.append(signature(found) if len(found) else None)
            yield pa.RecordBatch.from_pydict({
                "seen": batch.column("seen"), "doc_id": batch.column("doc_id"),
                "n_shingles": pa.array(sizes, pa.int64()),
                "digest": pa.array(digests, pa.binary()), "signature": pa.array(signatures, pa.binary()),
            })

    return docs.mapInArrow(sketch, "seen long, doc_id long, n_shingles long, digest binary, signature binary")


def index_keys(classes: DataFrame) -> DataFrame:
    """The keys that each class is entered under: cls, slot (which key it is of the class), key."""

    def enumerate_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = np.arange(SYMBOLS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for batch in batches:
            for start in range(0, batch.num_rows, 20_000):
                part = batch.slice(start, 20_000)
                symbols = _symbols(part.column("signature")).astype(np.uint64).reshape(-1, CHUNKS, WIDTH)
                keys = np.empty((len(symbols), CHUNKS, WIDTH), np.uint64)
                for left_out in range(WIDTH):
                    key = np.zeros(symbols.shape[:2], np.uint64)
                    for place in range(WIDTH):
                        if place != left_out:
                            key = key << np.uint64(16) | symbols[:, :, place]
                    keys[:, :, left_out] = key
                mixed = _spread(keys.reshape(-1, SYMBOLS) + salt)
                yield pa.RecordBatch.from_pydict({
                    "cls": pa.array(np.repeat(part.column("cls").to_numpy(zero_copy_only=False), SYMBOLS)),
                    "slot": pa.array(np.tile(np.arange(SYMBOLS, dtype=np.int32), len(symbols))),
                    "key": pa.array(mixed.reshape(-1).view(np.int64)),
                })

    return classes.select("cls", "signature").mapInArrow(enumerate_keys, "cls long, slot int, key long")


def _symbols(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, SYMBOLS)


def _shared_slot(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The first key that signatures share, by its slot; -1 for those that share none.

    A pair across components is looked at under that key only, so it is looked at once. How many symbols differ in all
    does not decide: sets that are similar enough may differ in more than ``REACH``.
    """
    by_chunk = (left != right).reshape(-1, CHUNKS, WIDTH)
    few = by_chunk.sum(axis=2) <= 1
    chunk = few.argmax(axis=1)
    left_out = by_chunk[np.arange(len(chunk)), chunk].argmax(axis=1)
    return np.where(few.any(axis=1), chunk * WIDTH + left_out, -1)


def _alike_in_size(left: np.ndarray, right: np.ndarray, similarity: int) -> np.ndarray:
    """Whether sets of these sizes can be similar: they have at most the smaller one in common."""
    return 100 * np.minimum(left, right) >= similarity * np.maximum(left, right)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted batches as tables that hold whole runs."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if batch.column("run")[batch.num_rows - 1] == held[0].column("run")[0]:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        values = table.column("run").to_numpy()
        # The last run may go on in the next batch.
        done = int(np.searchsorted(values, values[-1], "left"))
        yield table.slice(0, done)
        held = table.slice(done).to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _reported(
    table: pa.Table, left: np.ndarray, right: np.ndarray, symbols: np.ndarray, similarity: int
) -> Iterator[pa.RecordBatch]:
    """The pairs of rows that share a key and may be links by their sizes."""
    cls, size = table.column("cls").to_numpy(), table.column("size").to_numpy()
    for start in range(0, len(left), 100_000):
        a, b = left[start : start + 100_000], right[start : start + 100_000]
        met = (_shared_slot(symbols[a], symbols[b]) >= 0) & _alike_in_size(size[a], size[b], similarity)
        first, second = cls[a[met]], cls[b[met]]
        yield pa.RecordBatch.from_pydict(
            {"a": pa.array(np.maximum(first, second)), "b": pa.array(np.minimum(first, second))}
        )


def _signed(entries: DataFrame, classes: DataFrame, run: Column) -> DataFrame:
    chosen = entries.withColumn("run", run).join(classes.select("cls", "size", "signature"), "cls")
    return chosen.repartition("run").sortWithinPartitions("run", F.col("cls") != F.col("first"), "cls")


def _part(cls: str) -> Column:
    return F.pmod(F.xxhash64(cls), F.ceil(F.col("rows") / _PART)).cast("int")


def _stars(entries: DataFrame, classes: DataFrame, similarity: int) -> DataFrame:
    """Each class with the first one under a key, if they may be links.

    A key of many rows is dealt to several runs, each with the first class. Half of the keys are enough here.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches):
            runs, symbols = table.column("run").to_numpy(), _symbols(table.column("signature"))
            heads = np.flatnonzero(np.concatenate([[True], runs[1:] != runs[:-1]]))
            rows = np.setdiff1d(np.arange(len(runs)), heads, assume_unique=True)
            yield from _reported(table, rows, heads[np.searchsorted(heads, rows, "right") - 1], symbols, similarity)

    parts = F.ceil(F.col("rows") / _PART).cast("int")
    everywhere = F.sequence(F.lit(0), parts - 1)
    own = F.when(F.col("cls") == F.col("first"), everywhere).otherwise(F.array(_part("cls")))
    dealt = entries.withColumn("part", F.explode(own))
    return _signed(dealt, classes, F.xxhash64("key", "part")).mapInArrow(compare, "a long, b long")


MET = "run long, slot int, cls long, root long, signature binary"


def _met(entries: DataFrame, classes: DataFrame, similarity: int) -> DataFrame:
    """The rows of runs that meet one of another component that may be a link, under the first key that the two share.

    Runs are compared all at once: each row with the next one, then the one after that, as far as the run goes. The rows
    of a part of a large key meet those of each other part in a run of their own. What comes out is a row for each class
    that meets others in a run, not one for each pair.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches):
            runs, symbols = table.column("run").to_numpy(), _symbols(table.column("signature"))
            root, slot, size = (table.column(name).to_numpy() for name in ("root", "slot", "size"))
            meets = np.zeros(len(runs), bool)
            rows, step = np.arange(len(runs)), 1
            while len(rows):
                rows = rows[rows + step < len(runs)]
                rows = rows[runs[rows] == runs[rows + step]]
                apart = rows[root[rows] != root[rows + step]]
                for start in range(0, len(apart), 100_000):
                    left = apart[start : start + 100_000]
                    left = left[_alike_in_size(size[left], size[left + step], similarity)]
                    left = left[_shared_slot(symbols[left], symbols[left + step]) == slot[left]]
                    meets[left] = meets[left + step] = True
                step += 1
            for batch in table.filter(pa.array(meets)).select(["run", "slot", "cls", "root", "signature"]).to_batches():
                yield batch

    parts = F.ceil(F.col("rows") / _PART).cast("int")
    dealt = entries.withColumn("own", _part("cls")).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    run = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    return _signed(dealt, classes, run).mapInArrow(compare, MET)


def _linked_across(
    entries: DataFrame, docs: DataFrame, classes: DataFrame, similarity: int
) -> tuple[DataFrame, int]:
    """Links that join the components of ``entries``, and their number: at least one for any two that have a link.

    Sets are brought to the runs, where pairs are confirmed on them; two components that a run has joined already are
    not compared further in it.
    """

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches):
            runs, symbols = table.column("run").to_numpy(), _symbols(table.column("signature"))
            cls, root, slot = (table.column(name).to_numpy() for name in ("cls", "root", "slot"))
            found = table.column("found").combine_chunks()
            size = pc.binary_length(found).to_numpy() // 8
            bounds = np.flatnonzero(np.concatenate([[True], runs[1:] != runs[:-1], [True]]))
            links = []
            for start, end in zip(bounds.tolist(), bounds[1:].tolist()):
                sets = [np.frombuffer(found[row].as_py(), np.uint64) for row in range(start, end)]
                joined: dict[int, int] = {}

                def top(vertex: int) -> int:
                    while joined.setdefault(vertex, vertex) != vertex:
                        joined[vertex] = vertex = joined[joined[vertex]]
                    return vertex

                for row in range(start, end - 1):
                    others = np.arange(row + 1, end)
                    others = others[root[others] != root[row]]
                    others = others[_alike_in_size(size[others], size[row], similarity)]
                    others = others[_shared_slot(symbols[others], symbols[row]) == slot[row]] if len(others) else others
                    for other in others.tolist():
                        a, b = top(int(root[row])), top(int(root[other]))
                        if a != b and _similar(sets[row - start], sets[other - start], similarity):
                            joined[a] = b
                            links.append((max(cls[row], cls[other]), min(cls[row], cls[other])))
            yield pa.RecordBatch.from_pydict({
                "a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())
            })

    met, count = counted(_met(entries, classes, similarity), "met-classes")
    wanted = met.select("cls").distinct().join(classes.select("cls", "digest"), "cls")
    sets = _sets(docs, stored(wanted, "wanted-classes", at_most=count))
    rows = met.join(sets, "cls").repartition("run").sortWithinPartitions("run", "cls")
    links = rows.mapInArrow(confirm, "a long, b long")
    return counted(links.repartition(max(1, -(-count // 500_000))), "links")


def _few(rows: DataFrame) -> DataFrame:
    """A table that is broadcast if its counted rows, a few numbers each, are at most a million."""
    return F.broadcast(rows) if rows.count() <= _FEW else rows


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """cls and the full set of shingles of the wanted classes (cls, digest), whose number is that of a row in ``docs``."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                sets = [shingles(text.as_py(), hashes).tobytes() for text in part.column("text")]
                for found, digest in zip(sets, part.column("digest")):
                    if xxhash.xxh3_128_digest(found) != digest.as_py():
                        raise ValueError("the documents are not the same in a second read; store them first")
                yield pa.RecordBatch.from_pydict({"cls": part.column("cls"), "found": pa.array(sets, pa.binary())})

    chosen = docs.join(_few(wanted), F.col("seen") == F.col("cls")).select("cls", "digest", "text")
    return stored(chosen.mapInArrow(gather, "cls long, found binary"), "shingle-sets")


def _similar(left: np.ndarray, right: np.ndarray, similarity: int) -> bool:
    """Whether two sets, sorted, have ``similarity`` percent of their union in common."""
    places = np.searchsorted(left, right)
    places[places == len(left)] = 0
    common = int((left[places] == right).sum())
    return 100 * common >= similarity * (len(left) + len(right) - common)


def _confirmed(pairs: DataFrame, docs: DataFrame, classes: DataFrame, similarity: int) -> tuple[DataFrame, int]:
    """The pairs that are links, by their full sets, and their number."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for left, right in zip(batch.column("left"), batch.column("right")):
                left, right = np.frombuffer(left.as_py(), np.uint64), np.frombuffer(right.as_py(), np.uint64)
                linked.append(_similar(left, right, similarity))
            yield pa.RecordBatch.from_arrays(
                [batch.column(name).filter(pa.array(linked, pa.bool_())) for name in ("a", "b")], names=["a", "b"]
            )

    pairs, count = counted(pairs, "candidate-pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    wanted = stored(wanted.join(classes.select("cls", "digest"), "cls"), "wanted-classes", at_most=2 * count)
    sets = _sets(docs, wanted)
    left = sets.select(F.col("cls").alias("a"), F.col("found").alias("left"))
    right = sets.select(F.col("cls").alias("b"), F.col("found").alias("right"))
    found = pairs.join(left, "a").join(right, "b").mapInArrow(compare, "a long, b long")
    # Compared in parallel; what is left is two numbers a link.
    return counted(found.repartition(max(1, -(-count // 500_000))), "links")


def near_duplicates(
    docs: DataFrame, similarity: int = SIMILARITY, id_column: str = "doc_id", text_column: str = "text",
    seen_column: str | None = None,
) -> DataFrame:
    """One row for each row of ``docs``: seen, doc_id, n_shingles, component_id, kept, group.

    Documents whose sets of five-word shingles have ``100 * common >= similarity * all`` are linked. ``component_id`` is
    the smallest id that a document reaches by links; ``kept`` marks the documents that have it. Documents without words
    are linked with nothing. Rows of one id are documents of their own; a row without an id links like others and gives
    its component no id, so a component of such rows only has a null id and none kept. ``seen`` numbers the rows and
    ``group`` is the smallest of a component's numbers.

    1. Documents with equal sets are one class, found by an aggregation; only one of them goes on.
    2. Each class is compared with one class under each of half its keys, and confirmed links give components.
    3. Under keys that have classes of different components, all pairs across components are compared, in the tasks
       that hold the key's classes. No row is written for a pair that is no link.

    So large groups of near copies collapse in step 2, with a few pairs a member, and step 3 loses no link. Full sets are
    made again for the classes in candidate pairs only, from a second read of the texts. For it they are written once with
    their numbers, unless ``docs`` is a stored table that holds these in ``seen_column``.
    """
    rows = docs.select(
        place(seen_column).alias("seen"), F.col(id_column).cast("bigint").alias("doc_id"),
        F.col(text_column).cast("binary").alias("text"),
    )
    if seen_column is None:
        rows = stored(rows, "numbered-texts")
    found, count = counted(sketches(rows), "sketches")
    texts = rows.select("seen", "text")
    classes = stored(
        found.where("digest is not null").groupBy("digest").agg(
            F.min("seen").alias("cls"), F.min("doc_id").alias("least"), F.first("n_shingles").alias("size"),
            F.first("signature").alias("signature"),
        ),
        "classes",
        at_most=10 * count,
    )
    keys = index_keys(classes)
    # Which class comes first differs from key to key, so that members of a loose group are compared with many others.
    first = F.min_by("cls", F.xxhash64("cls", "key")).alias("first")
    shared = keys.groupBy("key").agg(F.count("*").alias("rows"), first).where("rows > 1")
    entries = stored(keys.join(shared, "key"), "index")

    stars = _stars(entries.where(F.col("slot") % 2 == 0), classes, similarity)
    links, number = _confirmed(stars.distinct(), texts, classes, similarity)
    roots = components(links, number)

    rooted = _with_roots(entries, roots)
    apart = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    crossing = rooted.join(apart.select("key"), "key")
    more, further = _linked_across(crossing, texts, classes, similarity)
    ties = roots.select(F.col("vertex").alias("a"), F.col("root").alias("b"))
    roots = components(ties.unionByName(more), 2 * number + further)

    least = _with_roots(classes, roots)
    named = least.groupBy("root").agg(F.min("least").alias("component_id"))
    named = least.join(named, "root").select(F.col("digest").alias("_digest"), "component_id", "root")
    result = found.join(named, F.col("digest") == F.col("_digest"), "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return result.select(
        "seen", "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
        F.coalesce("root", "seen").alias("group"),
    )


def _with_roots(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Add the root of each class; a class without links is its own."""
    known = roots.select(F.col("vertex").alias("_vertex"), F.col("root").alias("_root"))
    joined = rows.join(known, F.col("cls") == F.col("_vertex"), "left")
    return joined.withColumn("root", F.coalesce("_root", "cls")).drop("_vertex", "_root")
