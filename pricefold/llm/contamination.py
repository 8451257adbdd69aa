"""Operator 7: benchmark decontamination by a distributed positional inverted index.

The index is partitioned by document: each row of it is the complete inverted index of a segment of documents, whose
posting lists give the positions of each benchmark term in the segment. Any segment answers any query by itself, so a
search shuffles no postings and no term is hot. Phrases are found by intersecting offset-adjusted lists, starting from
the term that is rarest in the segment.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricefold.llm.common import place, stored
from pricefold.llm.pieces import forget_kept

WINDOW = 10
_SEGMENT = 1 << 20
_BLOCK_BYTES = 32 << 20
# Bytes of words, with A-Z as a-z; all others part words.
_WORD = bytes(
    value + 32 if 0x41 <= value <= 0x5A else value if value >= 0x80 or chr(value) in "0123456789abcdefghijklmnopqrstuvwxyz"
    else 0x20 for value in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORD).split() if text else []


@dataclass
class Phrases:
    """The distinct windows of a block of benchmark items, as stretches of the numbers of the items' terms.

    All is held in arrays: for each word four bytes, and some twenty for the window that starts there.
    """

    terms: dict[bytes, int]
    numbers: np.ndarray  # the terms of all items, one item after the other
    starts: np.ndarray
    lengths: np.ndarray
    names: list[str]
    items: np.ndarray  # the names of window w are those from item_starts[w] on, up to item_starts[w + 1]
    item_starts: np.ndarray
    anchored: np.ndarray  # the windows whose term in fewest windows is t, from anchor_starts[t] on
    anchor_starts: np.ndarray

    @classmethod
    def of(cls, items: list[tuple[str, bytes | None]], width: int = WINDOW) -> Phrases:
        terms: dict[bytes, int] = {}
        names: dict[str, int] = {}
        numbers, starts, lengths, owners, base = [], [], [], [], 0
        for item, text in items:
            found = [terms.setdefault(word, len(terms)) for word in words_of(text)]
            if not found:
                continue
            numbers.append(np.array(found, np.int32))
            count = max(1, len(found) - width + 1)
            starts.append(np.arange(base, base + count, dtype=np.int32))
            lengths.append(np.full(count, min(width, len(found)), np.int32))
            owners.append(np.full(count, names.setdefault(item, len(names)), np.int32))
            base += len(found)
        numbers, starts, lengths, owners = (
            np.concatenate(parts) if parts else np.zeros(0, np.int32) for parts in (numbers, starts, lengths, owners)
        )
        order, first = cls._alike(numbers, starts, lengths, width)
        windows = np.cumsum(first, dtype=np.int64) - 1
        pairs = np.unique(windows * max(1, len(names)) + owners[order])
        chosen = order[first]
        starts, lengths = starts[chosen], lengths[chosen]
        item_starts = np.searchsorted(pairs, np.arange(len(starts) + 1) * max(1, len(names)))
        anchors = cls._rarest(numbers, starts, lengths, width, len(terms))
        anchored = np.argsort(anchors, kind="stable").astype(np.int32)
        anchor_starts = np.searchsorted(anchors[anchored], np.arange(len(terms) + 1))
        owners = (pairs % max(1, len(names))).astype(np.int32)
        return cls(terms, numbers, starts, lengths, list(names), owners, item_starts, anchored, anchor_starts)

    @staticmethod
    def _alike(numbers: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """An order that puts equal windows side by side, and where in it a window differs from the one before.

        They are ordered by a hash and compared by their terms. Should two hashes ever be equal that are not of equal
        windows, a window may come twice, which changes no result.
        """

        def term(place: int, chosen: np.ndarray) -> np.ndarray:
            return np.where(place < lengths[chosen], numbers[np.minimum(starts[chosen] + place, len(numbers) - 1)], -1)

        every = np.arange(len(starts), dtype=np.int32)
        hashes = np.zeros(len(starts), np.uint64)
        for place in range(width if len(starts) else 0):
            hashes = (hashes ^ (term(place, every) + 1).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            hashes ^= hashes >> np.uint64(29)
        order = np.argsort(hashes, kind="stable").astype(np.int32)
        first = np.ones(len(order), bool)
        for place in range(width if len(starts) else 0):
            found = term(place, order)
            first[1:] = found[1:] != found[:-1] if not place else first[1:] | (found[1:] != found[:-1])
        return order, first

    @staticmethod
    def _rarest(numbers: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int, terms: int) -> np.ndarray:
        """For each window its term that the fewest windows hold."""
        counts = np.zeros(terms, np.int64)
        for place in range(width):
            counts += np.bincount(numbers[starts[lengths > place] + place], minlength=terms)
        best = numbers[starts]
        for place in range(1, width):
            inside = np.flatnonzero(lengths > place)
            other = numbers[starts[inside] + place]
            rarer = counts[other] < counts[best[inside]]
            best[inside[rarer]] = other[rarer]
        return best

    def window(self, place: int) -> np.ndarray:
        start = self.starts[place]
        return self.numbers[start : start + self.lengths[place]]

    def named(self, place: int) -> list[str]:
        return [self.names[item] for item in self.items[self.item_starts[place] : self.item_starts[place + 1]]]


INDEX_SCHEMA = (
    "ids array<bigint>, seen array<bigint>, lengths array<int>, terms array<int>, starts array<int>, positions binary"
)


def build_index(docs: DataFrame, phrases: Phrases) -> DataFrame:
    """Store the postings of the benchmark's terms; ``docs`` has id, seen and text as bytes.

    A row holds a segment of about a million words. Documents follow each other with one position between them, so no
    phrase runs from one into the next. ``positions`` are 32-bit numbers, list after list; list t starts at starts[t].
    """
    terms = docs.sparkSession.sparkContext.broadcast(phrases.terms)

    def segment(ids: list, seen: list, found: list[np.ndarray]) -> pa.RecordBatch:
        numbers = np.concatenate(found)
        known = np.flatnonzero(numbers >= 0)
        order = np.argsort(numbers[known], kind="stable")
        present, starts = np.unique(numbers[known][order], return_index=True)
        row = {
            "ids": pa.array([ids], pa.list_(pa.int64())),
            "seen": pa.array([seen], pa.list_(pa.int64())),
            "lengths": pa.array([[len(part) - 1 for part in found]], pa.list_(pa.int32())),
            "terms": pa.array([present.astype(np.int32)], pa.list_(pa.int32())),
            "starts": pa.array([starts.astype(np.int32)], pa.list_(pa.int32())),
            "positions": pa.array([known[order].astype("<i4").tobytes()], pa.binary()),
        }
        return pa.RecordBatch.from_pydict(row)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        get = terms.value.get
        ids, seen, found, held = [], [], [], 0
        for batch in batches:
            columns = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
            for document, row, text in zip(*columns):
                words = words_of(text.as_py())
                numbers = np.full(len(words) + 1, -1, np.int32)
                numbers[:-1] = np.fromiter(map(get, words, repeat(-1)), np.int32, len(words))
                ids.append(document)
                seen.append(row)
                found.append(numbers)
                held += len(numbers)
                if held >= _SEGMENT:
                    yield segment(ids, seen, found)
                    ids, seen, found, held = [], [], [], 0
        if ids:
            yield segment(ids, seen, found)

    postings = docs.select("id", "seen", "text").mapInArrow(index, INDEX_SCHEMA)
    return stored(postings, "postings")


class Segment:
    """A segment of the index, ready to be searched."""

    def __init__(self, row: dict, terms: int):
        self.positions = np.frombuffer(row["positions"], "<i4")
        self.counts = np.zeros(terms, np.int64)
        self.starts = np.zeros(terms, np.int64)
        self.present, starts = np.array(row["terms"], np.int64), np.array(row["starts"], np.int64)
        self.starts[self.present] = starts
        self.counts[self.present] = np.diff(np.append(starts, len(self.positions)))
        self.lengths = np.array(row["lengths"], np.int64)
        self.firsts = np.cumsum(self.lengths + 1) - self.lengths - 1

    def list(self, term: int) -> np.ndarray:
        return self.positions[self.starts[term] : self.starts[term] + self.counts[term]]

    def possible(self, phrases: Phrases) -> np.ndarray:
        """The windows all of whose terms occur in the segment: looked for from the segment's terms that are their rarest."""
        first = phrases.anchor_starts[self.present]
        count = phrases.anchor_starts[self.present + 1] - first
        places = np.arange(count.sum()) + np.repeat(first - np.cumsum(count) + count, count)
        chosen = phrases.anchored[places]
        for place in range(1, int(phrases.lengths.max(initial=0))):
            starts, long = phrases.starts[chosen], phrases.lengths[chosen] > place
            held = self.counts[phrases.numbers[np.minimum(starts + place, len(phrases.numbers) - 1)]] > 0
            chosen = chosen[held | ~long]
        return chosen[self.counts[phrases.numbers[phrases.starts[chosen]]] > 0]

    def phrase(self, window: np.ndarray) -> np.ndarray:
        """Where the terms of a window stand one after the other."""
        offsets = np.argsort(self.counts[window], kind="stable")
        starts = self.list(window[offsets[0]]) - offsets[0]
        for offset in offsets[1:]:
            other = self.list(window[offset])
            places = np.searchsorted(other, starts + offset)
            places[places == len(other)] = 0
            starts = starts[other[places] == starts + offset]
            if not len(starts):
                break
        return starts

    def near(self, window: np.ndarray, slop: int) -> np.ndarray:
        """First positions of stretches of ``len(window) + slop`` words in one document that have all the terms."""
        span = len(window) + slop
        # 64 bits, so that positions and the largest number fit together.
        lists = [self.list(term).astype(np.int64) for term in sorted(set(window.tolist()), key=lambda term: self.counts[term])]
        near = np.unique(np.concatenate(lists))
        rarest = lists[0]
        reach = np.searchsorted(rarest, near)
        ahead = np.where(reach < len(rarest), rarest[np.minimum(reach, len(rarest) - 1)], np.iinfo(np.int64).max)
        starts = near[ahead < near + span]
        ends = self.firsts + self.lengths
        bound = np.minimum(starts + span, ends[self.document(starts)])
        for other in lists[1:]:
            places = np.searchsorted(other, starts)
            found = np.where(places < len(other), other[np.minimum(places, len(other) - 1)], np.iinfo(np.int64).max)
            starts, bound = starts[found < bound], bound[found < bound]
        inside = rarest[np.minimum(np.searchsorted(rarest, starts), len(rarest) - 1)] < bound
        return starts[inside]

    def document(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.firsts, positions, "right") - 1


def search(index: DataFrame, phrases: Phrases, slop: int | None = None) -> DataFrame:
    """Match the windows in all segments: id, seen, n_words, hits, items of every document.

    ``hits`` are stretches of word positions, in order and apart from each other, that matches cover; ``items`` the
    items that have a match. Without ``slop`` a match is the exact phrase; with it, a stretch of that many words more
    than the window that has all its terms in any order.
    """
    # Plain values, since a broadcast does not carry the code of a class along.
    terms, rest = len(phrases.terms), [getattr(phrases, field.name) for field in fields(phrases)][1:]
    shared = index.sparkSession.sparkContext.broadcast(rest)

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Phrases({}, *shared.value)
        for batch in batches:
            for row in batch.to_pylist():
                segment = Segment(row, max(1, terms))
                cover = np.zeros(int((segment.lengths + 1).sum()) + 1, np.int64)
                items: dict[int, set[str]] = {}
                for place in segment.possible(known):
                    length = int(known.lengths[place])
                    window = known.window(place)
                    starts = segment.phrase(window) if slop is None else segment.near(window, slop)
                    if not len(starts):
                        continue
                    documents = segment.document(starts)
                    reach = starts + length + (slop or 0)
                    if slop:
                        reach = np.minimum(reach, (segment.firsts + segment.lengths)[documents])
                    np.add.at(cover, starts, 1)
                    np.add.at(cover, reach, -1)
                    for document in np.unique(documents).tolist():
                        items.setdefault(document, set()).update(known.named(place))
                yield described(row, segment, cover, items)

    def described(row: dict, segment: Segment, cover: np.ndarray, items: dict[int, set[str]]) -> pa.RecordBatch:
        hit = np.cumsum(cover) > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]])))
        hits: dict[int, list] = {}
        owners = segment.document(edges[::2])
        for document, start, end in zip(owners.tolist(), edges[::2].tolist(), edges[1::2].tolist()):
            first = int(segment.firsts[document])
            hits.setdefault(document, []).append({"start": start - first, "end": end - first})
        count = len(row["ids"])
        stretch = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.RecordBatch.from_pydict({
            "id": pa.array(row["ids"], pa.int64()),
            "seen": pa.array(row["seen"], pa.int64()),
            "n_words": pa.array(segment.lengths, pa.int64()),
            "hits": pa.array([hits.get(place, []) for place in range(count)], stretch),
            "items": pa.array([sorted(items.get(place, ())) for place in range(count)], pa.list_(pa.string())),
        })

    return index.mapInArrow(
        matched, "id long, seen long, n_words long, hits array<struct<start:long,end:long>>, items array<string>"
    )


def matches(
    docs: DataFrame, benchmark: DataFrame, slop: int | None = None, block_bytes: int = _BLOCK_BYTES,
    id_column: str = "doc_id", seen_column: str | None = None,
) -> DataFrame:
    """``search`` over an index of all of ``docs`` for the windows of all benchmark items.

    The benchmark is collected and broadcast in blocks of about ``block_bytes`` of text; one block is the rule. With
    several, the numbered documents are written once, each block is searched in an index of its own terms, and the hits
    of a document are put together. ``seen_column`` says where ``docs`` has the numbers already, if it does.
    """
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    seen = place(seen_column).alias("seen")
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), seen, F.col("text").cast("binary").alias("text"))
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")), F.col("text").cast("binary"))
    if blocks == 1:
        phrases = Phrases.of([tuple(row) for row in items.collect()])
        return search(build_index(rows, phrases), phrases, slop)
    rows = stored(rows, "numbered-documents")
    dealt = items.withColumn("_block", F.pmod(F.xxhash64(*items.columns), F.lit(blocks)))
    parts = []
    for block in range(blocks):
        chosen = dealt.where(F.col("_block") == block).drop("_block").collect()
        phrases = Phrases.of([tuple(row) for row in chosen])
        parts.append(search(build_index(rows, phrases), phrases, slop))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.groupBy("seen").agg(
        F.first("id").alias("id"), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("hits")).alias("hits"), F.flatten(F.collect_list("items")).alias("items"),
    )


def contaminated(
    docs: DataFrame, benchmark: DataFrame, block_bytes: int = _BLOCK_BYTES, id_column: str = "doc_id",
    seen_column: str | None = None,
) -> DataFrame:
    """One row for each row of ``docs``: seen, doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Words are runs of letters, digits and signs beyond ASCII, with A-Z as a-z. A window is ten consecutive words of an
    item, or all words of a shorter one. Words inside any occurrence of a window are hit. ``items_sha256`` covers the ids
    of the items with occurring windows, sorted as strings and joined by commas. A null or empty text has no words;
    items without words match nothing; items of one id count once; an item without id is called ``null``.
    """
    found = matches(docs, benchmark, None, block_bytes, id_column, seen_column)
    step = F.aggregate(
        F.array_sort("hits"),
        F.struct(F.lit(0).cast("bigint").alias("words"), F.lit(0).cast("bigint").alias("end")),
        lambda done, hit: F.struct(
            (done["words"] + F.greatest(hit["end"] - F.greatest(hit["start"], done["end"]), F.lit(0))).alias("words"),
            F.greatest(done["end"], hit["end"]).alias("end"),
        ),
    )
    items = F.array_sort(F.array_distinct("items"))
    told = found.withColumns({"n_hit": step["words"], "_items": items})
    return told.select(
        "seen", F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
