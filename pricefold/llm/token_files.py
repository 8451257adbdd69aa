"""Operator 5: token ids in files of bit-plane shuffled, zstandard-compressed blocks with a chunk index.

A file is a run of blocks, then a footer, then the footer's length as 8 bytes and the magic. A block holds ``BLOCK`` ids
(the last one fewer) as planes: plane k has byte k of every id, or bit k of every id, so that the high planes are almost
constant and compress to nothing. The footer is JSON, compressed: the chunk index (for each block its offset, its ids
and the length of each plane) and the documents (id, number of ids) in file order.
"""

from __future__ import annotations

import io
import json
import zlib
from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pricefold.llm.common import one_row_a_task, opened, shared_folder, written_whole
from pricefold.llm.pieces import Remembered, kept_by_worker, plain_pieces, shown_bytes

BLOCK = 65_536
# Pieces that a worker remembers, and as many of before; about 200 bytes each.
REMEMBERED = 800_000
_MAGIC = b"PLNS0001"


def planes(ids: np.ndarray, bits: bool = False) -> list[bytes]:
    """The byte planes of little-endian 32-bit ids, or their bit planes; a block's last byte is filled with zeros."""
    octets = ids.astype("<u4").view(np.uint8).reshape(-1, 4).T
    if not bits:
        return [plane.tobytes() for plane in octets]
    return [
        np.packbits(plane >> bit & 1, bitorder="little").tobytes() for plane in octets for bit in range(8)
    ]


def unplaned(parts: list[bytes], count: int) -> np.ndarray:
    """The ids of a block from its 4 byte planes or 32 bit planes."""
    if len(parts) == 4:
        octets = np.array([np.frombuffer(part, np.uint8) for part in parts])
    else:
        bits = np.array([
            np.unpackbits(np.frombuffer(part, np.uint8), count=count, bitorder="little") for part in parts
        ])
        octets = np.packbits(bits.reshape(4, 8, count), axis=1, bitorder="little")[:, 0, :]
    return np.ascontiguousarray(octets.T).view("<u4")[:, 0]


class PlaneWriter:
    """Writes documents of ids to a stream, holding one block of ids at a time."""

    def __init__(self, stream, bits: bool = False, block: int = BLOCK):
        self.stream, self.bits, self.block = stream, bits, block
        self.compress = zstandard.ZstdCompressor(level=3).compress
        self.waiting: list[np.ndarray] = []
        self.held = self.offset = self.total = 0
        self.chunks: list[tuple[int, int, list[int]]] = []
        self.documents: list[tuple[int | None, int]] = []

    def add(self, document: int | None, ids: np.ndarray) -> None:
        self.documents.append((document, len(ids)))
        self.waiting.append(ids)
        self.held += len(ids)
        self.total += len(ids)
        if self.held >= self.block:
            self._flush(self.held - self.held % self.block)

    def _flush(self, count: int) -> None:
        held = np.concatenate(self.waiting)
        for start in range(0, count, self.block):
            ids = held[start : min(start + self.block, count)]
            parts = [self.compress(plane) for plane in planes(ids, self.bits)]
            self.chunks.append((self.offset, len(ids), [len(part) for part in parts]))
            self.stream.write(b"".join(parts))
            self.offset += sum(map(len, parts))
        self.waiting, self.held = [held[count:]], len(held) - count

    def close(self) -> None:
        if self.held:
            self._flush(self.held)
        footer = zlib.compress(json.dumps({"chunks": self.chunks, "documents": self.documents}).encode())
        self.stream.write(footer + len(footer).to_bytes(8, "little") + _MAGIC)


class PlaneReader:
    """Reads a file of planes: whole documents in order, or any stretch of ids through the chunk index."""

    def __init__(self, file):
        self.file = file
        end = file.seek(0, io.SEEK_END) or file.tell()
        file.seek(end - 16)
        length, magic = int.from_bytes(file.read(8), "little"), file.read(8)
        if magic != _MAGIC:
            raise ValueError("not a file of token planes")
        file.seek(end - 16 - length)
        footer = json.loads(zlib.decompress(file.read(length)))
        self.chunks, self.documents = footer["chunks"], footer["documents"]
        self.firsts = np.cumsum([0] + [count for _, count, _ in self.chunks])

    def chunk(self, place: int) -> np.ndarray:
        offset, count, lengths = self.chunks[place]
        self.file.seek(offset)
        data = self.file.read(sum(lengths))
        bounds = np.cumsum([0, *lengths])
        parts = [
            zstandard.ZstdDecompressor().decompress(data[start:end]) for start, end in zip(bounds, bounds[1:])
        ]
        return unplaned(parts, count)

    def ids(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from position ``start`` of the file; only the chunks that hold them are read."""
        first = int(np.searchsorted(self.firsts, start, "right")) - 1
        last = int(np.searchsorted(self.firsts, start + count, "left"))
        if count <= 0:
            return np.zeros(0, "<u4")
        held = np.concatenate([self.chunk(place) for place in range(first, last)])
        return held[start - self.firsts[first] :][:count]

    def pieces(self) -> Iterator[tuple[int, np.ndarray]]:
        """The documents in order as (place of the document, ids); one that spans blocks comes in several pieces."""
        place, left = 0, self.documents[0][1] if self.documents else 0
        for number in range(len(self.chunks)):
            ids = self.chunk(number)
            while len(ids):
                while not left:
                    place += 1
                    left = self.documents[place][1]
                yield place, ids[:left]
                taken = min(left, len(ids))
                ids, left = ids[taken:], left - taken


class Encoder:
    """Texts to ids with the tokenizers library, without special tokens added."""

    def __init__(self, tokenizer: str, remembered: int = REMEMBERED):
        self.tokenizer = Tokenizer.from_file(tokenizer)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.pieces = Remembered(self._encode_piece, remembered)
        self.model = self.tokenizer.model
        # How bytes are written in the vocabulary, for texts read as one sign a byte.
        self.shown = {value: sign for sign, value in shown_bytes().items()}
        described = json.loads(self.tokenizer.to_str())
        pattern = described["pre_tokenizer"] or {}
        # Other tokenizers take the library's way for every text.
        self.known = pattern.get("type") == "ByteLevel" and pattern.get("use_regex") is True
        self.known = self.known and not pattern.get("add_prefix_space") and described["normalizer"] is None

    def _encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _encode_piece(self, piece: str) -> bytes:
        """The library's model for one piece, which its split pattern leaves whole and which holds no special string."""
        if piece.isascii() and "\n" not in piece:
            written = piece.replace(" ", self.shown[32])
        else:
            written = piece.encode().decode("latin-1").translate(self.shown)
        ids = [token.id for token in self.model.tokenize(written)]
        return pack(f"<{len(ids)}I", *ids)

    def __call__(self, text: str) -> np.ndarray:
        pieces = plain_pieces(text) if self.known and "<|" not in text else None
        return np.frombuffer(self._encode(text) if pieces is None else self.pieces.joined(pieces), "<u4")


def write_token_files(
    docs: DataFrame, tokenizer: str, end_id: int, folder: str, bits: bool = False, id_column: str = "doc_id",
    remembered: int = REMEMBERED,
) -> DataFrame:
    """Encode every text, append ``end_id`` to each and write the ids in ascending id order.

    Returns the manifest, read back from the folder: file, part (ascending with the ids), n_documents, n_ids. A null
    text counts as empty and gives just ``end_id``. Null ids come first; rows of one id are ordered by a hash of their
    text, which also lets a range boundary fall between them.

    ``remembered`` bounds the memory of a worker, at about 400 bytes each, and bears on its speed alone.

    One shuffle, by range of the id. A file is one range; a task that runs again replaces its file by the same one.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        path = f"{folder}/ids-{part:08d}.planes"
        first = next(batches, None)
        if first is None:
            return
        encode = kept_by_worker(f"encoder-{remembered}", tokenizer, lambda path: Encoder(path, remembered))
        end = np.array([end_id], "<u4")
        with written_whole(path) as stream:
            writer = PlaneWriter(stream, bits)
            batch = first
            while batch is not None:
                for start in range(0, batch.num_rows, 32):
                    rows = batch.slice(start, 32)
                    for document, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                        writer.add(document, np.concatenate([encode(text or ""), end]))
                batch = next(batches, None)
            writer.close()
        yield pa.RecordBatch.from_pydict({
            "file": [path], "part": pa.array([part], pa.int64()),
            "n_documents": pa.array([len(writer.documents)], pa.int64()), "n_ids": pa.array([writer.total], pa.int64()),
        })

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(id_column).cast("bigint").alias("_id"), text.alias("_text"))
    order = [F.asc_nulls_first("_id"), F.xxhash64("_text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    manifest = ordered.mapInArrow(write, "file string, part long, n_documents long, n_ids long")
    manifest.write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.schema(manifest.schema).parquet(f"{folder}/manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """One row per stored document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    ``ids_crc32`` is the CRC-32 of the ids as little-endian unsigned 32-bit integers. One task reads one file, one block
    at a time. The window over all files sees one row per file.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, place = opened(row["file"])
                with system.open_input_file(place) as file:
                    reader = PlaneReader(file)
                    sums = [0] * len(reader.documents)
                    for document, ids in reader.pieces():
                        sums[document] = zlib.crc32(ids.tobytes(), sums[document])
                counts = np.array([count for _, count in reader.documents], np.int64)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array([document for document, _ in reader.documents], pa.int64()),
                    "start": pa.array(row["before"] + np.cumsum(counts) - counts, pa.int64()),
                    "n_tokens": pa.array(counts, pa.int64()),
                    "ids_crc32": pa.array(sums, pa.int64()),
                })

    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("before", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))
    files = one_row_a_task(placed.select("file", "before"))
    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(
    docs: DataFrame, tokenizer: str, end_id: int = 2, bits: bool = False, remembered: int = REMEMBERED
) -> DataFrame:
    """Write the ids of all documents to a new shared folder and describe them as read back from there."""
    folder = shared_folder(docs.sparkSession, "token-files", lasting=True)
    manifest = write_token_files(docs, tokenizer, end_id, folder, bits, remembered=remembered)
    return read_token_files(manifest)
