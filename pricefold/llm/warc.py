"""Operator 2: WARC archives, and the normaliser that makes a monolithic gzip archive seekable.

``write_whole`` writes archives as one gzip stream each, which can only be read from the start. ``normalised`` inflates
such a stream once, rewrites every record as its own gzip member and writes a sidecar index of their offsets beside it.
``read_records`` uses the index to read each record by itself.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricefold.llm.common import one_row_a_task, opened, shared_folder, written_whole

# Fixed values of the format.
_GZIP = 31
_END = b"\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URN = "urn:page:"

_READ = 1 << 20


def _head(lines: dict[str, str | int | None]) -> bytes:
    return "".join(f"{name}: {value}\r\n" for name, value in lines.items() if value is not None).encode()


def record(
    page: int | None, url: str | None, payload: bytes | None, digest: str, length: int, refers_to: int | None, date: str
) -> bytes:
    """A response record, or without ``payload`` a revisit record, whose HTTP head still tells the payload's length."""
    http = b"HTTP/1.1 200 OK\r\n" + _head({"Content-Type": "text/html; charset=utf-8", "Content-Length": length}) + b"\r\n"
    block = http if payload is None else http + payload
    # A line break in a URL must not start a new header.
    target = None if url is None else quote(url, safe="%/:=&?~#+!$,;'@()*[]")
    head = _head({
        "WARC-Type": "response" if payload is not None else "revisit",
        "WARC-Record-ID": f"<{_URN}{'null' if page is None else page}>",
        "WARC-Date": date,
        "WARC-Target-URI": target,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Profile": _PROFILE if payload is None else None,
        "WARC-Refers-To": f"<{_URN}{refers_to}>" if payload is None else None,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    })
    return b"WARC/1.1\r\n" + head + b"\r\n" + block + _END


def _headers(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])


def _page(uri: str) -> int | None:
    number = uri[1:-1].removeprefix(_URN)
    return None if number == "null" else int(number)


def inflated(stream) -> Iterator[bytes]:
    """The content of a gzip stream of one or many members, in pieces, each inflated once."""
    inflate = zlib.decompressobj(_GZIP)
    while data := stream.read(_READ):
        while data:
            yield inflate.decompress(data)
            data = inflate.unused_data
            if inflate.eof:
                inflate = zlib.decompressobj(_GZIP)


def records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """The records of inflated content; what is held is one record and one piece."""
    held, start = bytearray(), 0
    wanted = 0
    for piece in pieces:
        held += piece
        while len(held) - start >= max(wanted, 1):
            end = held.find(_END, start)
            if end < 0:
                wanted = len(held) - start + 1
                break
            wanted = end + 4 - start + int(_headers(bytes(held[start:end]))["Content-Length"]) + 4
            if len(held) - start < wanted:
                break
            yield bytes(held[start : start + wanted])
            start, wanted = start + wanted, 0
        del held[:start]
        start = 0
    if held:
        raise ValueError("an archive ends within a record")


def first_seen(pages: DataFrame) -> DataFrame:
    """The pages whose payload a page with a larger id has too: page_id, digest, refers_to, without repeats.

    Aggregated before anything is shuffled by digest, so a payload that a third of all pages share sends one row a task.
    """
    slim = pages.select("page_id", "digest")
    shared = slim.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("pages"))
    shared = shared.where((F.col("pages") > 1) & F.col("refers_to").isNotNull()).drop("pages")
    older = F.col("page_id").isNull() | (F.col("page_id") < F.col("refers_to"))
    return slim.join(shared, "digest").where(older).distinct()


def write_whole(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", level: int = 6) -> DataFrame:
    """Write a WARC record per page to archives of one gzip stream each; returns their manifest, read back.

    Of pages with equal payloads that with the largest id is a response and the others revisit it. Pages that share that
    largest id and the payload are all responses, as are pages of equal payloads that have no id at all. A null html
    counts as empty; an empty payload is a payload like others. The payload is shuffled once, by page.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = next(batches, None)
        if batch is None:
            return
        path = f"{folder}/whole-{TaskContext.get().partitionId():08d}.warc.gz"
        compress, count = zlib.compressobj(level, zlib.DEFLATED, _GZIP), 0
        with written_whole(path) as stream:
            while batch is not None:
                digests, targets = batch.column("digest").to_pylist(), batch.column("refers_to").to_pylist()
                ids, urls = batch.column("page_id").to_pylist(), batch.column("url").to_pylist()
                for page, url, digest, target, html in zip(ids, urls, digests, targets, batch.column("payload")):
                    payload = html.as_py()
                    shown = base64.b32encode(bytes.fromhex(digest)).decode()
                    kept = payload if target is None else None
                    stream.write(compress.compress(record(page, url, kept, shown, len(payload), target, date)))
                count += batch.num_rows
                batch = next(batches, None)
            stream.write(compress.flush())
        yield pa.RecordBatch.from_pydict({"file": [path], "records": pa.array([count], pa.int64())})

    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    revisits = first_seen(rows).select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), "refers_to")
    same = rows["page_id"].eqNullSafe(revisits["_page"]) & (rows["digest"] == revisits["_digest"])
    told = rows.join(revisits, same, "left").drop("_page", "_digest")
    manifest = told.mapInArrow(write, "file string, records long")
    manifest.write.parquet(f"{folder}/whole")
    return pages.sparkSession.read.schema(manifest.schema).parquet(f"{folder}/whole")


def normalise(source: str, target: str, index: str, level: int = 6) -> int:
    """Rewrite one archive with a gzip member per record, and its index; returns the number of records.

    Index lines: offset, length, type and id of a record, separated by tabs.
    """
    system, place = opened(source)
    offset, lines = 0, []
    with system.open_input_stream(place, compression=None) as stream, written_whole(target) as out:
        for found in records(inflated(stream)):
            compress = zlib.compressobj(level, zlib.DEFLATED, _GZIP)
            member = compress.compress(found) + compress.flush()
            out.write(member)
            head = _headers(found[: found.index(_END)])
            lines.append(f"{offset}\t{len(member)}\t{head['WARC-Type']}\t{head['WARC-Record-ID']}\n")
            offset += len(member)
    with written_whole(index) as out:
        out.write("".join(lines).encode())
    return len(lines)


def normalised(manifest: DataFrame, folder: str) -> DataFrame:
    """Normalise the archives of a manifest, one a task; returns the new manifest: file, index, records."""

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source in batch.column("file").to_pylist():
                name = source.rpartition("/")[2].replace("whole-", "members-")
                target, index = f"{folder}/{name}", f"{folder}/{name}.idx"
                count = normalise(source, target, index)
                yield pa.RecordBatch.from_pydict(
                    {"file": [target], "index": [index], "records": pa.array([count], pa.int64())}
                )

    made = one_row_a_task(manifest.select("file")).mapInArrow(rewrite, "file string, index string, records long")
    made.write.parquet(f"{folder}/members")
    return manifest.sparkSession.read.schema(made.schema).parquet(f"{folder}/members")


def described(found: bytes) -> tuple[int | None, int, str, str, int | None]:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of a record; checks a payload that is there."""
    end = found.index(_END)
    head = _headers(found[:end])
    block = found[end + 4 : -4]
    http = block.index(_END)
    length = int(_headers(block[:http])["Content-Length"])
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    target = head.get("WARC-Refers-To")
    if target is None:
        payload = block[http + 4 :]
        if len(payload) != length or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"the payload of {head['WARC-Record-ID']} is not what its headers tell")
    return (
        _page(head["WARC-Record-ID"]), length, digest, head["WARC-Type"], None if target is None else _page(target)
    )


def read_records(manifest: DataFrame) -> DataFrame:
    """One row per record, read at the offset that the sidecar index names."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, index in zip(batch.column("file").to_pylist(), batch.column("index").to_pylist()):
                system, place = opened(index)
                with system.open_input_stream(place) as lines:
                    entries = lines.read().decode().splitlines()
                system, place = opened(path)
                rows = []
                with system.open_input_file(place) as file:
                    for entry in entries:
                        offset, length, *_ = entry.split("\t")
                        file.seek(int(offset))
                        rows.append(described(zlib.decompress(file.read(int(length)), _GZIP)))
                columns = list(zip(*rows)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, kind) for values, kind in zip(columns, kinds)], names=names
                )

    files = one_row_a_task(manifest.select("file", "index"))
    return files.mapInArrow(
        read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )


def archived(pages: DataFrame) -> DataFrame:
    """Archive all pages in a new shared folder, normalise the archives and describe each record as read back."""
    folder = shared_folder(pages.sparkSession, "warc", lasting=True)
    return read_records(normalised(write_whole(pages, folder), folder))
