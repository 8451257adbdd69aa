from __future__ import annotations

import base64
import gzip
import hashlib
import zlib

from pricefold.llm import warc


def shown(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_pages_come_back(spark):
    rows = [
        (1, "u\r\nX: y", "a"), (2, None, "a"), (2, "v", "a"), (None, "w", "a"), (3, "", "b"), (4, "x", None), (5, "y", ""),
        (None, "q", "zz"), (None, "q", "zz"), (6, "é ü", "\r\n\r\nWARC/1.1\r\n"), (7, "long", "<p>é</p>" * 200_000),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    clash = pages.selectExpr("*", "1 as digest", "2 as refers_to", "3 as payload")
    found = sorted((tuple(row) for row in warc.archived(clash).collect()), key=repr)
    refers = {0: 2, 3: 2, 5: 5}
    wanted = []
    for place, (page, _, html) in enumerate(rows):
        payload = (html or "").encode()
        target = {0: 2, 3: 2}.get(place) if html == "a" else (5 if place == 5 else None)
        wanted.append((page, len(payload), shown(payload), "revisit" if target else "response", target))
    assert refers and found == sorted(wanted, key=repr)
    assert warc.archived(pages.limit(0)).collect() == []


def test_a_monolithic_archive_becomes_seekable(tmp_path):
    made = [warc.record(page, None, b"payload %d" % page, "D", 9 + page // 10, None, "d") for page in range(40)]
    whole, target, index = (str(tmp_path / name) for name in ("whole.gz", "members.gz", "index"))
    # A gzip file of two members is read like one.
    (tmp_path / "whole.gz").write_bytes(gzip.compress(b"".join(made[:25])) + gzip.compress(b"".join(made[25:])))
    assert warc.normalise(whole, target, index) == 40
    data = (tmp_path / "members.gz").read_bytes()
    entries = [line.split("\t") for line in (tmp_path / "index").read_text().splitlines()]
    assert [zlib.decompress(data[int(at) : int(at) + int(size)], 31) for at, size, *_ in entries] == made
    assert gzip.decompress(data) == b"".join(made)


def test_query_equals_brute_force(spark, sf_dir):
    from pricefold.llm.queries import op2_warc, table

    pages = table(spark, sf_dir, "pages").union(table(spark, sf_dir, "pages").selectExpr("page_id + 1000", "url", "html"))
    latest = {}
    for row in pages.collect():
        latest[row.html] = max(latest.get(row.html, -1), row.page_id)
    for row in warc.archived(pages).collect():
        html = next(html for html, page in latest.items() if page in (row.page_id, row.refers_to))
        own = latest[html] == row.page_id
        assert row.payload_digest == shown(html.encode()) and row.payload_bytes == len(html.encode())
        assert (row.record_type, row.refers_to) == (("response", None) if own else ("revisit", latest[html]))
    assert op2_warc(spark, sf_dir).count() == table(spark, sf_dir, "pages").count()
