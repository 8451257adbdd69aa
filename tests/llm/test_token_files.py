from __future__ import annotations

import io
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from pricefold.llm.token_files import PlaneReader, PlaneWriter, planes, read_token_files, token_files, write_token_files


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("count", [1, 7, 8, 1000])
def test_planes_come_back(bits, count):
    from pricefold.llm.token_files import unplaned

    ids = np.random.default_rng(count).integers(0, 1 << 32, count, dtype=np.uint32)
    assert (unplaned(planes(ids, bits), count) == ids).all()


@pytest.mark.parametrize("bits", [False, True])
def test_any_stretch_of_a_file_comes_back(bits):
    chance = np.random.default_rng(3)
    documents = [chance.integers(0, 50_257, size, dtype=np.uint32) for size in (0, 5, 64, 1, 200, 0, 31)]
    stream = io.BytesIO()
    writer = PlaneWriter(stream, bits, block=32)
    for number, ids in enumerate(documents):
        writer.add(number, ids)
    writer.close()
    reader, whole = PlaneReader(stream), np.concatenate(documents)
    for start, count in [(0, 0), (0, 301), (31, 2), (63, 100), (300, 1), (64, 32)]:
        assert (reader.ids(start, count) == whole[start : start + count]).all()
    sums = [0] * len(documents)
    for place, ids in reader.pieces():
        sums[place] = zlib.crc32(ids.tobytes(), sums[place])
    assert sums == [zlib.crc32(ids.tobytes()) for ids in documents]


def expected(docs, tokenizer):
    library, start, rows = Tokenizer.from_file(tokenizer), 0, []
    for doc, text in docs:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return rows


def test_documents_of_all_kinds(spark, odd_documents, no_documents, tokenizer):
    rows = [tuple(row) for row in token_files(odd_documents, tokenizer).orderBy("start").collect()]
    ids = [row[0] for row in rows]
    assert ids == [None, None, *sorted(row.doc_id for row in odd_documents.collect() if row.doc_id is not None)]
    # Rows of one id may come in any order, so lengths and sums are compared as sets.
    wanted = expected([(row.doc_id, row.text) for row in odd_documents.collect()], tokenizer)
    assert sorted((doc, n, crc) for doc, _, n, crc in rows if doc) == sorted((doc, n, crc) for doc, _, n, crc in wanted if doc)
    assert [row[1] for row in rows] == np.cumsum([0, *[row[2] for row in rows[:-1]]]).tolist()
    assert token_files(no_documents, tokenizer).collect() == []


def test_files_can_be_read_again(spark, sf_dir, tokenizer, tmp_path):
    from pricefold.llm.queries import table

    docs = table(spark, sf_dir, "documents")
    manifest = write_token_files(docs, tokenizer, 2, str(tmp_path / "ids"), bits=True)
    first, second = (sorted(map(tuple, read_token_files(manifest).collect())) for _ in range(2))
    assert first == second and len(first) == docs.count()


def test_query_equals_the_library(spark, sf_dir, tokenizer):
    from pricefold.llm.queries import op5_token_files, table

    docs = sorted((row.doc_id, row.text) for row in table(spark, sf_dir, "documents").collect())
    rows = sorted(tuple(row) for row in op5_token_files(spark, sf_dir).collect())
    assert rows == expected(docs, tokenizer)
