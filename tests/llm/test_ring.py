from __future__ import annotations

import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from pricefold.llm import ring


def checked(rows, shards):
    slots = defaultdict(list)
    for row in rows:
        slots[row.shard].append(row.slot)
    counts = [len(slots[shard]) for shard in range(shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(found) == list(range(len(found))) for found in slots.values())


def test_counts_are_level_though_an_id_has_a_third_of_the_rows(spark):
    docs = spark.range(9_000).selectExpr("if(id < 3000, 7L, id) as doc_id", "cast(id as string) as text").repartition(6)
    rows = ring.sharded(docs, shards=7, nodes=16).collect()
    assert Counter(row.doc_id for row in rows)[7] == 3001 - 1
    checked(rows, 7)


def brute_walk(spark, docs, shards, nodes):
    """Each row by itself, one after the other: steps around the ring until a shard has room."""
    points = sorted(
        (row.point, row.shard, row.node) for row in spark.range(shards * nodes).select(
            F.floor(F.col("id") / nodes).cast("int").alias("shard"), (F.col("id") % nodes).alias("node")
        ).withColumn("point", ring._place(F.lit("node"), "shard", "node")).collect()
    )
    hashed = docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), ring._place(F.col("doc_id").cast("bigint")).alias("place"),
        F.xxhash64(F.coalesce("text", F.lit("")).cast("binary")).alias("content"),
    ).collect()
    rows = []
    for row in hashed:
        arc = next((k for k, (point, _, _) in enumerate(points) if row.place < point), 0)
        order = (row.content % ring._PARTS, row.place, (row.doc_id is not None, row.doc_id or 0), row.content)
        rows.append((arc, order, row.doc_id, row.text))
    rows.sort(key=lambda row: row[:2])
    room = [len(rows) // shards + (shard < len(rows) % shards) for shard in range(shards)]
    found, step = [], 0
    while rows:
        still = []
        for row in rows:
            shard = points[(row[0] + step) % len(points)][1]
            if room[shard]:
                room[shard] -= 1
                found.append((row[2], zlib.crc32(row[3].encode()), shard, step))
            else:
                still.append(row)
        rows, step = still, step + 1
    return found


def as_counter(rows):
    return Counter((row.doc_id, row.text_crc32, row.shard) for row in rows)


def test_every_row_is_where_its_walk_ends(spark, sf_dir, odd_documents):
    many = spark.range(900).selectExpr("if(id < 300, 7L, id div 2) as doc_id", "cast(id % 150 as string) as text")
    for docs, shards, nodes in ((many, 3, 2), (many, 7, 16), (odd_documents.select("doc_id", "text"), 5, 4)):
        expected = brute_walk(spark, docs, shards, nodes)
        assert as_counter(ring.sharded(docs, shards, nodes).collect()) == Counter(row[:3] for row in expected)


def test_the_split_of_the_input_does_not_matter(spark):
    docs = spark.range(1_000).selectExpr("if(id < 300, 7L, id) as doc_id", "cast(id % 400 as string) as text")
    answers = [
        Counter(map(tuple, ring.sharded(docs.repartition(n), 40).drop("grown_shard").collect())) for n in (1, 6, 12)
    ]
    assert answers[0] == answers[1] == answers[2]


def test_one_more_shard_moves_rows_to_itself_and_rows_that_walk(spark):
    docs = spark.range(4_000).selectExpr("id as doc_id", "'' as text")
    before, after = ({row.doc_id: row.shard for row in ring.sharded(docs, n).collect()} for n in (40, 41))
    walks = set()
    for n in (40, 41):
        walks |= {row[0] for row in brute_walk(spark, docs, n, 256) if row[3]}
    moved = {doc for doc in before if after[doc] not in (before[doc], 40)}
    assert moved <= walks and len(moved) < 0.2 * len(before)
    assert abs(sum(shard == 40 for shard in after.values()) - 4_000 / 41) <= 1


def test_equal_rows_are_written_out_in_chunks(spark, monkeypatch):
    docs = spark.range(500).selectExpr("if(id < 300, 7L, id) as doc_id", "'same' as text").repartition(3)
    plain = Counter(map(tuple, ring.sharded(docs, 6).drop("grown_shard").collect()))
    monkeypatch.setattr(ring, "_CHUNK", 9)
    rows = ring.sharded(docs, 6).collect()
    checked(rows, 6)
    assert Counter(tuple(row)[:-1] for row in rows) == plain


def test_documents_of_all_kinds(spark, odd_documents, no_documents):
    rows = ring.sharded(odd_documents, shards=5).collect()
    texts = [(row.doc_id, (row.text or "").encode()) for row in odd_documents.collect()]
    assert sorted(((row.doc_id, row.size, row.text_crc32) for row in rows), key=repr) == sorted(
        ((doc, len(text) + 16, zlib.crc32(text)) for doc, text in texts), key=repr
    )
    checked(rows, 5)
    assert {(row.law, row.grown_shard) for row in rows} == {("rows", None)}
    assert ring.sharded(no_documents).collect() == []


def test_the_plan_has_no_python(spark, odd_documents):
    plan = ring.sharded(odd_documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query_is_level(spark, sf_dir):
    from pricefold.llm.queries import op4_ring, table

    rows = op4_ring(spark, sf_dir).collect()
    assert len(rows) == table(spark, sf_dir, "documents").count()
    checked(rows, 40)
    again = op4_ring(spark, sf_dir).select(F.sum(F.xxhash64("doc_id", "shard", "slot").cast("decimal(38,0)"))).first()
    assert again == op4_ring(spark, sf_dir).select(F.sum(F.xxhash64("doc_id", "shard", "slot").cast("decimal(38,0)"))).first()
