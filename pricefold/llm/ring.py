"""Operator 4: shards by a consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations only.

Each shard has ``nodes`` points on a circle, at hashes of the shard and the point's number, so that a further shard adds
points and moves none. A row's hash falls into the arc before a point and belongs to the point's shard. No shard may hold
more than its share, n // shards rows or one more. What finds its shard full walks on clockwise to the next point whose
shard has room. Rows walk in steps, all at once: of those that come to a shard in the same step the ones of earlier arcs
go first, and in an arc they go in the order of their content.

So a row depends on the rows' contents alone, not on how they are read, and a row that is at its own point before and
after a shard is added stays or goes to the new one. Between old shards move at most the rows that walk, before or after.

The walk needs the rows of each arc as numbers only, and their count is fixed by the parameters: it is planned on the
driver. All that is done with rows is done by DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricefold.llm.common import checkpointed, located

_BITS = 52
# Rows of an arc are ranked in so many parts, by their texts.
_PARTS = 1024
# Equal rows are written out so many at a time where one of them has more.
_CHUNK = 10_000


def _place(*values: Column | str) -> Column:
    """A point on the circle, 0 to 2**52 - 1."""
    return F.shiftrightunsigned(F.xxhash64(*values), 64 - _BITS)


def arcs(spark: SparkSession, shards: int, nodes: int) -> DataFrame:
    """The ring: arc (its order on the circle), shard, and the hashes from ``low`` up to but not with ``high``.

    The arc that contains the zero of the circle comes in two pieces with the same number.
    """
    points = spark.range(shards * nodes, numPartitions=1).select(
        F.floor(F.col("id") / nodes).cast("int").alias("shard"), (F.col("id") % nodes).alias("node")
    )
    points = points.withColumn("point", _place(F.lit("node"), "shard", "node"))
    clockwise = Window.orderBy("point", "shard", "node")
    ordered = points.select(
        (F.row_number().over(clockwise) - 1).alias("arc"),
        "shard",
        F.coalesce(F.lag("point").over(clockwise), F.lit(0)).alias("low"),
        F.col("point").alias("high"),
        F.max("point").over(Window.partitionBy()).alias("last"),
    )
    pieces = F.array(
        F.struct(F.col("low"), F.col("high")),
        F.struct(
            F.when(F.col("arc") == 0, F.col("last")).alias("low"),
            F.when(F.col("arc") == 0, F.lit(1 << _BITS)).cast("bigint").alias("high"),
        ),
    )
    return ordered.select("arc", "shard", F.explode(pieces).alias("piece")).select("arc", "shard", "piece.*").where(
        "low < high"
    )


def walked(rows: list[int], owners: list[int], shards: int) -> list[tuple[int, int, int, int]]:
    """Where the rows of each arc go: (arc, low, high, shard), ranks from ``low`` up to but not with ``high``.

    ``rows`` and ``owners`` give the rows of each arc and the shard of its point, clockwise.
    """
    total, points = sum(rows), len(owners)
    room = [total // shards + (shard < total % shards) for shard in range(shards)]
    waiting = [(arc, 0) for arc in range(points) if rows[arc]]
    found, step = [], 0
    while waiting:
        still = []
        for arc, low in waiting:
            shard = owners[(arc + step) % points]
            high = min(rows[arc], low + room[shard])
            if high > low:
                found.append((arc, low, high, shard))
                room[shard] -= high - low
            if high < rows[arc]:
                still.append((arc, high))
        waiting, step = still, step + 1
    return found


def _segments(spark: SparkSession, ring: DataFrame, counts: DataFrame, shards: int) -> DataFrame:
    """The stretches of the arcs' rows with their shard, and the slot of the first row of each."""
    loads = {row.arc: row.rows for row in counts.groupBy("arc").agg(F.sum("rows").alias("rows")).collect()}
    owners = [row.shard for row in ring.groupBy("arc").agg(F.first("shard").alias("shard")).orderBy("arc").collect()]
    slots = [0] * shards
    lines = []
    for arc, low, high, shard in sorted(walked([loads.get(arc, 0) for arc in range(len(owners))], owners, shards)):
        lines.append(f"{arc},{low},{high},{shard},{slots[shard]}")
        slots[shard] += high - low
    # One literal, whatever the number of arcs.
    line = spark.range(1).select(F.explode(F.split(F.lit(";".join(lines)), ";")).alias("line")).where("line <> ''")
    fields = F.split("line", ",")
    return line.select(
        fields[0].cast("int").alias("arc"), fields[1].cast("bigint").alias("low"), fields[2].cast("bigint").alias("high"),
        fields[3].cast("int").alias("shard"), fields[4].cast("bigint").alias("first_slot"),
    )


def sharded(docs: DataFrame, shards: int = 40, nodes: int = 256, id_column: str = "doc_id") -> DataFrame:
    """One row for each row of ``docs``: id, size, text_crc32, law, shard, slot, grown_shard.

    Law ``rows``: the counts of any two shards differ by at most one. Sizes are the UTF-8 bytes of the text plus 16, 0
    bytes for a null text, whose CRC-32 is that of an empty text. ``slot`` numbers the rows of a shard from 0 without
    gaps. Null and repeated ids are spread over the arc of their hash like others; rows equal in all of these columns
    are alike, and which of them is which does not matter. ``grown_shard`` is always null, since under this law a
    further shard moves rows between the others too.

    Equal rows are counted before the first shuffle and written out after the last one, so an id or a row that a third
    of all rows share is spread. The slim rows are written once to the checkpoint folder; one more shuffle ranks them.
    """
    spark = docs.sparkSession
    ring = arcs(spark, shards, nodes)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), text.alias("_text")).select(
        "doc_id",
        (F.octet_length("_text") + 16).cast("bigint").alias("size"),
        F.crc32("_text").alias("text_crc32"),
        F.xxhash64("_text").alias("content"),
    )
    kinds = rows.groupBy(*rows.columns).agg(F.count("*").alias("copies"))
    # The size of the ring is fixed by the parameters.
    placed = located(kinds.withColumn("place", _place("doc_id")), ring.drop("shard"), "place", _BITS, small=True)
    placed = checkpointed(placed.withColumn("part", F.pmod("content", F.lit(_PARTS)).cast("int")))
    counts = placed.groupBy("arc", "part").agg(F.sum("copies").alias("rows"))
    upto = Window.partitionBy("arc").orderBy("part")
    starts = counts.select("arc", "part", (F.sum("rows").over(upto) - F.col("rows")).alias("start"))
    by_content = Window.partitionBy("arc", "part").orderBy("place", "doc_id", "content", "size", "text_crc32")
    ranked = placed.withColumn("before", F.sum("copies").over(by_content) - F.col("copies"))
    ranked = ranked.join(starts, ["arc", "part"]).withColumn("rank", F.col("before") + F.col("start"))
    dealt = F.broadcast(_segments(spark, ring, counts, shards))
    end = F.col("rank") + F.col("copies")
    found = ranked.join(dealt, "arc").where((F.col("rank") < F.col("high")) & (end > F.col("low")))
    first, last = F.greatest("rank", "low"), F.least(end, F.col("high"))
    found = found.select(
        "doc_id", "size", "text_crc32", "shard", (F.col("first_slot") + first - F.col("low")).alias("slot"),
        (last - first).alias("times"),
    )
    most = placed.agg(F.max("copies")).first()[0] or 0
    if most > _CHUNK:
        chunk = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("times") - 1) / _CHUNK)))
        found = found.withColumn("chunk", chunk).repartition("shard", "slot", "chunk").select(
            "doc_id", "size", "text_crc32", "shard", (F.col("slot") + F.col("chunk") * _CHUNK).alias("slot"),
            F.least(F.lit(_CHUNK), F.col("times") - F.col("chunk") * _CHUNK).alias("times"),
        )
    if most > 1:
        place = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("times") - 1))
        found = found.withColumn("place", place).withColumn("slot", F.col("slot") + F.col("place"))
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
