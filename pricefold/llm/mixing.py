"""Operator 6: mix sources to target weights by a low-discrepancy schedule of equal blocks of words.

A source has as many slots as it takes to reach its target, and its last slot is cut to the words that are missing then.
The order of the slots is the schedule: slot i falls on point ``i * golden ratio mod 1`` and the points are mapped through
the cumulative numbers of slots, so every stretch of the schedule holds the sources in proportion. Points that a source
has too many are passed over, and slots for which it has too few come at the end. The k-th slot of a source takes the
k-th block of its documents, which are shuffled, laid end to end and cut every ``block`` words; after the last block,
which may be shorter, it starts again. So a document has a place in the schedule for each time that it is taken.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricefold.llm.common import checkpointed, located, place

# Points are multiples of 2**-31. The step is 2**31 divided by the golden ratio, made odd, so no point repeats early.
_BITS = 31
_STEP = 1_327_217_885
# Slots are ranked within stretches of the schedule, documents within buckets of their shuffle order.
_STRETCH = 16
_BUCKETS = 10
_FEW_SOURCES = 100_000

WORD = r"[^\x20\x09-\x0D]+"


def _before(amount: str, group: Sequence[str], order: Sequence[str | Column]) -> Column:
    window = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(amount).over(window), F.lit(0))


def targets(sizes: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """Add number, weight and target to one row per source with its source_size.

    Sources by code point, null last, take the weights in turn. Together the targets make ``share`` times all sizes. No
    target is above ``most`` times its source's size; what is over is shared again by weight. In the order of size by
    weight the sources that stop form a prefix, so one pass over the sources finds the level of the others.
    """
    turn = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int"))
    sources = sizes.withColumn("number", turn).withColumn("weight", weight.cast("double"))
    limit = F.col("source_size") * F.lit(most)
    sources = sources.withColumn("_ratio", limit / F.col("weight"))
    whole = Window.partitionBy()
    stopped = _before("source_size", [], ["_ratio", "number"]) * F.lit(most)
    weight_left = F.sum("weight").over(whole) - _before("weight", [], ["_ratio", "number"])
    level = (F.sum("source_size").over(whole) * F.lit(share) - stopped) / weight_left
    sources = sources.withColumn("_level", level)
    reached = F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "number"))
    sources = sources.withColumn("_reached", F.coalesce(F.min_by("_level", reached).over(whole), F.lit(0.0)))
    target = F.least(F.col("_reached") * F.col("weight"), limit)
    return sources.withColumn("target", target).drop("_ratio", "_level", "_reached")


def quotas(sources: DataFrame, most: int, block: int) -> DataFrame:
    """Add to each source its blocks, the words it gives and the slots it gives them in.

    The words are the target rounded up, so a source with a target is never without a slot: ``rounds`` times all words
    and then the first ``rest`` words again.
    """
    words = F.least(F.ceil("target"), F.col("source_size") * most).cast("bigint")
    sources = sources.withColumn("blocks", F.ceil(F.col("source_size") / block)).withColumn("words", words)
    whole = F.when(F.col("words") > 0, F.floor(F.col("words") / F.col("source_size"))).otherwise(0)
    sources = sources.withColumn("rounds", whole.cast("bigint"))
    sources = sources.withColumn("rest", F.col("words") - F.col("rounds") * F.col("source_size"))
    slots = F.col("rounds") * F.col("blocks") + F.ceil(F.col("rest") / block)
    return sources.withColumn("slots", slots.cast("bigint"))


def schedule(sources: DataFrame, small: bool) -> DataFrame:
    """The slots as (number of the source, rank among its slots, position): as many a source as its ``slots``, from rank 0.

    Positions rise with the rank; they order the slots of all sources and have gaps where a point was passed over.
    """
    number = sources.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    if not number:
        none = F.lit(0).cast("bigint")
        return sources.select("number", none.alias("rank"), none.alias("position")).where(F.lit(False))
    share = F.sum("slots").over(Window.orderBy("number")) / F.sum("slots").over(Window.partitionBy())
    ends = sources.withColumn("high", F.round(share * F.lit(1 << _BITS)).cast("bigint"))
    shares = ends.select("number", F.lag("high", 1, 0).over(Window.orderBy("number")).alias("low"), "high")
    point = F.pmod(F.pmod("id", F.lit(1 << _BITS)) * F.lit(_STEP), F.lit(1 << _BITS))
    slots = sources.sparkSession.range(number).withColumn("point", point)
    slots = located(slots, shares, "point", _BITS, small)
    slots = slots.select("number", "id", F.shiftright("id", _STRETCH).alias("stretch"))
    counts = slots.groupBy("number", "stretch").agg(F.count("*").alias("slots"))
    # One row for each source and stretch that it has points in, which the points' ranks and the missing slots need.
    counts = checkpointed(counts)
    met = counts.groupBy(F.col("number").alias("_number")).agg(F.sum("slots").alias("_met"))
    wanted = sources.select("number", "slots")
    lacking = wanted.join(met, F.col("number") == F.col("_number"), "left").withColumn("_met", F.coalesce("_met", F.lit(0)))
    lacking = lacking.where(F.col("_met") < F.col("slots"))
    # Those that come late are in turn too: each source's k-th is dealt into the k-th round after the last point.
    late = lacking.select("number", F.posexplode(F.sequence("_met", F.col("slots") - 1)).alias("turn", "rank"))
    late = late.select("number", "rank", (F.col("turn") + number).alias("position"))
    counts = counts.withColumn("start", _before("slots", ["number"], ["stretch"])).drop("slots")
    within = F.row_number().over(Window.partitionBy("number", "stretch").orderBy("id")) - 1
    ranked = slots.withColumn("rank", within).join(counts, ["number", "stretch"])
    ranked = ranked.select("number", (F.col("rank") + F.col("start")).alias("rank"), F.col("id").alias("position"))
    wanted = F.broadcast(wanted) if small else wanted
    return ranked.join(wanted, "number").where(F.col("rank") < F.col("slots")).drop("slots").unionByName(late)


def mixed(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    most: int = 2,
    block: int = 64,
    id_column: str = "doc_id",
    seen_column: str | None = None,
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, size, source_size, target, taken, slots, seen.

    ``size`` counts the words of the text (0 for null); ``taken`` the words that the mix takes of the document, repeats
    counted, at most ``most`` times its size. What a source gives is its target, rounded up to whole words. ``slots`` has
    for each time that words of the document are taken the schedule position of the first slot that does, rising; it is
    empty where none is taken. Documents read by these positions are the mix in its order. The shuffle
    order is a hash of id and text, so reruns agree; rows that agree in both follow the order of the input, which
    ``seen`` numbers, or ``seen_column`` if it is given. Null ids and a null source are values like others.

    Words are counted once and written, slim, to the checkpoint folder. A source that holds most rows is ordered in
    2**10 buckets of the hash and its slots are ranked by stretches of the schedule; only sums are put in order whole.
    Slots meet documents by source and rank, one row for each time that a document is taken.
    """
    rows = checkpointed(docs.select(
        place(seen_column).alias("seen"),
        F.col(id_column).alias("doc_id"),
        "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        F.xxhash64(F.col(id_column), "text").alias("key"),
    ))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = checkpointed(quotas(targets(sizes, weights, share, most), most, block))
    small = sources.count() <= _FEW_SOURCES
    few = (lambda frame: F.broadcast(frame)) if small else (lambda frame: frame)
    named = few(sources.withColumnRenamed("source", "_source"))
    rows = rows.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "source")

    rows = rows.withColumn("bucket", F.shiftrightunsigned("key", 64 - _BUCKETS))
    sums = rows.groupBy("number", "bucket").agg(F.sum("size").alias("words"))
    sums = sums.withColumn("first", _before("words", ["number"], ["bucket"])).drop("words")
    laid = rows.where("size > 0").withColumn("start", _before("size", ["number", "bucket"], ["key", "doc_id", "seen"]))
    laid = laid.join(sums, ["number", "bucket"]).withColumn("start", F.col("start") + F.col("first"))
    # Each whole round takes all words of a document; the round that is not whole those before the rest.
    again = F.least("size", F.greatest(F.col("rest") - F.col("start"), F.lit(0)))
    turns = F.col("rounds") + F.when(again > 0, 1).otherwise(0)
    times = laid.where(turns > 0).withColumn("turn", F.explode(F.sequence(F.lit(0).cast("bigint"), turns - 1)))
    rank = F.col("turn") * F.col("blocks") + F.floor(F.col("start") / block)
    times = times.select("seen", "number", rank.alias("rank"), (F.col("rounds") * F.col("size") + again).alias("taken"))
    given = times.join(schedule(sources, small), ["number", "rank"]).groupBy("seen").agg(
        F.first("taken").alias("taken"), F.array_sort(F.collect_list("position")).alias("slots")
    )
    result = rows.drop("slots").join(given, "seen", "left")
    return result.select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"),
        F.coalesce("slots", F.array().cast("array<bigint>")).alias("slots"), "seen",
    )
