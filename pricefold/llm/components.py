"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricefold.llm.common import checkpointed


def _stars(links: DataFrame, smaller_only: bool) -> DataFrame:
    """Tie the neighbours of each vertex to the smallest of them and itself.

    A large star ties the larger neighbours, a small star the smaller ones and the vertex; neither changes the
    components. The smallest neighbour is aggregated before the shuffle and joined back, so a vertex with very many
    links is never one group.
    """
    back = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    around = links if smaller_only else links.unionByName(back)
    least = around.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
    tied = around.join(least, "a")
    if smaller_only:
        moved = tied.select(F.col("b").alias("a"), F.col("least").alias("b"))
        moved = moved.unionByName(least.select("a", F.col("least").alias("b")))
    else:
        moved = tied.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.where("a > b").distinct()


def components(links: DataFrame, at_most: int | None = None) -> DataFrame:
    """``vertex`` and ``root``, the smallest vertex of its component, for each vertex with a link.

    ``links`` has two long columns ``a`` and ``b``, in any order, repeats allowed; ``at_most`` bounds their number, if
    it is known, so that few links take few partitions. Each round writes the links to the
    checkpoint folder; there are about as many rounds as the logarithm of the longest path. At the end every vertex
    has one link, to its root.
    """
    current = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    # Each round keeps at most two links for one.
    bound = None if at_most is None else 2 * at_most
    current = checkpointed(current, bound)
    seen = None
    while True:
        current = checkpointed(_stars(_stars(current, smaller_only=False), smaller_only=True), bound)
        state = current.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.col("a").cast("decimal(38,0)"))
        ).first()
        if state == seen:
            break
        seen = state
    roots = current.select(F.col("b").alias("vertex"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("vertex"), F.col("b").alias("root")).unionByName(roots)
