"""Operators over keyed relations: duplicates, membership and the single-match left join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rank of what is stored already, above that of all sources.
STORED = (1 << 63) - 1


def distinct_rows(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    return frame.select(*columns).distinct()


def latest_per_key(frame: DataFrame, keys: Sequence[str], order: str = "_seq") -> DataFrame:
    """One row per key: the one with the greatest ``order``, which must be unique within a key.

    An aggregation rather than a ranking window: copies of a key are combined before the shuffle, so a key that
    holds a large share of the rows costs one row per task. Each column has its own ``max_by`` because a
    fixed-width buffer keeps this a hash aggregation, where a struct would force a sort.
    """
    values = [name for name in frame.columns if name not in (*keys, order)]
    return frame.groupBy(*keys).agg(*[F.max_by(name, order).alias(name) for name in values])


def first_source(sources: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Union of relations that are each unique by key; an earlier relation wins over a later one."""
    ranked = [frame.withColumn("_rank", F.lit(rank)) for rank, frame in enumerate(sources)]
    union = ranked[0]
    for frame in ranked[1:]:
        union = union.unionByName(frame)
    values = [name for name in sources[0].columns if name not in keys]
    return union.groupBy(*keys).agg(*[F.min_by(name, "_rank").alias(name) for name in values])


def winners(
    ranked: Sequence[tuple[DataFrame, Column]], keys: Sequence[str], existing: DataFrame
) -> DataFrame:
    """One row per key that ``existing`` does not hold: that of the greatest rank, by one aggregation of the union.

    Each source comes with its rank, a bigint below ``STORED`` that is unique within a key; ``_seq``, which it may be made
    of, is no value. Stored keys take part with the rank ``STORED``, so they need no join of their own and all sides meet
    in one shuffle, combined before it.
    """
    values = [name for name in ranked[0][0].columns if name not in (*keys, "_seq")]
    stored = [F.lit(None).cast(ranked[0][0].schema[name].dataType).alias(name) for name in values]
    union = existing.select(*keys, *stored, F.lit(STORED).alias("_rank"))
    for frame, rank in ranked:
        union = union.unionByName(frame.select(*keys, *values, rank.cast("bigint").alias("_rank")))
    best = union.groupBy(*keys).agg(
        F.max("_rank").alias("_rank"), *[F.max_by(name, "_rank").alias(name) for name in values]
    )
    return best.where(F.col("_rank") < STORED).drop("_rank")


def new_keys(frame: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``frame`` whose key is not in ``existing``."""
    return frame.join(existing.select(*keys), list(keys), "left_anti")


def changes(rows: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows that are not stored as they are, with ``is_new`` where their key is not stored at all.

    Both sides are unique by key, which includes the storage month where both have it, and have the same columns.
    """
    values = [name for name in rows.columns if name not in keys]
    held = stored.select(*keys, F.struct(*values).alias("_held"))
    joined = rows.join(held, list(keys), "left")
    differs = ~F.struct(*values).eqNullSafe(F.col("_held"))
    return joined.where(differs).withColumn("is_new", F.col("_held").isNull()).drop("_held")


def replaced(stored: DataFrame, changed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The stored rows with the changed ones in the place of those with their keys."""
    kept = stored.join(changed.select(*keys), list(keys), "left_anti")
    return kept.unionByName(changed.select(*kept.columns))


def any_left_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], unique: bool = True
) -> DataFrame:
    """Left join with at most one match per left row; right columns without a match are 0.

    With ``unique=False`` the right side may repeat a key; the greatest row (by column order) is then taken.
    No broadcast is forced: the optimizer broadcasts the right side when its size is below the session threshold
    and otherwise shuffles both sides by key.
    """
    values = [name for name in right.columns if name not in keys]
    if not unique:
        best = right.groupBy(*keys).agg(F.max(F.struct(*values)).alias("_best"))
        right = best.select(*keys, "_best.*")
    joined = left.join(right, list(keys), "left")
    return joined.withColumns({name: F.coalesce(name, F.lit(0)) for name in values})
