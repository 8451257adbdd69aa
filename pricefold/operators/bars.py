"""Roll-up of minute bars to daily bars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def day_bars(minutes: DataFrame) -> DataFrame:
    """First open, highest high, lowest low and last close of each symbol and day.

    ``minutes`` has one row per symbol and minute. Partial results are combined before the shuffle, so what is
    shuffled has the size of the daily bars, times the tasks a day is spread over.
    """
    return (
        minutes.groupBy("symbol", F.col("day").alias("date"))
        .agg(
            F.min_by("open", minutes["date"]).alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", minutes["date"]).alias("close"),
        )
    )


#: The first and the last minute that a bar rolled up from minutes knows of; null for a bar from elsewhere.
SPAN = ["first_minute", "last_minute"]


def day_states(minutes: DataFrame) -> DataFrame:
    """Daily bars that further minutes can be merged into: those of ``day_bars``, with their first and last minute."""
    return minutes.groupBy("symbol", F.col("day").alias("date")).agg(
        F.min_by("open", minutes["date"]).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", minutes["date"]).alias("close"),
        F.min(minutes["date"]).alias("first_minute"),
        F.max(minutes["date"]).alias("last_minute"),
    )


def merged_states(*states: DataFrame) -> DataFrame:
    """Bars of the same day from different minutes as one, as if all the minutes had been rolled up together.

    Merging is associative, commutative and the same when repeated, so a bar may take in minutes that it has already.
    """
    union = states[0]
    for more in states[1:]:
        union = union.unionByName(more)
    return union.groupBy("symbol", "date").agg(
        F.min_by("open", "first_minute").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "last_minute").alias("close"),
        F.min("first_minute").alias("first_minute"),
        F.max("last_minute").alias("last_minute"),
    )
