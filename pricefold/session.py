"""Session settings: shuffle sizes for large jobs, and a session for tests, the bench and small jobs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
# More partitions than this cost more in shuffle blocks than they save in memory.
_MOST_PARTITIONS = 50_000


@contextmanager
def shuffles_sized_for(*inputs: DataFrame) -> Iterator[None]:
    """Start the shuffles of the enclosed jobs with two partitions per input split.

    Adaptive execution merges partitions that turn out small, so this only ever helps: the session's default of a few
    hundred is far too low for terabytes. A higher setting of the session stays.
    """
    spark = inputs[0].sparkSession
    before = spark.conf.get(_INITIAL_PARTITIONS, None)
    session = int(before or spark.conf.get("spark.sql.shuffle.partitions"))
    splits = sum(frame.rdd.getNumPartitions() for frame in inputs)
    spark.conf.set(_INITIAL_PARTITIONS, str(max(session, min(2 * splits, _MOST_PARTITIONS))))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_INITIAL_PARTITIONS)
        else:
            spark.conf.set(_INITIAL_PARTITIONS, before)


@contextmanager
def joins_on_part_of_keys(spark: SparkSession) -> Iterator[None]:
    """Let joins of the enclosed jobs use sides that are dealt out alike by some of the join keys."""
    before = spark.conf.get(_ALL_KEYS, None)
    spark.conf.set(_ALL_KEYS, "false")
    try:
        yield
    finally:
        spark.conf.unset(_ALL_KEYS) if before is None else spark.conf.set(_ALL_KEYS, before)


def local_session(cores: int = 8, shuffle_partitions: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A session on this machine. On a cluster use the one the cluster gives."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("pricefold")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
