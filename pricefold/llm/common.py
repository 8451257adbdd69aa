"""Folders that driver and executors share, files in them, and tables that cut the lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow.fs
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_root(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``, with its file system.

    A local session without that setting gets a temporary folder; on a cluster the setting is needed.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not context.getCheckpointDir():
        if not root and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(root or tempfile.mkdtemp(prefix="pricefold-"))
    # Without a scheme the path is in the cluster's default file system, which tasks cannot tell from the path.
    path = context._jvm.org.apache.hadoop.fs.Path(root or context.getCheckpointDir())
    return path.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(path).toString()


# Who asks for folders and gives them back when what is made of them is written; nobody does outside ``gathered``.
_gathering: ContextVar[list[str] | None] = ContextVar("gathering", default=None)


def shared_folder(spark: SparkSession, name: str, lasting: bool = False) -> str:
    """The name of a new folder below the shared one; a ``lasting`` one is a result and never given back."""
    folder = f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    folders = _gathering.get()
    if folders is not None and not lasting:
        folders.append(folder)
    return folder


@contextmanager
def gathered(folders: list[str]) -> Iterator[None]:
    """Note the folders that are made meanwhile."""
    token = _gathering.set(folders)
    try:
        yield
    finally:
        _gathering.reset(token)


def freed(spark: SparkSession, folders: list[str], still_read: DataFrame) -> None:
    """Delete folders that nothing needs any more, and forget them; those that ``still_read`` reads from stay."""
    files = still_read.inputFiles()
    needed = [folder for folder in folders if any(folder.rpartition("/")[2] in file for file in files)]
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in folders:
        if folder not in needed:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(settings).delete(path, True)
    folders[:] = needed


def fitted(frame: DataFrame, at_most: int | None, rows: int = 500_000) -> DataFrame:
    """``frame`` in no more partitions than its known bound of rows needs, so that little data makes few files."""
    return frame if at_most is None else frame.coalesce(max(1, -(-at_most // rows)))


def checkpointed(frame: DataFrame, at_most: int | None = None) -> DataFrame:
    """``frame`` computed and written to the checkpoint folder, which no lost executor undoes."""
    shared_root(frame.sparkSession)
    return fitted(frame, at_most).checkpoint()


def stored(frame: DataFrame, name: str, at_most: int | None = None) -> DataFrame:
    """``frame`` written to the shared folder and read back: it is computed once and no lost executor undoes it."""
    return counted(frame, name, at_most)[0]


def counted(frame: DataFrame, name: str, at_most: int | None = None) -> tuple[DataFrame, int]:
    """A stored table, and its number of rows as counted by the write."""
    folder, seen = shared_folder(frame.sparkSession, name), Observation()
    fitted(frame, at_most).observe(seen, F.count("*").alias("rows")).write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder), seen.get["rows"]


def place(column: str | None) -> Column:
    """The number of a row: the column that holds it, or one that this read of the rows gives.

    Another read may deal files to partitions in another way, as cores come and go, and so number the rows otherwise.
    """
    return F.monotonically_increasing_id() if column is None else F.col(column)


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` stored with their numbers: ``place``, and each row as one column ``doc``, so no name in it clashes."""
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    return stored(docs.select(place(None).alias("place"), whole.alias("doc")), "numbered-documents")


def drawn(texts: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` of the distinct rows of ``texts``, or all if there are no more.

    The draw goes by a hash of the row and copies count once, so neither copies nor rows left out before bear on its size.
    The number of distinct rows is estimated, to a few hundredths.
    """
    key = F.xxhash64(*texts.columns)
    total = texts.agg(F.approx_count_distinct(key)).first()[0]
    if total > rows:
        texts = texts.where(F.shiftrightunsigned(key, 1) < int(rows / total * ((1 << 63) - 1)))
    return texts.distinct()


def opened(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path or URI, as tasks reach it, and the path in it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(path)


@contextmanager
def written_whole(path: str) -> Iterator[pyarrow.NativeFile]:
    """A stream whose file gets its name at the end, so a task that dies or runs twice leaves no half file there."""
    system, place = opened(path)
    system.create_dir(os.path.dirname(place), recursive=True)
    unfinished = f"{place}.{uuid.uuid4().hex}"
    with system.open_output_stream(unfinished) as stream:
        yield stream
    system.move(unfinished, place)


def one_row_a_task(files: DataFrame) -> DataFrame:
    """Deal the rows of a table of files to as many tasks as there are files."""
    return files.repartition(max(1, files.count()))


def located(rows: DataFrame, intervals: DataFrame, place: str, bits: int, small: bool) -> DataFrame:
    """Give each row the columns of the interval (``low`` up to but not with ``high``) that its ``place`` falls into.

    Places are below ``2**bits``. Both sides meet on the high bits first, so this is an equality join with few
    candidates a row. ``small`` says that the intervals have a proven bound and may be broadcast.
    """
    shift = bits - min(bits, 12)
    buckets = F.sequence(F.shiftright("low", shift), F.shiftright(F.col("high") - 1, shift))
    coarse = intervals.where("low < high").withColumn("_bucket", F.explode(buckets))
    rows = rows.withColumn("_bucket", F.shiftright(place, shift))
    found = rows.join(F.broadcast(coarse) if small else coarse, "_bucket")
    return found.where((F.col(place) >= F.col("low")) & (F.col(place) < F.col("high"))).drop("_bucket", "low", "high")
