"""Parquet tables of a store directory.

Staging tables: one directory per import (``batch=N``), so repeating a failed import replaces its own files only.
Keyed tables: one directory per month, files sorted by symbol and date, so a lookup reads one month and, by the
row-group statistics, a few row groups of it.
"""

from __future__ import annotations

import re
from collections.abc import Collection
from datetime import date
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricefold.functions.scalars import month_of
from pricefold.operators.keyed import changes, replaced
from pricefold.schema import HIDDEN, KEY, STAGING, TABLES, columns, stored

# Row numbers of a scan partition take the low bits of a position, the partition number the bits above them.
_POSITION_BITS = 33
_MAX_PARTITIONS = 2 ** (63 - _POSITION_BITS)
# A month before the minimum date, kept as an empty directory: a read by month then always finds a path.
_EMPTY_MONTH = date(1969, 12, 1)


class Numbers(NamedTuple):
    """The last batch of a staging table, and the partition numbers that its rows take up."""

    batch: int
    partitions: int


def _with_news(rows: DataFrame) -> T.StructType:
    return T.StructType([*rows.schema.fields, T.StructField("is_new", T.BooleanType())])


class Tables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str, months: Collection[date] | None = None) -> DataFrame:
        """A stored table with its declared columns and the storage columns. It must have been created.

        With ``months`` only the directories of those months are listed and read, so the cost of a lookup or of a
        small merge does not grow with the number of months stored.
        """
        return self._scan(table, stored(table), months)

    def _scan(self, table: str, schema: T.StructType, months: Collection[date] | None) -> DataFrame:
        reader = self.spark.read.schema(schema).option("basePath", self.path(table))
        if months is None:
            return reader.parquet(self.path(table))
        names = ",".join(f"month={month.isoformat()}" for month in sorted({_EMPTY_MONTH, *months}))
        return reader.parquet(f"{self.path(table)}/{{{names}}}")

    def exists(self, table: str) -> bool:
        folder, files = self._folder(self.path(table))
        return files.exists(folder)

    def kept(self, name: str, rows: DataFrame) -> DataFrame:
        """``rows`` written to a directory beside the tables and read from there, so that they are found once."""
        rows.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(rows.schema).parquet(self.path(name))

    def make(self, name: str) -> None:
        """Make an empty directory beside the tables."""
        folder, files = self._folder(self.path(name))
        files.mkdirs(folder)

    def drop(self, name: str) -> None:
        """Delete a directory beside the tables."""
        folder, files = self._folder(self.path(name))
        files.delete(folder, True)

    def create(self, table: str) -> None:
        """Create the table empty, dropping its rows if it exists."""
        partition = "batch" if table in STAGING else "month"
        empty = self.spark.createDataFrame([], stored(table))
        if table in STAGING and self.exists(table):
            self._note_numbers(table, self.numbers(table)._replace(partitions=0))
            self._forget_tokens(table)
        # Static whatever the session says: a dynamic overwrite with no rows would drop nothing.
        writer = empty.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy(partition).parquet(self.path(table))
        if partition == "month":
            month = f"{self.path(table)}/month={_EMPTY_MONTH.isoformat()}"
            empty.drop("month").write.mode("overwrite").parquet(month)

    def _folder(self, path: str):
        """A path and its file system, as the cluster's Hadoop settings name it."""
        context = self.spark.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        return folder, folder.getFileSystem(context._jsc.hadoopConfiguration())

    def _names(self, path: str) -> list[str]:
        """The names in a directory, none if there is no such directory."""
        folder, files = self._folder(path)
        return [status.getPath().getName() for status in files.listStatus(folder)] if files.exists(folder) else []

    def numbers(self, table: str) -> Numbers:
        """The numbers that imports of a staging table have used, from the name of one marker directory.

        A store without a marker is asked for the names of its batch directories; no file is listed.
        """
        noted = [re.fullmatch(r"batch=(\d+),partitions=(\d+)", name) for name in self._names(self.path(f"imports/{table}"))]
        if any(noted):
            return max(Numbers(*map(int, found.groups())) for found in noted if found)
        batches = [re.fullmatch(r"batch=(\d+)", name) for name in self._names(self.path(table))]
        last = max((int(found.group(1)) for found in batches if found), default=0)
        return Numbers(last, last)

    def _note_numbers(self, table: str, numbers: Numbers) -> None:
        """Put down the new marker before the old ones go, so that no number comes twice."""
        home = self.path(f"imports/{table}")
        name = f"batch={numbers.batch},partitions={numbers.partitions}"
        folder, files = self._folder(f"{home}/{name}")
        files.mkdirs(folder)
        for old in self._names(home):
            if old != name:
                files.delete(self._folder(f"{home}/{old}")[0], True)

    def _held(self, table: str, token: str) -> tuple[Numbers, int] | None:
        """What an import of this token has been given before: batch and partitions, and the first partition number."""
        names = self._names(self.path(f"tokens/{table}/{token}"))
        found = [re.fullmatch(r"batch=(\d+),first=(\d+),partitions=(\d+)", name) for name in names]
        held = [tuple(map(int, match.groups())) for match in found if match]
        return max(((Numbers(batch, partitions), first) for batch, first, partitions in held), default=None)

    def _hold(self, table: str, token: str, numbers: Numbers, first: int) -> None:
        name = f"batch={numbers.batch},first={first},partitions={numbers.partitions}"
        folder, files = self._folder(self.path(f"tokens/{table}/{token}/{name}"))
        files.mkdirs(folder)

    def _forget_tokens(self, table: str) -> None:
        """Imports of before are no longer there to be replaced."""
        self.drop(f"tokens/{table}")

    def stage(
        self, table: str, rows: DataFrame, position: str, partitions: int, overwrite: bool = False,
        token: str | None = None,
    ) -> int:
        """Write one import and return its batch number, which is larger than that of any import before.

        An import with a ``token``, a name fit for a file, takes the place of an earlier one with the same token: it has that
        one's batch number, and its partition numbers if they suffice.

        ``position`` numbers the rows within the scan (partition number above, row number below) and ``partitions`` is
        the number of partitions it may mention. The partition numbers of imports follow each other, which makes
        ``_seq`` increase from import to import without reading what is stored. Dropping the rows starts them again,
        but not the batch numbers: whoever has merged up to a batch still finds the next one above it.
        """
        used = self.numbers(table)
        first = 0 if overwrite else used.partitions
        if overwrite:
            self._forget_tokens(table)
        held = self._held(table, token) if token and not overwrite else None
        if held and held[0].partitions >= partitions:
            (batch, _), first = held
            return self._write_batch(table, rows, position, batch, first)
        if first + partitions > _MAX_PARTITIONS:
            raise OverflowError(f"{table} has used up its row numbers; merge it and import with overwrite")
        batch = held[0].batch if held else used.batch + 1
        # A marker that an unfinished overwrite left must not be below the rows that are still there.
        self._note_numbers(table, Numbers(max(used.batch, batch), max(used.partitions, first + partitions)))
        if token:
            self._hold(table, token, Numbers(batch, partitions), first)
        if not overwrite:
            return self._write_batch(table, rows, position, batch, first)
        staged = self._staged(table, rows, position, first).withColumn("batch", F.lit(batch).cast("bigint"))
        writer = staged.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy("batch").parquet(self.path(table))
        self._note_numbers(table, Numbers(batch, partitions))
        return batch

    def _staged(self, table: str, rows: DataFrame, position: str, first: int) -> DataFrame:
        return rows.select(*columns(table), (F.col(position) + F.lit(first << _POSITION_BITS)).alias("_seq"))

    def _write_batch(self, table: str, rows: DataFrame, position: str, batch: int, first: int) -> int:
        staged = self._staged(table, rows, position, first)
        staged.write.mode("overwrite").parquet(f"{self.path(table)}/batch={batch}")
        return batch

    def _laid_out(self, table: str, rows: DataFrame) -> DataFrame:
        """Few files per month, sorted by symbol and date.

        A month of minutes takes many files. Range partitions give each its own stretch of symbols, so a lookup opens
        one, and cut a symbol that holds most rows by date; the price is that the bounds are sampled from a second run
        of the last stage. A month of days is small, and the rebalancing splits it by size where it is not.
        """
        keys = ["month", "symbol", "date"]
        day = "day" if "day" in columns(table) else "date"
        extra = [name for name in HIDDEN.get(table, {}) if name in rows.columns]
        rows = rows.select(*columns(table), *extra, month_of(day).alias("month"))
        laid = rows.repartitionByRange(*keys) if table == "minutes" else rows.hint("rebalance", "month")
        return laid.sortWithinPartitions(*keys)

    def append(self, table: str, rows: DataFrame) -> int:
        """Append rows and return how many there were."""
        return self._write(table, rows, "append")

    def replace(self, table: str, rows: DataFrame) -> int:
        """Replace the months that ``rows`` has and return the number of rows.

        The months change when the job commits; a failed job leaves them alone.
        """
        return self._write(table, rows, "overwrite", partitionOverwriteMode="dynamic")

    def rewrite_months(self, table: str, months: Collection[date]) -> int:
        """Lay the files of some months out anew, after many small merges, and return the number of rows.

        The rows go through a copy beside the table, so that no month is read and replaced by one job.
        """
        if table in STAGING or not months:
            return 0
        return self._rewrite(table, self.hidden(table, months))

    def hidden(self, table: str, months: Collection[date] | None = None) -> DataFrame:
        """A keyed table with the columns that its reads leave out."""
        fields = [T.StructField(name, kind) for name, kind in HIDDEN.get(table, {}).items()]
        return self._scan(table, T.StructType([*stored(table).fields, *fields]), months)

    def upsert(self, table: str, rows: DataFrame) -> tuple[int, int]:
        """Make ``rows``, unique by key, the stored ones of their keys; how many were new, and how many changed.

        The rows are compared with the months that they name. What differs goes to a table beside, from which months
        that have only new keys are appended to, and months with changed rows are written anew; others keep their files.
        Rows that are stored as they are do nothing, so an upsert can be repeated, also after a failure. Columns that
        reads leave out count too where ``rows`` has them.
        """
        day = "day" if "day" in columns(table) else "date"
        extra = [name for name in HIDDEN.get(table, {}) if name in rows.columns]
        names = [*columns(table), *extra]
        dated = rows.select(*names, month_of(day).alias("month"))
        months = {row["month"] for row in dated.select("month").distinct().collect()}
        if not months:
            return 0, 0
        keys = ["month", *KEY]
        held = self.hidden(table, months)
        beside = self.path(f"changes/{table}")
        changes(dated, held.select(*dated.columns), keys).write.mode("overwrite").parquet(beside)
        changed = self.spark.read.schema(_with_news(dated)).parquet(beside)
        counts = changed.groupBy("month", "is_new").agg(F.count("*").alias("n")).collect()
        redone = sorted({row["month"] for row in counts if not row["is_new"]})
        news = changed.where(~F.col("month").isin(redone)) if redone else changed
        if len(redone) < len({row["month"] for row in counts}):
            self.append(table, news)
        if redone:
            own = changed.where(F.col("month").isin(redone)).drop("is_new")
            stored_rows = self.hidden(table, redone)
            others = [F.lit(None).cast(stored_rows.schema[name].dataType).alias(name) for name in stored_rows.columns
                      if name not in own.columns]
            self._rewrite(table, replaced(stored_rows, own.select("*", *others), keys))
        return tuple(sum(row["n"] for row in counts if row["is_new"] is new) for new in (True, False))

    def _rewrite(self, table: str, rows: DataFrame) -> int:
        """Replace months by rows that are read from them, through a copy, so that no job reads what it replaces."""
        copy = f"{self.path('rewritten')}/{table}"
        rows.write.mode("overwrite").parquet(copy)
        return self.replace(table, self.spark.read.schema(rows.schema).parquet(copy))

    def _write(self, table: str, rows: DataFrame, mode: str, **options: str) -> int:
        seen = Observation()
        # Counted after the layout, since a count before it would also see the rows of the sampling run.
        laid = self._laid_out(table, rows).observe(seen, F.count("*").alias("written"))
        laid.write.mode(mode).options(**options).partitionBy("month").parquet(self.path(table))
        return seen.get["written"]

    def create_all(self) -> None:
        for table in sorted(TABLES):
            self.create(table)
