"""Copies of the daily tables by symbol: bucketed, so that joins and windows by symbol need no shuffle.

The stored tables lie by month, which lookups and merges need; bucketed as well they would have a file for each month and
bucket. A copy has one file for each bucket and catch-up instead. It knows the files that it was made of: new ones are
added to it, and where one has gone, since its month was written anew, the copy is made anew. Minutes have no copy: a
symbol with a third of them would be one bucket, while its daily bars are as many as the calendar's days at most.
"""

from __future__ import annotations

import re
import zlib

from pyspark.sql import DataFrame

from pricefold.schema import KEY, TABLES, columns
from pricefold.sinks.tables import Tables

BUCKETED = ("days", "adjustments", "days_adjusted")


class Buckets:
    def __init__(self, tables: Tables, buckets: int):
        self.tables, self.spark, self.buckets = tables, tables.spark, buckets

    def read(self, table: str) -> DataFrame:
        """The copy of a table, caught up with it."""
        if table not in BUCKETED:
            raise ValueError(f"no copy by symbol of {table}")
        self._catch_up(table)
        return self.spark.table(self._registered(table))

    def _home(self, table: str) -> str:
        return f"by_symbol/{table}/buckets={self.buckets}"

    def _registered(self, table: str) -> str:
        """The copy as an external table of the session's catalog, which alone can say that files are buckets."""
        path = self.tables.path(f"{self._home(table)}/rows")
        name = f"pricefold_{zlib.crc32(path.encode()):08x}_{re.sub('[^a-z_]', '', table)}_by_symbol"
        fields = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in TABLES[table].fields)
        sort = ", ".join(KEY)
        location = path.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"create table if not exists {name} ({fields}) using parquet "
            f"clustered by (symbol) sorted by ({sort}) into {self.buckets} buckets location '{location}'"
        )
        # Files may have come by another session since this one listed them.
        self.spark.catalog.refreshTable(name)
        return name

    def _catch_up(self, table: str) -> None:
        rows, home = self.tables.read(table), self._home(table)
        files = set(rows.inputFiles())
        taken, whole = self._taken(home)
        if whole and taken == files:
            return
        # While this mark is there the copy may hold rows twice or in part, and the next read makes it anew.
        self._mark(home, done=False)
        if whole and taken < files:
            rows = self.spark.read.schema(TABLES[table]).parquet(*sorted(files - taken))
            self._write(table, rows, overwrite=False)
        else:
            self._write(table, rows, overwrite=True)
        noted = self.spark.createDataFrame([(name,) for name in sorted(files)], "file string")
        noted.coalesce(1).write.mode("overwrite").parquet(self.tables.path(f"{home}/files"))
        self._mark(home, done=True)

    def _taken(self, home: str) -> tuple[set[str], bool]:
        """The files that a copy was made of, and whether it holds them whole."""
        if not self.tables.exists(f"{home}/files/_SUCCESS") or self.tables.exists(f"{home}/unfinished"):
            return set(), False
        noted = self.spark.read.schema("file string").parquet(self.tables.path(f"{home}/files"))
        return {row.file for row in noted.collect()}, True

    def _mark(self, home: str, done: bool) -> None:
        if done:
            self.tables.drop(f"{home}/unfinished")
        else:
            self.tables.make(f"{home}/unfinished")

    def _write(self, table: str, rows: DataFrame, overwrite: bool) -> None:
        """Rows dealt out as the buckets are, so that a task writes one file."""
        dealt = rows.select(*columns(table)).repartition(self.buckets, "symbol").sortWithinPartitions(*KEY)
        dealt.write.insertInto(self._registered(table), overwrite=overwrite)
