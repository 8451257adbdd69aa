"""A price store: a directory of tables and the verbs that fill and read it."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pricefold.functions.scalars import month_of
from pricefold.operators import adjustment
from pricefold.plans import adjusting, merging, views
from pricefold.schema import BAD, STAGING, TABLES
from pricefold.session import joins_on_part_of_keys, shuffles_sized_for
from pricefold.sinks.buckets import Buckets
from pricefold.sinks.tables import Tables
from pricefold.sources import csv_files, rows
from pricefold.sources.csv_files import SYMBOL_IN_NAME

# Distinct keys that a lookup broadcasts at most; a key takes some 50 bytes.
FEW_KEYS = 1_000_000
# Where minutes lie between their arrival and the refresh of their days' bars.
ADDED = "added/minutes"


@dataclass(frozen=True)
class ImportReport:
    """What an import did. The counts are those of the whole input, before the offset."""

    batch: int
    accepted: int
    rejected: int
    too_old: int


@dataclass(frozen=True)
class MergeReport:
    """Rows added to each keyed table, and stored rows that were replaced where that was asked for."""

    minutes: int
    days: int
    adjustments: int
    replaced: int = 0


@dataclass(frozen=True)
class AdjustReport:
    """Rows adjusted, and dividends left out because they are not below the prior close.

    Of actions on days without a bar, where these are looked after: those that moved to the next bar, and those lost.
    """

    adjusted: int
    bad_dividends: int
    moved_actions: int = 0
    lost_actions: int = 0


class PriceStore:
    """Raw and adjusted prices under ``root``, which executors must be able to reach.

    One writer at a time. Every verb can be repeated after a failure: imports replace their own files only, merges
    add only keys that are not there, and ``adjust`` changes the adjusted prices only when its job commits.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.tables = Tables(spark, root)
        if all(map(self.tables.exists, ("days", "minutes", "days_adjusted"))):
            self.create_views()

    # Schema

    def reset(self) -> None:
        """Create all tables empty, dropping what they hold, and define the two views."""
        self.tables.create_all()
        self.create_views()

    def create_views(self) -> None:
        """Define the temporary views anew, since a view keeps the file listing of the moment it was made."""
        adjusted = self.tables.read("days_adjusted")
        views.days_view(self.tables.read("days"), adjusted).createOrReplaceTempView("days_view")
        views.minutes_view(self.tables.read("minutes"), adjusted).createOrReplaceTempView("minutes_view")

    # Import

    def import_days(self, path: str | list[str], multiline: bool = False, **options) -> ImportReport:
        """Import daily bars with their dividends and split ratios. For the options see ``stage``.

        ``multiline`` allows line breaks in quoted fields; a file is then read by one task.
        """
        return self.stage("days_import", csv_files.read_days(self.spark, path, multiline), **options)

    def import_minutes(
        self, path: str | list[str], symbol: str | None = None, name_pattern: str = SYMBOL_IN_NAME, **options
    ) -> ImportReport:
        """Import minute bars of one symbol; without one, the group of ``name_pattern`` in each file's name is it.

        Rows of different files in one import have no order among them.
        """
        text = csv_files.read_minutes(self.spark, path, symbol, name_pattern)
        return self.stage("minutes_import", text, **options)

    def import_adjustments(
        self, path: str | list[str], symbol: str | None = None, name_pattern: str = SYMBOL_IN_NAME,
        multiline: bool = False, **options,
    ) -> ImportReport:
        """Import dividends and splits, with the symbol as in ``import_minutes``, ``multiline`` as in ``import_days``."""
        text = csv_files.read_adjustments(self.spark, path, symbol, name_pattern, multiline)
        return self.stage("adjustments_import", text, **options)

    def stage(
        self,
        table: str,
        text: DataFrame,
        offset: int | None = None,
        overwrite: bool = False,
        skip_errors: bool = False,
        token: str | None = None,
    ) -> ImportReport:
        """Parse text rows and append them to a staging table.

        ``offset`` starts at that accepted row of each file, counted from 1. ``overwrite`` first drops all rows of
        the staging table, those of other symbols too. A row that does not parse fails the import and nothing is
        written; with ``skip_errors`` it goes to the table's directory under ``rejects`` instead. An import with a
        ``token`` replaces an earlier one with the same token.
        """
        typed = rows.TYPERS[table](text)
        if overwrite and not skip_errors:
            # The overwrite drops the old rows before the first new one is parsed, so look for bad rows first.
            rows.accepted(typed, table, skip_errors).write.format("noop").mode("overwrite").save()
        seen = Observation()
        counted = typed.observe(seen, *[count.alias(name) for name, count in rows.counts(table).items()])
        kept = rows.accepted(counted, table, skip_errors)
        if offset:
            kept = rows.from_offset(kept, offset, counted_from=rows.accepted(typed, table, skip_errors))
        partitions = text.rdd.getNumPartitions()
        batch = self.tables.stage(table, kept, rows.POSITION, partitions, overwrite, token)
        report = ImportReport(batch, **seen.get)
        if report.rejected:
            rejects = self.tables.path(f"rejects/{table}/batch={batch}")
            rows.rejected(typed, table).write.mode("overwrite").parquet(rejects)
        return report

    # Merge

    def merge(
        self, since: Mapping[str, int] | None = None, rescan: bool = False, newest: bool = False, refresh: bool = False
    ) -> MergeReport:
        """Add staged rows with new keys to the keyed tables.

        ``since`` gives, by staging table, the last batch that is merged already, to leave it and earlier ones out.
        Daily bars are rolled up for the months that staged minutes touch; ``rescan`` rolls up all months, which is
        only needed after a merge failed and its staged rows were dropped.

        Stored rows stay as they are, but for two options. With ``newest`` the row that was imported last takes the place
        of a stored one with its key; the bar of a day with minutes is rolled up from them anew, and an empty action
        replaces none. With ``refresh`` minutes are only added, and the bars of their days take them in; bars that know
        the minutes they span do so without a look at those. Months without a change keep their files.
        """
        staged = [self.tables.read(table).where(F.col("batch") > (since or {}).get(table, 0)) for table in STAGING]
        if newest:
            report = self._merge_newest(*staged)
        else:
            report = self._merge(*staged, rescan, refresh)
        self.create_views()
        return report

    def _merge(
        self, minutes_staged: DataFrame, days_staged: DataFrame, actions_staged: DataFrame, rescan: bool, refresh: bool
    ) -> MergeReport:
        minute_months, day_months, action_months = map(self._months, (minutes_staged, days_staged, actions_staged))
        touched = merging.staged_days(minutes_staged)
        refreshed = 0
        if refresh:
            # What a merge that broke off had added already; bars may take it in twice.
            refreshed = self._refresh(ADDED) if self.tables.exists(ADDED) else 0
        existing = merging.of_days(self.tables.read("minutes", minute_months), touched, "day")
        with shuffles_sized_for(minutes_staged, existing):
            added = merging.minutes_delta(minutes_staged, existing)
            if refresh:
                added.write.mode("overwrite").parquet(self.tables.path(ADDED))
                added = self.spark.read.schema(added.schema).parquet(self.tables.path(ADDED))
            minutes = self.tables.append("minutes", added)
        if refresh:
            refreshed += self._refresh(ADDED)
            self.tables.drop(ADDED)

        # Days that no staged minute touches were rolled up when their minutes came.
        if rescan:
            rolled, existing = self.tables.read("minutes"), self.tables.read("days")
        else:
            rolled = merging.of_days(self.tables.read("minutes", minute_months), touched, "day")
            new_days = touched.unionByName(merging.staged_days(days_staged)).distinct()
            existing = merging.of_days(self.tables.read("days", minute_months | day_months), new_days, "date")
        with shuffles_sized_for(days_staged, rolled, existing):
            days = self.tables.append("days", merging.days_delta(rolled, days_staged, existing, spans=True))

        new_days = merging.staged_days(days_staged).unionByName(merging.staged_days(actions_staged)).distinct()
        existing = merging.of_days(self.tables.read("adjustments", day_months | action_months), new_days, "date")
        with shuffles_sized_for(days_staged, actions_staged, existing):
            actions = self.tables.append("adjustments", merging.actions_delta(days_staged, actions_staged, existing))
        return MergeReport(minutes, days, actions, refreshed)

    def _refresh(self, added: str) -> int:
        """Let the stored bars take in minutes that were added to the minutes; how many bars changed.

        Days without a stored bar are left to the merge.
        """
        minutes = self.spark.read.schema(TABLES["minutes"]).parquet(self.tables.path(added))
        months = self._months(minutes)
        days = merging.staged_days(minutes)
        held = merging.of_days(self.tables.hidden("days", months), days, "date")
        own = minutes.join(held.select("symbol", F.col("date").alias("day")), ["symbol", "day"], "left_semi")
        older = self.tables.read("minutes", months) if held.where("last_minute is null").limit(1).count() else own
        return self.tables.upsert("days", merging.refreshed_days(held, own, older.select(*own.columns)))[1]

    def _merge_newest(
        self, minutes_staged: DataFrame, days_staged: DataFrame, actions_staged: DataFrame
    ) -> MergeReport:
        minute_months, day_months = map(self._months, (minutes_staged, days_staged))
        with shuffles_sized_for(minutes_staged):
            minutes = self.tables.upsert("minutes", merging.newest_minutes(minutes_staged))
        wanted = merging.staged_days(minutes_staged).unionByName(merging.staged_days(days_staged)).distinct()
        rolled = merging.of_days(self.tables.read("minutes", minute_months | day_months), wanted, "day")
        with shuffles_sized_for(days_staged, rolled):
            days = self.tables.upsert("days", merging.newest_days(rolled, days_staged, spans=True))
        with shuffles_sized_for(days_staged, actions_staged):
            actions = self.tables.upsert("adjustments", merging.newest_actions(days_staged, actions_staged))
        return MergeReport(*(new for new, _ in (minutes, days, actions)), sum(n for _, n in (minutes, days, actions)))

    def _months(self, staged: DataFrame) -> set[date]:
        """The months that staged rows fall in; at most one value per calendar month."""
        found = staged.select(month_of(F.col("date").cast("date")).alias("month")).distinct().collect()
        return {row["month"] for row in found}

    # Adjust

    def adjust(
        self, skip_errors: bool = False, exact: bool = True, lost: str = "drop", by_segment: bool = False,
        incremental: bool = False, buckets: int | None = None,
    ) -> AdjustReport:
        """Recompute all adjusted daily prices; see ``pricefold.operators.adjustment``.

        With ``skip_errors`` the dividends left out are written to ``rejects/days_adjusted``. With ``lost="next_bar"`` an
        action on a day without a bar counts on the symbol's next day with one; those moved, and those without such a day,
        are written to ``moved_actions``. ``by_segment`` takes the two-level form, for symbols of very many rows.

        With ``incremental`` only symbols whose bars or actions have changed since the last run are adjusted, and of their
        rows only those that differ are written; the report counts these. After a run with other options all are.

        With a number of ``buckets`` bars and actions are read from their copies by symbol, which are caught up first; no
        bar is shuffled then before it is written.
        """
        days, actions = (
            self.by_symbol(name, buckets) if buckets else self.tables.read(name) for name in ("days", "adjustments")
        )
        every = days, actions
        options = f"skip_errors={skip_errors},exact={exact},lost={lost}"
        before = self._fingerprints(options) if incremental else None
        if before is not None:
            changed = adjusting.changed_symbols(before, adjusting.fingerprints(*every))
            symbols = self.tables.kept("changed_symbols", changed)
            days, actions = (adjusting.of_symbols(rows, symbols) for rows in every)
        rows = adjusting.with_actions(days, actions, by_symbol=not by_segment and not buckets, lost=lost)
        form = adjustment.adjusted_by_segment if by_segment else adjustment.adjusted_days
        adjusted = form(rows, skip_errors, exact, report=skip_errors)
        with shuffles_sized_for(days, actions), joins_on_part_of_keys(self.spark):
            if before is None:
                written = self.tables.replace("days_adjusted", adjusted)
            else:
                written = sum(self.tables.upsert("days_adjusted", adjusted))
            moved, gone = self._write_moved(*every) if lost == "next_bar" else (0, 0)
        # Noted last: what a run that breaks off has not written is found changed again.
        state = self.tables.path(f"adjusted_from/{options}")
        self.tables.drop("adjusted_from")
        adjusting.fingerprints(*every).write.mode("overwrite").parquet(state)
        bad = self._write_bad_dividends() if skip_errors else 0
        self.create_views()
        return AdjustReport(written, bad, moved, gone)

    def _fingerprints(self, options: str) -> DataFrame | None:
        """What the adjusted prices were made of by the last run, if it had these options and ended."""
        if not self.tables.exists(f"adjusted_from/{options}/_SUCCESS"):
            return None
        return self.spark.read.parquet(self.tables.path(f"adjusted_from/{options}"))

    def _write_moved(self, days: DataFrame, actions: DataFrame) -> tuple[int, int]:
        seen = Observation()
        counts = F.count("bar").alias("moved"), F.count_if(F.col("bar").isNull()).alias("lost")
        moved = adjusting.moved_actions(days, actions).observe(seen, *counts)
        moved.write.mode("overwrite").parquet(self.tables.path("moved_actions"))
        return seen.get["moved"], seen.get["lost"]

    def _write_bad_dividends(self) -> int:
        """Copy what the adjusted rows tell of dividends left out; the scan reads that column of few values alone."""
        seen = Observation()
        bad = self.tables.hidden("days_adjusted").where(F.col(BAD).isNotNull()).observe(seen, F.count("*").alias("bad"))
        found = bad.select("symbol", "date", f"{BAD}.*")
        found.write.mode("overwrite").parquet(self.tables.path("rejects/days_adjusted"))
        return seen.get["bad"]

    def rewrite_months(self, table: str, months: Collection[date]) -> int:
        """Lay some months of a keyed table out in few files again, after many small merges."""
        rows = self.tables.rewrite_months(table, months)
        self.create_views()
        return rows

    # Read

    def days_view(self) -> DataFrame:
        return views.days_view(self.tables.read("days"), self.tables.read("days_adjusted"))

    def minutes_view(self) -> DataFrame:
        return views.minutes_view(self.tables.read("minutes"), self.tables.read("days_adjusted"))

    def by_symbol(self, table: str, buckets: int) -> DataFrame:
        """``days``, ``adjustments`` or ``days_adjusted`` from a copy in buckets by symbol; see ``sinks.buckets``."""
        return Buckets(self.tables, buckets).read(table)

    def days_view_by_symbol(self, buckets: int) -> DataFrame:
        """The daily view over the copies by symbol, for reads of whole histories.

        Run it within ``pricefold.session.joins_on_part_of_keys``; its join and windows by symbol then shuffle nothing.
        """
        return views.days_view(self.by_symbol("days", buckets), self.by_symbol("days_adjusted", buckets))

    def days_between(self, symbol: str, first: str, last: str) -> DataFrame:
        """The daily view of a symbol from one day to another, both included; lists only their months."""
        days, adjusted = self._months_between("days", first, last)
        view = views.days_view(days, adjusted).where(F.col("symbol") == symbol)
        return view.where(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))

    def minutes_between(self, symbol: str, first: str, last: str) -> DataFrame:
        """The minute view of a symbol from one time to another, both included; lists only their months."""
        minutes, adjusted = self._months_between("minutes", first, last)
        view = views.minutes_view(minutes, adjusted).where(F.col("symbol") == symbol)
        return view.where(F.col("date").between(F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz")))

    def _months_between(self, table: str, first: str, last: str) -> tuple[DataFrame, DataFrame]:
        start, end = (datetime.fromisoformat(moment).date().replace(day=1) for moment in (first, last))
        count = (end.year - start.year) * 12 + end.month - start.month + 1
        places = [start.year * 12 + start.month - 1 + step for step in range(max(count, 0))]
        months = [date(place // 12, place % 12 + 1, 1) for place in places]
        return self.tables.read(table, months), self.tables.read("days_adjusted", months)

    def get_day(self, symbol: str, day: str) -> DataFrame:
        """See ``views.get_day``; reads the month of the day only."""
        return views.get_day(*self._month_of("days", day), symbol, day)

    def get_minute(self, symbol: str, minute: str) -> DataFrame:
        """See ``views.get_minute``; reads the month of the minute only."""
        return views.get_minute(*self._month_of("minutes", minute), symbol, minute)

    def _month_of(self, table: str, moment: str) -> tuple[DataFrame, DataFrame]:
        month = datetime.fromisoformat(moment).date().replace(day=1)
        return self.tables.read(table, [month]), self.tables.read("days_adjusted", [month])

    def get_days(self, keys: DataFrame) -> DataFrame:
        """See ``views.get_days``; lists and reads only the months that the keys name."""
        return views.get_days(*self._of_keys("days", keys, "date"))

    def get_minutes(self, keys: DataFrame) -> DataFrame:
        """See ``views.get_minutes``; lists and reads only the months that the keys name."""
        return views.get_minutes(*self._of_keys("minutes", keys, "timestamp_ntz"))

    def _of_keys(self, table: str, keys: DataFrame, kind: str) -> tuple[DataFrame, DataFrame, DataFrame, bool]:
        """The months that keys name, of a table and of the adjusted prices; the keys; whether they may be broadcast."""
        found = views.wanted_keys(keys, kind).groupBy("month").agg(F.count("*").alias("n")).collect()
        months, few = [row["month"] for row in found], sum(row["n"] for row in found) <= FEW_KEYS
        named = F.col("month").isin(months)
        tables = (self.tables.read(name, months).where(named) for name in (table, "days_adjusted"))
        return *tables, keys, few

    def get(self, mode: str, symbol: str, moment: str) -> DataFrame:
        if mode not in ("day", "minute"):
            raise ValueError(f"unknown mode: {mode}")
        return self.get_day(symbol, moment) if mode == "day" else self.get_minute(symbol, moment)
