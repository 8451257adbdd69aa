"""One query per operator, over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricefold.functions.scalars import day_of, descaled, is_action
from pricefold.operators import adjustment, bars, keyed
from pricefold.plans import adjusting, merging, views
from pricefold.schema import ACTION, KEY, PRICES
from pricefold.sources import rows
from workload import feeds

_MINUTE = KEY + PRICES


# Sources and row validation


def parse_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = rows.type_days(feeds.day_text(spark, sf_dir))
    return rows.accepted(typed, "days_import", skip_errors=False).select(*KEY, *PRICES, *ACTION)


def parse_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = rows.type_minutes(feeds.minute_text(spark, sf_dir))
    return rows.accepted(typed, "minutes_import", skip_errors=False).select(*_MINUTE)


def parse_adjustments(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = rows.type_adjustments(feeds.action_text(spark, sf_dir))
    return rows.accepted(typed, "adjustments_import", skip_errors=False).select(*KEY, *ACTION)


def reject_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = rows.type_minutes(feeds.minute_text(spark, sf_dir, spoiled=True))
    return rows.rejected(typed, "minutes_import").select("symbol", "date", "close", "volume")


def skip_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = rows.type_minutes(feeds.minute_text(spark, sf_dir, spoiled=True))
    return rows.accepted(typed, "minutes_import", skip_errors=True).select(*_MINUTE)


def import_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = rows.type_days(feeds.old_day_text(spark, sf_dir))
    return typed.agg(*[count.alias(name) for name, count in rows.counts("days_import").items()])


def min_date_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = rows.type_days(feeds.old_day_text(spark, sf_dir))
    return rows.accepted(typed, "days_import", skip_errors=False).select(*KEY, "close")


def offset_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = rows.type_minutes(feeds.minute_text(spark, sf_dir, spoiled=True))
    good = rows.accepted(typed, "minutes_import", skip_errors=True)
    return rows.from_offset(good, 100).select(*_MINUTE)


# Scalars


def to_date_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.table(spark, sf_dir, "events").select("event_id", "ts", day_of("ts").alias("day"))


def descaled_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = feeds.staged_minutes(spark, sf_dir)
    return staged.select("symbol", "date", *[descaled(price).alias(price) for price in PRICES])


# Keyed operators and merge


def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.distinct_rows(feeds.line_actions(spark, sf_dir), [*KEY, *ACTION])


def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = feeds.staged_minutes(spark, sf_dir).drop("event_type")
    return keyed.latest_per_key(staged, KEY).select(*_MINUTE)


def anti_new_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = feeds.staged_minutes(spark, sf_dir)
    stored = staged.where(F.col("event_type").isin("click", "view"))
    return merging.minutes_delta(staged, stored)


def day_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.day_bars(feeds.minutes(spark, sf_dir)).select(*_MINUTE)


def days_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored days after a merge: stored, then rolled up from minutes, then imported."""
    stored = feeds.order_days(spark, sf_dir, "P")
    minutes = feeds.order_minutes(spark, sf_dir, "F")
    staged = feeds.order_rows(spark, sf_dir, "O")
    return stored.select(*_MINUTE).unionByName(merging.days_delta(minutes, staged, stored))


def action_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.line_actions(spark, sf_dir).where(is_action())


def actions_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The actions that a merge adds: those inside the daily bars before those of separate files."""
    in_bars = feeds.line_bars(spark, sf_dir).withColumn("_seq", F.lit(0).cast("bigint"))
    separate = feeds.order_actions(spark, sf_dir, "F", "O")
    stored = feeds.order_actions(spark, sf_dir, "P")
    return merging.actions_delta(in_bars, separate, stored)


def newest_days_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored days after a merge in which newest rows win: rolled up from minutes, then imported, then stored."""
    stored = feeds.order_days(spark, sf_dir, "P").select(*_MINUTE)
    newest = merging.newest_days(feeds.order_minutes(spark, sf_dir, "F"), feeds.order_rows(spark, sf_dir, "O"))
    return keyed.replaced(stored, keyed.changes(newest, stored, KEY), KEY)


def refreshed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored bars after every third minute of an hour came late; one in five knows nothing of its older minutes."""
    every = feeds.minutes(spark, sf_dir).select("symbol", "day", "date", *PRICES)
    late = F.minute("date") % 3 == 0
    states = bars.day_states(every.where(~late))
    bare = F.dayofmonth("date") % 5 == 0
    stored = states.withColumns({name: F.when(~bare, F.col(name)) for name in bars.SPAN})
    return merging.refreshed_days(stored, every.where(late), every.where(~late)).select(*_MINUTE)


# Adjustment


# The daily feed carries its actions in the rows of the bars, so these read it once and do not join.


def any_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = feeds.line_bars(spark, sf_dir)
    return adjusting.with_actions(feeds.days_of(every), feeds.actions_of(every))


def pair_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    paired = adjustment.with_newer_event(feeds.line_bars(spark, sf_dir))
    names = ["newer_date", "newer_dividend", "newer_split_ratio", "factor"]
    return adjustment.with_factor(paired).select(*KEY, *names)


def bad_dividends(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = feeds.line_bars(spark, sf_dir).withColumn("dividend", F.col("dividend") * 1000)
    found = adjustment.bad_dividends(adjustment.with_newer_event(every))
    return found.select(*KEY, "newer_date", "newer_dividend", "close")


def running_coefficient(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = adjustment.adjusted_days(feeds.line_bars(spark, sf_dir), exact=False)
    return every.select(*KEY, "adjustment_coefficient")


def adjusted_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adjustment.adjusted_days(feeds.line_bars(spark, sf_dir), exact=False)


def adjusted_days_skipping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``adjusted_days``, with dividends a thousand times as large; the bad ones among them are left out."""
    every = feeds.line_bars(spark, sf_dir).withColumn("dividend", F.col("dividend") * 1000)
    return adjustment.adjusted_days(every, skip_errors=True, exact=False)


def adjusted_days_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In decimal arithmetic, the default, for histories whose coefficients have no more digits than it has."""
    return adjustment.adjusted_days(feeds.split_bars(spark, sf_dir), exact=True)


def exact_within_one_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether decimal and double arithmetic differ by at most one unit, for each daily bar with all its actions."""
    every = feeds.line_bars(spark, sf_dir)
    return _near(*[adjustment.adjusted_days(every, exact=mode) for mode in (True, False)])


def _near(one: DataFrame, other: DataFrame) -> DataFrame:
    """Whether all values of two adjustments differ by at most one unit, for each day."""
    names = [name for name in one.columns if name not in KEY]
    joined = one.join(other.withColumnsRenamed({name: f"other_{name}" for name in names}), KEY)
    near = [F.abs(F.col(name) - F.col(f"other_{name}")) <= 1 for name in names]
    return joined.select(*KEY, F.forall(F.array(*near), lambda each: each).alias("near"))


def exact_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``adjusted_days_exact``, by the two-level form."""
    return adjustment.adjusted_by_segment(feeds.split_bars(spark, sf_dir), exact=True)


def segments_within_one_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the two-level form in double arithmetic differs from the one-level form by at most one unit."""
    every = feeds.line_bars(spark, sf_dir)
    return _near(adjustment.adjusted_by_segment(every, exact=False), adjustment.adjusted_days(every, exact=False))


def placed_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The actions of all orders on the days of the line bars: where they are, move to, or are lost."""
    every = feeds.separate_actions(spark, sf_dir)
    return adjusting.placed_actions(feeds.line_bars(spark, sf_dir), every)


def adjusted_next_bar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily bars adjusted by the actions of all orders, which move to the next day with a bar."""
    every = feeds.separate_actions(spark, sf_dir)
    return adjusting.adjust(feeds.line_bars(spark, sf_dir), every, skip_errors=True, exact=False, lost="next_bar")


def adjusted_incrementally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjusted prices of a run before some symbols had their last bars, brought up to date by those symbols alone."""
    every = feeds.line_bars(spark, sf_dir)
    number = F.substr("symbol", F.lit(2)).cast("int")
    before = every.where((number % 3 != 0) | (F.col("date") < F.lit("1997-06-01").cast("date")))
    made_of = [adjusting.fingerprints(feeds.days_of(rows), feeds.actions_of(rows)) for rows in (before, every)]
    symbols = adjusting.changed_symbols(*made_of)
    stored = adjustment.adjusted_days(before, exact=False)
    anew = adjustment.adjusted_days(adjusting.of_symbols(every, symbols), exact=False)
    return keyed.replaced(stored, keyed.changes(anew, stored, KEY), KEY)


# Views and lookups


def _adjusted_before_2001(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All daily bars, and the adjusted ones of a run made before the bars of 2001 came in."""
    every = feeds.line_bars(spark, sf_dir)
    before = every.where(F.col("date") < F.lit("2001-01-01").cast("date"))
    return feeds.days_of(every), adjustment.adjusted_days(before, exact=False)


def days_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.days_view(*_adjusted_before_2001(spark, sf_dir))


def _minutes_and_adjusted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    minutes = feeds.minutes(spark, sf_dir)
    actions = feeds.event_actions(spark, sf_dir)
    return minutes, adjusting.adjust(bars.day_bars(minutes), actions, skip_errors=True, exact=False)


def minutes_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.minutes_view(*_minutes_and_adjusted(spark, sf_dir))


def get_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.get_day(*_adjusted_before_2001(spark, sf_dir), "S0", "1996-12-02")


def get_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.get_minute(*_minutes_and_adjusted(spark, sf_dir), "U8", "2024-01-01 00:00:00")


def get_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many days at once: those of all orders, of symbols that have bars and of some that have none, with repetitions."""
    keys = feeds.order_actions(spark, sf_dir, "P", "F", "O")
    return views.get_days(*_adjusted_before_2001(spark, sf_dir), keys)


def get_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many minutes at once: those of all events, and for errors the minute an hour later."""
    return views.get_minutes(*_minutes_and_adjusted(spark, sf_dir), feeds.asked_minutes(spark, sf_dir))


# Everything from staged rows to the daily view


def price_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = feeds.order_days(spark, sf_dir, "P")
    delta = merging.days_delta(feeds.order_minutes(spark, sf_dir, "F"), feeds.order_rows(spark, sf_dir, "O"), stored)
    days = stored.select(*_MINUTE).unionByName(delta)
    in_bars = feeds.order_actions(spark, sf_dir, "P").withColumn("symbol", F.translate("symbol", "S", "C"))
    separate = feeds.order_actions(spark, sf_dir, "F", "O").withColumn("symbol", F.translate("symbol", "S", "C"))
    nothing = in_bars.where(F.lit(False))
    actions = merging.actions_delta(in_bars, separate, nothing)
    return views.days_view(days, adjusting.adjust(days, actions, skip_errors=True, exact=False))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        parse_days, parse_minutes, parse_adjustments, reject_rows, skip_errors, import_counts, min_date_filter,
        offset_rows, to_date_day, descaled_prices, distinct_rows, dedup_latest, anti_new_keys, day_bars, days_merged,
        newest_days_merged, refreshed_days, adjusted_incrementally,
        action_filter, actions_merged, any_left_join, pair_factors, bad_dividends, running_coefficient, adjusted_days,
        adjusted_days_skipping, adjusted_days_exact, exact_within_one_unit, exact_by_segment, segments_within_one_unit,
        placed_actions, adjusted_next_bar, days_view, minutes_view, get_day, get_minute, get_days, get_minutes,
        price_history,
    )
}
