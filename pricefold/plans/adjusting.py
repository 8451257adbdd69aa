"""The full adjustment: daily bars and corporate actions to adjusted daily prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricefold.operators.adjustment import adjusted_days
from pricefold.operators.keyed import any_left_join
from pricefold.schema import ACTION, KEY, NO_SPLIT, PRICES, SCALE

#: What becomes of an action on a day without a bar.
LOST = ("drop", "next_bar")


def placed_actions(days: DataFrame, actions: DataFrame) -> DataFrame:
    """Each action with ``bar``: the first day of the symbol, from its own on, that has a bar; null where none follows.

    Bars and actions of a symbol are put in one order, newest first, and the last bar seen is carried along; so there is
    no join on a range of days. Both are unique by symbol and day, which bounds the group of a symbol by the calendar.
    """
    none = F.lit(None).cast("bigint")
    bars = days.select(*KEY, F.col("date").alias("bar"), *[none.alias(name) for name in ACTION], F.lit(0).alias("_kind"))
    events = actions.select(*KEY, F.lit(None).cast("date").alias("bar"), *ACTION, F.lit(1).alias("_kind"))
    newest_first = Window.partitionBy("symbol").orderBy(F.desc("date"), "_kind")
    carried = F.last("bar", ignorenulls=True).over(newest_first.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return bars.unionByName(events).withColumn("bar", carried).where("_kind = 1").select(*KEY, *ACTION, "bar")


def combined_actions(placed: DataFrame) -> DataFrame:
    """One action for each bar from those placed there, as if all had happened on its day.

    Split ratios multiply. Dividends add up, each in terms of a share before the first of the splits, which is what the
    prior close is the price of; so one that comes after a split of 2 counts twice. Results are truncated after each
    step. An action of a ratio 0, which stands for none, is one of ratio 1.
    """
    events = F.sort_array(F.collect_list(F.struct("date", *ACTION)))
    zero = F.struct(F.lit(0).cast("bigint").alias("dividend"), F.lit(NO_SPLIT).cast("bigint").alias("split_ratio"))

    def scaled(one, other):
        wide = one.cast("decimal(19,0)") * other.cast("decimal(19,0)")
        return F.floor(wide / F.lit(SCALE).cast("decimal(5,0)")).cast("bigint")

    def step(so_far, event):
        ratio = F.when(event.split_ratio == 0, F.lit(NO_SPLIT)).otherwise(event.split_ratio)
        return F.struct(
            (so_far.dividend + scaled(event.dividend, so_far.split_ratio)).alias("dividend"),
            scaled(so_far.split_ratio, ratio).alias("split_ratio"),
        )

    grouped = placed.where("bar is not null").groupBy("symbol", F.col("bar").alias("date")).agg(events.alias("events"))
    return grouped.select(*KEY, F.aggregate("events", zero, step).alias("action")).select(*KEY, "action.*")


def moved_actions(days: DataFrame, actions: DataFrame) -> DataFrame:
    """The actions on days without a bar: their own columns, and ``bar`` they move to, null where they are lost."""
    return placed_actions(days, actions).where("bar is null or bar <> date")


def with_actions(days: DataFrame, actions: DataFrame, by_symbol: bool = False, lost: str = "drop") -> DataFrame:
    """Daily bars with the action of the same day, 0 where there is none.

    An action on a day without a bar is lost; with ``lost="next_bar"`` it counts as one of the symbol's next day with a
    bar, and is lost only where there is none.

    ``by_symbol`` deals out both sides by symbol alone, as the adjustment needs the bars. It saves a shuffle of the bars
    in a plan that runs within ``pricefold.session.joins_on_part_of_keys``, and costs one elsewhere.
    """
    if lost not in LOST:
        raise ValueError(f"unknown treatment of actions without a bar: {lost}")
    bars, events = days.select(*KEY, *PRICES), actions.select(*KEY, *ACTION)
    if lost == "next_bar":
        events = combined_actions(placed_actions(bars, events))
    if by_symbol:
        bars, events = bars.repartition("symbol"), events.repartition("symbol")
    return any_left_join(bars, events, KEY)


def adjust(
    days: DataFrame, actions: DataFrame, skip_errors: bool = False, exact: bool = True, lost: str = "drop"
) -> DataFrame:
    return adjusted_days(with_actions(days, actions, lost=lost), skip_errors, exact)


# Incremental adjustment: what the adjusted prices of a symbol were made of.


def fingerprints(days: DataFrame, actions: DataFrame) -> DataFrame:
    """For each symbol, the number of its bars and actions and the sum of their hashes.

    Rows are combined before the shuffle, which has one row for each symbol and task, and nothing is sorted.
    """
    bars = days.select("symbol", F.xxhash64(F.lit("bar"), *KEY, *PRICES).alias("hash"))
    events = actions.select("symbol", F.xxhash64(F.lit("action"), *KEY, *ACTION).alias("hash"))
    return bars.unionByName(events).groupBy("symbol").agg(
        F.count("*").alias("rows"), F.sum(F.col("hash").cast("decimal(38,0)")).alias("hashes")
    )


def changed_symbols(before: DataFrame, now: DataFrame) -> DataFrame:
    """The symbols whose fingerprint is not what it was before, new ones among them."""
    return now.join(before, ["symbol", "rows", "hashes"], "left_anti").select("symbol")


def of_symbols(rows: DataFrame, symbols: DataFrame) -> DataFrame:
    """The rows of some symbols; few symbols are broadcast by the optimizer, so that no other row is shuffled."""
    return rows.join(symbols, "symbol", "left_semi")
