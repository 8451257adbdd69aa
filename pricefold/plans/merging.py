"""Deltas that a merge adds to the keyed tables.

Every function returns only the rows whose key the target does not hold yet, so a merge can be repeated.
Inputs may be the whole tables; rows of the same key in one staging table are settled by import order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricefold.functions.scalars import day_of, is_action
from pricefold.operators.bars import SPAN, day_bars, day_states, merged_states
from pricefold.operators.keyed import STORED, winners
from pricefold.schema import ACTION, KEY, PRICES, columns


def staged_days(staged: DataFrame) -> DataFrame:
    """The distinct symbols and days of staged rows; small where little is new, and then broadcast by the optimizer."""
    return staged.select("symbol", day_of("date").alias("day")).distinct()


def of_days(rows: DataFrame, days: DataFrame, day: str) -> DataFrame:
    """The stored rows of the given symbols and days, so that a merge shuffles those and not whole months."""
    wanted = days.select(F.col("symbol"), F.col("day").alias(day)) if day != "day" else days
    return rows.join(wanted, ["symbol", day], "left_semi")


def _columns(table: str, spans: bool = False) -> list[str]:
    return [*columns(table), *(SPAN if spans and table == "days" else [])]


def _without_span(bars: DataFrame) -> DataFrame:
    """Bars from elsewhere, in the columns of bars from minutes."""
    return bars.withColumns({name: F.lit(None).cast("timestamp_ntz") for name in SPAN})


def _ranked_days(minutes: DataFrame, staged: DataFrame, spans: bool) -> list[tuple[DataFrame, Column]]:
    """Bars rolled up from minutes, above imported ones, of which the last imported is first."""
    rolled, imported = day_states(minutes) if spans else day_bars(minutes), staged.select(*KEY, *PRICES, "_seq")
    imported = _without_span(imported) if spans else imported
    names = [*KEY, *PRICES, *(SPAN if spans else [])]
    return [
        (rolled.select(*names), F.lit(STORED - 1)),
        (imported.select(*names, "_seq"), F.col("_seq")),
    ]


def _ranked_actions(staged_days: DataFrame, staged_actions: DataFrame) -> list[tuple[DataFrame, Column]]:
    """Actions inside the daily bars, above those from separate files; of each the last imported is first."""
    in_bars, separate = (
        staged.where(is_action()).select(*KEY, *ACTION, "_seq") for staged in (staged_days, staged_actions)
    )
    return [(in_bars, F.col("_seq")), (separate, F.col("_seq") - STORED)]


def minutes_delta(staged: DataFrame, existing: DataFrame) -> DataFrame:
    rows = winners([(staged.select(*KEY, *PRICES, "_seq"), F.col("_seq"))], KEY, existing)
    return rows.withColumn("day", day_of("date")).select(*columns("minutes"))


def days_delta(minutes: DataFrame, staged: DataFrame, existing: DataFrame, spans: bool = False) -> DataFrame:
    """A stored day beats a bar rolled up from minutes, which beats an imported daily bar.

    A stored day is not refreshed by later minutes. With ``spans`` the bars also tell which minutes they span.
    """
    return winners(_ranked_days(minutes, staged, spans), KEY, existing).select(*_columns("days", spans))


def actions_delta(staged_days: DataFrame, staged_actions: DataFrame, existing: DataFrame) -> DataFrame:
    """A stored action beats one inside the daily bars, which beats one from a separate file. Empty ones are dropped."""
    return winners(_ranked_actions(staged_days, staged_actions), KEY, existing).select(*columns("adjustments"))


# Newest rows win: what staged rows say of their keys, whatever is stored.


def newest_minutes(staged: DataFrame) -> DataFrame:
    return minutes_delta(staged, _nothing(staged))


def newest_days(minutes: DataFrame, staged: DataFrame, spans: bool = False) -> DataFrame:
    """The bar rolled up from a day's minutes where there are any, else the daily bar that was imported last."""
    return days_delta(minutes, staged, _nothing(staged), spans)


def newest_actions(staged_days: DataFrame, staged_actions: DataFrame) -> DataFrame:
    return actions_delta(staged_days, staged_actions, _nothing(staged_days))


def _nothing(staged: DataFrame) -> DataFrame:
    return staged.select(*KEY).where(F.lit(False))


# Refresh: bars take in minutes that come later.


def refreshed_days(stored: DataFrame, added: DataFrame, older: DataFrame) -> DataFrame:
    """The bars of the days that ``added`` minutes fall on, as if all minutes of these days were rolled up.

    ``stored`` bars that know the minutes they span take in the added ones, without a look at the older minutes. A bar
    from elsewhere, which says nothing of minutes, is rolled up from the day's ``older`` minutes, which hold the added
    ones or not.
    """
    days = staged_days(added).withColumnRenamed("day", "date")
    known = stored.where(F.col("last_minute").isNotNull()).join(days, KEY, "left_semi")
    bare = stored.where(F.col("last_minute").isNull()).join(days, KEY, "left_semi").select("symbol", F.col("date").alias("day"))
    names = [*KEY, *PRICES, *SPAN]
    before = day_states(older.join(bare, ["symbol", "day"], "left_semi"))
    return merged_states(known.select(*names), before.select(*names), day_states(added).select(*names))
