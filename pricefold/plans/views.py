"""Read side: raw prices beside adjusted ones, and lookups by key."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricefold.functions.scalars import day_of, descaled, month_of, truncated
from pricefold.operators.keyed import any_left_join
from pricefold.schema import ADJUSTED, KEY, PRICES, SCALE, VIEW


def _keys(left: DataFrame, right: DataFrame, keys: list[str]) -> list[str]:
    """Join on the storage month too where both sides have it, so a filter on it prunes both scans."""
    return [*keys, "month"] if "month" in left.columns and "month" in right.columns else keys


def joined_days(days: DataFrame, adjusted: DataFrame) -> DataFrame:
    """Daily bars with their stored adjusted prices; 0 where a day has none."""
    right = adjusted.drop("adjustment_coefficient")
    return any_left_join(days, right, _keys(days, right, KEY))


def joined_minutes(minutes: DataFrame, adjusted: DataFrame) -> DataFrame:
    """Minute bars with prices adjusted by the stored (truncated) coefficient of their day; 0 where there is none."""
    right = adjusted.drop(*ADJUSTED).withColumnRenamed("date", "day")
    joined = any_left_join(minutes, right, _keys(minutes, right, ["symbol", "day"]))
    coefficient = F.col("adjustment_coefficient")
    return joined.withColumns(
        {name: truncated(F.col(price) * coefficient / SCALE) for price, name in zip(PRICES, ADJUSTED)}
    )


def _shown(view: DataFrame) -> DataFrame:
    """The columns of a view; stored tables also show the month, so that readers can name the months they need."""
    return view.select(*VIEW, *[name for name in view.columns if name == "month"])


def days_view(days: DataFrame, adjusted: DataFrame) -> DataFrame:
    return _shown(joined_days(days, adjusted))


def minutes_view(minutes: DataFrame, adjusted: DataFrame) -> DataFrame:
    return _shown(joined_minutes(minutes, adjusted))


def _described(found: DataFrame) -> DataFrame:
    prices = [descaled(name).alias(name) for name in [*PRICES, *ADJUSTED]]
    return found.select("symbol", F.col("date").cast("string").alias("date"), *prices)


def _at(view: DataFrame, symbol: str, moment, day: date) -> DataFrame:
    found = view.where((F.col("symbol") == F.lit(symbol)) & (F.col("date") == moment))
    if "month" in view.columns:
        found = found.where(F.col("month") == F.lit(day.replace(day=1)))
    return found


def get_day(days: DataFrame, adjusted: DataFrame, symbol: str, day: str) -> DataFrame:
    """The daily bar of a symbol and ``YYYY-MM-DD`` day as decimals; no row when there is none."""
    when = date.fromisoformat(day)
    return _described(_at(joined_days(days, adjusted), symbol, F.lit(when), when))


def get_minute(minutes: DataFrame, adjusted: DataFrame, symbol: str, minute: str) -> DataFrame:
    """The minute bar of a symbol and ``YYYY-MM-DD hh:mm:ss`` time as decimals; no row when there is none."""
    when = datetime.fromisoformat(minute)
    moment = F.lit(when.isoformat(sep=" ")).cast("timestamp_ntz")
    view = joined_minutes(minutes, adjusted)
    found = _at(view, symbol, moment, when.date()).where(F.col("day") == F.lit(when.date()))
    return _described(found)


def wanted_keys(keys: DataFrame, kind: str) -> DataFrame:
    """The distinct symbols and dates asked for, with their days and months; ``kind`` is the type of a date.

    A key without a symbol or a date finds nothing, so it is not among them.
    """
    dated = keys.select("symbol", F.col("date").cast(kind).alias("date")).where("symbol is not null and date is not null")
    return dated.distinct().select("*", day_of("date").alias("day"), month_of(day_of("date")).alias("month"))


def _only(rows: DataFrame, wanted: DataFrame, names: list[str]) -> DataFrame:
    """The rows that a lookup needs; where the storage month is there, it is part of the key and prunes the scan."""
    return rows.join(wanted, [name for name in names if name in rows.columns], "left_semi")


def _found(keys: DataFrame, view: DataFrame, kind: str, few: bool) -> DataFrame:
    """One row for each key asked for, in decimals, ``found`` telling whether there is a bar."""
    prices = [*PRICES, *ADJUSTED]
    asked = keys.select("symbol", F.col("date").cast(kind).alias("date"))
    bars = view.select(*KEY, F.lit(True).alias("found"), *prices)
    joined = asked.join(F.broadcast(bars) if few else bars, KEY, "left")
    return joined.select(
        "symbol", F.col("date").cast("string").alias("date"), F.coalesce("found", F.lit(False)).alias("found"),
        *[descaled(name).alias(name) for name in prices],
    )


def get_days(days: DataFrame, adjusted: DataFrame, keys: DataFrame, few: bool = False) -> DataFrame:
    """The daily bars of many keys at once: symbol, date, found, and the prices as decimals.

    ``keys`` has a symbol and a date; other columns play no part. Each of its rows gives one row, repeated ones too. Where
    there is no bar, or the key holds a null, ``found`` is false and the prices are null.

    Both tables are first reduced to the keys, so a bar that nobody asked for is never shuffled if ``few`` says that the
    distinct keys are few enough to be broadcast. Otherwise everything meets by shuffles, and a key that is asked for very
    often is a skewed left side, which adaptive execution splits.
    """
    wanted = wanted_keys(keys, "date")
    wanted = F.broadcast(wanted) if few else wanted
    names = [*KEY, "month"]
    view = joined_days(_only(days, wanted, names), _only(adjusted, wanted, names))
    return _found(keys, view, "date", few)


def get_minutes(minutes: DataFrame, adjusted: DataFrame, keys: DataFrame, few: bool = False) -> DataFrame:
    """As ``get_days`` for minute bars; a key's date is a time, to the second."""
    wanted = wanted_keys(keys, "timestamp_ntz")
    days = wanted.select("symbol", F.col("day").alias("date"), "month").distinct()
    if few:
        wanted, days = F.broadcast(wanted), F.broadcast(days)
    view = joined_minutes(_only(minutes, wanted, [*KEY, "day", "month"]), _only(adjusted, days, [*KEY, "month"]))
    return _found(keys, view, "timestamp_ntz", few)
