"""Relations of the price store: column types, keys and fixed values.

Prices, dividends, split ratios and coefficients are fixed-point ``bigint`` with four decimals
(28.75 is stored as 287500). No stored column is nullable in meaning: a missing value is 0.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values.
SCALE = 10_000
NO_SPLIT = 10_000
NO_DIVIDEND = 0
MINIMUM_DATE = "1970-01-01"

KEY = ["symbol", "date"]
PRICES = ["open", "high", "low", "close"]
ACTION = ["dividend", "split_ratio"]
ADJUSTED = [f"adjusted_{price}" for price in PRICES]
VIEW = KEY + PRICES + ADJUSTED

_LONG = T.LongType()
_TYPES = {"symbol": T.StringType(), "date": T.DateType(), "day": T.DateType(), "month": T.DateType()}


def _struct(*names: str, **overrides: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, overrides.get(name) or _TYPES.get(name, _LONG)) for name in names])


# Data columns of the seven stored tables, in declared order.
TABLES = {
    "minutes_import": _struct(*KEY, *PRICES, date=T.TimestampNTZType()),
    "days_import": _struct(*KEY, *PRICES, *ACTION),
    "adjustments_import": _struct(*KEY, *ACTION),
    "minutes": _struct("symbol", "day", "date", *PRICES, date=T.TimestampNTZType()),
    "days": _struct(*KEY, *PRICES),
    "adjustments": _struct(*KEY, *ACTION),
    "days_adjusted": _struct(*KEY, "adjustment_coefficient", *ADJUSTED),
}

# Columns on disk that reads leave out: why a row's newer dividend was not applied, and the minutes that a bar spans.
BAD = "bad_dividend"
HIDDEN = {
    "days_adjusted": {BAD: _struct("newer_date", "newer_dividend", "close", newer_date=T.DateType())},
    "days": {"first_minute": T.TimestampNTZType(), "last_minute": T.TimestampNTZType()},
}

STAGING = ["minutes_import", "days_import", "adjustments_import"]


def columns(table: str) -> list[str]:
    return TABLES[table].fieldNames()


def stored(table: str) -> T.StructType:
    """Columns on disk: the data columns plus the ones the storage layout needs.

    Staging rows carry ``_seq`` (import order, unique per table) and live in one directory per import;
    keyed tables live in one directory per month.
    """
    extra = _struct("_seq", "batch") if table in STAGING else _struct("month")
    return T.StructType(TABLES[table].fields + extra.fields)
