"""Column functions for the text and fixed-point formats of price files.

All of them are built-in expressions, so they stay inside generated JVM code, and none of them depends on
the session time zone: timestamps are naive (``timestamp_ntz``).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricefold.schema import SCALE

# 15 integer digits cover every price that fits a scaled bigint, which leaves 23 decimals of the 38 there are.
_WIDE = "decimal(38,23)"
# Leaves the quotient below enough decimals that rounding it never reaches the next integer.
_RATIO = "decimal(24,18)"
# Times a whole number of nine digits this is exact.
_FACTOR = "decimal(28,23)"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# Numbers of at most 14 digits, and plain digits of any number of decimals. Both are matched before they are parsed, since
# parsing what is no number is slow.
_SHORT = r"^[0-9]{1,8}(\.[0-9]{0,6})?([eE](-[0-9]|\+?[0-3]))?$"
_PLAIN = r"^[0-9]{1,10}(\.[0-9]*)?$"
# More than the error of a double and its product, which is below 2.3e-16.
_ABOVE = 1.0 + 2.0**-51


def scaled(text: Column | str) -> Column:
    """Number text to a fixed-point integer, truncated; NULL when it is no number or negative.

    Doubles decide almost all texts. The scaled value of a number of at most 14 digits is whole, or further from whole than
    1e-14 of itself; so a double raised by more than its error, 4.4e-16 of it, has the right whole part. Longer plain
    digits are cut after the fourth decimal first. All other text takes 38-digit arithmetic.
    """
    trimmed = F.trim(_column(text))
    point = F.instr(trimmed, ".")
    cut = F.when(point > 0, F.substr(trimmed, F.lit(1), point + 4)).otherwise(trimmed)

    def parsed(number: Column) -> Column:
        return F.floor(number.try_cast("double") * F.lit(float(SCALE)) * F.lit(_ABOVE))

    return (
        F.when(trimmed.rlike(_SHORT), parsed(trimmed))
        .when(trimmed.rlike(_PLAIN), parsed(cut))
        .otherwise(_scaled_widely(trimmed))
    )


def _scaled_widely(trimmed: Column) -> Column:
    # Powers of ten of five digits are beyond every number that fits, and beyond the cast.
    number = F.when(~trimmed.rlike(r"[eE][+-]?\d{5}"), trimmed.try_cast(_WIDE))
    # Truncate before multiplying: a plain product would first round to a smaller scale.
    whole = F.floor(F.greatest(number, F.lit(0).cast(_WIDE)), F.lit(4)) * F.lit(SCALE)
    return F.when(number > F.lit(Decimal("-0.0001")), whole.try_cast("bigint"))


def scaled_reciprocal(text: Column | str) -> Column:
    """``1 / number`` as a fixed-point integer, truncated; NULL when there is no such positive value.

    For numbers from 0.0001 to 10000 the double quotient is off by one at most, and the exact product with the number,
    of which 23 decimals count, tells which way. Above, the result is 0. Smaller numbers count with 18 decimals.
    """
    trimmed = F.trim(_column(text))
    about, factor = trimmed.try_cast("double"), trimmed.try_cast(_FACTOR)
    guess = F.floor(F.lit(float(SCALE)) / about).cast("bigint")

    def fits(quotient: Column) -> Column:
        return quotient.cast("decimal(9,0)") * factor <= SCALE

    exact = F.when(fits(guess + 1), guess + 1).when(fits(guess), guess).otherwise(guess - 1)
    number = trimmed.try_cast(_RATIO)
    small = F.floor(F.lit(SCALE).cast("decimal(5,0)") / F.when(number > 0, number)).try_cast("bigint")
    large = trimmed.try_cast("decimal(38,0)") > SCALE
    # Beyond the digits that are kept, only the size matters.
    in_range = (factor >= F.lit(Decimal("0.0001"))) & (factor <= SCALE)
    return F.when(in_range, exact).when(large, F.lit(0).cast("bigint")).otherwise(small)


def descaled(value: Column | str) -> Column:
    """Fixed-point integer to its exact decimal value."""
    return (_column(value).cast("decimal(20,0)") * F.lit(Decimal("0.0001"))).cast("decimal(20,4)")


def parsed_date(text: Column | str, separator: str = "-") -> Column:
    """Year-month-day text to a date; month and day may have one digit, the year must have four."""
    value = _column(text)
    wanted = value.rlike(r"^\d{4}S\d{1,2}S\d{1,2}$".replace("S", f"[{separator}]"))
    return F.when(wanted, F.translate(value, separator, "-").try_cast("date"))


def parsed_time(text: Column | str) -> Column:
    """``year-month-day hour:minute:second`` text to a naive timestamp."""
    value = _column(text)
    wanted = value.rlike(r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$")
    return F.when(wanted, value.try_cast("timestamp_ntz"))


def day_of(time: Column | str) -> Column:
    return _column(time).cast("date")


def month_of(day: Column | str) -> Column:
    return F.trunc(_column(day), "month")


def truncated(value: Column | str) -> Column:
    """Double to integer, towards zero."""
    return _column(value).cast("bigint")


def is_action(dividend: Column | str = "dividend", split_ratio: Column | str = "split_ratio") -> Column:
    """True for a row that carries a dividend or a split."""
    return (_column(dividend) != 0) | (_column(split_ratio) != SCALE)
