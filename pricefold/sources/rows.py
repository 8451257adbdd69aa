"""From text columns to typed rows: parsing, rejecting, the minimum date, file order.

A typed row keeps its text in the struct ``_raw``, which plans that do not show it do not build, and its place in
reading order in ``_position``: increasing within a file and unique, but not consecutive.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricefold.functions.scalars import parsed_date, parsed_time, scaled, scaled_reciprocal
from pricefold.schema import ACTION, MINIMUM_DATE, PRICES, columns
from pricefold.sources.csv_files import ACTION_FIELDS, BLOCK, DAY_FIELDS, FILE, MINUTE_FIELDS

RAW, POSITION = "_raw", "_position"


# All numbers of a row, parsed by one expression over an array: written out for each column, they would make generated code
# that the JVM finds too long to compile.
_NUMBERS = "_numbers"


def _typed(text: DataFrame, raw: list[str], parsed: dict[str, Column], numbers: list[str]) -> DataFrame:
    """Typed rows: ``parsed``, and the fixed-point values of the columns ``numbers``, by the names of ``parsed`` for None."""
    raw_struct = F.struct(*[F.col(f"`{name}`").alias(name) for name in raw]).alias(RAW)
    origin = [name for name in (FILE, BLOCK) if name in text.columns]
    position = F.monotonically_increasing_id().alias(POSITION)
    texts = F.array(*[F.col(f"`{name}`") for name in numbers])
    place = iter(range(len(numbers)))
    columns_ = [
        (F.col(_NUMBERS)[next(place)] if column is None else column).alias(name) for name, column in parsed.items()
    ]
    return text.withColumn(_NUMBERS, F.transform(texts, scaled)).select(*columns_, raw_struct, position, *origin)


def type_days(text: DataFrame) -> DataFrame:
    parsed = {"symbol": F.col("ticker"), "date": parsed_date("date")}
    parsed |= dict.fromkeys([*PRICES, *ACTION])
    return _typed(text, DAY_FIELDS, parsed, [*PRICES, "ex-dividend", "split_ratio"])


def type_minutes(text: DataFrame) -> DataFrame:
    parsed = {"symbol": F.col("symbol"), "date": parsed_time("date")}
    parsed |= dict.fromkeys(PRICES)
    return _typed(text, ["symbol", *MINUTE_FIELDS], parsed, PRICES)


def type_adjustments(text: DataFrame) -> DataFrame:
    parsed = {
        "symbol": F.col("symbol"),
        "date": parsed_date("`Date(ex)`", separator="."),
        "dividend": None,
        "split_ratio": scaled_reciprocal("Split"),
    }
    return _typed(text, ["symbol", *ACTION_FIELDS], parsed, ["RegularDividend$"])


TYPERS = {"days_import": type_days, "minutes_import": type_minutes, "adjustments_import": type_adjustments}


def is_rejected(table: str) -> Column:
    """True where a needed field is missing or did not parse."""
    return reduce(lambda either, name: either | F.col(name).isNull(), columns(table)[1:], F.col("symbol").isNull())


def is_recent() -> Column:
    return F.col("date") >= F.lit(MINIMUM_DATE).cast("date")


def rejected(typed: DataFrame, table: str) -> DataFrame:
    """The text of the rows that did not parse."""
    return typed.where(is_rejected(table)).select(f"{RAW}.*")


def accepted(typed: DataFrame, table: str, skip_errors: bool) -> DataFrame:
    """Rows that parsed and are not too old. Without ``skip_errors`` a row that did not parse fails the job."""
    if skip_errors:
        on_error = F.lit(False)
    else:
        on_error = F.raise_error(F.concat(F.lit("row does not parse: "), F.to_json(RAW))).cast("boolean")
    # One CASE, so that no not-null check derived from the date test can drop a bad row before it is reported.
    keep = F.when(is_rejected(table), on_error).otherwise(is_recent())
    # Always true. A filter that reads the position stays above the projection, so rows are parsed once, not twice.
    return typed.where(keep & (F.col(POSITION) >= 0))


def counts(table: str) -> dict[str, Column]:
    """Counts over typed rows, as named aggregates."""
    bad = is_rejected(table)
    return {
        "accepted": F.count_if(~bad & is_recent()),
        "rejected": F.count_if(bad),
        "too_old": F.count_if(~bad & ~is_recent()),
    }


def from_offset(
    rows: DataFrame, offset: int | None, counted_from: DataFrame | None = None, max_blocks: int = 100_000
) -> DataFrame:
    """Keep accepted rows from the ``offset``-th of their file on, counting from 1; None and 0 keep all.

    Rows are counted per file block first and only the block counts are put in order, so no task sees a whole file.
    The block counts are broadcast when their number, known from the scan's partitions and files, is small.
    ``counted_from`` may name an equal plan to count, where ``rows`` itself carries something to run only once.
    """
    if not offset:
        return rows
    # Consecutive within a block, since one task reads a block from start to end.
    number = F.monotonically_increasing_id()
    counted = (rows if counted_from is None else counted_from).withColumn("_number", number)
    blocks = counted.groupBy(FILE, BLOCK).agg(F.count("*").alias("_rows"), F.min("_number").alias("_first"))
    before = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        FILE, BLOCK, (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift")
    )
    if len(rows.inputFiles()) + rows.rdd.getNumPartitions() <= max_blocks:
        starts = F.broadcast(starts)
    numbered = rows.withColumn("_number", number).join(starts, [FILE, BLOCK])
    kept = numbered.where(F.col("_number") + F.col("_shift") >= offset)
    return kept.select(*rows.columns)
