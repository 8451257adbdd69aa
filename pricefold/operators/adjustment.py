"""Back-adjustment of daily prices for splits and dividends.

Rows of one symbol are read from the newest day to the oldest. Each row is scaled by the running product of the
factors of all newer rows' events:

    split factor     1 / (newer split ratio)
    dividend factor  1 - newer dividend / own close

so an event changes every row older than its own day, and the newest row keeps its prices.

One symbol is one window group. That group is bounded for daily bars: the input is unique by symbol and day, so a symbol
has at most one row per calendar day, whatever the size of the table. For longer series the two-level form cuts symbols
into segments of time: what is newer than a segment comes to it as one carried row and one carried coefficient, so the
rows of one symbol are spread over as many tasks as it has segments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricefold.operators.decimal_fold import CARRIED, fold_batches, last_coefficients
from pricefold.schema import ADJUSTED, BAD, KEY, NO_DIVIDEND, NO_SPLIT, PRICES, SCALE


def _newest_first() -> WindowSpec:
    return Window.partitionBy("symbol").orderBy(F.desc("date"))


def with_newer_event(rows: DataFrame) -> DataFrame:
    """Add the date, dividend and split ratio of the next newer day of the symbol.

    ``rows`` holds daily bars with ``dividend`` and ``split_ratio``, where 0 means none. The added columns use the
    neutral values (0 and 10000) for the newest day.
    """
    newest_first = _newest_first()
    split = F.when(F.col("split_ratio") == 0, NO_SPLIT).otherwise(F.col("split_ratio"))
    return rows.withColumns(
        {
            "newer_date": F.lag("date").over(newest_first),
            "newer_dividend": F.lag("dividend", 1, NO_DIVIDEND).over(newest_first),
            "newer_split_ratio": F.lag(split, 1, NO_SPLIT).over(newest_first),
        }
    )


def is_bad_dividend() -> Column:
    """True where the newer dividend would leave nothing, or less, of this row's close."""
    return (F.col("newer_dividend") != NO_DIVIDEND) & (F.col("newer_dividend") >= F.col("close"))


def bad_dividends(paired: DataFrame) -> DataFrame:
    return paired.where(is_bad_dividend())


def with_checked_dividend(paired: DataFrame, skip_errors: bool) -> DataFrame:
    """Replace a bad newer dividend by none, or fail the job that reads it."""
    if skip_errors:
        on_error = F.lit(NO_DIVIDEND)
    else:
        message = F.format_string(
            "dividend not below the prior close: symbol %s, close of %s, dividend of %s",
            F.col("symbol"),
            F.col("date").cast("string"),
            F.col("newer_date").cast("string"),
        )
        on_error = F.raise_error(message).cast("bigint")
    checked = F.when(is_bad_dividend(), on_error).otherwise(F.col("newer_dividend"))
    return paired.withColumn("newer_dividend", checked)


def with_bad_dividend(paired: DataFrame) -> DataFrame:
    """Add a struct that tells of a bad newer dividend, null where there is none."""
    return paired.withColumn(BAD, F.when(is_bad_dividend(), F.struct("newer_date", "newer_dividend", "close")))


def with_factor(paired: DataFrame) -> DataFrame:
    """Add each row's own factor as a double; 1 where the newer row has no event."""
    split = F.when(F.col("newer_split_ratio") != NO_SPLIT, F.lit(float(SCALE)) / F.col("newer_split_ratio"))
    dividend = F.when(F.col("newer_dividend") != NO_DIVIDEND, 1 - F.col("newer_dividend") / F.col("close"))
    one = F.lit(1.0)
    return paired.withColumn("factor", F.coalesce(split, one) * F.coalesce(dividend, one))


def with_coefficient(factors: DataFrame) -> DataFrame:
    """Add the running product of the factors, newest day first."""
    newer = _newest_first().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return factors.withColumn("coefficient", F.product("factor").over(newer))


def _adjusted_native(paired: DataFrame) -> DataFrame:
    return _truncated(with_coefficient(with_factor(paired)), paired)


def _truncated(rows: DataFrame, paired: DataFrame) -> DataFrame:
    prices = [F.floor(F.col(price) * F.col("coefficient")).alias(name) for price, name in zip(PRICES, ADJUSTED)]
    coefficient = F.floor(F.col("coefficient") * SCALE).alias("adjustment_coefficient")
    return rows.select("symbol", "date", coefficient, *prices, *_kept(paired))


def _adjusted_exact(paired: DataFrame) -> DataFrame:
    newest = F.col("newer_date").isNull().alias("newest")
    rows = paired.select("symbol", "date", *PRICES, newest, "newer_dividend", "newer_split_ratio", *_kept(paired))
    # The window has put each symbol into one partition, in this order; naming the order adds no sort to the plan.
    return _folded(rows.sortWithinPartitions("symbol", F.desc("date")), paired)


def _folded(ordered: DataFrame, paired: DataFrame) -> DataFrame:
    longs = [T.StructField(name, T.LongType()) for name in ["adjustment_coefficient", *ADJUSTED]]
    carried = [paired.schema[name] for name in ["symbol", "date", *_kept(paired)]]
    return ordered.mapInArrow(fold_batches, T.StructType([*carried[:2], *longs, *carried[2:]]))


def _kept(paired: DataFrame) -> list[str]:
    return [BAD] if BAD in paired.columns else []


# The two-level form. Rows carry ``segment``, the start of their stretch of time.

_HEAD = "_head"


def _in_segment() -> WindowSpec:
    return Window.partitionBy("symbol", "segment").orderBy(F.desc("date"))


def _newer_segments() -> WindowSpec:
    """All segments of the symbol that are newer than this one, one row each."""
    return Window.partitionBy("symbol").orderBy(F.desc("segment")).rowsBetween(Window.unboundedPreceding, -1)


def segment_heads(rows: DataFrame) -> DataFrame:
    """The oldest row of the next newer segment of the symbol, one for each segment but the newest.

    The rows are dealt out before the aggregation. To combine them first would keep a second hash map in the tasks that
    form the rows, and saves little, as a segment has few rows in each of them.
    """
    names = ("date", "dividend", "split_ratio")
    dealt = rows.select("symbol", "segment", *names).repartition("symbol", "segment")
    oldest = dealt.groupBy("symbol", "segment").agg(
        F.min("date").alias("date"), *[F.min_by(name, "date").alias(name) for name in names[1:]]
    )
    older = Window.partitionBy("symbol").orderBy(F.desc("segment"))
    handed = oldest.select("symbol", "segment", *[F.lag(name).over(older).alias(name) for name in names])
    return handed.where(F.col("date").isNotNull())


def with_newer_event_by_segment(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """As ``with_newer_event``, for rows that carry ``segment``; no window is wider than a segment's rows.

    Each segment is headed by its row of ``segment_heads``, which is newer than all of its own and goes after the window.
    So the rows need no join: they are dealt out and sorted once, and a task holds one sort of them. ``newest`` is added
    to the first row of each segment, and what else a head carries comes to that row.
    """
    handed = [name for name in heads.columns if name not in rows.columns]
    headed = rows.withColumn(_HEAD, F.lit(False)).unionByName(
        heads.withColumn(_HEAD, F.lit(True)), allowMissingColumns=True
    )
    in_segment = _in_segment()
    so_far = in_segment.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def newer(name: str) -> Column:
        return F.coalesce(F.lag(name).over(in_segment), F.first(F.when(F.col(_HEAD), F.col(name))).over(so_far))

    paired = headed.withColumns(
        {
            "newer_date": newer("date"),
            "newer_dividend": F.coalesce(newer("dividend"), F.lit(NO_DIVIDEND)),
            "newer_split_ratio": F.coalesce(newer("split_ratio"), F.lit(NO_SPLIT)),
            "newest": F.coalesce(F.lag(_HEAD).over(in_segment), F.lit(True)),
            **{name: F.lag(name).over(in_segment) for name in handed},
        }
    )
    return paired.where(~F.col(_HEAD)).drop(_HEAD)


def _coefficient_by_segment(factors: DataFrame) -> DataFrame:
    """The running product in two levels: within the segment, times the product of all newer segments.

    The product of a segment is that of its oldest row, so it does not depend on the order in which tasks end.
    """
    within = _in_segment().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = factors.withColumn("local", F.product("factor").over(within))
    products = local.groupBy("symbol", "segment").agg(F.min_by("local", "date").alias("product"))
    carried = products.select(
        "symbol", "segment", F.coalesce(F.product("product").over(_newer_segments()), F.lit(1.0)).alias("before")
    )
    joined = local.join(carried, ["symbol", "segment"])
    return joined.withColumn("coefficient", F.col("before") * F.col("local"))


def _heads_with_coefficient(heads: DataFrame, paired: DataFrame) -> DataFrame:
    """Add the coefficient that the segment of each head starts from, as text.

    Decimal products are rounded at each step, so they do not regroup. But only events change the coefficient: this folds
    the events of a symbol in their order, without the rows between them, and keeps what it has at the end of each
    segment. Each segment then starts from the last of these that is newer.
    """
    is_event = (F.col("newer_dividend") != NO_DIVIDEND) | (F.col("newer_split_ratio") != NO_SPLIT)
    events = paired.where(is_event).select(
        "symbol", "segment", "date", "close", "newer_dividend", "newer_split_ratio",
        (F.row_number().over(_newest_first()) == 1).alias("newest"),
    )
    kind = T.StructType([paired.schema["symbol"], paired.schema["segment"], T.StructField("coefficient", T.StringType())])
    ends = events.sortWithinPartitions("symbol", F.desc("date")).drop("date").mapInArrow(last_coefficients, kind)
    # The head of a segment comes before the end of the same one.
    both = heads.withColumn(_HEAD, F.lit(True)).unionByName(
        ends.withColumn(_HEAD, F.lit(False)), allowMissingColumns=True
    )
    newest_first = Window.partitionBy("symbol").orderBy(F.desc("segment"), F.desc(_HEAD))
    before = F.last("coefficient", ignorenulls=True).over(
        newest_first.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return both.withColumn(CARRIED, before).where(F.col(_HEAD)).drop(_HEAD, "coefficient")


def _adjusted_exact_by_segment(paired: DataFrame) -> DataFrame:
    """The decimal fold over the rows, by segment, with the same digits as in one level."""
    rows = paired.select(
        "symbol", "segment", "date", *PRICES, "newest", "newer_dividend", "newer_split_ratio",
        F.coalesce(CARRIED, F.lit("1")).alias(CARRIED), *_kept(paired),
    )
    # The window has left the rows in this order; naming the order adds no sort to the plan.
    return _folded(rows.sortWithinPartitions("symbol", "segment", F.desc("date")).drop("segment"), paired)


def adjusted_by_segment(
    rows: DataFrame, skip_errors: bool = False, exact: bool = True, report: bool = False, unit: str = "month"
) -> DataFrame:
    """As ``adjusted_days``, in two levels: symbols are cut into segments of a time ``unit`` (of ``date_trunc``).

    In decimal mode the results are the same; in double mode they may differ by one unit, since the product is formed in
    another order. The date may also be a time, for bars of less than a day. Rows without a symbol or a date are left out.
    """
    split = F.when(F.col("split_ratio") == 0, NO_SPLIT).otherwise(F.col("split_ratio"))
    segment = F.date_trunc(unit, "date").cast(rows.schema["date"].dataType)
    rows = rows.dropna(subset=KEY).withColumns({"segment": segment, "split_ratio": split})

    def paired(heads: DataFrame) -> DataFrame:
        pairs = with_newer_event_by_segment(rows, heads)
        return with_checked_dividend(with_bad_dividend(pairs) if report else pairs, skip_errors)

    heads = segment_heads(rows)
    if exact:
        return _adjusted_exact_by_segment(paired(_heads_with_coefficient(heads, paired(heads))))
    pairs = paired(heads)
    return _truncated(_coefficient_by_segment(with_factor(pairs)), pairs)


def adjusted_days(
    rows: DataFrame, skip_errors: bool = False, exact: bool = True, report: bool = False
) -> DataFrame:
    """Adjusted prices and stored coefficient of each daily bar.

    ``exact=True`` works in decimal arithmetic of 28 significant digits. ``exact=False`` is a pure window plan in
    double arithmetic; a price whose exact value is next to an integer may then differ by one unit (0.0001).
    A dividend that is not below the prior close fails the job, or is left out with ``skip_errors``. With ``report``
    the rows also tell of the dividends left out.
    """
    paired = with_newer_event(rows)
    paired = with_checked_dividend(with_bad_dividend(paired) if report else paired, skip_errors)
    return _adjusted_exact(paired) if exact else _adjusted_native(paired)
