"""The driver's tables read as price feeds.

They hold no prices, so bars, corporate actions and file text are derived from them. ``workload.sql`` has the same
derivations as SQL. Scaled prices are cents times 100.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricefold.functions.scalars import is_action
from pricefold.operators.keyed import latest_per_key
from pricefold.schema import ACTION, KEY, PRICES
from pricefold.sources.csv_files import BLOCK, DAY_FIELDS, FILE, MINUTE_FIELDS, MINUTE_SCHEMA


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def price_of(amount: str) -> Column:
    return F.round(F.col(amount) * 100).cast("bigint") * 100


# Daily bars with actions, from lineitem: one symbol per supplier.


def line_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line: the dividend and split it announces, 0 and 10000 for none."""
    lines = table(spark, sf_dir, "lineitem")
    dividend = F.when(F.col("l_returnflag") == "R", F.round(F.col("l_discount") * 100)).otherwise(0)
    return lines.select(
        F.concat(F.lit("S"), "l_suppkey").alias("symbol"),
        F.col("l_shipdate").cast("date").alias("date"),
        (dividend.cast("bigint") * 10000).alias("dividend"),
        _split_of(F.when(F.col("l_tax") >= 0.08, F.col("l_linenumber"))).alias("split_ratio"),
    )


def _split_of(line: Column) -> Column:
    return F.when(line == 7, 20000).when(line == 6, 5000).when(line == 5, 15000).otherwise(10000).cast("bigint")


def line_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    ticks = lines.select(
        F.concat(F.lit("S"), "l_suppkey").alias("symbol"),
        F.col("l_shipdate").cast("date").alias("date"),
        price_of("l_extendedprice").alias("price"),
        F.when(F.col("l_returnflag") == "R", F.round(F.col("l_discount") * 100)).otherwise(0).alias("paid"),
        F.when(F.col("l_tax") >= 0.08, F.col("l_linenumber")).alias("line"),
    )
    return ticks.groupBy("symbol", "date").agg(
        F.expr("(min(price) + max(price)) div 2").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.expr("sum(price) div count(*)").alias("close"),
        (F.max("paid").cast("bigint") * 10000).alias("dividend"),
        _split_of(F.max("line")).alias("split_ratio"),
    )


def split_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily bars with splits alone, whose factors are 0.5, 2 and 0.8, so that all coefficients are short decimals."""
    split = F.when(F.col("split_ratio") == 15000, 12500).otherwise(F.col("split_ratio"))
    bars = line_bars(spark, sf_dir)
    return bars.withColumns({"dividend": F.lit(0).cast("bigint"), "split_ratio": split.cast("bigint")})


def days_of(bars: DataFrame) -> DataFrame:
    return bars.select(*KEY, *PRICES)


def actions_of(bars: DataFrame) -> DataFrame:
    return bars.where(is_action()).select(*KEY, *ACTION)


# Minute bars, from events: one symbol per user, import order by event id.


def staged_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, step = price_of("value"), F.col("event_id")
    low = price - step % 5 * 100
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("U"), "user_id").alias("symbol"),
        # Cut to the minute without leaving timestamp_ntz.
        F.expr("ts - make_dt_interval(0, 0, 0, extract(second from ts))").alias("date"),
        price.alias("open"),
        (price + step % 7 * 100).alias("high"),
        F.when(low > 0, low).otherwise(price).alias("low"),
        price.alias("close"),
        F.col("event_id").alias("_seq"),
        "event_type",
    )


def minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyed minute table."""
    staged = staged_minutes(spark, sf_dir).drop("event_type")
    return latest_per_key(staged, KEY).withColumn("day", F.col("date").cast("date"))


def event_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily actions of the event symbols. Some dividends are not below the prior close."""
    big = F.col("value") >= 40
    per_day = table(spark, sf_dir, "events").groupBy(
        F.concat(F.lit("U"), "user_id").alias("symbol"), F.col("ts").cast("date").alias("date")
    )
    rows = per_day.agg(
        F.max(F.when(F.col("event_type") == "purchase", F.col("event_id") % 9 * 100).otherwise(0)).alias("dividend"),
        F.max(F.when(big & (F.col("event_type") == "signup"), 2).when(big & (F.col("event_type") == "error"), 1)
              .otherwise(0)).alias("kind"),
    )
    split = F.when(F.col("kind") == 2, 20000).when(F.col("kind") == 1, 5000).otherwise(10000).cast("bigint")
    return actions_of(rows.withColumn("split_ratio", split))


# Feeds from orders. Each order status is a feed of its own, and all three cover the same symbols.


def order_rows(spark: SparkSession, sf_dir: str, status: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == status)
    price = price_of("o_totalprice")
    return orders.select(
        F.concat(F.lit("C"), F.col("o_custkey") % 50).alias("symbol"),
        F.col("o_orderdate").cast("date").alias("date"),
        *[price.alias(name) for name in PRICES],
        F.col("o_orderkey").alias("_seq"),
    )


def order_days(spark: SparkSession, sf_dir: str, status: str) -> DataFrame:
    return latest_per_key(order_rows(spark, sf_dir, status), KEY)


def order_minutes(spark: SparkSession, sf_dir: str, status: str) -> DataFrame:
    rows = order_rows(spark, sf_dir, status)
    minute = F.expr("cast(date as timestamp_ntz) + make_dt_interval(0, 0, cast(_seq % 390 as int), 0)")
    return latest_per_key(rows.withColumn("date", minute), KEY).withColumn("day", F.col("date").cast("date"))


def order_actions(spark: SparkSession, sf_dir: str, *statuses: str) -> DataFrame:
    """Corporate actions for the supplier symbols."""
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderstatus").isin(*statuses))
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return orders.select(
        F.concat(F.lit("S"), F.col("o_custkey") % 100).alias("symbol"),
        F.col("o_orderdate").cast("date").alias("date"),
        (F.col("o_orderkey") % 10 * 1000).alias("dividend"),
        F.when(urgent, 20000).otherwise(10000).cast("bigint").alias("split_ratio"),
        F.col("o_orderkey").alias("_seq"),
    )


def separate_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corporate actions of all orders, one for each symbol and day."""
    every = order_actions(spark, sf_dir, "P", "F", "O")
    return latest_per_key(every.where(is_action()), KEY)


def asked_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of a lookup: the minutes of all events, those of errors an hour late."""
    late = F.expr("date + interval 1 hour")
    return staged_minutes(spark, sf_dir).select(
        "symbol", F.when(F.col("event_type") == "error", late).otherwise(F.col("date")).alias("date")
    )


# File text. Lines are built with to_csv and taken apart with from_csv, as the file reader would.


def _short_date(day: Column, separator: str = "-") -> Column:
    """Year, month and day without leading zeros."""
    return F.concat_ws(separator, F.year(day), F.month(day), F.dayofmonth(day))


def _through_csv(frame: DataFrame, names: list[str], schema: str, *kept: str) -> DataFrame:
    fields = F.struct(*[F.col(f"`{name}`").cast("string") for name in names])
    lines = frame.select(F.to_csv(fields).alias("line"), *kept)
    # Generated rather than projected, so that a filter above does not parse the line once more per field.
    return lines.select(F.inline(F.array(F.from_csv("line", schema))), *kept)


def _day_lines(frame: DataFrame) -> DataFrame:
    return _through_csv(frame, DAY_FIELDS, ", ".join(f"`{name}` string" for name in DAY_FIELDS))


def day_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily lines, one per line item; the high has more decimals than are stored."""
    lines = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    return _day_lines(
        lines.select(
            F.concat(F.lit("S"), "l_suppkey").alias("ticker"),
            _short_date(F.col("l_shipdate")).alias("date"),
            price.alias("open"),
            F.concat(price.cast("string"), F.lit("129999999999")).alias("high"),
            F.concat(F.lit(" "), price.cast("string"), F.lit("e-1")).alias("low"),
            price.alias("close"),
            F.col("l_discount").cast("decimal(4,2)").alias("ex-dividend"),
            (1 + F.col("l_tax")).cast("decimal(4,2)").alias("split_ratio"),
        )
    )


def old_day_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily lines from orders, 28 years early, so that some lie before 1970."""
    orders = table(spark, sf_dir, "orders")
    price = F.col("o_totalprice").cast("decimal(12,2)")
    return _day_lines(
        orders.select(
            F.concat(F.lit("C"), "o_custkey").alias("ticker"),
            F.add_months(F.col("o_orderdate").cast("date"), -336).alias("date"),
            *[price.alias(name) for name in PRICES],
            F.lit("0.0").alias("ex-dividend"),
            F.lit("1.0").alias("split_ratio"),
        )
    )


def minute_text(spark: SparkSession, sf_dir: str, spoiled: bool = False) -> DataFrame:
    """Minute lines, one per event. When spoiled, errors have no number as close and sign-ups no proper time."""
    events = table(spark, sf_dir, "events").select(
        "*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK)
    )
    rows = events.select(
        FILE,
        BLOCK,
        "event_type",
        F.concat(F.lit("u"), "user_id").alias("symbol"),
        _short_date(F.col("ts")).alias("_day"),
        F.concat_ws(":", F.hour("ts"), F.minute("ts"), F.lit("0")).alias("_time"),
        F.col("value").cast("decimal(12,2)").alias("price"),
        "event_id",
    )
    separator, close = F.lit(" "), F.col("price").cast("string")
    if spoiled:
        separator = F.when(F.col("event_type") == "signup", "T").otherwise(separator)
        close = F.when(F.col("event_type") == "error", "n/a").otherwise(close)
    rows = rows.select(
        "symbol", FILE, BLOCK, F.concat("_day", separator, "_time").alias("date"),
        (F.col("price") + 1).alias("high"), F.col("price").alias("low"), F.col("price").alias("open"),
        close.alias("close"), F.col("event_id").alias("volume"), F.lit("0").alias("last_volume"),
    )
    return _through_csv(rows, MINUTE_FIELDS, MINUTE_SCHEMA, "symbol", FILE, BLOCK).withColumn(
        "symbol", F.upper("symbol")
    )


def action_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corporate-action lines from part."""
    parts = table(spark, sf_dir, "part")
    when = F.date_add(F.lit("2000-01-01").cast("date"), (F.col("p_partkey") % 5000).cast("int"))
    lines = parts.select(
        F.concat(F.lit("p"), "p_partkey").alias("symbol"),
        _short_date(when, ".").alias("Date(ex)"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("RegularDividend$"),
        # Some are so large that nothing is left, some are next to a whole number of ten-thousandths.
        F.when(F.col("p_partkey") % 11 == 0, F.concat("p_size", F.lit("000000")))
        .when(F.col("p_partkey") % 7 == 0, F.concat(F.lit("100."), F.lpad("p_size", 18, "0")))
        .otherwise((F.col("p_size") / F.lit(100)).cast("decimal(6,2)").cast("string")).alias("Split"),
    )
    names = ["Date(ex)", "RegularDividend$", "Split"]
    text = _through_csv(lines, names, ", ".join(f"`{name}` string" for name in names), "symbol")
    return text.withColumn("symbol", F.upper("symbol"))
