"""Readers of the three CSV formats. They return text columns only; `rows` gives them types.

A file with a header is read by column name, the minute files by position. A missing path fails when the reader is
called. Besides the text columns each row carries where it was read from, for counting rows in file order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fields of a minute file, in file order.
MINUTE_FIELDS = ["date", "high", "low", "open", "close", "volume", "last_volume"]
# Headers that daily and corporate-action files must have.
DAY_FIELDS = ["ticker", "date", "open", "high", "low", "close", "ex-dividend", "split_ratio"]
ACTION_FIELDS = ["Date(ex)", "RegularDividend$", "Split"]

FILE, BLOCK = "_file", "_block"
MINUTE_SCHEMA = ", ".join(f"{name} string" for name in MINUTE_FIELDS)
# The file name without its extension.
SYMBOL_IN_NAME = r"^(.*?)(?:\.[^.]*)?$"


def _origin() -> list[Column]:
    return [F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK)]


def _symbol(symbol: str | None, name_pattern: str) -> Column:
    """The given symbol, or the part of each file's name that the pattern's group takes, in upper case."""
    # The file name comes percent-encoded, and decoding would take a plus sign for a blank.
    file_name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    named = F.lit(symbol) if symbol is not None else F.regexp_extract(file_name, name_pattern, 1)
    return F.upper(named).alias("symbol")


def _reader(spark: SparkSession, multiline: bool):
    # A doubled quote stands for a quote; a file whose header differs from the first one's is an error. Quoted line
    # breaks make each file one split, so they must be asked for.
    return spark.read.option("escape", '"').option("enforceSchema", False).option("multiLine", multiline)


def read_days(spark: SparkSession, path: str | list[str], multiline: bool = False) -> DataFrame:
    rows = _reader(spark, multiline).option("header", True).csv(path)
    return rows.select(*[F.col(f"`{name}`") for name in DAY_FIELDS], *_origin())


def read_minutes(
    spark: SparkSession, path: str | list[str], symbol: str | None = None, name_pattern: str = SYMBOL_IN_NAME
) -> DataFrame:
    rows = spark.read.option("escape", '"').schema(MINUTE_SCHEMA).csv(path)
    return rows.select(_symbol(symbol, name_pattern), *MINUTE_FIELDS, *_origin())


def minute_stream(spark: SparkSession, path: str, files_per_batch: int) -> DataFrame:
    """The minute files that arrive in a directory, as a stream."""
    reader = spark.readStream.option("escape", '"').option("maxFilesPerTrigger", files_per_batch)
    return reader.schema(MINUTE_SCHEMA).csv(path).select(_symbol(None, SYMBOL_IN_NAME), *MINUTE_FIELDS, *_origin())


def read_adjustments(
    spark: SparkSession, path: str | list[str], symbol: str | None = None, name_pattern: str = SYMBOL_IN_NAME,
    multiline: bool = False,
) -> DataFrame:
    rows = _reader(spark, multiline).option("header", True).csv(path)
    return rows.select(_symbol(symbol, name_pattern), *[F.col(f"`{name}`") for name in ACTION_FIELDS], *_origin())
