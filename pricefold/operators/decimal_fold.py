"""The decimal arithmetic of the adjustment, over the sorted rows of a partition."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from decimal import ROUND_HALF_EVEN, Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from pricefold.schema import ADJUSTED, NO_DIVIDEND, NO_SPLIT, PRICES, SCALE

# Executors get this module's code with the task, so they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: significant digits.
DIGITS = 28
_INT64 = 2**63
CARRIED = "carried"
_READ = ["symbol", "date", "newest", "newer_dividend", "newer_split_ratio", *PRICES]


def _coefficients(
    before: Decimal, starts: list[str | None], dividends: np.ndarray, splits: np.ndarray, closes: np.ndarray
) -> list[Decimal]:
    """The coefficient before the first given row and after each. The rows are those where it changes.

    ``starts`` has the coefficient that a row starts from where it does not go on with the one before.
    """
    running = [before]
    changes = zip(starts, dividends.tolist(), splits.tolist(), closes.tolist())
    for start, dividend, split, close in changes:
        value = running[-1] if start is None else Decimal(start)
        if split != NO_SPLIT:
            value = value * (1 / (Decimal(split) / SCALE))
        if dividend != NO_DIVIDEND:
            value = value * (1 - Decimal(dividend) / Decimal(close))
        running.append(value)
    return running


def _fraction(value: Decimal) -> tuple[int, int]:
    """``value`` as a whole number over a power of ten, both without common tens."""
    _, digits, exponent = value.as_tuple()
    whole = int("".join(map(str, digits)))
    while exponent < 0 and whole % 10 == 0 and whole:
        whole, exponent = whole // 10, exponent + 1
    return (whole * 10**exponent, 1) if exponent >= 0 else (whole, 10**-exponent)


def _floor_products(values: np.ndarray, level: np.ndarray, running: list[Decimal], raw: np.ndarray) -> np.ndarray:
    """``floor(value * coefficient)`` in decimal arithmetic; ``raw`` marks the rows whose coefficient is 1.

    The double product decides every value that is not next to an integer; its relative error is below 2**-51. The
    others are decided in 64-bit integers where the coefficient is a short decimal, as after splits alone, and else
    once for each distinct pair of value and coefficient.
    """
    product = values * np.array([float(value) for value in running])[level]
    result = np.where(raw, values, np.floor(product).astype(np.int64))
    unsure = np.flatnonzero((np.abs(product - np.rint(product)) <= product * 2.0**-50) & ~raw)
    if not len(unsure):
        return result
    fractions = [_fraction(value) for value in running]
    most = int(values[unsure].max())
    short = np.array([tens < _INT64 and whole * max(1, most) < _INT64 for whole, tens in fractions])
    whole = np.array([whole if fits else 0 for (whole, _), fits in zip(fractions, short)], np.int64)
    tens = np.array([tens if fits else 1 for (_, tens), fits in zip(fractions, short)], np.int64)
    easy, hard = unsure[short[level[unsure]]], unsure[~short[level[unsure]]]
    result[easy] = values[easy] * whole[level[easy]] // tens[level[easy]]
    if len(hard):
        pairs, place = np.unique(np.stack([values[hard], level[hard]]), axis=1, return_inverse=True)
        exact = [int(Decimal(value) * running[at]) for value, at in pairs.T.tolist()]
        result[hard] = np.array(exact, np.int64)[place.reshape(-1)]
    return result


def _starts(batch: pa.RecordBatch, newest: np.ndarray, changes: np.ndarray) -> list[str | None]:
    """What each row where the coefficient changes starts from; null where it goes on."""
    if CARRIED not in batch.schema.names:
        return ["1" if first else None for first in newest[changes].tolist()]
    carried = batch.column(CARRIED).take(pa.array(changes)).to_pylist()
    return [value if first else None for first, value in zip(newest[changes].tolist(), carried)]


def last_coefficients(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The coefficient after the last event of each symbol and segment.

    The rows are the events (rows with a newer dividend or split) sorted by symbol, newest day first, ``newest`` marking
    the first of each symbol. Columns out: symbol, segment, coefficient as text. One coefficient is carried.
    """
    held: tuple | None = None
    last = Decimal(1)
    for batch in batches:
        column = {
            name: batch.column(name).to_numpy(zero_copy_only=False)
            for name in ("newest", "newer_dividend", "newer_split_ratio", "close")
        }
        places = list(zip(batch.column("symbol").to_pylist(), batch.column("segment").to_pylist()))
        with localcontext() as context:
            context.prec, context.rounding = DIGITS, ROUND_HALF_EVEN
            starts = ["1" if first else None for first in column["newest"].tolist()]
            running = _coefficients(
                last, starts, column["newer_dividend"], column["newer_split_ratio"], column["close"]
            )[1:]
        done = []
        for place, value in zip(places, running):
            if held and held[0] != place:
                done.append((*held[0], str(held[1])))
            held = place, value
        last = running[-1] if running else last
        yield _segments(batch, done)
    if held:
        yield _segments(batch, [(*held[0], str(held[1]))])


def _segments(like: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
    kinds = [like.schema.field("symbol").type, like.schema.field("segment").type, pa.string()]
    data = [pa.array([row[k] for row in rows], kind) for k, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(data, names=["symbol", "segment", "coefficient"])


def fold_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adjust rows that come sorted by symbol, newest day first.

    ``newest`` marks the first row of each symbol, or of each part of one, and ``carried``, if there is such a column, tells
    the coefficient that such a row starts from, 1 otherwise. Columns that the fold does not read are carried along.
    Only one coefficient is carried from batch to batch, so no symbol is held in memory, and Python loops over the rows
    that change the coefficient, not over all.
    """
    last = Decimal(1)
    for batch in batches:
        column = {
            name: batch.column(name).to_numpy(zero_copy_only=False)
            for name in _READ if name not in ("symbol", "date")
        }
        newest, dividend, split = column["newest"], column["newer_dividend"], column["newer_split_ratio"]
        changes = np.flatnonzero(newest | (dividend != NO_DIVIDEND) | (split != NO_SPLIT))
        # Number of changes at or before each row, which is the index of the row's coefficient.
        level = np.searchsorted(changes, np.arange(batch.num_rows), side="right")
        with localcontext() as context:
            context.prec, context.rounding = DIGITS, ROUND_HALF_EVEN
            running = _coefficients(
                last, _starts(batch, newest, changes), dividend[changes], split[changes], column["close"][changes]
            )
            raw = np.array([value == 1 for value in running])[level]
            coefficient = np.array([int(value * SCALE) for value in running], dtype=np.int64)[level]
            prices = [_floor_products(column[price], level, running, raw) for price in PRICES]
        last = running[-1]
        data = [batch.column("symbol"), batch.column("date"), coefficient, *prices]
        names = ["symbol", "date", "adjustment_coefficient", *ADJUSTED]
        carried = [name for name in batch.schema.names if name not in (*_READ, CARRIED)]
        yield pa.RecordBatch.from_arrays(
            [*map(pa.array, data), *[batch.column(name) for name in carried]], names=[*names, *carried]
        )
