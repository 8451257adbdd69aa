"""The adjustment against a plain fold written down here, and its invariants."""

from __future__ import annotations

import random
import re
from datetime import date, timedelta
from decimal import Decimal, localcontext

import numpy as np
import pytest

from pricefold.operators import adjustment, decimal_fold
from pricefold.plans import adjusting

BARS = "symbol string, date date, open bigint, high bigint, low bigint, close bigint"
SCHEMA = f"{BARS}, dividend bigint, split_ratio bigint"
FIRST = date(1990, 1, 1)


def history(symbol, generator, days, event_share=0.2):
    rows = []
    for day in range(days):
        price = generator.randrange(10_000, 9_000_000)
        dividend, split = 0, generator.choice([0, 10000])
        if generator.random() < event_share:
            dividend = generator.choice([0, generator.randrange(1, 9000)])
            split = generator.choice([10000, 20000, 30000, 70000, 15000, 3730, 1000, 12500, 60000, 5000])
        prices = (price, price + 777, price - 333, price + 111)
        rows.append((symbol, FIRST + timedelta(days=day), *prices, dividend, split))
    return rows


def expected_rows(rows, skip=False):
    """Newest to oldest, in 28-digit decimals."""
    out = []
    with localcontext() as context:
        context.prec = 28
        for symbol in {row[0] for row in rows}:
            own = sorted((row for row in rows if row[0] == symbol), key=lambda row: row[1], reverse=True)
            coefficient, newer = Decimal(1), None
            for row in own:
                if newer is not None:
                    if newer[7] not in (0, 10000):
                        coefficient *= 1 / (Decimal(newer[7]) / Decimal(10000))
                    if newer[6] != 0 and not (skip and newer[6] >= row[5]):
                        coefficient *= 1 - Decimal(newer[6]) / Decimal(row[5])
                prices = [int(Decimal(price) * coefficient) for price in row[2:6]]
                out.append((symbol, row[1], int(coefficient * 10000), *prices))
                newer = row
    return sorted(out)


def adjusted(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    names = ["symbol", "date", "adjustment_coefficient", *adjustment.ADJUSTED]
    return sorted(tuple(row) for row in adjustment.adjusted_days(frame, **options).select(*names).collect())


@pytest.fixture(scope="module")
def many():
    generator = random.Random(11)
    rows = [row for number in range(12) for row in history(f"s{number}", generator, 40 + 10 * number)]
    # One symbol with a third of all rows, and one without events.
    return rows + history("hot", generator, len(rows) // 2, 0.02) + history("plain", generator, 30, 0.0)


def test_exact_equals_the_decimal_fold(spark, many):
    assert adjusted(spark, many) == expected_rows(many)


def split_only(count, ratio):
    generator = random.Random(3)
    prices = [generator.randrange(100, 900_000) * 100 for _ in range(count)]
    rows = [("a", FIRST + timedelta(days=day), *[price] * 4, 0, 10000) for day, price in enumerate(prices)]
    return [*rows[:-1], (*rows[-1][:7], ratio)]


@pytest.mark.parametrize("ratio", [20000, 40000, 30000, 5000, 12500, 3730])
def test_split_only_histories_need_few_decimals(monkeypatch, ratio):
    """Whole cents by a short coefficient are next to integers throughout, yet are not decided one by one."""
    rows = split_only(4000, ratio)
    made = []

    class Counting(Decimal):
        def __mul__(self, other):
            made.append(1)
            return Decimal(self) * other

    monkeypatch.setattr(decimal_fold, "Decimal", Counting)
    values = np.array([row[2] for row in rows] * 3, np.int64)
    running = [Decimal(1), 1 / (Decimal(ratio) / Decimal(10000))]
    level = np.ones(len(values), np.int64)
    found = decimal_fold._floor_products(values, level, running, np.zeros(len(values), bool))
    assert found.tolist() == [int(Decimal(value) * running[1]) for value in values.tolist()]
    # Ratios without a short reciprocal decide each distinct price once.
    assert len(made) <= (0 if ratio in (20000, 40000, 5000, 12500) else 4000)


def test_large_values_and_coefficients_stay_exact():
    values = np.array([9_007_199_254_740_993, 123_456_789_012_345_600, 10, 0], np.int64)
    running = [Decimal("0.5"), Decimal("0.0625"), Decimal("12.5"), Decimal("0.3333333333333333333333333333")]
    for at, coefficient in enumerate(running):
        level = np.full(len(values), at)
        found = decimal_fold._floor_products(values, level, running, np.zeros(len(values), bool))
        with localcontext() as context:
            context.prec = 28
            assert found.tolist() == [int(Decimal(value) * coefficient) for value in values.tolist()]


def test_exact_does_not_depend_on_batches(spark, many):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert adjusted(spark, many) == expected_rows(many)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_double_is_within_one_unit(spark, many):
    found, expected = adjusted(spark, many, exact=False), expected_rows(many)
    assert [row[:2] for row in found] == [row[:2] for row in expected]
    worst = max(abs(a - b) for left, right in zip(found, expected) for a, b in zip(left[2:], right[2:]))
    assert worst <= 1


def test_three_for_one_split(spark):
    rows = [("a", FIRST, 30000, 30000, 30000, 30000, 0, 0), ("a", date(1990, 1, 2), 1, 1, 1, 1, 0, 30000)]
    assert adjusted(spark, rows)[0][3] == 9999
    assert adjusted(spark, rows, exact=False)[0][3] == 10000


def test_newest_row_and_symbols_without_events_stay_raw(spark, many):
    found = {row[:2]: row for row in adjusted(spark, many)}
    for row in many:
        newest = row[1] == max(other[1] for other in many if other[0] == row[0])
        if newest or row[0] == "plain":
            assert found[row[:2]][2:] == (10000, *row[2:6])


def test_scaling_prices_and_dividends_keeps_the_coefficients(spark, many):
    scaled = [(*row[:2], *[price * 3 for price in row[2:6]], row[6] * 3, row[7]) for row in many]
    assert [row[2] for row in adjusted(spark, scaled)] == [row[2] for row in adjusted(spark, many)]


@pytest.mark.parametrize("exact", [True, False])
def test_bad_dividends(spark, exact):
    rows = [
        ("a", date(2020, 1, 1), 100, 100, 100, 100, 0, 0),
        ("a", date(2020, 1, 2), 90, 90, 90, 0, 100, 20000),
        ("a", date(2020, 1, 3), 80, 80, 80, 80, 5, 10000),
        ("b", date(2020, 1, 3), 7, 7, 7, 7, 99, 20000),
    ]
    with pytest.raises(Exception, match="dividend not below the prior close"):
        adjusted(spark, rows, exact=exact)
    # The close of 0 and the dividend equal to the close drop the dividends; the split stays.
    assert [row[2] for row in adjusted(spark, rows, exact=exact, skip_errors=True)] == [5000, 10000, 10000, 10000]
    bad = adjustment.bad_dividends(adjustment.with_newer_event(spark.createDataFrame(rows, SCHEMA)))
    assert sorted((row["symbol"], row["date"], row["newer_date"]) for row in bad.collect()) == [
        ("a", date(2020, 1, 1), date(2020, 1, 2)), ("a", date(2020, 1, 2), date(2020, 1, 3))
    ]


def test_skipping_matches_the_fold(spark):
    generator = random.Random(5)
    rows = [(*row[:6], row[6] * 900, row[7]) for row in history("a", generator, 120, 0.5)]
    assert adjusted(spark, rows, skip_errors=True) == expected_rows(rows, skip=True)


def test_known_first_trading_days(spark):
    """Two real bars whose adjusted prices are known; one split stands for all later events."""
    known = [
        ((287500, 288700, 287500, 287500), 679948, (147, 4228, 4245, 4228, 4228)),
        ((255000, 292500, 255000, 280000), 4335573, (23, 588, 674, 588, 645)),
    ]
    for prices, split, wanted in known:
        rows = [("a", FIRST, *prices, 0, 0), ("a", date(1990, 1, 2), 1, 1, 1, 1, 0, split)]
        assert adjusted(spark, rows)[0][2:] == wanted


def test_an_action_on_a_day_without_bar_has_no_effect(spark):
    days = spark.createDataFrame([("a", FIRST, 5, 5, 5, 5)], BARS)
    columns = "symbol string, date date, dividend bigint, split_ratio bigint"
    actions = spark.createDataFrame([("a", date(1990, 1, 2), 3, 20000)], columns)
    assert adjusting.adjust(days, actions).first()["adjusted_open"] == 5


def test_one_shuffle_and_one_sort_by_symbol(spark, many):
    frame = spark.createDataFrame(many, SCHEMA)
    for exact in (True, False):
        plan = adjustment.adjusted_days(frame, exact=exact)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
        assert plan.count("Sort [") == 1


def by_segment(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    names = ["symbol", "date", "adjustment_coefficient", *adjustment.ADJUSTED]
    return sorted(tuple(row) for row in adjustment.adjusted_by_segment(frame, **options).select(*names).collect())


@pytest.mark.parametrize("unit", ["month", "year"])
def test_segments_give_the_digits_of_the_decimal_fold(spark, many, unit):
    assert by_segment(spark, many, unit=unit) == expected_rows(many)


def test_segments_in_double_mode_are_within_one_unit(spark, many):
    found, exact = by_segment(spark, many, exact=False), expected_rows(many)
    assert [row[:2] for row in found] == [row[:2] for row in exact]
    assert all(abs(x - y) <= 1 for one, other in zip(found, exact) for x, y in zip(one[2:], other[2:]))


@pytest.mark.parametrize("exact", [True, False])
def test_segments_skip_or_report_bad_dividends(spark, exact):
    rows = [("x", date(2020, 1 + k // 3, 1 + k % 3), 100, 100, 100, 100, 100 if k == 3 else 10 * (k == 5), 0) for k in range(9)]
    with pytest.raises(Exception, match="dividend not below the prior close"):
        by_segment(spark, rows, exact=exact)
    assert by_segment(spark, rows, exact=exact, skip_errors=True) == expected_rows(rows, skip=True)
    frame = adjustment.adjusted_by_segment(spark.createDataFrame(rows, SCHEMA), True, exact, report=True)
    told = frame.where("bad_dividend is not null").select("date", "bad_dividend.newer_date").collect()
    assert [tuple(row) for row in told] == [(date(2020, 1, 3), date(2020, 2, 1))]


def test_a_long_series_of_times_is_cut_into_segments(spark):
    moments = 4_000
    rows = spark.range(moments).selectExpr(
        "'x' as symbol", "timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(0, cast(id as int)) as date",
        *[f"100000 + id as {price}" for price in ("open", "high", "low", "close")],
        "if(id % 97 = 0, 50, 0) as dividend", "if(id % 501 = 500, 20000, 0) as split_ratio",
    )
    rows = rows.withColumns({name: rows[name].cast("bigint") for name in ("dividend", "split_ratio")})
    one = adjustment.adjusted_days(rows)
    two = adjustment.adjusted_by_segment(rows, unit="day")
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    # What all rows of a symbol meet in is keyed by segment; by symbol alone go the segments and the events.
    plan = two._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\([^)]*segment#", plan)


def test_segments_sort_the_rows_once_and_join_none(spark, many):
    prices = {name: "max" for name in ("open", "high", "low", "close", "dividend", "split_ratio")}
    rows = spark.createDataFrame(many, SCHEMA).groupBy("symbol", "date").agg(prices)
    rows = rows.withColumnsRenamed({f"max({name})": name for name in prices}).select("symbol", "date", *prices)
    two = adjustment.adjusted_by_segment(rows)
    # A task that forms the rows or folds them holds them once: there is no join, one sort, no second aggregation.
    plan = two._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    fold = plan.split("Exchange")[0]
    assert "MapInArrow" in fold and fold.count("Sort [") == 1
    assert re.search(r"partial_min\(date[^\n]*\n[^\n]*Exchange hashpartitioning\(symbol[^\n]*segment", plan)
    assert sorted(map(tuple, two.collect())) == sorted(map(tuple, adjustment.adjusted_days(rows).collect()))


def test_segments_leave_out_rows_without_symbol_or_date(spark, many):
    bare = [(None, *many[0][1:]), (many[0][0], None, *many[0][2:])]
    assert by_segment(spark, many + bare) == expected_rows(many)


ACTIONS = "symbol string, date date, dividend bigint, split_ratio bigint"


def test_actions_move_to_the_next_bar_and_combine(spark):
    def day(number):
        return date(2020, 1, number)

    bars = [(symbol, day(number), 100, 100, 100, 100) for symbol in "xyz" for number in (2, 6, 9)]
    actions = [
        ("x", day(6), 30, 0), ("x", day(3), 10, 20000), ("x", day(4), 7, 15000), ("x", day(5), 0, 0),
        ("x", day(10), 5, 10000), ("y", day(1), 3, 10000), ("w", day(3), 3, 10000), ("z", day(9), 0, 20000),
    ]
    days, events = spark.createDataFrame(bars, BARS), spark.createDataFrame(actions, ACTIONS)
    joined = adjusting.with_actions(days, events, lost="next_bar").where("dividend <> 0 or split_ratio not in (0, 10000)")
    # Ten, then seven after a split of two, then thirty after splits of two and one and a half.
    assert sorted(tuple(row) for row in joined.select("symbol", "date", "dividend", "split_ratio").collect()) == [
        ("x", day(6), 10 + 14 + 90, 30000), ("y", day(2), 3, 10000), ("z", day(9), 0, 20000),
    ]
    moved = adjusting.moved_actions(days, events).select("symbol", "date", "bar").collect()
    assert sorted(map(tuple, moved), key=repr) == sorted([
        ("x", day(3), day(6)), ("x", day(4), day(6)), ("x", day(5), day(6)), ("x", day(10), None), ("y", day(1), day(2)),
        ("w", day(3), None),
    ], key=repr)
    default = adjusting.with_actions(days, events).where("dividend <> 0 or split_ratio > 10000")
    assert sorted(tuple(row) for row in default.select("symbol", "date", "dividend").collect()) == [
        ("x", day(6), 30), ("z", day(9), 0),
    ]
    with pytest.raises(ValueError):
        adjusting.with_actions(days, events, lost="prior_bar")
    plan = adjusting.placed_actions(days, events)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1
