from __future__ import annotations

from contextlib import contextmanager

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pricefold.operators import adjustment
from pricefold.plans import adjusting
from pricefold.session import joins_on_part_of_keys
from pricefold.sinks.buckets import Buckets

DAYS = "ticker,date,open,high,low,close,volume,ex-dividend,split_ratio"


def lines(symbols, days, close=30, event=False):
    return [
        f"{symbol},2020-{1 + day // 28:02}-{1 + day % 28:02},{close},{close + 1},{close - 1},{close},5,"
        f"{0.5 if event and day % 9 == 4 else 0},{2 if event and day % 17 == 11 else 1}"
        for symbol in symbols
        for day in days
    ]


@contextmanager
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        with joins_on_part_of_keys(spark):
            yield
    finally:
        spark.conf.set(name, before)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def rows(frame):
    return sorted(tuple(row) for row in frame.collect())


@pytest.fixture
def filled(store, write):
    store.import_days(write("days.csv", DAYS, *lines("ABCDEFG", range(60), event=True)))
    store.merge()
    return store


def test_copies_hold_what_the_tables_hold(filled):
    filled.adjust()
    for table in ("days", "adjustments", "days_adjusted"):
        copy = filled.by_symbol(table, 4)
        assert rows(copy) == rows(filled.tables.read(table).select(*copy.columns)) != []
    with pytest.raises(ValueError):
        filled.by_symbol("minutes", 4)


def test_adjust_gives_the_same_from_copies(filled):
    for exact in (True, False):
        count = filled.adjust(exact=exact).adjusted
        wanted = rows(filled.tables.read("days_adjusted"))
        assert filled.adjust(exact=exact, buckets=4).adjusted == count == 420
        assert rows(filled.tables.read("days_adjusted")) == wanted


def test_bars_are_not_shuffled(spark, filled):
    with no_broadcast(spark):
        bars = adjusting.with_actions(filled.by_symbol("days", 4), filled.by_symbol("adjustments", 4))
        for exact in (True, False):
            found = plan(adjustment.adjusted_days(bars, exact=exact))
            assert "SortMergeJoin" in found and "Window" in found and "Exchange" not in found
        filled.adjust(buckets=4)
        view = filled.days_view_by_symbol(4)
        newest = Window.partitionBy("symbol").orderBy("date")
        found = plan(view.withColumn("before", F.lag("close").over(newest)))
        assert "SortMergeJoin" in found and "Window" in found and "Exchange" not in found
        assert rows(view) == rows(filled.days_view().drop("month"))


def test_lookups_still_prune_months(filled):
    filled.adjust(buckets=4)
    found = filled.get_day("A", "2020-01-05")
    months = {name.split("month=")[1].split("/")[0] for name in found.inputFiles()}
    assert found.count() == 1 and months == {"1969-12-01", "2020-01-01"}


def test_a_copy_takes_in_new_files_alone(filled, write, monkeypatch):
    filled.by_symbol("days", 4)
    kinds = []
    real = Buckets._write
    monkeypatch.setattr(
        Buckets, "_write", lambda self, table, new, overwrite: (kinds.append((overwrite, new.count())), real(self, table, new, overwrite))
    )
    assert filled.by_symbol("days", 4).count() == 420 and kinds == []
    filled.import_days(write("more.csv", DAYS, *lines("AH", range(60, 64))))
    filled.merge()
    assert filled.by_symbol("days", 4).count() == 428 and kinds == [(False, 8)]
    # A month written anew is not what the copy was made of.
    filled.import_days(write("late.csv", DAYS, *lines("A", [3], close=77)))
    filled.merge(newest=True)
    copy = filled.by_symbol("days", 4)
    assert kinds[1:] == [(True, 428)] and rows(copy) == rows(filled.tables.read("days").drop("month"))


def test_a_copy_left_unfinished_is_made_anew(filled, write, monkeypatch):
    filled.by_symbol("days", 4)
    filled.import_days(write("more.csv", DAYS, *lines("AH", range(60, 64))))
    filled.merge()
    real = Buckets._mark

    def broken(self, home, done):
        if done:
            raise RuntimeError("lost")
        real(self, home, done)

    with monkeypatch.context() as patch:
        patch.setattr(Buckets, "_mark", broken)
        with pytest.raises(RuntimeError):
            filled.by_symbol("days", 4)
    assert filled.by_symbol("days", 4).count() == 428


def test_an_empty_store_and_a_reset_one(store, filled):
    assert filled.by_symbol("days", 4).count() == 420
    store.reset()
    assert store.by_symbol("days", 4).count() == 0 and store.adjust(buckets=4).adjusted == 0
