"""From files to lookups through the store's verbs."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest

from pricefold.operators import adjustment
from pricefold.plans import adjusting, merging
from pricefold.session import joins_on_part_of_keys
from pricefold.sinks import tables
from pricefold.sources import csv_files, rows
from pricefold.store import PriceStore

DAYS = "ticker,date,open,high,low,close,volume,ex-dividend,split_ratio,adj_open,adj_high,adj_low,adj_close,adj_volume"
ACTIONS = "Date(ex),RegularDividend$,Split"


def day(ticker, when, open_, high, low, close, dividend="0.0", split="1.0"):
    return f"{ticker},{when},{open_},{high},{low},{close},1000.0,{dividend},{split},1,1,1,1,1"


GOLDEN = [
    day("X", "2020-01-01", 30, 30, 30, 30),
    day("X", "2020-01-02", 31, 33, 30, 32),
    day("X", "2020-01-03", 16.1, 16.5, 15.5, 16, split="2.0"),
    day("X", "2020-02-04", 16.5, 17.5, 16, 17),
]


def collected(frame, *names):
    return sorted(tuple(row) for row in frame.select(*names).collect())


def test_days_from_file_to_lookup(store, write):
    lines = [*GOLDEN, day("Y", "2020-01-03", 10, 11, 9, 10)]
    lines[1] = day("X", "2020-01-02", 31, 33, 30, 32, dividend="0.3")
    report = store.import_days(write("days.csv", DAYS, *lines))
    assert (report.accepted, report.rejected, report.too_old) == (5, 0, 0)
    merged = store.merge()
    assert (merged.minutes, merged.days, merged.adjustments) == (0, 5, 2)
    store.adjust()
    stored = store.tables.read("days_adjusted").where("symbol = 'X'")
    assert collected(stored, "date", "adjustment_coefficient", "adjusted_open") == [
        (date(2020, 1, 1), 4950, 148500),
        (date(2020, 1, 2), 5000, 155000),
        (date(2020, 1, 3), 10000, 161000),
        (date(2020, 2, 4), 10000, 165000),
    ]
    found = store.get_day("X", "2020-01-01").collect()
    assert [row.asDict() for row in found] == [
        {
            "symbol": "X",
            "date": "2020-01-01",
            **{price: Decimal(30) for price in ("open", "high", "low", "close")},
            **{f"adjusted_{price}": Decimal("14.85") for price in ("open", "high", "low", "close")},
        }
    ]
    assert store.get("day", "X", "2020-01-09").collect() == []
    with pytest.raises(ValueError):
        store.get("week", "X", "2020-01-01")


def test_merge_again_changes_nothing(store, write):
    store.import_days(write("days.csv", DAYS, *GOLDEN))
    store.import_minutes(write("x.csv", "2020-01-02 10:00:00,33,30,31,32,5,5"), "x")
    store.merge()
    before = {table: collected(store.tables.read(table), "*") for table in ("minutes", "days", "adjustments")}
    again = store.merge(rescan=True)
    assert (again.minutes, again.days, again.adjustments) == (0, 0, 0)
    assert before == {table: collected(store.tables.read(table), "*") for table in before}


def test_minutes_from_file_to_lookup(store, write):
    minutes = write(
        "in/AAL.csv",
        "2013-12-09 09:30:00,24.0,23.9,23.95,23.98,100,1",
        "",
        "2013-12-09 12:00:00,25.44,23.4501,24.1,24.2,100,1,extra",
        "2013-12-09 15:59:00,24.7,24.5,24.55,24.6,100,1",
        "2013-12-10 09:30:00,26,25,25.5,25.75,100,1",
    )
    actions = write("adj.txt", ACTIONS + ",Note", "2013.12.10,0.4920,2,n", "2013.12.11,1,1,no such day")
    assert store.import_minutes(minutes).accepted == 4
    store.import_adjustments(actions, "aal")
    store.merge()
    bars = store.tables.read("days").where("date = date'2013-12-09'")
    assert collected(bars, "symbol", "open", "high", "low", "close") == [("AAL", 239500, 254400, 234501, 246000)]
    store.adjust()
    coefficient = Decimal(2) * (1 - Decimal("0.492") / Decimal("24.6"))
    assert coefficient == Decimal("1.96")
    found = store.get("minute", "AAL", "2013-12-09 12:00:00").collect()
    assert len(found) == 1
    assert found[0]["date"] == "2013-12-09 12:00:00"
    assert found[0]["low"] == Decimal("23.4501")
    assert found[0]["adjusted_low"] == Decimal("45.9621")
    view = store.spark.sql("select * from minutes_view where symbol = 'AAL'")
    assert view.count() == 4


def test_a_day_without_adjusted_row_reads_as_zero(store, write):
    store.import_minutes(write("x.csv", "2020-01-02 10:00:00,33,30,31,32,5,5"), "x")
    store.merge()
    for view in (store.days_view(), store.minutes_view()):
        assert collected(view, "open", "adjusted_open", "adjusted_close") == [(310000, 0, 0)]


def test_source_priorities(store, write):
    store.import_minutes(write("x.csv", "2020-01-02 10:00:00,50,40,45,46,5,5"), "X")
    store.import_days(write("days.csv", DAYS, *GOLDEN[:2], day("X", "2020-01-03", 1, 1, 1, 1, "0.5")))
    store.import_adjustments(write("a.txt", ACTIONS, "2020.01.03,0.7,1", "2020.01.02,0.9,1"), "X")
    store.merge()
    days, actions = store.tables.read("days"), store.tables.read("adjustments")
    assert collected(days, "date", "open")[1] == (date(2020, 1, 2), 450000)
    assert collected(actions, "date", "dividend") == [(date(2020, 1, 2), 9000), (date(2020, 1, 3), 5000)]
    # What is stored stays: later minutes of a stored day and repeated keys change nothing.
    store.import_minutes(write("x2.csv", "2020-01-02 09:00:00,60,30,35,36,5,5", "2020-01-02 10:00:00,1,1,1,1,1,1"), "X")
    store.import_days(write("days2.csv", DAYS, day("X", "2020-01-01", 99, 99, 99, 99)))
    report = store.merge()
    assert (report.minutes, report.days, report.adjustments) == (1, 0, 0)
    assert collected(store.tables.read("days"), "date", "open")[:2] == [
        (date(2020, 1, 1), 300000),
        (date(2020, 1, 2), 450000),
    ]


def test_last_imported_row_of_a_key_wins(store, write):
    store.import_days(write("a.csv", DAYS, day("X", "2020-01-01", 1, 1, 1, 1), day("X", "2020-01-01", 2, 2, 2, 2)))
    store.merge()
    assert collected(store.tables.read("days"), "open") == [(20000,)]
    store.reset()
    store.import_days(write("a.csv", DAYS, day("X", "2020-01-01", 3, 3, 3, 3)))
    store.import_days(write("b.csv", DAYS, day("X", "2020-01-01", 2, 2, 2, 2)))
    store.merge()
    assert collected(store.tables.read("days"), "open") == [(20000,)]


def test_import_sequence_and_overwrite(store, write):
    first = store.import_days(write("a.csv", DAYS, GOLDEN[0]))
    second = store.import_days(write("b.csv", DAYS, *GOLDEN[1:]))
    assert second.batch > first.batch
    staged = store.tables.read("days_import")
    assert staged.count() == staged.select("_seq").distinct().count() == 4
    assert staged.where(f"batch = {first.batch}").agg({"_seq": "max"}).first()[0] < (
        staged.where(f"batch = {second.batch}").agg({"_seq": "min"}).first()[0]
    )
    store.merge(since={"days_import": first.batch})
    assert store.tables.read("days").count() == 3
    store.import_days(write("c.csv", DAYS, day("Z", "2021-01-01", 1, 1, 1, 1)), overwrite=True)
    assert collected(store.tables.read("days_import"), "symbol") == [("Z",)]


def test_bad_rows(store, write):
    bad = write("bad.csv", DAYS, GOLDEN[0], day("X", "2020-1-2", "NaN", 1, 1, 1), "X,2020-01-03,1,1,1", GOLDEN[3])
    store.import_days(write("good.csv", DAYS, GOLDEN[0]))
    for overwrite in (False, True):
        with pytest.raises(Exception, match="row does not parse"):
            store.import_days(bad, overwrite=overwrite)
        assert store.tables.read("days_import").count() == 1
    report = store.import_days(bad, skip_errors=True)
    assert (report.accepted, report.rejected) == (2, 2)
    assert store.tables.read("days_import").count() == 3
    rejects = store.spark.read.parquet(store.tables.path("rejects") + "/days_import")
    assert collected(rejects, "date") == [("2020-01-03",), ("2020-1-2",)]


def test_missing_file_or_column(store, write, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        store.import_days(str(tmp_path / "none.csv"))
    with pytest.raises(Exception, match="split_ratio"):
        store.import_days(write("short.csv", "ticker,date,open,high,low,close,ex-dividend", "X,2020-01-01,1,1,1,1,0"))


def test_columns_are_found_by_name(store, write):
    path = write("turned.csv", "split_ratio,ex-dividend,close,low,high,open,date,ticker", "2,0.5,4,3,2,1,2020-01-01,q")
    store.import_days(path)
    names = ("symbol", "open", "high", "low", "close", "dividend", "split_ratio")
    assert collected(store.tables.read("days_import"), *names) == [("q", 10000, 20000, 30000, 40000, 5000, 20000)]


def test_files_of_one_import_must_agree_on_their_header(store, write, tmp_path):
    write("in/a.csv", "ticker,date,open,high,low,close,ex-dividend,split_ratio", "a,2020-01-01,1,2,3,4,0,1")
    write("in/b.csv", "ticker,date,close,high,low,open,ex-dividend,split_ratio", "b,2020-01-01,1,2,3,4,0,1")
    with pytest.raises(Exception, match="CSV header does not conform|header"):
        store.import_days(str(tmp_path / "in"))
    assert store.tables.read("days_import").count() == 0


def test_minimum_date_and_offset(store, write):
    dates = ["1969-12-31", "1970-01-01", "1970-01-02", "1970-01-03", "1970-01-04", "1970-01-05"]
    path = write("old.csv", DAYS, *[day("X", when, 1, 1, 1, 1) for when in dates])
    report = store.import_days(path, offset=3)
    assert (report.accepted, report.rejected, report.too_old) == (5, 0, 1)
    assert collected(store.tables.read("days_import"), "date") == [(date(1970, 1, day),) for day in (3, 4, 5)]


def test_offset_counts_in_file_order_across_splits(spark, store, write):
    moments = [f"2020-01-01 {hour:02}:{minute:02}:00" for hour in range(24) for minute in range(60)]
    path = write("long.csv", *[f"{moment},3,1,2,2,0,0" for moment in moments])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.minPartitionNum", "20")
    try:
        store.import_minutes(path, "X", offset=1001)
        staged = store.tables.read("minutes_import")
        assert staged.rdd.getNumPartitions() > 1
        assert collected(staged, "date") == [(datetime.fromisoformat(moment),) for moment in moments[1000:]]
        in_order = [row["date"] for row in staged.orderBy("_seq").collect()]
        assert in_order == sorted(in_order)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_offset_counts_each_file_by_itself(spark, write, tmp_path):
    for name in ("a", "b"):
        write(f"in/{name}.csv", *[f"2020-01-0{day} 10:00:00,3,1,2,2,0,0" for day in range(1, 6)], "bad")
    typed = rows.type_minutes(csv_files.read_minutes(spark, str(tmp_path / "in")))
    good = rows.accepted(typed, "minutes_import", skip_errors=True)
    for max_blocks in (0, 100):
        kept = rows.from_offset(good, 4, max_blocks=max_blocks)
        assert collected(kept, "symbol", "date") == [
            (symbol, datetime(2020, 1, day, 10)) for symbol in ("A", "B") for day in (4, 5)
        ]
    plan = rows.from_offset(good, 4, max_blocks=0)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_symbols_from_file_names(spark, write, tmp_path):
    for name in ("^gspc.csv", "BRK.B.csv", "a+b c%20.csv", "plain"):
        write(f"in/{name}", "2020-01-01 10:00:00,1,1,1,1,1,1")
    text = csv_files.read_minutes(spark, str(tmp_path / "in"))
    assert collected(text, "symbol") == [("A+B C%20",), ("BRK.B",), ("PLAIN",), ("^GSPC",)]
    write("adj/adj_AAL.txt", ACTIONS, "2020.01.01,1,1")
    actions = csv_files.read_adjustments(spark, str(tmp_path / "adj"), name_pattern=r"^adj_(.*)\.txt$")
    assert collected(actions, "symbol") == [("AAL",)]


def test_nothing_to_do(store, write):
    assert store.import_minutes(write("empty.csv"), "X").accepted == 0
    report = store.import_minutes(write("bad.csv", "x,y", "z"), "X", skip_errors=True)
    assert (report.accepted, report.rejected) == (0, 2)
    assert store.import_days(write("header.csv", DAYS)).accepted == 0
    merged = store.merge()
    assert (merged.minutes, merged.days, merged.adjustments) == (0, 0, 0)
    for skip in (False, True):
        for exact in (False, True):
            assert store.adjust(skip_errors=skip, exact=exact).adjusted == 0
    assert store.get_minute("X", "2020-01-01 00:00:00").collect() == []


def test_failed_adjust_leaves_the_old_prices(store, write):
    store.import_days(write("days.csv", DAYS, *GOLDEN))
    store.merge()
    store.adjust()
    before = collected(store.tables.read("days_adjusted"), "*")
    store.import_adjustments(write("a.txt", ACTIONS, "2020.02.04,16,2"), "X")
    store.merge()
    for exact in (True, False):
        with pytest.raises(Exception, match="dividend not below the prior close: symbol X, close of 2020-01-03"):
            store.adjust(exact=exact)
        assert collected(store.tables.read("days_adjusted"), "*") == before
        report = store.adjust(skip_errors=True, exact=exact)
        assert (report.adjusted, report.bad_dividends) == (4, 1)
        rejects = store.spark.read.parquet(store.tables.path("rejects/days_adjusted"))
        assert collected(rejects, "date", "newer_date", "newer_dividend") == [
            (date(2020, 1, 3), date(2020, 2, 4), 160000)
        ]
        before = collected(store.tables.read("days_adjusted"), "*")
        assert [row[2] for row in before] == [10000, 10000, 20000, 10000]


def test_lookup_reads_one_month_with_pushed_filters(store, write):
    store.import_days(write("days.csv", DAYS, *GOLDEN))
    store.import_minutes(write("x.csv", "2020-01-02 10:00:00,33,30,31,32,5,5", "2020-02-02 10:00:00,3,3,3,3,5,5"), "X")
    store.merge()
    store.adjust()
    for found in (store.get_day("X", "2020-01-02"), store.get_minute("X", "2020-01-02 10:00:00")):
        # The month asked for, and the empty one that each table has.
        months = sorted(name.split("month=")[1].split("/")[0] for name in found.inputFiles())
        assert months == ["1969-12-01"] * 2 + ["2020-01-01"] * 2
        assert found.count() == 1
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 2
        pushed = found._jdf.queryExecution().explainString(
            found.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
        assert pushed.count("EqualTo(symbol,X)") == 2 and pushed.count("EqualTo(date,") == 2
    assert store.get_day("X", "1999-01-02").collect() == []


def test_views_can_be_filtered_in_sql(store, write):
    store.import_days(write("days.csv", DAYS, *GOLDEN))
    store.merge()
    store.adjust()
    found = store.spark.sql("select adjusted_open from days_view where symbol = 'X' and date = date'2020-01-02'")
    assert found.collect()[0][0] == 155000
    assert store.spark.table("minutes_view").count() == 0


def test_a_merge_touches_only_its_months(store, write):
    store.import_days(write("days.csv", DAYS, *GOLDEN))
    store.merge()
    store.import_days(write("more.csv", DAYS, day("Y", "2020-02-04", 1, 1, 1, 1), day("Y", "2020-03-04", 2, 2, 2, 2)))
    assert store.merge().days == 2
    assert store.tables.read("days").count() == 6
    january, march = date(2020, 1, 1), date(2020, 3, 1)
    assert store.tables.read("days", [january, march, date(2030, 1, 1)]).count() == 4
    assert store.tables.read("days", [date(2030, 1, 1)]).count() == 0


def test_reset_empties_the_tables(store, write):
    store.import_days(write("days.csv", DAYS, *GOLDEN))
    store.merge()
    store.adjust()
    store.reset()
    for table in ("days_import", "days", "adjustments", "days_adjusted", "minutes"):
        assert store.tables.read(table).count() == 0
    assert store.spark.table("days_view").count() == 0


@pytest.fixture(params=["static", "dynamic"])
def overwrite_mode(spark, request):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", request.param)
    yield request.param
    spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_verbs_do_not_depend_on_the_overwrite_mode(overwrite_mode, store, write):
    store.import_days(write("a.csv", DAYS, *GOLDEN))
    store.import_days(write("b.csv", DAYS, day("Z", "2021-01-01", 1, 1, 1, 1)), overwrite=True)
    assert collected(store.tables.read("days_import"), "symbol") == [("Z",)]
    assert store.merge().days == 1
    assert store.adjust().adjusted == 1
    store.reset()
    for table in ("days_import", "days", "adjustments", "days_adjusted"):
        assert store.tables.read(table).count() == 0
    store.import_days(write("c.csv", DAYS, *GOLDEN))
    assert store.merge().days == 4


def test_batch_numbers_are_never_used_again(store, write):
    first = store.import_days(write("a.csv", DAYS, GOLDEN[0])).batch
    second = store.import_days(write("b.csv", DAYS, GOLDEN[1])).batch
    assert store.merge().days == 2
    third = store.import_days(write("c.csv", DAYS, GOLDEN[2]), overwrite=True).batch
    assert first < second < third
    assert store.merge(since={"days_import": second}).days == 1
    store.reset()
    assert store.import_days(write("d.csv", DAYS, GOLDEN[3])).batch > third
    # A store from before the markers goes by the names of its batches.
    import shutil

    shutil.rmtree(store.tables.path("imports"))
    assert store.import_days(write("e.csv", DAYS, GOLDEN[3])).batch > third + 1


def test_rejects_of_all_imports_stay(store, write):
    for name, overwrite in (("a", False), ("b", True)):
        store.import_days(write(f"{name}.csv", DAYS, GOLDEN[0], f"{name},no date,1,1,1"), skip_errors=True, overwrite=overwrite)
    rejects = store.spark.read.parquet(store.tables.path("rejects") + "/days_import")
    assert collected(rejects, "ticker") == [("a",), ("b",)]


def test_overwrite_helps_when_the_row_numbers_are_used_up(store, write, monkeypatch):
    monkeypatch.setattr(tables, "_MAX_PARTITIONS", 2)
    paths = [write(f"{name}.csv", DAYS, GOLDEN[0]) for name in "abc"]
    for path in paths[:2]:
        store.import_days(path)
    with pytest.raises(OverflowError):
        store.import_days(paths[2])
    assert store.import_days(paths[2], overwrite=True).accepted == 1
    assert store.import_days(paths[2]).accepted == 1


def test_a_new_session_sees_both_views(store, write):
    store.import_days(write("days.csv", DAYS, *GOLDEN))
    store.merge()
    store.adjust()
    other = store.spark.newSession()
    PriceStore(other, store.tables.root)
    assert other.sql("select adjusted_open from days_view where symbol = 'X' and date = date'2020-01-02'").first()[0] == 155000
    assert other.table("minutes_view").count() == 0


def test_views_and_ranges_read_only_their_months(store, write):
    lines = [day("X", f"2020-{month:02}-03", month, month, month, month) for month in range(1, 13)]
    store.import_days(write("days.csv", DAYS, *lines))
    store.import_minutes(write("x.csv", *[f"2021-{month:02}-03 10:00:00,3,3,3,3,5,5" for month in range(1, 13)]), "X")
    store.merge()
    store.adjust()
    found = store.spark.sql("select * from days_view where month = date'2020-03-01' and symbol = 'X'")
    assert found.count() == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [") == 2 and "PartitionFilters: []" not in plan
    for between, wanted in (
        (store.days_between("X", "2020-03-03", "2020-05-02"), [date(2020, month, 3) for month in (3, 4)]),
        (store.minutes_between("X", "2021-11-03 10:00:00", "2021-12-03 10:00:00"),
         [datetime(2021, month, 3, 10) for month in (11, 12)]),
    ):
        assert [row.date for row in between.orderBy("date").collect()] == wanted
        months = {name.split("month=")[1].split("/")[0] for name in between.inputFiles()}
        assert len(months) <= 4
    assert store.days_between("X", "2020-05-01", "2020-03-01").count() == 0


def test_adjust_shuffles_the_bars_once(store, write):
    store.import_days(write("days.csv", DAYS, *GOLDEN))
    store.merge()
    spark = store.spark
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with joins_on_part_of_keys(spark):
            rows = adjusting.with_actions(store.tables.read("days"), store.tables.read("adjustments"), by_symbol=True)
            for exact in (True, False):
                plan = adjustment.adjusted_days(rows, exact=exact)._jdf.queryExecution().executedPlan().toString()
                above, _, below = plan.partition("SortMergeJoin")
                assert "Exchange" not in above and below.count("Exchange hashpartitioning") == 2
        assert store.adjust().adjusted == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_skipping_takes_one_join_and_one_window(store, write):
    store.import_days(write("days.csv", DAYS, *GOLDEN))
    store.merge()
    rows = adjusting.with_actions(store.tables.read("days"), store.tables.read("adjustments"))
    plan = adjustment.adjusted_days(rows, skip_errors=True, report=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join ") == 1 and plan.count("Window [") == 1
    assert "Join" not in store.tables.hidden("days_adjusted")._jdf.queryExecution().executedPlan().toString()


def test_a_merge_reduces_stored_rows_before_the_shuffle(store, write):
    store.import_minutes(write("x.csv", *[f"2020-01-{day:02} 10:00:00,33,30,31,32,5,5" for day in range(1, 29)]), "X")
    store.merge()
    staged = store.tables.read("minutes_import").where("date = timestamp_ntz'2020-01-05 10:00:00'")
    existing = merging.of_days(store.tables.read("minutes"), merging.staged_days(staged), "day")
    assert existing.count() == 1
    plan = merging.minutes_delta(staged, existing)._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "LeftAnti" not in plan and plan.index("HashAggregate") < plan.index("LeftSemi")


def test_months_can_be_laid_out_again(store, write):
    january = date(2020, 1, 1)
    for number, line in enumerate(GOLDEN[:3]):
        store.import_days(write(f"{number}.csv", DAYS, line))
        store.merge()
    before = collected(store.tables.read("days"), "*")
    assert len(store.tables.read("days", [january]).inputFiles()) == 4
    assert store.rewrite_months("days", [january]) == 3
    assert len(store.tables.read("days", [january]).inputFiles()) == 2
    assert collected(store.tables.read("days"), "*") == before
    assert store.rewrite_months("days", []) == 0


def test_line_breaks_in_quoted_fields(store, write):
    path = write("notes.csv", "ticker,note,date,open,high,low,close,ex-dividend,split_ratio", 'x,"two', 'lines",2020-01-01,1,2,1,2,0,1')
    with pytest.raises(Exception, match="row does not parse"):
        store.import_days(path)
    assert store.import_days(path, multiline=True).accepted == 1


def test_many_keys_at_once(store, write):
    store.import_days(write("days.csv", DAYS, *GOLDEN, day("Y", "2021-05-03", 10, 11, 9, 10)))
    store.import_minutes(write("z.csv", "2020-01-02 10:00:00,33,30,31,32,5,5", "2020-03-02 10:01:00,3,2,2,3,5,5"), "Z")
    store.merge()
    store.adjust()
    asked = [("X", "2020-01-02"), ("X", "2020-01-02"), ("X", "2020-01-09"), ("Y", "2021-05-03"), (None, "2020-01-02"), ("X", None)]
    keys = store.spark.createDataFrame([(s, d, "extra", 1) for s, d in asked], "symbol string, date string, open string, month int")
    found = sorted((tuple(row) for row in store.get_days(keys).select("symbol", "date", "found", "open", "adjusted_open").collect()), key=repr)
    assert found == sorted([
        ("X", "2020-01-02", True, Decimal(31), Decimal("15.5")), ("X", "2020-01-02", True, Decimal(31), Decimal("15.5")),
        ("X", "2020-01-09", False, None, None), ("Y", "2021-05-03", True, Decimal(10), Decimal(10)),
        (None, "2020-01-02", False, None, None), ("X", None, False, None, None),
    ], key=repr)
    times = [("Z", "2020-01-02 10:00:00"), ("Z", "2020-01-02 10:02:00"), ("Z", "2020-03-02 10:01:00"), ("Z", "2020-03-02 10:01:00")]
    minutes = store.spark.createDataFrame(times, "symbol string, date string")
    rows = store.get_minutes(minutes).select("date", "found", "close").collect()
    assert sorted((row.date, row.found, row.close) for row in rows) == [
        (times[0][1], True, Decimal(32)), (times[1][1], False, None), *[(times[2][1], True, Decimal(3))] * 2,
    ]
    none = store.spark.createDataFrame([], "symbol string, date date")
    assert store.get_days(none).collect() == []
    for date_, symbol in (("2020-01-02", "X"), ("2020-02-04", "X")):
        one = store.get_day(symbol, date_).drop("symbol", "date").collect()
        many = store.get_days(store.spark.createDataFrame([(symbol, date_)], "symbol string, date string"))
        assert many.drop("symbol", "date", "found").collect() == one


def test_a_lookup_of_few_keys_reads_their_months_and_shuffles_no_table(store, write):
    lines = [day("X", f"20{year}-{month:02}-03", 3, 3, 3, 3) for year in (19, 20) for month in range(1, 13)]
    store.import_days(write("days.csv", DAYS, *lines))
    store.merge()
    store.adjust()
    keys = store.spark.createDataFrame([("X", "2019-03-03"), ("X", "2020-07-03")], "symbol string, date string")
    found = store.get_days(keys)
    files = {name.split("month=")[1][:10] for name in found.inputFiles()}
    assert files <= {"2019-03-01", "2020-07-01", "1969-12-01"}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [month") >= 2 and "PartitionFilters: []" not in plan
    # Both tables meet the keys in broadcast joins, and only what is left of them meets further.
    assert plan.count("LeftSemi, BuildRight") >= 2 and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_the_next_bar_gets_the_action_of_a_day_without_one(store, write):
    store.import_days(write("days.csv", DAYS, *GOLDEN))
    store.import_adjustments(write("x.txt", ACTIONS, "2020.01.20,0.17,2", "2020.02.05,1,1"), "X")
    store.merge()
    plain = store.adjust()
    assert (plain.moved_actions, plain.lost_actions) == (0, 0)
    report = store.adjust(lost="next_bar")
    assert (report.adjusted, report.moved_actions, report.lost_actions) == (4, 1, 1)
    coefficient = {row.date: row.adjustment_coefficient for row in store.tables.read("days_adjusted").collect()}
    # The close before the moved action is 16: (16 - 0.17) / 16, and twice that, as its ratio is one half.
    assert coefficient[date(2020, 2, 4)] == 10000 and coefficient[date(2020, 1, 3)] == 19787
    moved = store.spark.read.parquet(store.tables.path("moved_actions"))
    assert collected(moved.where("bar is not null"), "date", "bar") == [(date(2020, 1, 20), date(2020, 2, 4))]
    again = store.adjust(lost="next_bar", by_segment=True)
    assert (again.adjusted, again.moved_actions) == (4, 1)
    assert {row.date: row.adjustment_coefficient for row in store.tables.read("days_adjusted").collect()} == coefficient


def files_of(store, table, month):
    return sorted(store.tables.read(table, [month]).inputFiles())


def test_newest_rows_replace_stored_ones_and_leave_other_months(store, write):
    january, february = date(2020, 1, 1), date(2020, 2, 1)
    store.import_days(write("days.csv", DAYS, *GOLDEN))
    store.import_minutes(write("x.csv", "2020-01-02 10:00:00,50,40,45,46,5,5", "2020-01-02 11:00:00,51,40,45,47,5,5"), "X")
    store.merge()
    before = files_of(store, "days", february), files_of(store, "days", january)
    store.import_days(write("b.csv", DAYS, day("X", "2020-01-01", 99, 99, 99, 99, "0.5"), day("X", "2020-01-02", 1, 1, 1, 1)))
    store.import_minutes(write("y.csv", "2020-01-02 10:00:00,60,30,35,36,5,5"), "X")
    assert store.merge().replaced == 0
    report = store.merge(newest=True)
    # A minute, the bar of its day, and an imported bar; its action is new. Minutes come before the imported second.
    assert (report.minutes, report.days, report.adjustments, report.replaced) == (0, 0, 0, 3)
    bars = collected(store.tables.read("days"), "date", "open", "high", "low", "close")
    assert bars[:2] == [(date(2020, 1, 1), *[990000] * 4), (date(2020, 1, 2), 350000, 600000, 300000, 470000)]
    assert len(bars) == 4 and store.tables.read("minutes").count() == 2
    assert collected(store.tables.read("adjustments").where("date = date'2020-01-01'"), "dividend") == [(5000,)]
    assert files_of(store, "days", february) == before[0] and files_of(store, "days", january) != before[1]
    laid = files_of(store, "days", january)
    again = store.merge(newest=True)
    assert (again.minutes, again.days, again.adjustments, again.replaced) == (0, 0, 0, 0)
    assert files_of(store, "days", january) == laid
    # Without the option what is stored stays.
    store.import_days(write("c.csv", DAYS, day("X", "2020-01-01", 1, 1, 1, 1)))
    store.merge()
    assert collected(store.tables.read("days"), "date", "open")[0] == (date(2020, 1, 1), 990000)


def full_roll_up(store):
    from pricefold.operators.bars import day_bars

    return collected(day_bars(store.tables.read("minutes")), "symbol", "date", "open", "high", "low", "close")


def test_refreshed_bars_equal_a_full_roll_up(store, write):
    store.import_minutes(write("a.csv", "2020-01-02 10:00:00,50,40,45,46,5,5", "2020-02-03 10:00:00,9,8,9,8,5,5"), "X")
    store.merge()
    february = files_of(store, "days", date(2020, 2, 1))
    store.import_minutes(write("b.csv", "2020-01-02 09:00:00,49,41,44,45,5,5", "2020-01-02 16:00:00,55,39,47,48,5,5"), "X")
    stale = collected(store.tables.read("days"), "open")
    store.merge()
    assert collected(store.tables.read("days"), "open") == stale
    # Their minutes are stored now, so only minutes to come refresh the bar.
    store.import_minutes(write("c.csv", "2020-01-02 08:00:00,60,41,43,45,5,5", "2020-01-03 08:00:00,6,4,4,5,5,5"), "X")
    report = store.merge(refresh=True)
    assert (report.minutes, report.days, report.replaced) == (2, 1, 1)
    assert files_of(store, "days", date(2020, 2, 1)) == february
    found = collected(store.tables.read("days"), "symbol", "date", "open", "high", "low", "close")
    assert found[0] == ("X", date(2020, 1, 2), 430000, 600000, 400000, 460000)
    # An imported bar gives way to all minutes of its day.
    store.import_days(write("d.csv", DAYS, day("X", "2020-01-07", 1, 1, 1, 1)))
    store.merge()
    store.import_minutes(write("e.csv", "2020-01-07 08:00:00,60,41,43,45,5,5"), "X")
    assert store.merge(refresh=True).replaced == 1
    assert ("X", date(2020, 1, 7), 430000, 600000, 410000, 450000) in full_roll_up(store)
    assert collected(store.tables.read("days").where("date = date'2020-01-07'"), "open") == [(430000,)]


def test_a_refresh_that_broke_off_is_made_up_for(store, write, monkeypatch):
    store.import_minutes(write("a.csv", "2020-01-02 10:00:00,50,40,45,46,5,5"), "X")
    store.merge()
    store.import_minutes(write("b.csv", "2020-01-02 09:00:00,49,41,44,45,5,5"), "X")
    with monkeypatch.context() as broken:
        broken.setattr(PriceStore, "_refresh", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.merge(refresh=True)
    assert store.tables.read("minutes").count() == 2
    assert store.merge(refresh=True).replaced == 1
    assert collected(store.tables.read("days"), "symbol", "date", "open", "high", "low", "close") == full_roll_up(store)
    assert not store.tables.exists("added/minutes")


def test_a_bar_that_knows_its_minutes_is_refreshed_without_them(store, write, monkeypatch):
    store.import_minutes(write("a.csv", "2020-01-02 10:00:00,50,40,45,46,5,5"), "X")
    store.merge()
    store.import_minutes(write("b.csv", "2020-01-02 09:00:00,49,41,44,45,5,5"), "X")
    given = []
    plain = merging.refreshed_days
    monkeypatch.setattr(merging, "refreshed_days", lambda *frames: given.append(plain(*frames)) or given[-1])
    assert store.merge(refresh=True).replaced == 1
    assert given and not [name for name in given[0].inputFiles() if "/minutes/month=" in name]


def test_an_incremental_adjustment_equals_a_full_one(store, write):
    def prices():
        return collected(store.tables.read("days_adjusted"), "symbol", "date", "adjustment_coefficient", "adjusted_open")

    store.import_days(write("a.csv", DAYS, *GOLDEN, day("Y", "2020-01-03", 10, 11, 9, 10), day("Y", "2020-03-03", 10, 11, 9, 10)))
    store.merge()
    # Without a run before, all symbols are adjusted.
    assert store.adjust(incremental=True).adjusted == 6
    assert store.adjust(incremental=True).adjusted == 0
    march = files_of(store, "days_adjusted", date(2020, 3, 1))
    store.import_days(write("b.csv", DAYS, day("X", "2020-02-05", 8, 9, 7, 8, split="2.0"), day("Z", "2020-02-05", 8, 9, 7, 8)))
    store.merge()
    # Four older rows of X change, and two rows are new.
    assert store.adjust(incremental=True).adjusted == 6
    assert files_of(store, "days_adjusted", date(2020, 3, 1)) == march
    found = prices()
    assert store.adjust().adjusted == 8 and prices() == found
    assert store.adjust(incremental=True, skip_errors=True).adjusted == 8 and prices() == found
    assert store.adjust(incremental=True, skip_errors=True).adjusted == 0
