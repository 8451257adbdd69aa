"""Minute files imported as they arrive."""

from __future__ import annotations

import pytest

from pricefold.streaming.arrivals import checkpoint_folder, import_arrived_minutes


def symbols(store):
    return sorted(row["symbol"] for row in store.tables.read("minutes_import").collect())


def test_each_file_is_imported_once(store, write, tmp_path):
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    write("landing/aapl.csv", "2020-01-02 10:00:00,33,30,31,32,5,5")
    write("landing/msft.csv", "2020-01-02 10:00:00,33,30,31,32,5,5", "2020-01-02 10:01:00,33,30,31,32,5,5")
    reports = import_arrived_minutes(store, landing, checkpoint)
    assert sum(report.accepted for report in reports) == 3
    assert symbols(store) == ["AAPL", "MSFT", "MSFT"]
    assert import_arrived_minutes(store, landing, checkpoint) == []
    write("landing/ibm.csv", "2020-01-03 10:00:00,33,30,31,32,5,5", "broken")
    with pytest.raises(Exception, match="row does not parse"):
        import_arrived_minutes(store, landing, checkpoint)
    assert symbols(store) == ["AAPL", "MSFT", "MSFT"]
    assert [report.rejected for report in import_arrived_minutes(store, landing, checkpoint, skip_errors=True)] == [1]
    assert symbols(store) == ["AAPL", "IBM", "MSFT", "MSFT"]
    staged = store.tables.read("minutes_import")
    assert staged.select("_seq").distinct().count() == staged.count()


def test_checkpoint_folder_is_under_the_shared_one(store):
    shared = store.spark.conf.get("spark.checkpoint.dir", None) or store.tables.root
    first, second = checkpoint_folder(store, "/in/a"), checkpoint_folder(store, "/in/b")
    assert first.startswith(shared.rstrip("/") + "/") and first.endswith("/in-a") and first != second


def test_a_batch_that_is_run_again_replaces_its_rows(store, write, tmp_path, monkeypatch):
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    write("landing/aapl.csv", "2020-01-02 10:00:00,33,30,31,32,5,5")
    import_arrived_minutes(store, landing, checkpoint)
    write("landing/msft.csv", "2020-01-02 10:00:00,33,30,31,32,5,5", "2020-01-02 10:01:00,33,30,31,32,5,5")
    stage = type(store).stage

    def lost_after_its_write(*args, **options):
        stage(*args, **options)
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(type(store), "stage", lost_after_its_write)
        with pytest.raises(Exception, match="lost"):
            import_arrived_minutes(store, landing, checkpoint)
    assert symbols(store) == ["AAPL", "MSFT", "MSFT"]
    reports = import_arrived_minutes(store, landing, checkpoint)
    assert symbols(store) == ["AAPL", "MSFT", "MSFT"] and [report.accepted for report in reports] == [2]
    staged = store.tables.read("minutes_import")
    assert staged.select("_seq").distinct().count() == 3 and reports[0].batch == 2
    # A new checkpoint is another stream, whose batches replace none of these.
    assert sum(report.accepted for report in import_arrived_minutes(store, landing, str(tmp_path / "other"))) == 3
    assert symbols(store) == ["AAPL"] * 2 + ["MSFT"] * 4
