"""Import of minute files as they arrive in a directory.

The same import as ``PriceStore.import_minutes``, driven by a file stream: its checkpoint remembers which files are
imported, so calling it again takes only new ones. Files already in staging are never read again.
"""

from __future__ import annotations

import re
from queue import Queue

from pyspark.sql import DataFrame

from pricefold.sources.csv_files import minute_stream
from pricefold.store import ImportReport, PriceStore


def checkpoint_folder(store: PriceStore, landing: str) -> str:
    """A folder for this store and directory under the cluster's shared one, or beside the tables if it names none."""
    shared = store.spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        return store.tables.path(f"checkpoints/{_slug(landing)}")
    return f"{shared.rstrip('/')}/minute_arrivals/{_slug(store.tables.root)}/{_slug(landing)}"


def _slug(path: str) -> str:
    return re.sub(r"[^A-Za-z0-9]+", "-", path).strip("-")


def import_arrived_minutes(
    store: PriceStore,
    landing: str,
    checkpoint: str | None = None,
    skip_errors: bool = False,
    files_per_batch: int = 10_000,
) -> list[ImportReport]:
    """Import the minute files that are new in ``landing``; each file's name gives its symbol.

    Returns one report per micro-batch once all files there have been imported. A batch that is run again after a failure
    replaces what it had staged, known by the stream, which its checkpoint names, and by the batch's number in it. After a
    reset of the store give a new checkpoint, since the old one still counts the files as imported.
    """
    reports: list[ImportReport] = []
    started: Queue[str] = Queue()

    def stage(text: DataFrame, number: int) -> None:
        stream = started.get()
        started.put(stream)
        report = store.stage("minutes_import", text, skip_errors=skip_errors, token=f"{stream}-{number}")
        reports.append(report)

    query = (
        minute_stream(store.spark, landing, files_per_batch)
        .writeStream.foreachBatch(stage)
        .option("checkpointLocation", checkpoint or checkpoint_folder(store, landing))
        .trigger(availableNow=True)
        .start()
    )
    started.put(query.id)
    query.awaitTermination()
    return reports
