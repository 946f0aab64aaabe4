"""New snapshot files as a stream: each micro-batch is a series of dated snapshots.

The stream carries file names only; which of them belong to a feed, their dates and their layouts are found as in the batch
job, and the files of a micro-batch are read by the batch readers. The file source remembers in its checkpoint which files
it has seen, so the checkpoint takes the place of the ledger. A replayed micro-batch replaces the partitions it wrote before.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.changes import IntraBatch, NullEquality
from tidemark.plans.feeds import (
    apply_participations,
    apply_registrations,
    prepare_participation,
    prepare_registration,
)
from tidemark.sources.files import create_text, file_names, make_folder, partition_values, read_text
from tidemark.sources.snapshots import describe_files, read_dated_snapshots, stream_files

log = logging.getLogger(__name__)


class SplitSnapshot(RuntimeError):
    """Files of one date arrived in different runs of a stream."""


def _claim_dates(spark: SparkSession, dates: list[str], checkpoint: str, batch_id: int) -> None:
    """Note which batch brought each date; a second batch with the same date must not replace the first."""
    folder = f"{checkpoint}/snapshot-dates"
    for day in dates:
        if any(int(claimed) != batch_id for claimed in partition_values(spark, folder, day)):
            raise SplitSnapshot(f"snapshot {day} was read by an earlier run; rebuild the table from all its files")
        make_folder(spark, f"{folder}/{day}={batch_id}")


def ignored_files(spark: SparkSession, checkpoint: str) -> list[str]:
    """Files that a stream has seen and not read: of another feed, or not text."""
    folder, names = f"{checkpoint}/ignored-files", []
    for name in file_names(spark, folder):
        names += json.loads(read_text(spark, f"{folder}/{name}") or "[]")
    return sorted(names)


def _start(
    spark: SparkSession,
    folder: str,
    stem: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame],
    store: Callable[[SparkSession, DataFrame, list[str]], object],
) -> StreamingQuery:
    def handle(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        files = describe_files(batch).withColumn("stamp", F.coalesce("stamp", F.date_format("modificationTime", "yyyyMMdd"))).collect()  # one row per file
        mine = [f for f in files if f["stem"] == stem and f["readable"]]
        others = sorted(f["file_name"] for f in files if f not in mine)
        if others:
            log.warning("files that are not snapshots of %s were not read: %s", stem, others)
            create_text(own, f"{checkpoint}/ignored-files/{batch_id}.json", json.dumps(others))
        if not mine:
            return
        dates = sorted({f"{f['stamp'][:4]}-{f['stamp'][4:6]}-{f['stamp'][6:]}" for f in mine})
        _claim_dates(own, dates, checkpoint, batch_id)
        store(own, read_dated_snapshots(own, {f["path"]: f["stamp"] for f in mine}, prepare, quality=True), dates)

    return (
        stream_files(spark, folder).writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_registrations(
    spark: SparkSession,
    folder: str,
    stem: str,
    table: str,
    checkpoint: str,
    null_equality: NullEquality = "sql",
    late: str = "splice",
) -> StreamingQuery:
    """Apply all registration files that have arrived since the last call, then stop.

    Files of any known layout and column order; a file without a date in its name takes that of its timestamp. All files
    of a date must have arrived; a later file of a date already read fails the stream. A date older than one applied by an
    earlier run is spliced into the history, or left out and logged (`late='skip'`).
    """
    store = lambda session, rows, dates: apply_registrations(session, rows, table, null_equality, late, dates)
    return _start(spark, folder, stem, checkpoint, prepare_registration, store)


def stream_participations(
    spark: SparkSession,
    folder: str,
    stem: str,
    table: str,
    checkpoint: str,
    intra_batch: IntraBatch = "keep",
) -> StreamingQuery:
    """Apply all participation files that have arrived since the last call, then stop. Files are chosen as above.

    All files of a date must have arrived; a later file of a date already read fails the stream.
    """
    store = lambda session, rows, dates: apply_participations(session, rows, table, intra_batch, dates)
    return _start(spark, folder, stem, checkpoint, prepare_participation, store)
