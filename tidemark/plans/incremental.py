"""The recurring job: find new or unfinished files, back up, apply them, note what is done."""

from __future__ import annotations

import itertools
import logging
from dataclasses import dataclass, field
from typing import Literal

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import http_date_to_stamp
from tidemark.operators.changes import IntraBatch, NullEquality
from tidemark.operators.ledger import needs_backup, pending_files
from tidemark.plans.feeds import (
    Applied,
    LateSnapshot,
    apply_participations,
    apply_registrations,
    prepare_participation,
    prepare_registration,
)
from tidemark.schemas import LEDGER, PARTICIPATION_LOG, REGISTRATION_TABLE
from tidemark.sinks.backups import backup_table
from tidemark.sources.ledger import read_ledger, write_ledger
from tidemark.sources.manifest import current_manifest
from tidemark.sources.snapshots import list_snapshots, read_dated_snapshots

log = logging.getLogger(__name__)


Late = Literal["splice", "skip"]


@dataclass
class Pipeline:
    """Where the feeds land and where their tables, backups and ledger are kept.

    `late` says what becomes of a registration snapshot older than one applied: it is put into the history, or set aside."""

    landing: str
    registration_stem: str
    participation_stem: str
    registration_table: str
    participation_table: str
    backup_folder: str
    ledger: str
    null_equality: NullEquality = "sql"
    intra_batch: IntraBatch = "keep"
    late: Late = "splice"
    read_options: dict = field(default_factory=dict)


@dataclass
class RunReport:
    """Outcome of a run: files applied, whether a backup was made, files that belong to no feed or are no text
    files, late registration files (applied as well, unless the pipeline sets them aside), and the first failure, if any."""

    applied: dict[str, Applied] = field(default_factory=dict)
    backed_up: bool = False
    ignored: list[str] = field(default_factory=list)
    late: list[str] = field(default_factory=list)
    error: Exception | None = None


def landing_files(spark: SparkSession, pipeline: Pipeline) -> DataFrame:
    """All files in the landing folder, in one listing."""
    return list_snapshots(spark, pipeline.landing)


def backup_tables(spark: SparkSession, pipeline: Pipeline) -> dict[str, list[str]]:
    """Bring the text backups of both tables up to date; returns the dates that were exported."""
    targets = {"registration": (pipeline.registration_table, REGISTRATION_TABLE), "participation": (pipeline.participation_table, PARTICIPATION_LOG)}
    return {name: backup_table(spark, table, f"{pipeline.backup_folder}/{name}", schema) for name, (table, schema) in targets.items()}


def _mark(spark: SparkSession, pipeline: Pipeline, files: list[Row], processed: bool) -> None:
    entries = [(f["file_name"], f["timestamp"], processed, True) for f in files]
    write_ledger(spark, pipeline.ledger, spark.createDataFrame(entries, LEDGER))


def run_incremental(
    spark: SparkSession, pipeline: Pipeline, listing: DataFrame | None = None, raise_errors: bool = False
) -> RunReport:
    """Process every pending file once; safe to repeat and to interrupt.

    The date of a snapshot is the date prefix of its name or else the date of its timestamp.
    All pending dates of a feed are one series, parsed, decided and committed once; then the ledger notes all their files at
    once. Registrations come first; several files of one feed and date are one snapshot. If a series fails, its dates are tried one by
    one, oldest first, until the one that fails; that and later ones stay unfinished in the ledger, and the other feed goes
    on. A registration snapshot older than one applied is reported as late and spliced into the history, or set aside
    (`Pipeline.late`). Files whose stem is that of neither feed are reported and not read. The first failure is logged and
    returned, or raised on request. `listing` replaces the scan of the landing folder (columns
    path, file_name, stem, stamp, timestamp).
    """
    report, failed = RunReport(), {}
    try:
        ledger = read_ledger(spark, pipeline.ledger)
        files = landing_files(spark, pipeline) if listing is None else listing
        of_feeds = F.col("stem").isin(pipeline.registration_stem, pipeline.participation_stem)
        if "readable" in files.columns:
            of_feeds = of_feeds & F.col("readable")
        report.ignored = sorted(r[0] for r in files.where(~of_feeds).select("file_name").collect())
        dated = files.where(of_feeds).withColumn("stamp", F.coalesce("stamp", http_date_to_stamp("timestamp"))).where(
            F.col("stamp").isNotNull()
        )
        pending = pending_files(dated, ledger)
        snapshots = _snapshots(dated, pending, pipeline)
        if not snapshots:
            return report
        open_files = [file for files in snapshots for file in files]
        if needs_backup(pending, ledger).first()["needs_backup"]:
            backup_tables(spark, pipeline)
            report.backed_up = True
            _mark(spark, pipeline, open_files, processed=False)
        for _, series in itertools.groupby(snapshots, key=lambda files: files[0]["stem"]):
            _apply_series(spark, pipeline, list(series), report, failed)
        report.error = next(iter(failed.values()), None)
    except Exception as error:
        report.error = error
        log.exception("run stopped; unfinished files are retried by the next run")
    if report.error and raise_errors:
        raise report.error
    return report


def _apply_series(spark: SparkSession, pipeline: Pipeline, series: list[list[Row]], report: RunReport, failed: dict) -> None:
    """Apply the snapshots of one feed together, or else one by one up to the first that fails."""
    try:
        _apply(spark, pipeline, series, report)
        return
    except Exception as error:
        if len(series) == 1:
            failed[series[0][0]["stem"]] = error
    log.warning("%d snapshots could not be applied together; they are tried one by one", len(series))
    for files in series:
        try:
            if files[0]["stem"] in failed:
                raise failed[files[0]["stem"]]
            _apply(spark, pipeline, [files], report)
        except Exception as error:
            log.exception("%s failed; it is retried by the next run", ", ".join(f["file_name"] for f in files))
            failed[files[0]["stem"]] = error
            return


def _snapshots(dated: DataFrame, pending: DataFrame, pipeline: Pipeline) -> list[list[Row]]:
    """Files to read, one group per feed and date: registrations first, then oldest first.

    A date is stored as a whole, so if one of its files is pending, all of them are read again.
    """
    wanted = pending.select(F.col("stem").alias("_stem"), F.col("stamp").alias("_stamp")).distinct()
    of_date = (F.col("stem") == F.col("_stem")) & (F.col("stamp") == F.col("_stamp"))
    is_participation = (F.col("stem") == pipeline.participation_stem).cast("int")
    files = dated.join(wanted, of_date, "left_semi").orderBy(is_participation, "stamp", "file_name").collect()
    return [list(group) for _, group in itertools.groupby(files, key=lambda f: (f["stem"], f["stamp"]))]


def _apply(spark: SparkSession, pipeline: Pipeline, series: list[list[Row]], report: RunReport) -> None:
    registrations = series[0][0]["stem"] == pipeline.registration_stem
    by_stamp = {files[0]["stamp"]: files for files in series}
    paths = {f["path"]: f["stamp"] for files in series for f in files}
    prepare = prepare_registration if registrations else prepare_participation
    rows = read_dated_snapshots(spark, paths, prepare, quality=True, **pipeline.read_options)
    dates = [f"{s[:4]}-{s[4:6]}-{s[6:]}" for s in by_stamp]
    late: list[str] = []
    if registrations:
        newest = max((d for d in current_manifest(spark, pipeline.registration_table).values if d not in dates), default="")
        late = [d for d in dates if d < newest]
        try:
            done = apply_registrations(spark, rows, pipeline.registration_table, pipeline.null_equality, pipeline.late, dates)
        except LateSnapshot:  # the table does not know enough to splice
            done = apply_registrations(spark, rows, pipeline.registration_table, pipeline.null_equality, "skip", dates)
    else:
        done = apply_participations(spark, rows, pipeline.participation_table, pipeline.intra_batch, dates)
    finished = {applied.snapshot_date: applied for applied in done}
    for stamp, files in by_stamp.items():
        names = ", ".join(f["file_name"] for f in files)
        if f"{stamp[:4]}-{stamp[4:6]}-{stamp[6:]}" in late:
            report.late.append(names)
        if stamp in finished:
            report.applied[names] = finished[stamp]
            log.info("%s: %s", names, finished[stamp])
        else:
            log.warning("%s is late and was set aside; rebuild the table to include it", names)
    _mark(spark, pipeline, [f for files in series for f in files], processed=True)
