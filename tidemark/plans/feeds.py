"""Jobs that bring snapshots of the two feeds into their stored tables.

A series of snapshots, one or a long backlog, is parsed once into a columnar work table, decided on narrow rows (key,
date, digests) and committed as one version of the table (`sources.manifest`). With the rows go side tables, which make
the next run cheap and late snapshots exact:

* registrations, `latest`: the row observed last per key, so that a snapshot does not read the history;
* registrations, `skipped:<date>`: the keys that a snapshot had and that were not stored because nothing changed;
* participations, `fingerprints` and `bloom`: the identities of all stored rows in hash buckets, with Bloom filters.

Side tables belong to the version they were committed with; without them a job reads narrow columns of the table itself.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import logging
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import coercion_failed, row_fingerprint, to_date_lenient, to_int_lenient
from tidemark.operators.changes import IntraBatch, NullEquality, first_batch_rows, one_per_fingerprint
from tidemark.operators.clean import align_to_schema, harmonize_layout, normalize_whitespace, parse_columns, with_snapshot_date
from tidemark.operators.joins import split_join
from tidemark.operators.keys import KeyViolation, latest_per_key
from tidemark.operators.membership import BUCKET, FINGERPRINT, blocks_for, bloom_filter, bucket_of, may_contain, of_lot
from tidemark.operators.series import DIGEST, HAS_NULL, LAYOUT, MARK_FIELDS, MARKS, decide_series, with_marks
from tidemark.schemas import KEY, SNAPSHOT_DATE
from tidemark.session import shuffles_dropped, work_folder
from tidemark.sinks.tables import CODEC, Draft, NothingToRebuild, newest_partition
from tidemark.sources.files import remove_folder
from tidemark.sources.manifest import Manifest, current_manifest
from tidemark.sources.snapshots import BROKEN_QUOTES, LONG_ROW, SHORT_ROW, list_snapshots, read_dated_snapshots, read_snapshot
from tidemark.sources.tables import read_side, read_table

log = logging.getLogger(__name__)

_FAILED = "_failed"
_QUALITY = T.StructType([
    T.StructField(_FAILED, T.IntegerType()), *[T.StructField(c, T.BooleanType()) for c in (LONG_ROW, SHORT_ROW, BROKEN_QUOTES)],
])
_FINGERPRINT_FIELD = T.StructType([T.StructField(DIGEST, T.StringType())])
#: Registration columns that cannot be compared between the layouts: the age on the day of the file, then at the year's end.
_UNLIKE = tuple(schemas.PREVIOUS_RENAMES.values())
LATEST, SKIPPED, FINGERPRINTS, BLOOM = "latest", "skipped", "fingerprints", "bloom"
#: An empty side table: every snapshot in the table has noted what it skipped.
NOTED = "noted"
#: Fingerprints (a few dozen bytes each) that may be broadcast, by count, and parts of an index before it is written anew.
BROADCAST_ROWS, INDEX_PARTS = 500_000, 8
#: Participation rows decided at a time, and blocks (4 KB each) of Bloom filters up to which many fingerprints are tested against them.
LOT_ROWS, FILTER_BLOCKS = 32_000_000, 8_192


class LateSnapshot(RuntimeError):
    """A registration snapshot is older than one already applied."""


@dataclass
class Applied:
    """What one snapshot did: rows read and stored, texts that did not parse, rows of the wrong length or with broken quotes."""

    snapshot_date: str
    staged: int
    inserted: int
    failed_values: int
    long_rows: int = 0
    short_rows: int = 0
    broken_quotes: int = 0


def _iso(stamp: str) -> str:
    return dt.datetime.strptime(stamp, "%Y%m%d").date().isoformat()


def _days(dates: list[str]) -> list[dt.date]:
    return [dt.date.fromisoformat(d) for d in dates]


# --- preparing and staging ---

def _prepared(clean: DataFrame, table: T.StructType, failed: Column, extra: tuple[T.StructField, ...] = (), **parsed) -> DataFrame:
    given = {c: F.lit(False) for c in (LONG_ROW, SHORT_ROW, BROKEN_QUOTES) if c not in clean.columns}
    counted = clean.withColumns({_FAILED: failed, **given})
    return align_to_schema(parse_columns(counted, **parsed), T.StructType([*table.fields, *extra, *_QUALITY.fields]))


def prepare_registration(df: DataFrame) -> DataFrame:
    """All-text registration rows with a date, in the types and columns of the table.

    Adds the layout of the file, the number of values per row that could not be parsed, and what was wrong with the row.
    """
    clean = normalize_whitespace(harmonize_layout(df, version_column=LAYOUT))
    ints = [c for c in schemas.REGISTRATION_INT_COLUMNS if c in clean.columns]
    failed = F.lit(0)
    for c in ints:
        failed = failed + coercion_failed(F.col(c), to_int_lenient(F.col(c))).cast("int")
    return _prepared(clean, schemas.REGISTRATION_TABLE, failed, (T.StructField(LAYOUT, T.StringType()),), ints=ints)


def prepare_participation(df: DataFrame) -> DataFrame:
    """All-text participation rows with a date, in the types and columns of the log; counts as above."""
    clean = normalize_whitespace(df)
    dates = [c for c in schemas.PARTICIPATION_DATE_COLUMNS if c in clean.columns]
    failed = F.lit(0)
    for c in dates:
        failed = failed + coercion_failed(F.col(c), to_date_lenient(F.col(c))).cast("int")
    return _prepared(clean, schemas.PARTICIPATION_LOG, failed, dates=dates)


def participation_fingerprint() -> Column:
    """Identity of a participation row; the snapshot date is not part of it."""
    return row_fingerprint(schemas.PARTICIPATION_COLUMNS, schemas.PARTICIPATION_DATE_COLUMNS)


def _marked_registrations(rows: DataFrame) -> DataFrame:
    return with_marks(rows, schemas.REGISTRATION_COLUMNS, _UNLIKE)


def _marked_participations(rows: DataFrame) -> DataFrame:
    return rows.withColumn(DIGEST, participation_fingerprint())


@contextlib.contextmanager
def work_table(rows: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """Keep rows as a table in the shared work folder while they are read several times."""
    spark, path = rows.sparkSession, work_folder(rows.sparkSession, purpose)
    try:
        with shuffles_dropped(spark):
            rows.write.parquet(path, compression=CODEC)
        yield spark.read.schema(rows.schema).parquet(path)
    finally:
        remove_folder(spark, path)


def read_registrations(spark: SparkSession, table: str) -> DataFrame:
    """The registration change history."""
    return read_table(spark, table, schemas.REGISTRATION_TABLE)


def read_participations(spark: SparkSession, table: str) -> DataFrame:
    """The participation log, with the date of the snapshot that brought each row."""
    return read_table(spark, table, schemas.PARTICIPATION_LOG)


def quality_counts(staged: DataFrame) -> DataFrame:
    """Per snapshot date: rows, values that did not parse, long and short rows, rows with broken quotes."""
    flag = lambda c: F.count_if(F.col(c)).alias(c.strip("_") + ("s" if c.endswith("row") else ""))
    return staged.groupBy(SNAPSHOT_DATE).agg(
        F.count(F.lit(1)).alias("staged"), F.sum(_FAILED).alias("failed_values"), flag(LONG_ROW), flag(SHORT_ROW), flag(BROKEN_QUOTES)
    )


def _counted(staged: DataFrame) -> dict[str, dict]:
    return {r[SNAPSHOT_DATE].isoformat(): r.asDict() for r in quality_counts(staged).collect()}  # one row per date


def _reports(counts: dict[str, dict], inserted: dict[str, int], dates: list[str]) -> list[Applied]:
    names = ("failed_values", "long_rows", "short_rows", "broken_quotes")
    return [Applied(d.replace("-", ""), counts.get(d, {}).get("staged", 0), inserted.get(d, 0), *(counts.get(d, {}).get(n) or 0 for n in names)) for d in dates]


# --- registrations ---

def narrow_history(spark: SparkSession, table: str, manifest: Manifest) -> DataFrame:
    """(key, date, marks) of the stored rows of a version."""
    return read_table(spark, table, schemas.REGISTRATION_TABLE, MARK_FIELDS, manifest=manifest).select(KEY, SNAPSHOT_DATE, *MARKS)


def _observed_before(spark: SparkSession, table: str, manifest: Manifest, day: str) -> DataFrame:
    """(key, date, marks) of the row observed last per key before `day`.

    Usually the side table left by the snapshot applied before: one row per key. Otherwise the latest stored rows."""
    applied = [d for d in manifest.values if d < day]
    saved = read_side(spark, table, manifest, f"{LATEST}:{applied[-1]}") if applied else None
    if saved is not None:
        return saved.select(KEY, SNAPSHOT_DATE, *MARKS)
    history = narrow_history(spark, table, manifest).where(F.col(SNAPSHOT_DATE) < F.lit(day).cast("date"))
    return latest_per_key(history, [KEY], SNAPSHOT_DATE)


def check_decided(decided: DataFrame) -> dict[str, int]:
    """Rows to store per date; raises if a key is NULL or occurs twice in a date. One pass over the decided narrow rows."""
    found = decided.groupBy(SNAPSHOT_DATE).agg(
        F.count_if("kept").alias("kept"), F.count_if("repeated").alias("repeated"), F.count_if(F.col(KEY).isNull()).alias("null_rows")
    ).collect()
    repeated, nulls = sum(r["repeated"] for r in found), sum(r["null_rows"] for r in found)
    if repeated or nulls:
        raise KeyViolation(f"key ({KEY}, {SNAPSHOT_DATE}): {repeated} rows repeat a key, {nulls} rows have a NULL")
    return {r[SNAPSHOT_DATE].isoformat(): r["kept"] for r in found}


def _store_series(
    spark: SparkSession, draft: Draft, staged: DataFrame, baseline: DataFrame, null_equality: NullEquality, anew: bool = False
) -> dict[str, int]:
    """Write the changed rows of staged snapshots and the side tables; returns the rows stored per date."""
    if anew or not draft.base.values or NOTED in draft.base.sides:
        draft.sides[NOTED] = []
    with work_table(decide_series(staged, baseline, KEY, SNAPSHOT_DATE, null_equality), "decided") as decided:
        kept = check_decided(decided)
        keys = decided.where("kept").select(KEY, SNAPSHOT_DATE)
        rows = split_join(staged, keys, [KEY, SNAPSHOT_DATE], "left_semi")
        counts = draft.write(rows.select(*schemas.REGISTRATION_TABLE.names, *MARKS)) if any(kept.values()) else {}
        draft.write_dated_side(SKIPPED, decided.where("NOT kept").select(KEY, SNAPSHOT_DATE))
        last = max(kept, default=None)
        if last is not None:
            observed = decided.select(KEY, SNAPSHOT_DATE, *MARKS).unionByName(baseline.select(KEY, SNAPSHOT_DATE, *MARKS))
            draft.write_side(f"{LATEST}:{last}", latest_per_key(observed, [KEY], SNAPSHOT_DATE))
    return counts


def _kept_sides(base: Manifest, dates: list[str]) -> Callable[[str], bool]:
    """Side tables that still hold after the dates were replaced: of earlier snapshots, and one state before them."""
    states = sorted(n for n in base.sides if n.startswith(f"{LATEST}:") and n.partition(":")[2] < dates[0])
    return lambda name: name in states[-1:] or (name.startswith(f"{SKIPPED}:") and name.partition(":")[2] not in dates)


def apply_registrations(
    spark: SparkSession, rows: DataFrame, table: str, null_equality: NullEquality = "sql", late: str = "raise", dates: list[str] | None = None,
) -> list[Applied]:
    """Store a whole series of registration snapshots in one pass and one commit; returns what each date did.

    `rows` are prepared rows of any number of dates; `dates` adds dates whose files had no rows. Rows are compared with the row
    of their key observed before, in the series or in the side table of the version before, so only narrow rows are shuffled by
    key; the changed rows then join back. Partitions of the dates are replaced, so a repeated run stores the same rows. A
    repeated or missing key fails the run and stores nothing.

    Dates older than one that is stored are late. They raise, are left out (`late='skip'`) or are spliced into the history
    one by one (`late='splice'`), which leaves the table as if they had come in order."""
    with work_table(_marked_registrations(rows), "staged") as staged:
        counts = _counted(staged)
        present = sorted({*counts, *(dates or ())})
        stored = current_manifest(spark, table).values
        newest = max((d for d in stored if d not in present), default="")
        behind = [d for d in present if d < newest]
        if behind and late == "raise":
            raise LateSnapshot(f"snapshot {behind[0]} is older than {newest}, which is already stored")
        if behind and late == "skip":
            log.warning("snapshots older than %s are left out: %s", newest, behind)
        reports = []
        if behind and late == "splice":
            from tidemark.plans.late import splice_registrations

            for day in behind:
                own = staged.where(F.col(SNAPSHOT_DATE) == F.lit(day).cast("date"))
                reports += _reports(counts, {day: splice_registrations(spark, own, day, table, null_equality)}, [day])
        current = [d for d in present if d not in behind]
        if current:
            with Draft(spark, table) as draft:
                if behind:
                    staged = staged.where(F.col(SNAPSHOT_DATE).isin(_days(current)))
                baseline = _observed_before(spark, table, draft.base, current[0])
                inserted = _store_series(spark, draft, staged, baseline, null_equality)
                draft.commit(inserted, current, sides=_kept_sides(draft.base, current))
            reports += _reports(counts, inserted, current)
    return reports


def apply_registration(
    spark: SparkSession,
    source: DataFrame | str | list[str],
    stamp: str,
    table: str,
    null_equality: NullEquality = "sql",
    late: str = "raise",
    **read_options,
) -> Applied:
    """Store the rows of one registration snapshot that are new or changed: `apply_registrations` for one date."""
    day, newest = _iso(stamp), newest_partition(spark, table)
    if late == "raise" and newest is not None and newest > day:
        raise LateSnapshot(f"snapshot {day} is older than {newest}, which is already stored")
    rows = prepare_registration(_staged(spark, source, stamp, **read_options))
    return next(iter(apply_registrations(spark, rows, table, null_equality, late, [day])), Applied(stamp, 0, 0, 0))


def _staged(spark: SparkSession, source: DataFrame | str | list[str], stamp: str, **options) -> DataFrame:
    scan = source if isinstance(source, DataFrame) else read_snapshot(spark, source, quality=True, **options)
    return with_snapshot_date(scan, stamp)


# --- participations ---

def _index_parts(manifest: Manifest) -> list[tuple[str, str, int]]:
    """(fingerprints, bloom, blocks of the bloom) of each part of the index."""
    parts = []
    for name in sorted(manifest.sides):
        if name.startswith(f"{BLOOM}:"):
            _, part, blocks = name.split(":")
            parts.append((f"{FINGERPRINTS}:{part}", name, int(blocks)))
    return parts


@contextlib.contextmanager
def known_fingerprints(spark: SparkSession, table: str, manifest: Manifest, wanted: DataFrame, only: bool = True) -> Iterator[DataFrame]:
    """Those of the distinct fingerprints `wanted` (column FINGERPRINT) that are stored; others that are stored may come with
    them unless `only`.

    The Bloom filters rule out most new ones; only the buckets of the rest are read. The stored fingerprints are not shuffled
    while the rest is small enough to broadcast, by its count. Many fingerprints are not tested against large filters, each of
    which would shuffle them: the buckets they fall into are read. A table without an index is read itself, one column."""
    if not any(manifest.folders.values()):
        yield wanted.where(F.lit(False))
        return
    narrow = lambda stored: split_join(wanted, stored, [FINGERPRINT], "left_semi") if only else stored
    parts = _index_parts(manifest)
    if not parts:
        whole = read_table(spark, table, schemas.PARTICIPATION_LOG, _FINGERPRINT_FIELD, manifest=manifest)
        yield narrow(whole.select(F.col(DIGEST).alias(FINGERPRINT)).distinct())
        return
    with contextlib.ExitStack() as held:
        possible = wanted.withColumn(BUCKET, bucket_of(F.col(FINGERPRINT)))
        if sum(blocks for _, _, blocks in parts) <= FILTER_BLOCKS or wanted.count() <= BROADCAST_ROWS:
            flagged, flags = wanted, []
            for k, (_, bloom, blocks) in enumerate(parts):
                flagged = may_contain(flagged, read_side(spark, table, manifest, bloom), blocks, f"_in{k}")
                flags.append(F.col(f"_in{k}"))
            flagged = flagged.where(F.greatest(*flags) if len(flags) > 1 else flags[0]).select(FINGERPRINT)
            possible = held.enter_context(work_table(flagged.withColumn(BUCKET, bucket_of(F.col(FINGERPRINT))), "possible"))
        found = {r[BUCKET]: r["n"] for r in possible.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n")).collect()}
        stored = None
        for fingerprints, _, _ in parts:
            part = read_side(spark, table, manifest, fingerprints).where(F.col(BUCKET).isin(sorted(found))).select(FINGERPRINT)
            stored = part if stored is None else stored.unionByName(part)
        if sum(found.values()) <= BROADCAST_ROWS:
            yield stored.join(F.broadcast(possible.select(FINGERPRINT)), FINGERPRINT, "left_semi").select(FINGERPRINT)
        else:
            yield narrow(stored)


@contextlib.contextmanager
def fresh_fingerprints(spark: SparkSession, table: str, manifest: Manifest, staged: DataFrame) -> Iterator[DataFrame]:
    """(digest, first date) of staged rows, without those that are stored."""
    first = staged.groupBy(DIGEST).agg(F.min(SNAPSHOT_DATE).alias(SNAPSHOT_DATE))
    with contextlib.ExitStack() as held:
        if any(manifest.folders.values()):
            with (
                work_table(first, "first") as first,
                known_fingerprints(spark, table, manifest, first.select(F.col(DIGEST).alias(FINGERPRINT)), only=False) as known,
            ):
                fresh = held.enter_context(work_table(split_join(first, known.withColumnRenamed(FINGERPRINT, DIGEST), [DIGEST], "left_anti"), "fresh"))
        else:
            fresh = held.enter_context(work_table(first, "fresh"))
        yield fresh


class _IndexPart:
    """The part of the index that a draft adds, written lot by lot; the index is written anew when it has many parts."""

    def __init__(self, spark: SparkSession, draft: Draft, table: str):
        parts = _index_parts(draft.base)
        self.spark, self.draft, self.table = spark, draft, table
        self.anew = bool(draft.base.values) and not parts or len(parts) >= INDEX_PARTS
        self.part = f"{draft.number:08d}"

    def add(self, fresh: DataFrame, n_fresh: int, lots: int, lot: int) -> None:
        """Add the new fingerprints of a lot, and those stored before if the index is written anew."""
        added = fresh.select(F.col(DIGEST).alias(FINGERPRINT))
        if self.anew:
            before = read_table(self.spark, self.table, schemas.PARTICIPATION_LOG, _FINGERPRINT_FIELD, manifest=self.draft.base)
            added = added.unionByName(before.where(of_lot(F.col(DIGEST), lots, lot)).select(F.col(DIGEST).alias(FINGERPRINT)).distinct())
        if n_fresh or self.anew:
            dealt = added.withColumn(BUCKET, bucket_of(F.col(FINGERPRINT)))
            self.draft.write_side(f"{FINGERPRINTS}:{self.part}", dealt.hint("rebalance", BUCKET), BUCKET)

    def finish(self) -> Callable[[str], bool]:
        """Write the filter of the part; tells which sides stay."""
        paths = self.draft.sides.get(f"{FINGERPRINTS}:{self.part}")
        if paths:
            keys = self.spark.read.schema(f"{FINGERPRINT} string, {BUCKET} int").parquet(f"{self.draft.table}/{paths[0]}")
            n_keys = keys.count()
            if n_keys:
                blocks = blocks_for(n_keys)
                self.draft.write_side(f"{BLOOM}:{self.part}:{blocks}", bloom_filter(keys, blocks))
            else:  # no part without rows
                del self.draft.sides[f"{FINGERPRINTS}:{self.part}"]
                remove_folder(self.spark, f"{self.draft.table}/{paths[0]}")
        return lambda name: not self.anew


def apply_participations(
    spark: SparkSession, rows: DataFrame, table: str, intra_batch: IntraBatch = "keep", dates: list[str] | None = None,
) -> list[Applied]:
    """Store a whole series of participation snapshots in one pass and one commit; returns what each date did.

    A row is stored with the first date of the series that has it, if no equal row is stored yet; equal rows of one date are all
    stored, or one of them (`intra_batch='dedupe'`). A log only grows: rows of a date stay when it is published again without
    them, because later snapshots that had them too did not store them. A repeated run adds nothing. The stored rows
    are neither read nor written again: a date published again gets one more folder.

    Large series are decided in lots of fingerprints, all dates together, one after the other: the shuffles and work tables of a
    lot are deleted before the next begins, so beside the staged rows and what is stored the disk holds those of one lot."""
    with work_table(_marked_participations(rows), "staged") as staged:
        counts = _counted(staged)
        present = sorted({*counts, *(dates or ())})
        if not present:
            return []
        lots = 1
        while lots * LOT_ROWS < sum(c["staged"] for c in counts.values()):
            lots *= 2
        with Draft(spark, table) as draft:
            inserted, index, keys = {}, _IndexPart(spark, draft, table), [DIGEST, SNAPSHOT_DATE]
            for lot in range(lots):
                own = staged.where(of_lot(F.col(DIGEST), lots, lot)) if lots > 1 else staged
                with fresh_fingerprints(spark, table, draft.base, own) as fresh:
                    n_fresh = fresh.count()
                    if n_fresh:
                        added = own.join(F.broadcast(fresh), keys, "left_semi") if n_fresh <= BROADCAST_ROWS else split_join(own, fresh, keys, "left_semi")
                        added = added.select(*schemas.PARTICIPATION_LOG.names, DIGEST)
                        inserted = draft.write(one_per_fingerprint(added, DIGEST) if intra_batch == "dedupe" else added)
                    index.add(fresh, n_fresh, lots, lot)
            draft.commit(inserted, present, add=True, sides=index.finish())
    return _reports(counts, inserted, present)


def apply_participation(
    spark: SparkSession,
    source: DataFrame | str | list[str],
    stamp: str,
    table: str,
    intra_batch: IntraBatch = "keep",
    **read_options,
) -> Applied:
    """Store the rows of one participation snapshot that are not stored yet: `apply_participations` for one date."""
    rows = prepare_participation(_staged(spark, source, stamp, **read_options))
    return next(iter(apply_participations(spark, rows, table, intra_batch, [_iso(stamp)])), Applied(stamp, 0, 0, 0))


# --- rebuilding from dated files ---

def _dated_files(spark: SparkSession, folder: str, stem: str, undated: str) -> tuple[list[str], list[str]]:
    """(paths, dates) of the snapshots of a feed."""
    files = list_snapshots(spark, folder, stem).collect()  # one short row per file
    unreadable = [f["file_name"] for f in files if not f["readable"]]
    if unreadable:
        raise ValueError(f"files of {stem} that are not text files: {unreadable}")
    left_out = [f["file_name"] for f in files if f["snapshot_date"] is None]
    if left_out and undated == "raise":
        raise ValueError(f"files of {stem} without a date in their name: {left_out}")
    if left_out:
        log.warning("files without a date in their name are left out: %s", left_out)
    dated = [f for f in files if f["snapshot_date"] is not None]
    if not dated:
        raise NothingToRebuild(f"no dated snapshot of {stem} in {folder}")
    return [f["path"] for f in dated], sorted({f["snapshot_date"].isoformat() for f in dated})


def rebuild_registration(
    spark: SparkSession,
    folder: str,
    stem: str,
    table: str,
    null_equality: NullEquality = "sql",
    ties: list[str] | None = None,
    undated: str = "raise",
    **read_options,
) -> int:
    """Rebuild the registration table from all dated snapshots; returns the number of rows stored.

    One pass over all snapshots in date order, whatever the order they arrived in. A repeated
    (key, date) fails the rebuild unless `ties` names columns whose greatest values win. The
    present version stays until the new one is complete. A file without a date in its name fails the rebuild,
    or is left out (`undated='skip'`).
    """
    paths, dates = _dated_files(spark, folder, stem, undated)
    rows = read_dated_snapshots(spark, paths, prepare_registration, quality=True, **read_options)
    if ties is not None:
        rows = latest_per_key(rows, [KEY, SNAPSHOT_DATE], SNAPSHOT_DATE, ties)
    with work_table(_marked_registrations(rows), "rebuild") as staged, Draft(spark, table) as draft:
        nothing = spark.createDataFrame([], T.StructType([f for f in staged.schema if f.name in (KEY, SNAPSHOT_DATE, *MARKS)]))
        counts = _store_series(spark, draft, staged, nothing, null_equality, anew=True)
        draft.commit(counts, dates, everything=True, sides=lambda name: False)
    return sum(counts.values())


def rebuild_participation(
    spark: SparkSession,
    folder: str,
    stem: str,
    table: str,
    intra_batch: IntraBatch = "keep",
    undated: str = "raise",
    **read_options,
) -> int:
    """Rebuild the participation log from all dated snapshots; returns the number of rows stored."""
    paths, dates = _dated_files(spark, folder, stem, undated)
    rows = read_dated_snapshots(spark, paths, prepare_participation, quality=True, **read_options)
    with work_table(_marked_participations(rows), "rebuild") as staged, Draft(spark, table) as draft:
        kept = first_batch_rows(staged, SNAPSHOT_DATE, intra_batch=intra_batch, fingerprint=DIGEST)
        counts = draft.write(kept.select(*schemas.PARTICIPATION_LOG.names, DIGEST))
        draft.commit(counts, dates, everything=True, sides=lambda name: False)
    return sum(counts.values())


def rebuild(
    spark: SparkSession,
    folder: str,
    targets: dict[str, tuple[str, str]],
    tables: set[str] = frozenset({"registration", "participation"}),
) -> dict[str, int]:
    """Rebuild the chosen tables. `targets` gives (stem, table path) per feed."""
    jobs = {"registration": rebuild_registration, "participation": rebuild_participation}
    unknown = set(tables) - set(jobs)
    if unknown:
        raise ValueError(f"unknown tables: {sorted(unknown)}")
    return {name: job(spark, folder, *targets[name]) for name, job in jobs.items() if name in tables}


__all__ = [
    "HAS_NULL", "Applied", "LateSnapshot", "apply_participation", "apply_participations", "apply_registration", "apply_registrations",
    "check_decided", "known_fingerprints", "narrow_history", "prepare_participation", "prepare_registration", "quality_counts",
    "read_participations", "read_registrations", "rebuild", "rebuild_participation", "rebuild_registration", "work_table",
]
