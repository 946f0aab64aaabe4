"""What is new in a snapshot: change detection for one snapshot or for a whole series.

Two kinds of table are kept. In a *change history* a row is stored when it differs from the
latest stored row of its key. In a *log* a row is stored when no equal row was stored before.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import Literal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import date_columns_of, has_null, row_digest, row_fingerprint
from tidemark.operators.joins import split_join
from tidemark.operators.keys import latest_per_key

NullEquality = Literal["sql", "null_safe"]
IntraBatch = Literal["keep", "dedupe"]


def compare_columns(df: DataFrame, order_col: str) -> list[str]:
    """Columns that decide whether two versions of a row are equal: all but the snapshot date."""
    return [c for c in df.columns if c != order_col]


def _known(value: str, allowed: tuple[str, ...], what: str) -> None:
    if value not in allowed:
        raise ValueError(f"{what} must be one of {allowed}, not {value!r}")


def changed_rows(
    staged: DataFrame,
    master: DataFrame,
    key: str,
    order_col: str,
    null_equality: NullEquality = "sql",
    as_of: dt.date | str | Column | None = None,
    ties: Sequence[str] = (),
    digest: str | None = None,
) -> DataFrame:
    """Staged rows that have no equal row among the latest stored rows per key.

    `null_equality='sql'` compares with `=`: a row with a NULL in any compared column equals
    nothing and is returned for every snapshot. `'null_safe'` treats NULL as equal to NULL and
    is preferable where repeated rows are not wanted. With `as_of`, only stored rows older than
    that date count as latest, which makes a repeated run give the same rows again.

    Only (key, order_col, digest of the compared columns) of `master` is aggregated and joined;
    name the `digest` column if the table stores it, and nothing else is read. `staged` may have
    it too. The digest is SHA-256 over an unambiguous encoding (`row_digest`), so equal digests
    mean equal columns.
    Joining on (key, digest) also spreads the rows of a key with very many staged rows.
    """
    _known(null_equality, ("sql", "null_safe"), "null_equality")
    compared = [c for c in compare_columns(staged, order_col) if c != digest]
    if as_of is not None:
        master = master.where(F.col(order_col) < (as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")))
    stored_digest = F.col(digest) if digest else row_digest(compared)
    latest = latest_per_key(
        master.select(key, order_col, *[t for t in ties if t != order_col], stored_digest.alias("_digest")),
        [key], order_col, ties,
    ).select(key, "_digest")
    own_digest = F.col(digest) if digest and digest in staged.columns else row_digest(compared)
    if null_equality == "sql":
        # A NULL join key matches nothing, exactly like a NULL in one of the compared columns.
        own_digest = F.when(~has_null(compared), own_digest)
    return split_join(staged.withColumn("_digest", own_digest), latest, [key, "_digest"], "left_anti").select(
        *staged.columns
    )


def keep_changes(
    rows: DataFrame,
    key: str,
    order_col: str,
    null_equality: NullEquality = "sql",
    baseline: DataFrame | None = None,
    digest: str | None = None,
) -> DataFrame:
    """Rows of a series of snapshots that differ from the previous row of their key.

    Gives what applying the snapshots one by one, oldest first, would store: a row that was
    skipped equals the latest stored one, so comparing with the previous *observed* row is the
    same. A key missing from some snapshots does not end its version. `baseline` holds the
    latest row per key stored before the series; it is compared with but not returned. Only digests of
    the compared columns are carried from row to row; name the `digest` column if both tables have it, then
    nothing else of the baseline is read.

    `rows` must have one row per (key, order_col) — check with `key_violations`, or reduce with
    `latest_per_key([key, order_col], ...)`. A window group then has at most one row per
    snapshot date (plus the baseline row), however many rows the table has.
    """
    _known(null_equality, ("sql", "null_safe"), "null_equality")
    values = [c for c in rows.columns if c not in (key, order_col, digest)]
    mark = digest or "_digest"
    own = rows if digest else rows.withColumn(mark, row_digest([key, *values]))
    own = own.withColumns({"_has_null": has_null([key, *values]), "_own": F.lit(True)})
    series = own
    if baseline is not None:
        stored = baseline if digest else baseline.withColumn(mark, row_digest([key, *values]))
        known = stored.select(key, order_col, mark).withColumn("_own", F.lit(False))
        series = own.unionByName(known, allowMissingColumns=True)
    previous = F.lag(mark).over(Window.partitionBy(key).orderBy(order_col))
    same = F.col(mark).eqNullSafe(F.col("_previous"))
    if null_equality == "sql":
        same = same & ~F.col("_has_null")
    kept = series.withColumn("_previous", previous).where(F.col("_own") & (F.col("_previous").isNull() | ~same))
    return kept.select(*rows.columns)


def new_rows(
    staged: DataFrame,
    master: DataFrame,
    columns: Sequence[str] | None = None,
    intra_batch: IntraBatch = "keep",
    fingerprint: str | None = None,
) -> DataFrame:
    """Staged rows whose fingerprint is not stored yet.

    Equal rows inside the batch are all returned (`intra_batch='keep'`), as only rows stored
    before count; `'dedupe'` returns one of them. Name the `fingerprint` column if `master`
    stores it: then nothing else of the table is read. It is used for `staged` too if it has one.
    """
    _known(intra_batch, ("keep", "dedupe"), "intra_batch")
    columns = list(columns or [c for c in staged.columns if c != fingerprint])
    stored_fp = F.col(fingerprint) if fingerprint else row_fingerprint(columns, date_columns_of(master))
    stored = master.select(stored_fp.alias("_fp")).distinct()
    ready = fingerprint is not None and fingerprint in staged.columns
    incoming_fp = F.col(fingerprint) if ready else row_fingerprint(columns, date_columns_of(staged))
    incoming = staged.withColumn("_fp", incoming_fp)
    if intra_batch == "dedupe":
        incoming = one_per_fingerprint(incoming, "_fp")
    return split_join(incoming, stored, ["_fp"], "left_anti").select(*staged.columns)


def one_per_fingerprint(df: DataFrame, fingerprint: str) -> DataFrame:
    """One row per fingerprint. Rows that differ only in NULL against '' resolve to the smallest."""
    rest = [c for c in df.columns if c != fingerprint]
    return df.groupBy(fingerprint).agg(F.min(F.struct(*rest)).alias("_row")).select(fingerprint, "_row.*")


def first_batch_rows(
    rows: DataFrame,
    batch: str,
    columns: Sequence[str] | None = None,
    intra_batch: IntraBatch = "keep",
    fingerprint: str | None = None,
) -> DataFrame:
    """Rows of a series of batches that first appear in their batch, with all their copies.

    Gives what applying `new_rows` batch by batch, oldest first, would store. The first batch per
    fingerprint is an aggregate over two narrow columns; the rows then join their own
    (fingerprint, batch), so copies of one row in many batches go to different tasks and a
    group of copies within one batch can be split.
    """
    _known(intra_batch, ("keep", "dedupe"), "intra_batch")
    columns = list(columns or [c for c in rows.columns if c not in (batch, fingerprint)])
    fp = fingerprint or "_fp"
    if fingerprint is None:
        rows = rows.withColumn(fp, row_fingerprint(columns, date_columns_of(rows)))
    first = rows.groupBy(fp).agg(F.min(batch).alias(batch))
    kept = split_join(rows, first, [fp, batch], "left_semi")
    if intra_batch == "dedupe":
        kept = one_per_fingerprint(kept, fp)
    return kept if fingerprint else kept.drop(fp)
