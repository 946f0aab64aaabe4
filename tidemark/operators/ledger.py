"""The ledger of processed files, as operators on (file_name, timestamp, processed, archived)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _looked_up(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    known = ledger.select(
        F.col("file_name").alias("_file"),
        F.col("timestamp").alias("_timestamp"),
        F.coalesce("processed", F.lit(True)).alias("_processed"),
        F.coalesce("archived", F.lit(False)).alias("_archived"),
    )
    return listing.join(known, F.col("file_name") == F.col("_file"), "left")


def _new_stamp() -> Column:
    return ~F.col("timestamp").eqNullSafe(F.col("_timestamp"))


def pending_files(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files to process: unseen, with another timestamp, or left unfinished.

    A file whose timestamp could not be read (NULL) is skipped. A ledger entry without
    `processed` counts as finished.
    """
    unfinished = ~F.coalesce("_processed", F.lit(True))
    return (
        _looked_up(listing.where(F.col("timestamp").isNotNull()), ledger)
        .where(_new_stamp() | unfinished)
        .select(*listing.columns)
    )


def needs_backup(pending: DataFrame, ledger: DataFrame) -> DataFrame:
    """One row: does any pending file bring a new timestamp, or was one never archived?

    A mere retry of archived files needs no new backup.
    """
    fresh = _new_stamp() | ~F.coalesce("_archived", F.lit(False))
    return _looked_up(pending, ledger).agg(F.coalesce(F.bool_or(fresh), F.lit(False)).alias("needs_backup"))


def upsert_ledger(ledger: DataFrame, updates: DataFrame) -> DataFrame:
    """Entries of `updates` replace those of the same file; a NULL `archived` keeps the old flag."""
    old = ledger.select(*[F.col(c).alias("_old_" + c) for c in ("file_name", "timestamp", "processed", "archived")])
    new = updates.select("file_name", "timestamp", "processed", "archived", F.lit(True).alias("_new"))
    joined = new.join(old, F.col("file_name") == F.col("_old_file_name"), "full")

    def either(name: str) -> Column:
        return F.when(F.col("_new"), F.col(name)).otherwise(F.col("_old_" + name)).alias(name)

    return joined.select(
        F.coalesce("file_name", "_old_file_name").alias("file_name"),
        either("timestamp"),
        either("processed"),
        F.coalesce("archived", "_old_archived").alias("archived"),
    )
