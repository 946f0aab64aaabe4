"""Writing the stored tables as versions: a reader sees the version before or the one after, never a part.

See `sources.manifest` for the layout. Every function here writes files into new folders and ends with one commit.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import SNAPSHOT_DATE
from tidemark.session import shuffles_dropped
from tidemark.sources.files import create_text, folder_names, remove_folder, replace_folder
from tidemark.sources.manifest import SIDES, Manifest, current_manifest, load_manifest, manifest_numbers, manifest_path

#: How stored and work tables are packed: digests, which are most of a narrow row, take half the space of the default.
CODEC = "zstd"
#: Versions that `remove_old_versions` leaves for readers that opened them before.
KEPT_VERSIONS = 3


class NothingToRebuild(RuntimeError):
    """No snapshot was found, so the stored table is left alone."""


class ConcurrentCommit(RuntimeError):
    """Another writer committed a version since this one read the table; nothing was changed."""


class Draft:
    """A version in the making. `write` and `write_side` add files that nobody reads; `commit` makes them the table.

    Used as a context, it deletes its files if it ends without a commit."""

    def __init__(self, spark: SparkSession, table: str, partition: str = SNAPSHOT_DATE):
        self.spark, self.table, self.partition = spark, table.rstrip("/"), partition
        self.base = current_manifest(spark, self.table, partition)
        self.number = max([self.base.number, *manifest_numbers(spark, self.table)]) + 1
        self.name = f"version={self.number:08d}-{uuid.uuid4().hex[:12]}"
        self.sides: dict[str, list[str]] = {}
        self.committed = False

    def __enter__(self) -> Draft:
        return self

    def __exit__(self, *_) -> None:
        if not self.committed:
            for path in (self.name, *(p for paths in self.sides.values() for p in paths)):
                if self.name in path:
                    remove_folder(self.spark, f"{self.table}/{path}")

    def write(self, df: DataFrame) -> dict[str, int]:
        """Write rows, one folder per partition value, beside those written before, and count all per value (from file footers).

        Rebalancing gives few, evenly filled files: adaptive execution merges small dates and splits a
        date that holds most of the rows."""
        folder = f"{self.table}/{self.name}"
        with shuffles_dropped(self.spark):
            df.hint("rebalance", self.partition).write.mode("append").partitionBy(self.partition).parquet(folder, compression=CODEC)
        return self.counts()

    def counts(self) -> dict[str, int]:
        """Rows of each partition value written so far."""
        values = [n.partition("=")[2] for n in folder_names(self.spark, f"{self.table}/{self.name}") if n.startswith(f"{self.partition}=")]
        if not values:
            return {}
        rows = self.spark.read.schema(f"{self.partition} string").parquet(f"{self.table}/{self.name}")
        return {r[0]: r["n"] for r in rows.groupBy(self.partition).agg(F.count(F.lit(1)).alias("n")).collect()}

    def rows(self, schema: T.StructType) -> DataFrame:
        """What has been written."""
        return self.spark.read.schema(schema).parquet(f"{self.table}/{self.name}")

    def write_side(self, name: str, df: DataFrame, *partitions: str, add: bool = False) -> None:
        """Write a side table, beside its rows written before; with `add`, they come on top of those that the base version has."""
        path = f"{SIDES}/{name.partition(':')[0]}/{self.name}"
        writer = (df if partitions else df.hint("rebalance")).write.mode("append")
        with shuffles_dropped(self.spark):
            (writer.partitionBy(*partitions) if partitions else writer).parquet(f"{self.table}/{path}", compression=CODEC)
        self.sides[name] = [*(self.base.sides.get(name, []) if add else []), path]

    def write_dated_side(self, name: str, df: DataFrame) -> None:
        """Write a side table per partition value in one job, registered as `name:value`."""
        path = f"{SIDES}/{name}/{self.name}"
        with shuffles_dropped(self.spark):
            df.hint("rebalance", self.partition).write.partitionBy(self.partition).parquet(f"{self.table}/{path}", compression=CODEC)
        for folder in folder_names(self.spark, f"{self.table}/{path}"):
            if folder.startswith(f"{self.partition}="):
                self.sides[f"{name}:{folder.partition('=')[2]}"] = [f"{path}/{folder}"]

    def commit(
        self, counts: dict[str, int], replaced: Iterable[str], add: bool = False, everything: bool = False, sides: Callable[[str], bool] = lambda name: True,
    ) -> Manifest:
        """Make this the current version.

        `replaced` are the partition values that it defines, with the rows written for them or none; `add` leaves their
        rows of the base version in place. `everything` drops all other values. `sides` tells which side tables of
        the base version still hold."""
        folders = {} if everything else dict(self.base.folders)
        rows = {} if everything else dict(self.base.rows)
        for value in replaced:
            own = [f"{self.name}/{self.partition}={value}"] if value in counts else []
            folders[value] = (folders.get(value, []) if add else []) + own
            before = rows.get(value) if add and value in rows else 0
            rows[value] = before + counts.get(value, 0)
        kept = {n: p for n, p in self.base.sides.items() if sides(n)}
        made = Manifest(self.number, folders, rows, kept | self.sides)
        if not create_text(self.spark, manifest_path(self.table, self.number), made.to_text()):
            raise ConcurrentCommit(f"version {self.number} of {self.table} exists already")
        self.committed = True
        return made


def append_master(df: DataFrame, path: str, columns: Sequence[str], partition: str = SNAPSHOT_DATE) -> dict[str, int]:
    """Append rows with an explicit column list; returns the number of rows added per partition value."""
    with Draft(df.sparkSession, path, partition) as draft:
        counts = draft.write(df.select(*columns))
        draft.commit(counts, counts, add=True)
    return counts


def create_table(spark: SparkSession, name: str, path: str, schema: T.StructType) -> None:
    """Register the present version of a stored table, so that `spark.table(name)` and SQL can use it in this session.

    The name stands for the version of the moment, like a snapshot; call it again after a commit."""
    from tidemark.sources.tables import read_table

    read_table(spark, path, schema).createOrReplaceTempView(name)


def publish_partition(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    value: str,
    check: Callable[[DataFrame], None] = lambda written: None,
    partition: str = SNAPSHOT_DATE,
) -> int:
    """Replace one partition by the rows of `df`, also if there are none; returns how many there are.

    `df` may read the partition it replaces: that stays until the commit, and as a version after it. `check` gets the written
    rows and raises to keep them from being published.
    """
    rows = df.withColumn(partition, F.lit(value).cast(dict(df.dtypes).get(partition, "date")))
    with Draft(spark, table, partition) as draft:
        counts = draft.write(rows)
        check(draft.rows(rows.schema) if counts else spark.createDataFrame([], rows.schema))
        draft.commit(counts, [value])
    return counts.get(value, 0)


def publish_series(
    spark: SparkSession, df: DataFrame, table: str, values: Sequence[str], partition: str = SNAPSHOT_DATE
) -> dict[str, int]:
    """Replace several partitions by the rows of `df` in one commit; a value without rows becomes an empty partition."""
    with Draft(spark, table, partition) as draft:
        counts = draft.write(df)
        draft.commit(counts, values)
    return counts


def replace_table(
    spark: SparkSession, df: DataFrame, table: str, values: Sequence[str] = (), partition: str = SNAPSHOT_DATE
) -> int:
    """Write a whole table anew and put it in place of the old one in one commit; returns the number of rows.

    `values` are partitions that must exist even if no row belongs to them. Side tables of the old one go.
    """
    with Draft(spark, table, partition) as draft:
        counts = draft.write(df)
        draft.commit(counts, {*values, *counts}, everything=True, sides=lambda name: False)
    return sum(counts.values())


def remove_old_versions(spark: SparkSession, table: str, keep: int = KEPT_VERSIONS) -> list[str]:
    """Delete folders that none of the `keep` newest versions needs; returns them.

    Folders of writers still at work carry a number above the newest version and stay, as do plain partitions that some
    kept version reads."""
    numbers = manifest_numbers(spark, table)
    whole = [m for m in (load_manifest(spark, table, n) for n in reversed(numbers)) if m][:keep]
    if not whole:
        return []
    needed, newest, gone = set().union(*(m.paths() for m in whole)), whole[0].number, []
    roots = ["", *(f"{SIDES}/{n}/" for n in folder_names(spark, f"{table}/{SIDES}"))]
    for root in roots:
        for name in folder_names(spark, f"{table}/{root}" if root else table):
            if not name.startswith("version=") or int(name[8:16]) > newest:
                continue
            if not any(p == f"{root}{name}" or p.startswith(f"{root}{name}/") for p in needed):
                remove_folder(spark, f"{table}/{root}{name}")
                gone.append(f"{root}{name}")
    return gone


def export_tsv(df: DataFrame, path: str) -> None:
    """Write a table as tab-separated text: header, UTF-8, NULL bare, '' quoted, quotes doubled.

    An existing folder stays until the new one is complete. One file per task. For repeated exports of a stored table
    see `sinks.backups`, which writes only what has changed.
    """
    spark, fresh = df.sparkSession, f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    try:
        write_text(df, fresh)
        replace_folder(spark, fresh, path)
    finally:
        remove_folder(spark, fresh)


def write_text(df: DataFrame, path: str, *partitions: str) -> None:
    """The text files of `export_tsv`, in a folder that does not exist yet."""
    writer = df.write.options(
        sep="\t", header=True, quote='"', escape='"', encoding="UTF-8", nullValue="", emptyValue='""',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    (writer.partitionBy(*partitions) if partitions else writer).csv(path)


def newest_partition(spark: SparkSession, table: str, partition: str = SNAPSHOT_DATE) -> str | None:
    """Greatest partition value of the present version."""
    values = current_manifest(spark, table, partition).values
    return values[-1] if values else None
