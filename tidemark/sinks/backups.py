"""Text backups of a stored table, a folder per partition and version: a later backup writes only what has changed.

    backup/_manifests/00000003.json                 what the newest backup consists of
    backup/00000003/data_date=2024-01-01/part-....csv

A partition is exported again when the table's version has other folders for it. Each is noted with its number of rows and a checksum of
its values that does not depend on their order; `restore_backup` reads the text back and compares both.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import SNAPSHOT_DATE
from tidemark.sinks.tables import ConcurrentCommit, write_text
from tidemark.sources.files import create_text, folder_names, read_text, remove_folder
from tidemark.sources.manifest import current_manifest, manifest_numbers, manifest_path
from tidemark.sources.tables import import_tsv, read_table

#: Backups that stay when older ones are cleared.
KEPT_BACKUPS = 2


class DamagedBackup(RuntimeError):
    """A backup does not hold what was written."""


def _load(spark: SparkSession, folder: str, number: int) -> dict | None:
    try:
        found = json.loads(read_text(spark, manifest_path(folder, number)) or "")
    except ValueError:
        return None
    return found if isinstance(found, dict) and found.get("complete") is True else None


def newest_backup(spark: SparkSession, folder: str) -> dict:
    """Partitions of the newest complete backup: value to folder, source, rows and checksum."""
    for number in reversed(manifest_numbers(spark, folder)):
        found = _load(spark, folder, number)
        if found:
            return found["partitions"]
    return {}


def _sums(rows: DataFrame, columns: list[str], partition: str) -> dict[str, tuple[int, str]]:
    """(rows, checksum) per partition value: a sum of row hashes, exact in any order."""
    text = [F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("-")) for c in columns]
    found = rows.groupBy(F.col(partition).cast("string").alias("value")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*text).cast("decimal(38,0)")).alias("total")
    )
    return {r["value"]: (r["n"], str(r["total"])) for r in found.collect()}


def backup_table(spark: SparkSession, table: str, folder: str, schema: T.StructType, partition: str = SNAPSHOT_DATE) -> list[str]:
    """Bring a backup up to date with the present version of a table; returns the partition values that were exported."""
    present, before = current_manifest(spark, table, partition), newest_backup(spark, folder)
    changed = [v for v in present.values if before.get(v, {}).get("source") != present.folders[v]]
    if not changed and set(before) == set(present.values):
        return []
    number = max([0, *manifest_numbers(spark, folder)]) + 1
    columns = [c for c in schema.names if c != partition]
    own = f"{number:08d}-{uuid.uuid4().hex[:12]}"
    rows = read_table(spark, table, schema, partition=partition, manifest=present, values=changed)
    if any(present.folders[v] for v in changed):
        write_text(rows.hint("rebalance", partition), f"{folder}/{own}", partition)
    sums = _sums(rows, columns, partition)
    entries = {v: before[v] for v in present.values if v in before and v not in changed}
    for v in changed:
        n, total = sums.get(v, (0, None))
        entries[v] = {"source": present.folders[v], "folder": f"{own}/{partition}={v}" if n else None, "rows": n, "checksum": total}
    if not create_text(spark, manifest_path(folder, number), json.dumps({"partitions": entries, "complete": True}, indent=1, sort_keys=True)):
        raise ConcurrentCommit(f"backup {number} in {folder} exists already")
    _clear(spark, folder)
    return changed


def _clear(spark: SparkSession, folder: str) -> None:
    """Delete folders that none of the newest backups needs."""
    numbers = manifest_numbers(spark, folder)
    kept = [m for m in (_load(spark, folder, n) for n in reversed(numbers)) if m][:KEPT_BACKUPS]
    needed = {e["folder"].partition("/")[0] for m in kept for e in m["partitions"].values() if e["folder"]}
    for name in folder_names(spark, folder):
        if name[:8].isdigit() and int(name[:8]) <= max(numbers) and name not in needed:
            remove_folder(spark, f"{folder}/{name}")


def restore_backup(
    spark: SparkSession, folder: str, schema: T.StructType, partition: str = SNAPSHOT_DATE, multiline: bool = False, verify: bool = True,
) -> DataFrame:
    """The rows of the newest backup. Unless `verify` is off, rows and checksums of every partition are compared first; a
    difference raises `DamagedBackup`."""
    entries = newest_backup(spark, folder)
    columns = T.StructType([f for f in schema if f.name != partition])
    parts = [
        import_tsv(spark, f"{folder}/{e['folder']}", columns, multiline).withColumn(partition, F.lit(v).cast(schema[partition].dataType))
        for v, e in sorted(entries.items()) if e["folder"]
    ] if multiline else []
    if not multiline:
        by_root: dict[str, list[str]] = {}
        for e in entries.values():
            if e["folder"]:
                by_root.setdefault(e["folder"].partition("/")[0], []).append(f"{folder}/{e['folder']}")
        parts = [import_tsv(spark, paths, schema, base=f"{folder}/{root}") for root, paths in sorted(by_root.items())]
    rows = spark.createDataFrame([], schema)
    for part in parts:
        rows = rows.unionByName(part.select(*schema.names))
    if verify:
        found = _sums(rows, columns.names, partition)
        for v, e in entries.items():
            if found.get(v, (0, None)) != (e["rows"], e["checksum"]):
                raise DamagedBackup(f"{partition} {v}: {found.get(v, (0, None))} in place of {(e['rows'], e['checksum'])}")
    return rows
