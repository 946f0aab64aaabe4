"""Which folders a stored table consists of: numbered manifests, each written once and never changed.

    table/_manifests/00000007.json      partition values with their folders and row counts, and side tables
    table/version=00000007-1c9e.../data_date=2024-01-01/part-....parquet
    table/_sides/latest/version=.../    work tables that belong to the state of exactly this version

A writer puts its files into folders of its own and then creates the next manifest, which must not exist. That is the whole
commit: before it, readers see the version before; after it, the new one. Nothing is renamed, so it holds on object
stores as well. A manifest that a dying writer left incomplete is passed over. A folder without any manifest is read as
a plain partitioned table.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from tidemark.schemas import SNAPSHOT_DATE
from tidemark.sources.files import file_names, partition_values, read_text

MANIFESTS, SIDES = "_manifests", "_sides"


@dataclass(frozen=True)
class Manifest:
    """One version of a table. Folders are relative to the table; `rows` has a count where the writer knew it."""

    number: int = 0
    folders: dict[str, list[str]] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)
    sides: dict[str, list[str]] = field(default_factory=dict)

    @property
    def values(self) -> list[str]:
        return sorted(self.folders)

    def paths(self) -> set[str]:
        """All folders that the version needs."""
        return {p for paths in (*self.folders.values(), *self.sides.values()) for p in paths}

    def to_text(self) -> str:
        return json.dumps({"folders": self.folders, "rows": self.rows, "sides": self.sides, "complete": True}, indent=1, sort_keys=True)


def manifest_path(table: str, number: int) -> str:
    return f"{table}/{MANIFESTS}/{number:08d}.json"


def manifest_numbers(spark: SparkSession, table: str) -> list[int]:
    """Numbers taken, also by incomplete manifests; ascending."""
    return sorted(int(n[:-5]) for n in file_names(spark, f"{table}/{MANIFESTS}") if n.endswith(".json") and n[:-5].isdigit())


def load_manifest(spark: SparkSession, table: str, number: int) -> Manifest | None:
    """A manifest by its number; None if it is missing or incomplete."""
    try:
        found = json.loads(read_text(spark, manifest_path(table, number)) or "")
    except ValueError:
        return None
    if not isinstance(found, dict) or found.get("complete") is not True:
        return None
    return Manifest(number, found["folders"], found["rows"], found["sides"])


def current_manifest(spark: SparkSession, table: str, partition: str = SNAPSHOT_DATE) -> Manifest:
    """The newest complete version; for a folder without manifests, its plain partitions."""
    for number in reversed(manifest_numbers(spark, table)):
        found = load_manifest(spark, table, number)
        if found:
            return found
    return Manifest(folders={v: [f"{partition}={v}"] for v in partition_values(spark, table, partition)})


def stored_values(spark: SparkSession, table: str, partition: str = SNAPSHOT_DATE) -> list[str]:
    """Partition values of the current version, also those without rows; ascending."""
    return current_manifest(spark, table, partition).values
