"""Stored tables, prepared files and code lists."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import date_columns_of
from tidemark.sources.manifest import SIDES, Manifest, current_manifest

# FIXED VALUE: stands for NULL while a text backup is read. A control character, so that no
# stored text can be taken for it; an unquoted empty field reads as NULL, a quoted one as ''.
_NULL_MARK = "\x00"


def columns_of(df: DataFrame) -> list[str]:
    """Column names in order."""
    return df.columns


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    extra: T.StructType | None = None,
    partition: str = schemas.SNAPSHOT_DATE,
    manifest: Manifest | None = None,
    values: Iterable[str] | None = None,
) -> DataFrame:
    """The present version of a stored table with its declared columns; empty if nothing was stored yet.

    `extra` names technical columns (row digests) to return as well. `manifest` reads another version, `values` some
    partitions only. Spark reads only the columns that are used and only the partitions that a filter on the date leaves.
    """
    wanted = T.StructType(schema.fields + (extra.fields if extra else []))
    manifest = manifest or current_manifest(spark, path, partition)
    chosen = manifest.values if values is None else [v for v in values if v in manifest.folders]
    folders = [f"{path}/{folder}" for v in chosen for folder in manifest.folders[v]]
    # plain partitions, from before the table had versions, have one partition column less
    groups = [[f for f in folders if "/version=" not in f], [f for f in folders if "/version=" in f]]
    parts = [spark.read.option("basePath", path).schema(wanted).parquet(*g).select(*wanted.names) for g in groups if g]
    if not parts:
        return spark.createDataFrame([], wanted)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_side(spark: SparkSession, table: str, manifest: Manifest, *names: str) -> DataFrame | None:
    """Side tables of one kind and version together; None if it has none of these names."""
    paths = [f"{table}/{p}" for n in names for p in manifest.sides.get(n, [])]
    if not paths:
        return None
    return spark.read.option("basePath", f"{table}/{SIDES}/{names[0].partition(':')[0]}").parquet(*paths).drop("version")


def _text_options(delimiter: str, multiline: bool) -> dict:
    return {
        "sep": delimiter, "header": True, "quote": '"', "escape": '"', "encoding": "UTF-8",
        "nullValue": _NULL_MARK, "mode": "FAILFAST", "multiLine": multiline,
        "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
    }


def import_csv(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False) -> DataFrame:
    """A prepared comma-separated file in the target schema. Malformed rows or values fail the job."""
    return spark.read.schema(schema).options(**_text_options(",", multiline)).csv(path)


def import_tsv(spark: SparkSession, path: str | list[str], schema: T.StructType, multiline: bool = False, base: str | None = None) -> DataFrame:
    """Read back text written by `export_tsv`: NULL and '' come back as they were. `base` is the folder below which partition columns begin."""
    options = _text_options("\t", multiline) | ({"basePath": base} if base else {})
    return spark.read.schema(schema).options(**options).csv(path)


def code_list(spark: SparkSession, codes: Mapping[str, str], code: str, description: str) -> DataFrame:
    """A code list as a dimension. Broadcast is safe: the lists are constants of 100 rows at most."""
    rows = spark.createDataFrame(list(codes.items()), f"{code} string, {description} string")
    return F.broadcast(rows)


def dim_status(spark: SparkSession) -> DataFrame:
    """Registration status codes."""
    return code_list(spark, schemas.STATUS_CODES, "status_cd", "status_name")


def dim_race(spark: SparkSession) -> DataFrame:
    """Race codes."""
    return code_list(spark, schemas.RACE_CODES, "race_code", "race_name")


def dim_ethnicity(spark: SparkSession) -> DataFrame:
    """Ethnicity codes."""
    return code_list(spark, schemas.ETHNICITY_CODES, "ethnic_code", "ethnicity_name")


def dim_county(spark: SparkSession) -> DataFrame:
    """County numbers. They are text: the last county is `00`."""
    return code_list(spark, schemas.COUNTY_CODES, "county_id", "county_name")


__all__ = [
    "code_list", "columns_of", "date_columns_of", "dim_county", "dim_ethnicity", "dim_race", "dim_status",
    "import_csv", "import_tsv", "read_side", "read_table",
]
