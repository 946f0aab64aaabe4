"""Column-level clean-up of all-text snapshots. None of these shuffles."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import quoted, squeezed_sql, to_date_lenient, to_date_strict, to_int_lenient
from tidemark.schemas import PREVIOUS_RENAMES, PREVIOUS_UNUSED, SNAPSHOT_DATE


def normalize_whitespace(df: DataFrame) -> DataFrame:
    """Trim every string column and collapse inner runs of white space, in one projection."""
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if not names:
        return df
    # One array and one lambda: an expression per column makes generated code so long that the JVM only interprets it.
    texts = "_texts"
    while texts in df.columns:
        texts = f"_{texts}"
    squeezed = f"transform(array({', '.join(map(quoted, names))}), x -> if(x = '', x, {squeezed_sql('x')})) AS {texts}"
    place = {name: k for k, name in enumerate(names)}
    return df.selectExpr("*", squeezed).selectExpr(*[
        f"{texts}[{place[c]}] AS {quoted(c)}" if c in place else quoted(c) for c in df.columns
    ])


def with_snapshot_date(df: DataFrame, stamp: str | Column, name: str = SNAPSHOT_DATE) -> DataFrame:
    """Add the snapshot date from a `yyyyMMdd` stamp (constant or column); a bad stamp fails."""
    stamp = F.lit(stamp) if isinstance(stamp, str) else stamp
    return df.withColumn(name, to_date_strict(stamp))


def parse_columns(df: DataFrame, ints: Iterable[str] = (), dates: Iterable[str] = ()) -> DataFrame:
    """Replace text columns by their lenient INT or DATE value; columns the file lacks are skipped."""
    parsed = {c: to_int_lenient(F.col(c)) for c in ints if c in df.columns}
    parsed |= {c: to_date_lenient(F.col(c)) for c in dates if c in df.columns}
    return df.withColumns(parsed) if parsed else df


def align_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Give `df` exactly the columns of `schema`, in its order: add missing ones as NULL, drop others."""
    have = {f.name: f.dataType for f in df.schema}

    def aligned(field: T.StructField) -> str:
        name, kind = quoted(field.name), field.dataType.simpleString()
        if field.name not in have:
            return f"cast(NULL AS {kind}) AS {name}"
        return name if have[field.name] == field.dataType else f"cast({name} AS {kind}) AS {name}"

    return df.selectExpr(*[aligned(f) for f in schema])


def column_differences(df: DataFrame, schema: T.StructType) -> tuple[list[str], list[str]]:
    """(columns of `schema` missing in `df`, columns of `df` that `schema` does not have)."""
    wanted = schema.names
    return [c for c in wanted if c not in df.columns], [c for c in df.columns if c not in wanted]


def harmonize_layout(
    df: DataFrame,
    renames: Mapping[str, str] = PREVIOUS_RENAMES,
    unused: Iterable[str] = PREVIOUS_UNUSED,
    version_column: str | None = None,
) -> DataFrame:
    """Bring a file of the previous layout to the names of the current one.

    Files already in the current layout pass unchanged. The renamed age is the age on the day
    of the file, not at the end of the year; ask for `version_column` ('previous'/'current')
    where the two must not be compared with each other.
    """
    previous = any(old in df.columns and new not in df.columns for old, new in renames.items())
    for old, new in renames.items():
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    df = df.drop(*unused)
    if version_column:
        df = df.withColumn(version_column, F.lit("previous" if previous else "current"))
    return df
