"""Counts and shares. Every result is built from per-task partial counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.keys import key_violations


def count_by(df: DataFrame, *keys: str, name: str = "record_count") -> DataFrame:
    """Number of rows per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def percentage(part: Column, whole: Column, scale: int = 2) -> Column:
    """100 * part / whole, rounded half away from zero in exact decimal arithmetic."""
    part, whole = part.cast("decimal(18,0)"), whole.cast("decimal(18,0)")
    return F.round(F.lit(100).cast("decimal(3,0)") * part / F.nullif(whole, F.lit(0).cast("decimal(18,0)")), scale)


def with_percent_of_total(df: DataFrame, count: str, name: str, scale: int = 2) -> DataFrame:
    """Share of each row's count in the sum over all rows.

    The total is a scalar subquery, which reuses the shuffle of the grouping. A window without
    partition keys would move all groups into one task instead.
    """
    total = df.agg(F.sum(count)).scalar()
    return df.withColumn(name, percentage(F.col(count), total, scale))


def duplicate_groups(df: DataFrame, keys: Sequence[str], name: str = "row_count") -> DataFrame:
    """Key values that occur more than once; the same rows as a broken key has."""
    return key_violations(df, keys, name)


def duplicate_profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: groups with duplicates, their rows, rows per group, all groups and all rows."""
    groups = count_by(df, *keys, name="_rows")
    repeated = F.col("_rows") > 1
    rows = F.sum(F.when(repeated, F.col("_rows")))
    return groups.agg(
        F.count_if(repeated).alias("duplicate_groups"),
        F.coalesce(rows, F.lit(0)).alias("duplicate_rows"),
        (rows / F.count_if(repeated)).alias("mean_rows_per_group"),
        F.count(F.lit(1)).alias("groups"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
    )


def label_drift(df: DataFrame, label: str, period: Column, scale: int = 2) -> DataFrame:
    """Rows per label and period with the label's share of the period."""
    counts = df.groupBy(F.col(label), period.alias("period")).agg(F.count(F.lit(1)).alias("record_count"))
    totals = counts.groupBy(F.col("period").alias("_period")).agg(F.sum("record_count").alias("_total"))
    return (
        counts.join(totals, F.col("period").eqNullSafe(F.col("_period")))
        .select(label, "period", "record_count", percentage(F.col("record_count"), F.col("_total"), scale).alias("pct_of_period"))
    )


def label_span(df: DataFrame, label: str, date: str) -> DataFrame:
    """First and last date on which each label is seen."""
    return df.groupBy(label).agg(
        F.min(date).alias("first_seen"), F.max(date).alias("last_seen"), F.count(F.lit(1)).alias("record_count")
    )


def layout_conformance(df: DataFrame, widths: Mapping[str, int]) -> DataFrame:
    """Longest value per column against its declared width: one aggregate over the table, then unpivoted."""
    measured = df.agg(*[
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(w).alias("declared_width"),
            F.max(F.length(c)).alias("max_length"),
            F.count_if(F.length(c) > w).alias("rows_over_width"),
        ).alias(c)
        for c, w in widths.items()
    ])
    return (
        measured.select(F.inline(F.array(*[F.col(c) for c in widths])))
        .withColumn("conforms", F.col("rows_over_width") == 0)
    )
