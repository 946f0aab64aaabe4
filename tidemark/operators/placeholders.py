"""Rows that carry a literal where a value should be."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.profile import count_by, percentage
from tidemark.schemas import PLACEHOLDER_DATE


def placeholder_rows(df: DataFrame, column: str, literal: str = PLACEHOLDER_DATE) -> DataFrame:
    """Rows with the literal; the filter is pushed to the scan."""
    return df.where(F.col(column) == literal)


def placeholder_share(df: DataFrame, column: str, group: str, literal: str = PLACEHOLDER_DATE) -> DataFrame:
    """Per group: rows, rows with the literal, their share of the group and of all such rows."""
    counts = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("record_count"),
        F.count_if(F.col(column) == literal).alias("placeholder_count"),
    )
    # both sums, so that the subquery is the same plan and reuses the grouping
    total = counts.agg(F.struct(F.sum("placeholder_count").alias("p"), F.sum("record_count").alias("r"))).scalar()["p"]
    return counts.select(
        "*",
        percentage(F.col("placeholder_count"), F.col("record_count")).alias("pct_of_group"),
        percentage(F.col("placeholder_count"), total).alias("pct_of_placeholder_rows"),
    )


def placeholder_spikes(
    df: DataFrame, column: str, date: str, factor: int = 3, literal: str = PLACEHOLDER_DATE
) -> DataFrame:
    """Dates with more than `factor` times the mean number of placeholder rows per date that has any."""
    counts = count_by(placeholder_rows(df, column, literal), date)
    rows, dates = F.sum("record_count"), F.count(F.lit(1))
    summary = counts.agg(F.struct(rows.alias("rows"), dates.alias("dates"))).scalar()
    # Integer comparison: count / mean > factor without a division.
    return counts.where(F.col("record_count") * summary["dates"] > summary["rows"] * factor)


def backfill(
    df: DataFrame,
    key: str,
    date: str,
    column: str,
    target: str,
    ties: Sequence[str] = (),
    literal: str = PLACEHOLDER_DATE,
) -> DataFrame:
    """Add `target`: the column's value, or for a placeholder the next valid value of its key.

    The original column stays as reported. Rows of a key are ordered by `date`, then `ties`;
    NULL or '' is neither a placeholder nor valid. Rows with no later valid value get NULL.

    The next value is looked up in two steps, so that no task ever orders all rows of a key:
    within the date, and else over one row per key and date, of which a key has at most as many
    as there are dates. The windows run backwards with a growing frame: one step per row.
    """
    is_placeholder = F.col(column) == literal
    valid = F.when((F.col(column) != literal) & (F.col(column) != ""), F.col(column))
    rows = df.withColumn("_valid", valid)

    def following(window_keys: Sequence[str], order: Sequence[str], value: str) -> Column:
        window = Window.partitionBy(*window_keys).orderBy(*[F.desc(o) for o in order])
        return F.last(value, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, -1))

    # One row per key and date: the first valid value of that date, NULL if it has none.
    order = F.struct(*ties, "_valid")
    days = rows.groupBy(key, date).agg(F.min_by("_valid", F.when(F.col("_valid").isNotNull(), order)).alias("_first"))
    days = days.withColumn("_later", following([key], [date], "_first")).select(key, date, "_later")
    if ties:
        rows = rows.withColumn("_same_day", following([key, date], ties, "_valid"))
    else:
        rows = rows.withColumn("_same_day", F.lit(None).cast("string"))
    # NULL dates keep their rows: a NULL never joins, the left side stays whole.
    joined = rows.join(days.withColumnsRenamed({key: "_key", date: "_date"}), (F.col(key) == F.col("_key")) & (F.col(date) == F.col("_date")), "left")
    value: Column = F.when(is_placeholder, F.coalesce("_same_day", "_later")).otherwise(F.col(column))
    return joined.select(*df.columns, value.alias(target))
