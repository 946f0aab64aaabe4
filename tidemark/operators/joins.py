"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import spread
from tidemark.operators.keys import latest_per_key

_RIGHT = "_r_"


def all_of(conditions: Sequence[Column]) -> Column:
    """Conjunction of the conditions."""
    return functools.reduce(operator.and_, conditions)


def split_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join on `keys` whose hot keys adaptive execution can split.

    If `right` comes out of an aggregation by the same keys, Spark joins in that partitioning
    and the skew rule, which needs a plain shuffle on either side, does not apply: all rows of
    a hot key meet in one task. Joining on a hash of the keys as well makes both sides shuffle
    again (the aggregated one is small) and lets a large partition of `left` be cut into pieces.
    Spark still replaces the shuffle by a broadcast when it measures `right` to be small enough.

    Columns of `right` that `left` has too are not returned.
    """
    renamed = right.select(
        *[F.col(c).alias(_RIGHT + c) for c in right.columns], spread(keys).alias(_RIGHT + "_spread")
    )
    condition = all_of([F.col(c) == F.col(_RIGHT + c) for c in ["_spread", *keys]])
    joined = left.withColumn("_spread", spread(keys)).join(renamed, condition, how)
    added = [] if how in ("left_semi", "left_anti") else [c for c in right.columns if c not in left.columns]
    return joined.select(*left.columns, *[F.col(_RIGHT + c).alias(c) for c in added])


def link_history(
    registrations: DataFrame,
    history: DataFrame,
    key: str,
    order_col: str | None = None,
    how: str = "inner",
    ties: Sequence[str] = (),
) -> DataFrame:
    """History rows with the columns of the latest registration of their key.

    Without `order_col` the registrations must already be unique per key. Either way a history
    row meets one registration at most, so the result never has more rows than `history`.
    """
    current = registrations if order_col is None else latest_per_key(registrations, [key], order_col, ties)
    return split_join(history, current, [key], how)


def link_history_as_of(
    registrations: DataFrame,
    history: DataFrame,
    key: str,
    reg_date: str,
    his_date: str,
    ties: Sequence[str] = (),
    how: str = "inner",
) -> DataFrame:
    """History rows with the registration in force on their date: the latest not newer than it.

    No pair is formed. Both sides are first reduced to one row per key and date; a running
    `last` over the union of the two date lists finds the registration for every date. The
    window therefore holds at most two rows per key and calendar day whatever the row counts.
    History rows then join their own (key, date).
    """
    values = [c for c in registrations.columns if c != key]
    versions = latest_per_key(registrations, [key, reg_date], reg_date, ties)
    asked = history.select(key, F.col(his_date).alias("_day")).distinct()
    timeline = (
        versions.select(key, F.col(reg_date).alias("_day"), F.struct(*values).alias("_version"))
        .unionByName(asked, allowMissingColumns=True)
    )
    # At the same date the registration (order 0) comes before the question (order 1).
    running = (
        Window.partitionBy(key)
        .orderBy("_day", F.col("_version").isNull().cast("int"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    answers = (
        timeline.withColumn("_in_force", F.last("_version", ignorenulls=True).over(running))
        .where(F.col("_version").isNull() & F.col("_in_force").isNotNull())
        .select(key, F.col("_day").alias(his_date), "_in_force")
    )
    linked = split_join(history, answers, [key, his_date], how)
    added = [v for v in values if v not in history.columns]
    return linked.select(*history.columns, *[F.col("_in_force")[v].alias(v) for v in added])


def decode(df: DataFrame, column: str, dimension: DataFrame, code: str, description: str, name: str) -> DataFrame:
    """Add the description of a code; unknown codes get NULL."""
    lookup = dimension.select(F.col(code).alias("_code"), F.col(description).alias(name))
    return df.join(lookup, F.col(column) == F.col("_code"), "left").drop("_code")


def unknown_codes(df: DataFrame, column: str, dimension: DataFrame, code: str) -> DataFrame:
    """Codes that the dimension does not list, with the number of rows using them.

    Counts first, so that only one row per code and task goes into the join.
    """
    used = df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    known = dimension.select(F.col(code).alias("_code"))
    return used.join(known, F.col(column) == F.col("_code"), "left_anti")
