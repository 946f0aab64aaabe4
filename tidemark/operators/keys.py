"""Latest rows per key and key checks. All aggregate before they shuffle."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class KeyViolation(ValueError):
    """A table or a batch breaks the key it is declared to have."""


def latest_per_key(df: DataFrame, keys: Sequence[str], order_col: str, ties: Sequence[str] = ()) -> DataFrame:
    """The row with the greatest `order_col` (then `ties`) for every key; a NULL order ranks lowest.

    Written as an aggregate and not as a window: every task first reduces its rows to one per
    key, so a key that holds a large part of the table adds one row per task to the shuffle.
    """
    newest = F.max_by(F.struct(*df.columns), F.struct(order_col, *ties))
    return df.groupBy(*keys).agg(newest.alias("_newest")).select("_newest.*")


def as_of_view(
    df: DataFrame, keys: Sequence[str], order_col: str, as_of: dt.date | str | Column, ties: Sequence[str] = ()
) -> DataFrame:
    """State of the table on `as_of`: the latest row per key among rows not newer than that date.

    The date filter reaches the scan, so a table partitioned by `order_col` reads only old partitions.
    """
    day = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
    return latest_per_key(df.where(F.col(order_col) <= day), keys, order_col, ties)


def key_violations(df: DataFrame, keys: Sequence[str], name: str = "row_count") -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)


def null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a NULL in one of the key columns."""
    condition = F.lit(False)
    for key in keys:
        condition = condition | F.col(key).isNull()
    return df.where(condition)


def check_key(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise `KeyViolation` if a key repeats or has a NULL. One pass that reads the key columns only."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    found = groups.agg(
        F.count_if(F.col("_rows") > 1).alias("repeated"),
        F.sum(F.when(missing, F.col("_rows"))).alias("null_rows"),
    ).first()
    if found["repeated"] or found["null_rows"]:
        raise KeyViolation(
            f"key ({', '.join(keys)}): {found['repeated']} values repeat, {found['null_rows'] or 0} rows have a NULL"
        )
