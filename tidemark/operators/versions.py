"""Reading a change history: what changed from one stored version of a key to the next.

All functions expect one row per (key, order_col) — the key of the history table — so a window
group has at most one row per snapshot date.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _with_previous(df: DataFrame, key: str, order_col: str, columns: Sequence[str]) -> DataFrame:
    """Add `_previous`: the listed columns of the preceding version, NULL for the first one."""
    window = Window.partitionBy(key).orderBy(order_col)
    return df.withColumn("_previous", F.lag(F.struct(*columns)).over(window))


def _any(conditions: Sequence[Column]) -> Column:
    result = F.lit(False)
    for condition in conditions:
        result = result | condition
    return result


def _differs(column: str) -> Column:
    return ~F.col(column).eqNullSafe(F.col("_previous")[column])


def classify_changes(df: DataFrame, key: str, order_col: str, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """Versions with `<group>_changed` flags and one `change_class`.

    A first version is `new`. Otherwise the class is the first group, in the given order, with a
    changed column, and `other` if none has. All flags of a first version are false.
    """
    columns = [c for group in groups.values() for c in group]
    first = F.col("_previous").isNull()
    flags = {f"{name}_changed": ~first & _any([_differs(c) for c in group]) for name, group in groups.items()}
    label = F.when(first, "new")
    for name in groups:
        label = label.when(F.col(f"{name}_changed"), name)
    return (
        _with_previous(df, key, order_col, columns)
        .withColumns(flags)
        .withColumn("change_class", label.otherwise("other"))
        .drop("_previous")
    )


def code_only_changes(
    df: DataFrame,
    key: str,
    order_col: str,
    pairs: Sequence[tuple[str, str]],
    increments: Sequence[str] = (),
) -> DataFrame:
    """Versions with `recoded` (codes that changed under an unchanged description) and `is_code_only`.

    A version is code-only if at least one code was recoded and no other column differs. A
    column in `increments`, such as an age, may also have grown by one. A changed description
    makes the change a real one, and so does a code without a description.
    """
    columns = [c for c in df.columns if c not in (key, order_col)]
    before = F.col("_previous")
    recoded = {code: _differs(code) & ~_differs(text) for code, text in pairs}

    def substantive(column: str) -> Column:
        changed = _differs(column)
        if column in recoded:
            return changed & ~recoded[column]
        if column in increments:
            return changed & ~F.coalesce(F.col(column) == before[column] + 1, F.lit(False))
        return changed

    names = F.array_compact(F.array(*[F.when(condition, F.lit(code)) for code, condition in recoded.items()]))
    return (
        _with_previous(df, key, order_col, columns)
        .withColumn("recoded", F.when(before.isNull(), F.array().cast("array<string>")).otherwise(names))
        .withColumn("is_code_only", before.isNotNull() & (F.size("recoded") > 0) & ~_any([substantive(c) for c in columns]))
        .drop("_previous")
    )


def changes_per_key(df: DataFrame, key: str, code_only: str = "is_code_only") -> DataFrame:
    """Versions and changes per key, with and without the code-only ones."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("versions"),
        (F.count(F.lit(1)) - 1).alias("changes"),
        (F.count(F.lit(1)) - 1 - F.count_if(F.col(code_only))).alias("changes_without_code_only"),
    )
