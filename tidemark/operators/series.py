"""Change detection on narrow rows: which rows of a series of snapshots differ from the row observed before.

All frames here have (key, date, DIGEST, SHARED, LAYOUT, HAS_NULL): digests of all compared columns and of those that mean
the same in every file layout, the layout's name, and whether a compared column is NULL. Wide rows join back afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import has_null, row_digest

DIGEST, SHARED, LAYOUT, HAS_NULL = "_digest", "_shared", "_layout", "_has_null"
MARKS = (DIGEST, SHARED, LAYOUT, HAS_NULL)
MARK_FIELDS = T.StructType([
    T.StructField(DIGEST, T.BinaryType()), T.StructField(SHARED, T.BinaryType()),
    T.StructField(LAYOUT, T.StringType()), T.StructField(HAS_NULL, T.BooleanType()),
])


def with_marks(rows: DataFrame, compared: Sequence[str], unlike: Sequence[str] = (), layout: str = LAYOUT) -> DataFrame:
    """Add the marks. `unlike` are columns that cannot be compared between layouts; `layout` names the layout's column."""
    shared = row_digest([c for c in compared if c not in unlike]) if unlike else row_digest(compared)
    own = F.col(layout) if layout in rows.columns else F.lit("current")
    return rows.withColumns({DIGEST: row_digest(compared), SHARED: shared, LAYOUT: own, HAS_NULL: has_null(compared)})


def same_row(before: str | Column, now: str | Column) -> Column:
    """Are two structs of marks equal: all compared columns within a layout, the shared ones across layouts?

    A row without a layout, from before marks were stored, is compared in all columns."""
    before, now = (F.col(c) if isinstance(c, str) else c for c in (before, now))
    across = before[LAYOUT].isNotNull() & now[LAYOUT].isNotNull() & (before[LAYOUT] != now[LAYOUT])
    equal = F.when(across, before[SHARED].eqNullSafe(now[SHARED])).otherwise(before[DIGEST].eqNullSafe(now[DIGEST]))
    return F.coalesce(equal, F.lit(False))


def marks_of(prefix: str = "") -> Column:
    """The marks of a row as one struct."""
    return F.struct(*[F.col(prefix + m).alias(m) for m in MARKS])


def decide_series(own: DataFrame, baseline: DataFrame, key: str, order_col: str, null_equality: str) -> DataFrame:
    """Own rows with `kept` (differs from the row of its key before it) and `repeated` (its key and date occur before it).

    `baseline` has the row observed last per key before the series. One shuffle of narrow rows by key; a key has as many
    rows as dates, unless it is repeated, which the caller refuses."""
    columns = [key, order_col, *MARKS]
    rows = own.select(*columns, F.lit(True).alias("_own")).unionByName(baseline.select(*columns, F.lit(False).alias("_own")))
    by_key = Window.partitionBy(key).orderBy(order_col)
    seen = rows.withColumns({
        "_before": F.lag(F.struct(F.lit(1).alias("is"), F.col(order_col).alias("date"), marks_of().alias("marks"))).over(by_key), "_now": marks_of(),
    })
    same = same_row(F.col("_before.marks"), F.col("_now"))
    if null_equality == "sql":  # a NULL equals nothing
        same = same & ~F.col(HAS_NULL)
    return seen.where("_own").select(
        *columns, (F.col("_before").isNull() | ~same).alias("kept"), F.coalesce(F.col("_before.date") == F.col(order_col), F.lit(False)).alias("repeated"),
    )
