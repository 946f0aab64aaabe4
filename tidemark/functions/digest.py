"""Row identities: the parity fingerprint, an injective digest and a spread hash.

The expressions over whole rows are built as SQL text: one call for all columns instead of
several per column, which keeps planning fast for tables with many columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import quoted

# FIXED VALUES: field separator and the day dates are counted from.
SEPARATOR = "||"
DAY_ZERO = "0001-01-01"


def date_columns_of(df: DataFrame) -> list[str]:
    """Names of the DATE columns, in order."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.DateType)]


def row_fingerprint(columns: Sequence[str], date_columns: Iterable[str] = ()) -> Column:
    """MD5 over the text of all columns in order, joined by `||`.

    NULL and '' are the same value here, dates count as days since 0001-01-01. The separator
    is not escaped, so ('a||b', 'c') and ('a', 'b||c') collide: use `row_digest` where that
    matters.
    """
    dates = set(date_columns)

    def text(name: str) -> str:
        value = quoted(name)
        if name in dates:
            value = f"datediff({value}, DATE'{DAY_ZERO}')"
        # concat_ws would skip a NULL together with its separator.
        return f"coalesce(cast({value} AS string), '')"

    return F.expr(f"md5(concat_ws('{SEPARATOR}', {', '.join(map(text, columns))}))")


def row_digest(columns: Sequence[str]) -> Column:
    """SHA-256 (32 bytes) over an unambiguous encoding of the columns.

    Every value is written with its length and NULL has a mark of its own, so two rows encode
    to the same text only if they are equal column by column with NULL equal to NULL. Stored
    next to wide rows, it lets a comparison read a few bytes instead of all columns. Meant for
    text, whole numbers, booleans and dates; fractional numbers compare by their text.
    """

    def text(name: str) -> str:
        value = f"cast({quoted(name)} AS string)"
        return f"coalesce(concat(char_length({value}), ':', {value}), '-')"

    return F.expr(f"unhex(sha2(concat({', '.join(map(text, columns))}), 256))")


def has_null(columns: Sequence[str]) -> Column:
    """True if any of the columns is NULL."""
    return F.expr(" OR ".join(f"{quoted(c)} IS NULL" for c in columns) or "false")


def spread(columns: Sequence[str]) -> Column:
    """64-bit hash used only to place rows; equality is always tested on the columns."""
    return F.xxhash64(*columns)
