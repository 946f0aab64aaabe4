"""Lenient parsing: unusable text becomes NULL instead of failing the job.

Only `try_*` functions are used, so the result is the same with ANSI mode on or off.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES: accepted number syntax, date pattern and date bounds.
NUMBER_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
DATE_PATTERN = "M/d/yyyy"
EARLIEST_DATE = dt.date(1677, 9, 22)
LATEST_DATE = dt.date(2262, 4, 11)
HTTP_DATE = (
    r"^(?:[A-Za-z]{3}, )?(\d{1,2} [A-Za-z]{3} \d{4}) "
    r"(?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d (?:GMT|UTC|[+-]\d{4})$"
)

_INT_MIN, _INT_MAX = -(2**31), 2**31 - 1


def _column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_int_lenient(col: Column | str) -> Column:
    """Text to INT. Empty, malformed, fractional or out-of-range text gives NULL.

    `1980.0`, `1e3`, `+5` and `007` are integers; Java-only spellings such as `19d` are not.
    """
    col = _column(col)
    number = F.when(col.rlike(NUMBER_PATTERN), col.try_cast("double"))
    whole = (number == F.floor(number)) & number.between(_INT_MIN, _INT_MAX)
    return F.when(whole, number.cast("int"))


def to_date_lenient(col: Column | str, pattern: str = DATE_PATTERN) -> Column:
    """Text to DATE. Malformed text and dates outside the supported range give NULL."""
    parsed = F.try_to_date(_column(col), pattern)
    return F.when(parsed.between(F.lit(EARLIEST_DATE), F.lit(LATEST_DATE)), parsed)


def to_date_strict(col: Column | str, pattern: str = "yyyyMMdd") -> Column:
    """Text to DATE, failing the job on a bad value: a wrong snapshot date must not pass."""
    col = _column(col)
    parsed = F.try_to_date(col, pattern)
    return F.when(parsed.isNotNull(), parsed).otherwise(
        F.raise_error(F.concat(F.lit("not a snapshot date: "), F.coalesce(col, F.lit("NULL")))).cast("date")
    )


def http_date_to_stamp(col: Column | str) -> Column:
    """HTTP date text such as `Mon, 20 Apr 2026 00:10:13 GMT` to `yyyyMMdd`; unreadable gives NULL.

    The day name is skipped because the parser does not accept it. Like every HTTP date the
    text is in GMT, so the calendar date is read from the text itself and does not depend on
    the session time zone.
    """
    col = _column(col)
    day = F.regexp_extract(col, HTTP_DATE, 1)
    return F.date_format(F.try_to_date(day, "d MMM yyyy"), "yyyyMMdd")


def coercion_failed(raw: Column | str, parsed: Column | str) -> Column:
    """True where a non-empty text was turned into NULL. For quality counters."""
    raw = _column(raw)
    return raw.isNotNull() & (raw != "") & _column(parsed).isNull()
