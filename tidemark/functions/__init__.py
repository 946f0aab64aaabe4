"""Column expressions."""

from tidemark.functions.digest import date_columns_of, has_null, row_digest, row_fingerprint, spread
from tidemark.functions.lenient import (
    coercion_failed,
    http_date_to_stamp,
    to_date_lenient,
    to_date_strict,
    to_int_lenient,
)
from tidemark.functions.text import quoted, squeeze_whitespace, squeezed_sql

__all__ = [
    "coercion_failed",
    "date_columns_of",
    "has_null",
    "http_date_to_stamp",
    "quoted",
    "row_digest",
    "row_fingerprint",
    "spread",
    "squeeze_whitespace",
    "squeezed_sql",
    "to_date_lenient",
    "to_date_strict",
    "to_int_lenient",
]
