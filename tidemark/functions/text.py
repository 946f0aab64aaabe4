"""Text normalisation as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUE: every code point the normaliser treats as white space, as the inside of a
# regular-expression class. `\s` alone covers fewer of them in Java and in RE2.
WHITESPACE = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# The coarse class in front changes nothing: it rejects letters and digits with two comparisons,
# which makes the expression more than twice as fast as the exact class alone.
WHITESPACE_RUN = rf"[\x00-\x20\x7f-\xa0\x{{1680}}-\x{{3000}}&&[{WHITESPACE}]]+"


def quoted(name: str) -> str:
    """A column name as it is written in a SQL expression."""
    return "`" + name.replace("`", "``") + "`"


def squeezed_sql(name: str) -> str:
    """`squeeze_whitespace` of a column as SQL text, for projections over very many columns."""
    return f"trim(regexp_replace({quoted(name)}, r'{WHITESPACE_RUN}', ' '))"


def squeeze_whitespace(col: Column | str) -> Column:
    """Runs of white space become one blank; none remains at either end. NULL stays NULL."""
    return F.trim(F.regexp_replace(col, WHITESPACE_RUN, " "))
