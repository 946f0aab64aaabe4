"""Statistics of whole texts as Spark column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ASCII white space, as inside a character class.
BLANK = r"\x20\x09-\x0D"
SYMBOLS = r"#*$%&|<>"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_distinct_words", "n_upper", "n_lower", "n_bangs", "n_digits", "n_ended_lines")


def add_text_stats(df: DataFrame, text: str = "text", wanted: tuple[str, ...] = COUNTS) -> DataFrame:
    """Add the wanted counts (long) of every whole text; a null text counts as empty.

    Words are maximal runs without ASCII white space. n_repeat_words counts the words inside 3-word windows that
    occur twice or more, the first included: windows are 64-bit hashes whose low bits are replaced by
    their position, so one sort of longs per text brings equal windows together."""
    body = F.coalesce(F.col(text), F.lit(""))
    p = "_"  # work columns must not meet columns of the input
    while any(c.lower().startswith(p) for c in df.columns):
        p += "_"
    words, letters, lines, bits, keys, doubles = (p + c for c in "wtlbkd")
    out = df.drop(*wanted).withColumn(words, F.array_remove(F.split(F.regexp_replace(body, r"[\x09-\x0D]", " "), " "), ""))
    out = out.withColumn(letters, F.array_join(words, ""))
    n = F.size(words)
    joined = F.col(letters)

    def without(chars: str) -> Column:
        return F.length(joined) - F.length(F.regexp_replace(joined, f"[{chars}]+", ""))

    made = {
        "n_words": n, "word_chars": F.length(joined), "n_symbols": without(SYMBOLS), "n_distinct_words": F.size(F.array_distinct(words)),
        "n_upper": without(r"\p{Lu}"), "n_lower": without(r"\p{Ll}"), "n_bangs": without("!"), "n_digits": without("0-9"),
    }
    if {"n_lines", "n_dup_lines", "n_ended_lines"} & set(wanted):
        out = out.withColumn(lines, F.filter(F.split(body, "\n"), lambda line: line.rlike(f"[^{BLANK}]")))
        made |= {
            "n_lines": F.size(lines), "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
            "n_ended_lines": F.size(F.filter(lines, lambda line: line.rlike(rf"[.!?…\"'»”)\]][{BLANK}]*\z"))),
        }
    if "n_repeat_words" in wanted:
        # (hash of a window, its position in as many low bits as the text needs), sorted
        keyed = F.expr(f"transform(slice({words}, 1, size({words}) - 2), (w, i) -> shiftleft(shiftright(xxhash64(w, {words}[i + 1], {words}[i + 2]), {bits}), {bits}) | i)")
        out = out.withColumn(bits, F.when(n >= 3, F.length(F.bin(n))).otherwise(F.lit(1)))
        out = out.withColumn(keys, F.when(n >= 3, F.sort_array(keyed)).otherwise(F.expr("array()").cast("array<bigint>")))
        same = f"filter({keys}, (x, i) -> (i > 0 and shiftright(x ^ {keys}[i - 1], {bits}) = 0) or (i + 1 < size({keys}) and shiftright(x ^ {keys}[i + 1], {bits}) = 0))"
        out = out.withColumn(doubles, F.expr(f"transform({same}, x -> x & (shiftleft(1L, {bits}) - 1))"))
        out = out.withColumn(doubles, F.sort_array(doubles))
        made["n_repeat_words"] = F.expr(f"aggregate(transform({doubles}, (x, i) -> if(i + 1 < size({doubles}), least(3L, {doubles}[i + 1] - x), 3L)), 0L, (a, x) -> a + x)")
    out = out.withColumns({name: made[name].cast("long") for name in wanted})
    return out.drop(words, letters, lines, bits, keys, doubles)
