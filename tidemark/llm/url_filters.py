"""URL filters: a blocked Bloom filter of listed URLs in front of an exact join. DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize

#: FIXED VALUES: query parameters that name a visit and not a page.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "gclid", "fbclid", "ref")
#: FIXED VALUES: leading host labels that name a view of the same site.
VIEWS = ("www", "m")
#: Bits of a block: eight words of 32 bits, one bit set in each.
WORDS, WORD_BITS = 8, 32
#: Largest number of blocks: 2**18 rows of eight ints (8 MB) are broadcast, however long the list is.
MAX_BLOCKS = 1 << 18


def host_of(url: Column) -> Column:
    """From the first `://` to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://` or for null."""
    rest = _rest(url)
    return F.translate(F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end."""
    return F.regexp_extract(_rest(url), r"(?s)\A[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))


def canonical(url: Column) -> Column:
    """Host without scheme, port, user or view label, path without trailing slash, sorted query without
    visit parameters, no fragment. Null where the URL has no host."""
    rest = F.regexp_replace(_rest(url), r"(?s)#.*", "")
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"(?s)\A.*@", ""), r":\d*\z", "")
    host = F.regexp_replace(F.regexp_replace(host, r"\.+\z", ""), rf"\A(?:{'|'.join(VIEWS)})\.(?=.*\.)", "")
    path = F.regexp_replace(path_of(url), r"/+\z", "")
    query = F.split(F.regexp_extract(rest, r"(?s)\?(.*)", 1), "&")
    named = F.array_sort(F.filter(query, lambda p: (p != "") & ~F.substring_index(p, "=", 1).isin(*TRACKING)))
    return F.when(host != "", F.concat(host, F.when(path == "", F.lit("/")).otherwise(path), F.when(F.size(named) > 0, F.concat(F.lit("?"), F.array_join(named, "&"))).otherwise(F.lit(""))))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule `(verdict, host, path)` that fits, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for what, site, start in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r)):
        fits = ((host == site) | host.endswith("." + site)) & path.startswith(start)
        rule, verdict = F.when(fits, F.lit(site + start)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _bit(key: Column, word: int) -> Column:
    return F.call_function("shiftleft", F.lit(1), F.pmod(F.xxhash64(key, F.lit(word)), F.lit(WORD_BITS)).cast("int"))


def bloom_filter(keys: DataFrame, key: str, rows: int) -> tuple[DataFrame, int]:
    """(block, w0..w7) with about 24 bits a key until MAX_BLOCKS, and the number of blocks.

    Beyond MAX_BLOCKS the filter passes more keys that are not listed; the exact join removes them."""
    blocks = min(MAX_BLOCKS, 1 << max(4, math.ceil(math.log2(max(1, rows) * 24 / (WORDS * WORD_BITS)))))
    words = [F.bit_or(_bit(F.col(key), i)).alias(f"w{i}") for i in range(WORDS)]
    return keys.where(F.col(key).isNotNull()).groupBy(_block(F.col(key), blocks).alias("block")).agg(*words), blocks


def judge_urls(pages: DataFrame, listed: DataFrame, url: str = "url", listed_url: str = "url", rules: list[tuple[str, str, str]] = ()) -> DataFrame:
    """`pages` with host, path, canonical_url, rule, listed and verdict (`allow` or `block`).

    A page's verdict is that of the longest fitting rule, else `block` if its canonical URL equals that of a listed
    URL, else `allow`. Pages that the Bloom filter passes are joined exactly with the listed URLs; the
    others never leave their task. A null or hostless URL has empty host and path and is never listed;
    an empty list or table gives no `block` but by rule. Repeated pages and listed URLs keep one verdict a
    row; further columns stay, columns of the result's names are replaced."""
    known = materialize(listed.select(canonical(F.col(listed_url)).alias("canonical_url")).where("canonical_url is not null").distinct(), "listed")
    bits, blocks = bloom_filter(known, "canonical_url", known.count())
    named = pages.drop("host", "path", "canonical_url", "rule", "listed", "verdict", "_block", "_maybe", "_hit")
    named = named.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url)), "canonical_url": canonical(F.col(url))})
    key = F.col("canonical_url")
    hashed = named.withColumn("_block", _block(key, blocks)).join(F.broadcast(bits.withColumnRenamed("block", "_block")), "_block", "left")
    passes = key.isNotNull() & F.col("w0").isNotNull()
    for i in range(WORDS):
        passes = passes & (F.col(f"w{i}").bitwiseAND(_bit(key, i)) != 0)
    tested = hashed.withColumn("_maybe", F.coalesce(passes, F.lit(False))).drop("_block", *(f"w{i}" for i in range(WORDS)))
    hit = tested.where("_maybe").join(known.withColumn("_hit", F.lit(True)), "canonical_url", "left")
    miss = tested.where("not _maybe").withColumn("_hit", F.lit(False))
    both = miss.unionByName(hit).withColumn("listed", F.coalesce("_hit", F.lit(False)))
    rule, verdict = rule_of(F.col("host"), F.col("path"), list(rules))
    return both.withColumns({"rule": rule, "verdict": F.coalesce(verdict, F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow")))}).drop("_maybe", "_hit")
