"""Which fingerprints are stored already: hash buckets for the exact answer, Bloom filters to tell which buckets to read.

A filter is a table of blocks, bitmaps of 32,768 bits. A fingerprint belongs to one block and sets PROBES bits of it, so a look-up is
a join on the block and a few bit tests, all built-in expressions. About BITS_PER_KEY bits per fingerprint make one
fingerprint in some hundreds a false hit, which the exact comparison removes.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of one bitmap (fixed by Spark's bitmap functions), bits set per key, bits reserved per key.
BLOCK_BITS, PROBES, BITS_PER_KEY = 32_768, 4, 12
#: Folders of an index; the number does not depend on the data, so that a stored index can be read by buckets for ever.
BUCKETS = 32
FINGERPRINT, BUCKET = "_fp", "bucket"


def bucket_of(fingerprint: Column) -> Column:
    """The folder that a fingerprint belongs to."""
    return F.pmod(F.xxhash64(F.lit(7), fingerprint), F.lit(BUCKETS)).cast("int")


def of_lot(fingerprint: Column, lots: int, lot: int) -> Column:
    """Does a fingerprint belong to this one of `lots`, a power of two? A lot holds whole buckets, or lies in one."""
    return F.pmod(F.xxhash64(F.lit(7), fingerprint), F.lit(lots)) == lot


def blocks_for(keys: int) -> int:
    """Blocks of a filter over so many keys."""
    return max(1, -(-keys * BITS_PER_KEY // BLOCK_BITS))


def _block(fingerprint: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(11), fingerprint), F.lit(blocks))


def _bits(fingerprint: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(100 + k), fingerprint), F.lit(BLOCK_BITS)) for k in range(PROBES)]


def bloom_filter(fingerprints: DataFrame, blocks: int) -> DataFrame:
    """(block, bits) over the column FINGERPRINT. Keys are shuffled by block first, so that each bitmap is made once; a key's
    bits travel as one number."""
    fp = F.col(FINGERPRINT)
    packed = functools.reduce(operator.add, [bit * F.lit(BLOCK_BITS**k) for k, bit in enumerate(_bits(fp))])
    dealt = fingerprints.select(_block(fp, blocks).alias("block"), packed.alias("bits")).repartition("block")
    bits = F.array(*[F.expr(f"bits div {BLOCK_BITS**k} % {BLOCK_BITS}") for k in range(PROBES)])
    return dealt.select("block", F.explode(bits).alias("bit")).groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))


def may_contain(keys: DataFrame, bloom: DataFrame, blocks: int, flag: str) -> DataFrame:
    """`keys` with a boolean: False means that the filter's table surely lacks the fingerprint."""
    fp = F.col(FINGERPRINT)
    tested = F.lit(True)
    for bit in _bits(fp):
        byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        tested = tested & (F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(1) == 1)
    found = bloom.select(F.col("block").alias("_block"), F.col("bits").alias("_bits"))
    joined = keys.withColumn("_own_block", _block(fp, blocks)).join(found, F.col("_own_block") == F.col("_block"), "left")
    return joined.select(*keys.columns, F.coalesce(F.col("_bits").isNotNull() & tested, F.lit(False)).alias(flag))
