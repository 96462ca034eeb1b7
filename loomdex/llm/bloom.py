"""Blocked Bloom filter as a table: one row per block of four 64-bit words, a bit in each word for each key.

Keys are 64-bit hashes. The table has at most `max_blocks` rows of five numbers, whatever it is built from,
so it is always small enough to broadcast; more keys raise the share of false positives, which the
callers' exact joins remove.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 4
BITS_PER_KEY = 32
MAX_BLOCKS = 1 << 18


def blocks_for(keys: int, max_blocks: int = MAX_BLOCKS) -> int:
    return min(max_blocks, max(1, -(-keys * BITS_PER_KEY // (64 * WORDS))))


def _bit(key: Column, word: int) -> Column:
    place = F.shiftright(key, 6 * word).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def build(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    return keys.groupBy(_block(F.col(key), blocks).alias("bloom_block")).agg(
        *(F.bit_or(_bit(F.col(key), i)).alias(f"bloom_{i}") for i in range(WORDS))
    )


def test(df: DataFrame, table: DataFrame, flag: str, key: str, blocks: int) -> DataFrame:
    """Adds a boolean: false if the key is null or certainly absent."""
    hit = F.col(key).isNotNull()
    for i in range(WORDS):
        hit &= F.col(f"bloom_{i}").bitwiseAND(_bit(F.col(key), i)) != 0
    found = df.withColumn("bloom_block", _block(F.col(key), blocks)).join(F.broadcast(table), "bloom_block", "left")
    return found.withColumn(flag, F.coalesce(hit, F.lit(False))).drop("bloom_block", *(f"bloom_{i}" for i in range(WORDS)))
