"""Blocked Bloom filters as tables, with DataFrame functions only.

A filter is a table (block, w0 .. w7); a key sets one bit in each of the eight 64-bit words of its block. A filter up
to BROADCAST_BYTES is broadcast, and its size is known from the number of keys before it is built. A larger one is
joined on its block number: rows without a key don't take part, and SALTS copies of the filter share the rows of a hot
key. Columns of the rows may have any names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandmill.llm.shared import fresh

WORDS = 8
#: A block's row: its number and eight words.
ROW_BYTES = 8 * (WORDS + 1)
BROADCAST_BYTES = 16 << 20
SALTS = 16


def _bit(key: Column, i: int) -> Column:
    return F.shiftright(F.xxhash64(key, F.lit("bit")), 6 * i).bitwiseAND(F.lit(63)).cast("int")


def build_filter(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, w0 .. w7) of the non-null keys; partial bit-ors come before the shuffle."""
    one = F.lit(1).cast("bigint")
    words = [F.bit_or(F.call_function("shiftleft", one, _bit(F.col(key), i))).alias(f"w{i}") for i in range(WORDS)]
    return keys.where(F.col(key).isNotNull()).groupBy(F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block")).agg(*words)


def with_possible(rows: DataFrame, key: str, bloom: DataFrame, blocks: int, name: str) -> DataFrame:
    """rows with a new boolean column of that name: whether the key may be in the filter. Null keys are not possible."""
    if name != fresh(rows.columns, name):
        raise ValueError(f"a column {name} is there already")
    names = [*rows.columns, name]
    block, words, salt = (fresh(names, x) for x in ("block", "words", "salt"))
    held = bloom.select(F.col("block").alias(block), F.struct(*(f"w{i}" for i in range(WORDS))).alias(words))
    one = F.lit(1).cast("bigint")
    bits = [F.col(words)[f"w{i}"].bitwiseAND(F.call_function("shiftleft", one, _bit(F.col(key), i))) != 0 for i in range(WORDS)]
    found = F.coalesce(reduce(lambda a, b: a & b, bits), F.lit(False)).alias(name)
    own = rows.withColumn(block, F.when(F.col(key).isNotNull(), F.pmod(F.xxhash64(key), F.lit(blocks))))
    if blocks * ROW_BYTES <= BROADCAST_BYTES:
        return own.join(F.broadcast(held), block, "left").select(*rows.columns, found)
    held = held.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = own.where(F.col(block).isNotNull()).withColumn(salt, F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    without = rows.where(F.col(key).isNull()).select(*rows.columns, F.lit(False).alias(name))
    return dealt.join(held, [block, salt], "left").select(*rows.columns, found).unionByName(without)


def filter_blocks(n: int, bits_per_key: int = 16) -> int:
    """Blocks for n keys."""
    return max(16, n * bits_per_key // (64 * WORDS) + 1)


def split_possible(rows: DataFrame, key: str, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose key surely isn't in wanted, rows whose key may be). wanted is a stored table with a column entry."""
    blocks, name = filter_blocks(wanted.count()), fresh(rows.columns, "possible")
    seen = with_possible(rows, key, build_filter(wanted, "entry", blocks), blocks, name)
    return seen.where(~F.col(name)).drop(name), seen.where(F.col(name)).drop(name)


def only_possible(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """rows whose key may be in wanted (a stored table with a column entry). An exact join follows."""
    return split_possible(rows, key, wanted)[1]


def without_keys(rows: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """rows less those whose key is an entry of gone (a stored table of distinct entries). Rows that surely stay aren't shuffled."""
    entry = fresh(rows.columns, "entry")
    sure, doubtful = split_possible(rows, key, gone)
    return sure.unionByName(doubtful.join(gone.select(F.col("entry").alias(entry)), F.col(key) == F.col(entry), "left_anti"))
