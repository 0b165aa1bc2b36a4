"""Leaving rows out before a shuffle."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A block is one bitmap of Spark's bitmap functions: 32,768 bits, 4 KB.
BLOCK_BITS = 32768
# Wanted keys that pass among the others, at most, while the filter stays under MAX_FILTER_BYTES.
FALSE_POSITIVES = 0.01
MAX_HASHES = 12
# The largest filter that is broadcast: above it, the filter keeps this size and lets more pass.
MAX_FILTER_BYTES = 128 * 1024 * 1024


def filter_shape(keys: int, false_positives: float = FALSE_POSITIVES, max_bytes: int = MAX_FILTER_BYTES) -> tuple[int, int]:
    """``(blocks, hashes)`` of a filter for ``keys`` distinct keys (or rows, an upper bound).

    The classical optimum: ``-n ln p / (ln 2)^2`` bits and ``(bits / n) ln 2`` hashes, in whole
    blocks. Beyond ``max_bytes`` the filter keeps that size and the hashes are fitted to it.
    """
    keys = max(keys, 1)
    bits = -keys * math.log(false_positives) / math.log(2) ** 2
    blocks = max(1, min(math.ceil(bits / BLOCK_BITS), max_bytes * 8 // BLOCK_BITS))
    hashes = max(1, min(MAX_HASHES, round(blocks * BLOCK_BITS / keys * math.log(2))))
    return blocks, hashes


def expected_false_positives(keys: int, blocks: int, hashes: int) -> float:
    """The share of other keys that a filter of this shape lets pass (keys spread evenly over blocks)."""
    per_block = keys / blocks
    return (1 - math.exp(-hashes * per_block / BLOCK_BITS)) ** hashes


def only_needed(rows: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not among the wanted ones.

    A blocked Bloom filter: a key picks one block by one hash and sets ``hashes`` bits in it by
    others. Its size follows the counted rows of ``wanted`` (``filter_shape``), so about
    ``FALSE_POSITIVES`` of the other rows pass whether a thousand or fifty million keys are wanted;
    the blocks are broadcast, at most ``MAX_FILTER_BYTES``. A row meets only its own block (a
    broadcast hash join on the block number) and tests its bits there. No wanted row is dropped;
    the join that follows decides on the rest, but shuffles little that it does not need.
    """
    blocks, hashes = filter_shape(wanted.count())

    def block(of: Column) -> Column:
        return F.pmod(F.xxhash64(of, F.lit(0)), F.lit(blocks))

    def bits(of: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(of, F.lit(i)), F.lit(BLOCK_BITS)) for i in range(1, hashes + 1)]

    filter_ = (
        wanted.select(block(wanted_key).alias("prune_part"), F.explode(F.array(*bits(wanted_key))).alias("bit"))
        .groupBy("prune_part")
        .agg(F.bitmap_construct_agg("bit").alias("prune_bits"))
    )
    found = rows.withColumn("prune_part", block(key)).join(F.broadcast(filter_), "prune_part")
    is_set = F.lit(True)
    for at in bits(key):
        byte = F.substring("prune_bits", (at / 8).cast("int") + 1, F.lit(1))
        number = F.conv(F.hex(byte), 16, 10).cast("int")
        is_set = is_set & (F.getbit(number, F.pmod(at, F.lit(8)).cast("int")) == 1)
    return found.filter(is_set).drop("prune_part", "prune_bits")
