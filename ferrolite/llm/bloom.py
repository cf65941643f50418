"""Bloom filters as DataFrames of bitmap blocks, made and asked with built-in functions only.

A key sets one bit in each half of the filter. A filter is a table of (block, bits); a block holds 32,768 bits.
Its size follows the number of keys at 16 bits a key, up to `max_bytes`, which bounds what is broadcast. Beyond
that bound more keys pass the filter than need to; whoever asks treats a pass as "perhaps" and decides exactly after.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

BLOCK_BITS = 32_768
BITS_PER_KEY = 16
MAX_BYTES = 32 << 20


def blocks_for(n_keys: int, max_bytes: int = MAX_BYTES) -> int:
    """Blocks of one half."""
    most = max(1, max_bytes * 8 // BLOCK_BITS // 2)
    return min(most, max(1, math.ceil(n_keys * BITS_PER_KEY / 2 / BLOCK_BITS)))


def _slots(key: Column, blocks: int) -> list[Column]:
    width = blocks * BLOCK_BITS
    return [F.pmod(F.xxhash64(F.lit(17 + half), key), F.lit(width)) + F.lit(half * width) for half in (0, 1)]


def _pack(slots: DataFrame) -> DataFrame:
    return slots.groupBy(F.floor(F.col("slot") / BLOCK_BITS).cast("long").alias("block")).agg(
        F.bitmap_construct_agg(F.pmod("slot", F.lit(BLOCK_BITS))).alias("bits"))


def repeated(keys: DataFrame, key: Column, blocks: int) -> DataFrame:
    """Filter of the bits that two or more rows set: both bits of every repeated key are among them."""
    slots = keys.select(F.explode(F.array(*_slots(key, blocks))).alias("slot"))
    return _pack(slots.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("slot"))


def present(keys: DataFrame, key: Column, blocks: int) -> DataFrame:
    """Filter of all keys."""
    return _pack(keys.select(F.explode(F.array(*_slots(key, blocks))).alias("slot")))


def ask(df: DataFrame, key: Column, bits: DataFrame, blocks: int, out: str) -> DataFrame:
    """Add a boolean: may the key be in the filter? The filter is broadcast; blocks_for() bounds its bytes."""
    for half, slot in enumerate(_slots(key, blocks)):
        df = df.withColumn(f"__slot{half}", slot)
    for half in (0, 1):
        table = F.broadcast(bits.select(F.col("block").alias(f"__b{half}"), F.col("bits").alias(f"__bits{half}")))
        df = df.join(table, F.floor(F.col(f"__slot{half}") / BLOCK_BITS).cast("long") == F.col(f"__b{half}"), "left")
    hit = F.lit(True)
    for half in (0, 1):
        pos = F.pmod(F.col(f"__slot{half}"), F.lit(BLOCK_BITS)).cast("int")
        byte = F.conv(F.hex(F.substring(F.col(f"__bits{half}"), (pos / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        hit = hit & F.coalesce(F.call_function("getbit", byte, pos % 8) == 1, F.lit(False))
    return df.withColumn(out, hit).drop(*[f"__{p}{h}" for p in ("slot", "b", "bits") for h in (0, 1)])
