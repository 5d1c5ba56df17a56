"""Hashes that any SQL engine can reproduce, used for sampling and crossing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 60
HASH_SPAN = 1 << HASH_BITS


def row_hash(key: Sequence[str], seed: int) -> Column:
    """Uniform 60-bit number from the key columns and a seed.

    The first 15 hex digits of md5('k1|k2|...|seed'). It depends on the row
    alone: not on partitioning, order, retries or engine.
    """
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key]
    digest = F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def threshold(fraction: float) -> int:
    """The row_hash value below which a fraction of all rows falls."""
    return int(round(fraction * HASH_SPAN))


def java_string_hash(c: Column) -> Column:
    """32-bit polynomial string hash over UTF-16 units (signed int)."""
    mask = F.lit(0xFFFFFFFF)
    zero = F.lit(0).cast("bigint")
    chars = F.split(c, "")

    def step(acc: Column, ch: Column) -> Column:
        return (acc * 31 + F.ascii(ch)).bitwiseAND(mask)

    def pair_step(acc: Column, ch: Column) -> Column:
        rest = F.ascii(ch) - 0x10000
        high = F.lit(0xD800) + F.shiftright(rest, 10)
        low = F.lit(0xDC00) + rest.bitwiseAND(F.lit(0x3FF))
        pair = ((acc * 31 + high) * 31 + low).bitwiseAND(mask)
        return F.when(rest >= 0, pair).otherwise(step(acc, ch))

    # Characters of two units are rare, so only texts that hold one pay for them.
    paired = c.rlike(r"[\x{10000}-\x{10FFFF}]")
    total = F.when(paired, F.aggregate(chars, zero, pair_step)).otherwise(
        F.aggregate(chars, zero, step)
    )
    return F.when(total > 0x7FFFFFFF, total - 0x100000000).otherwise(total).cast("int")


def hash_cross(cols: Sequence[Column | str], buckets: int, algo: str = "java") -> Column:
    """Bucket of several values joined by `_`: non-negative hash modulo buckets.

    algo="java" is reproducible outside Spark; algo="xxhash64" is the fast form.
    Null is crossed as the text "null".
    """
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    text = F.concat_ws("_", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    if algo == "java":
        hashed = java_string_hash(text)
    elif algo == "xxhash64":
        hashed = F.xxhash64(text)
    else:
        raise ValueError("algo is 'java' or 'xxhash64'")
    return F.pmod(hashed, F.lit(buckets)).cast("int")
