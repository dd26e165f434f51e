"""Deterministic hash draws.

``unit(key, seed)`` maps a row key to an integer in [0, 2^32) from the first
eight hex digits of ``md5(key || '|' || seed)``.  It depends only on the key,
never on partitioning or task retries, so samples, splits and routes are
reproducible, survive executor loss, and equal the SQL oracle bit for bit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO32 = 4294967296


def _col(key) -> Column:
    return F.col(key) if isinstance(key, str) else key


def unit(key, seed: int) -> Column:
    return F.conv(digest_prefix(key, seed), 16, 10).cast("bigint")


def digest_prefix(key, seed: int) -> Column:
    """The first eight (lowercase) hex digits of ``md5(key || '|' || seed)``."""
    return F.substring(F.md5(F.concat(_col(key).cast("string"), F.lit(f"|{seed}"))), 1, 8)


def below(key, seed: int, fraction: float) -> Column:
    """True for about ``fraction`` of keys (Bernoulli draw without replacement).

    Same test as ``unit(key, seed) < fraction * 2^32``, done on the hex text:
    fixed-width lowercase hex sorts like the number it spells, so the
    comparison skips the base conversion (about a third cheaper per draw).
    """
    threshold = int(round(fraction * TWO32))
    if threshold <= 0:
        return F.lit(False)
    if threshold >= TWO32:
        return F.lit(True)
    return digest_prefix(key, seed) < F.lit(format(threshold, "08x"))
