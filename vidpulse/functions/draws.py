"""Repeatable draws: a function of (seed, key) only.

They do not depend on partitioning, so a retried task draws the same values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_key(seed: int | str, key: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))


def _hex_prefix(digest: Column, digits: int) -> Column:
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")


def draw32(seed: int | str, key: Column) -> Column:
    """Uniform integer in ``[0, 2^32)``."""
    return _hex_prefix(md5_key(seed, key), 8)


def draw60(seed: int | str, key: Column) -> Column:
    """Uniform integer in ``[0, 2^60)``, in the order of the md5 text."""
    return _hex_prefix(md5_key(seed, key), 15)


def uniform(seed: int | str, key: Column) -> Column:
    """Uniform double in ``[0, 1)``."""
    return draw32(seed, key) / F.lit(float(2**32))


def int_between(seed: int | str, key: Column, low: int, high: int) -> Column:
    """Uniform integer in ``[low, high]``."""
    return F.lit(low) + draw32(seed, key) % F.lit(high - low + 1)
