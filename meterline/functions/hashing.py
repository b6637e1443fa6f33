"""Deterministic per-row hashes for splitting and sampling.

Both are pure functions of ``key``: a row lands in the same bucket whatever
the partitioning, the executor count or a task retry, so no sort and no
persist are needed to make the split repeatable.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash32(key: Column | str) -> Column:
    """First 8 hex digits of ``md5(key)`` as a number in [0, 2^32)."""
    k = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("bigint")


def split_bucket(key: Column | str, buckets: int = 100) -> Column:
    """Bucket in [0, buckets) used for the train/test split."""
    return hash32(key) % buckets


def sample_order_key(key: Column | str) -> Column:
    """Full md5 hex of the key: a pseudo-random but stable sample order."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(k.cast("string"))
