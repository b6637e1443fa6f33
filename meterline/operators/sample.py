"""Deterministic n-row sample: the n rows with the smallest ``md5(key)``.

The reference takes ``limit(1000)`` with no order, so its sample depends
on file layout and task timing. Ordering by ``md5(key)`` gives a stable,
pseudo-random sample instead.

A plain ``orderBy(..).limit(n)`` is a top-k: every task keeps n rows and one
task merges n rows from each task. At 100 TB that is hundreds of thousands
of tasks, so the merge would take hundreds of millions of rows. This version
first finds, in one aggregate pass that reads only ``key``, the smallest
power-of-two bound ``2^b`` on the 32-bit hash prefix that at least n rows
fall below. It then keeps only rows under that bound before the top-k, so
the merge sees about 2n rows. Only the integer b reaches the driver. When
the row count is already known (as in the jobs), the bound is computed
arithmetically and checked against the written sample's row count
(``write_ordered_sample``).
The result is exact. If at least n rows hash below ``2^b``, every row of
the true top n does too, because a smaller hash prefix means a smaller md5
hex string. Rows of one key follow a hash of all their columns, so equal keys
give the same sample in any layout too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.hashing import hash32, sample_order_key

HASH_BITS = 32


def sample_order(df: DataFrame, key: str) -> list[Column]:
    """md5(key), key, then a hash of the whole row."""
    return [sample_order_key(key), F.col(key), F.xxhash64(*df.columns)]


def hash_bound_bits(df: DataFrame, n: int, key: str = "key") -> int:
    """Smallest b with count(hash32(key) < 2^b) >= n (else 32).

    One aggregate pass reading only ``key``; each task sends one row of 33
    counts. The answer is one small integer, used as a literal, so the
    filtered top-k plan holds no subquery (a subquery in a filter is also
    copied into the scan's data filters and would run twice).
    """
    return int(hash_bound_frame(df, n, key).first()["bits"])


def hash_bound_frame(df: DataFrame, n: int, key: str = "key") -> DataFrame:
    """One-row frame holding ``bits`` (see ``hash_bound_bits``)."""
    h = hash32(key)
    wide = df.agg(*[F.count_if(h < (1 << b)).alias(f"below_{b}") for b in range(HASH_BITS + 1)])
    first_enough = F.coalesce(
        *[F.when(F.col(f"below_{b}") >= n, F.lit(b)) for b in range(HASH_BITS + 1)], F.lit(HASH_BITS)
    )
    return wide.select(first_enough.alias("bits"))


def ordered_sample(df: DataFrame, n: int = 1000, key: str = "key", prefilter: bool = True) -> DataFrame:
    """The n rows of ``df`` with the smallest (md5(key), key, hash of the row).

    ``key`` must be non-null (the clean table guarantees it).
    """
    out = df
    if prefilter:
        bits = hash_bound_bits(df, n, key)
        out = out.filter(hash32(key) < F.lit(float(1 << bits)))
    return out.orderBy(*sample_order(df, key)).limit(n)


def bound_bits_for_total(total: int, n: int, oversample: int = 4) -> int:
    """Smallest b with ``total * 2^b / 2^32 >= oversample * n`` (md5 prefixes are uniform)."""
    b = 0
    while b < HASH_BITS and total * (1 << b) < oversample * n * (1 << HASH_BITS):
        b += 1
    return b


def write_ordered_sample(
    df: DataFrame, n: int, total: int, path: str, key: str = "key", oversample: int = 4, columns: list[str] | None = None
) -> int:
    """Write the exact ordered sample to ``path`` (one CSV file) in one pass
    when the row count is known.

    The jobs know ``total`` already (the funnel observation, the split
    counts), so the hash bound is set arithmetically for about
    ``oversample * n`` candidates, and no bound aggregate runs. The written
    result verifies the bound: a complete top-n holds ``min(n, total)`` rows.
    The check reads back at most n rows. It counts what was written, so a
    retried task cannot skew it, unlike a metric observed below the top-k's
    exchange. If the bound was too tight (a skewed or small input), it
    widens and the file is rewritten, so the result is always exact.
    Returns the bits used.
    """
    from meterline.sources.sinks import write_single_csv

    spark = df.sparkSession
    want = min(n, total)
    bits = bound_bits_for_total(total, n, oversample)
    while True:
        cand = df.filter(hash32(key) < F.lit(float(1 << bits)))
        best = cand.orderBy(*sample_order(df, key)).limit(n)
        write_single_csv(best.select(*columns) if columns else best, path)
        if bits >= HASH_BITS or spark.read.options(header=True, multiLine=True).csv(path).count() >= want:
            return bits
        bits = min(HASH_BITS, bits + 4)
