"""Quality rules: compression bands.

A text is compressed whole and in fixed chunks with zstandard. Natural prose
compresses by a ratio that grows slowly with its length; a ratio above the band
for its length means repetition, one below it means noise. A document's verdict
depends on its text and the limits alone, never on the table around it.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import arrow_batches, column, fresh_name

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
# A median absolute deviation times this is the standard deviation of a normal distribution.
MAD_SIGMA = 1.4826
# The most labelled documents that limits are fitted on.
MAX_LABELLED = 20_000


@dataclass(frozen=True)
class Band:
    """Ratios (bytes in / bytes out) allowed for texts of fewer than ``below`` bytes."""

    below: float
    low: float
    high: float


# Limits that hold for lengths no labelled sample covers.
WIDE = (Band(512, 0.0, 4.0), Band(1024, 1.15, 4.0), Band(2048, 1.6, 4.0), Band(8192, 1.7, 4.5), Band(32768, 1.75, 5.0), Band(float("inf"), 1.75, 6.0))
# Fixed values: ``fit_bands`` on one half of the documents labelled good in a
# corpus of 10,000 (README gives the half and the figures on the other).
PROSE = (
    Band(256, 0.0, 4.0),
    Band(363, 1.373, 1.742),
    Band(512, 1.259, 1.922),
    Band(725, 1.445, 1.907),
    Band(1024, 1.533, 2.098),
    Band(1449, 1.716, 2.118),
    Band(2048, 1.802, 2.176),
    Band(2897, 1.888, 2.231),
    Band(4096, 1.987, 2.257),
    Band(5793, 2.053, 2.315),
    Band(8192, 2.079, 2.373),
    Band(11586, 2.119, 2.389),
    Band(16384, 2.092, 2.46),
    Band(23171, 2.061, 2.618),
    Band(32768, 1.75, 5.0),
    Band(float("inf"), 1.75, 6.0),
)


@dataclass(frozen=True)
class BandRules:
    """Limits by length, and the share of a text's chunks that may lie outside theirs.

    A chunk is judged by the band of its own length; a last chunk shorter than
    half a chunk is not judged. ``bands`` ascend by length and end at infinity.
    """

    bands: tuple[Band, ...] = PROSE
    chunk_bytes: int = 4096
    max_bad_chunk_share: float = 0.3
    level: int = 3
    min_words: int = 50
    max_repeat_percent: int = 50


METRICS = pa.struct(
    [
        ("n_words", pa.int64()),
        ("word_chars", pa.int64()),
        ("n_symbols", pa.int64()),
        ("n_dup_lines", pa.int64()),
        ("n_repeat_words", pa.int64()),
        ("n_bytes", pa.int64()),
        ("zstd_ratio", pa.float64()),
        ("n_chunks", pa.int64()),
        ("n_bad_chunks", pa.int64()),
        ("base_failed", pa.bool_()),
        ("kept", pa.bool_()),
    ]
)
METRICS_DDL = "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,n_bytes:bigint,zstd_ratio:double,n_chunks:bigint,n_bad_chunks:bigint,base_failed:boolean,kept:boolean>"


def repeated_window_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more."""
    n = len(words) - 2
    if n < 2:
        return 0
    number: defaultdict = defaultdict()
    number.default_factory = number.__len__
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    base = np.int64(len(number))
    pair = ids[:-1] * base + ids[1:]
    if base >= 1 << 20:  # the triple would not fit into 63 bits: number the pairs first
        pair = np.unique(pair, return_inverse=True)[1]
    key = pair[:-1] * base + ids[2:]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    repeated = np.zeros(n, bool)
    repeated[order[1:]] |= same
    repeated[order[:-1]] |= same
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + n] |= repeated
    return int(covered.sum())


def band_for(bands: tuple[Band, ...], n_bytes: int) -> Band:
    return bands[bisect_right(bands, n_bytes, key=lambda b: b.below)]


def length_class(n_bytes: int) -> int:
    """Half octaves: class ``c`` holds lengths from 2^(c/2) up to 2^((c+1)/2)."""
    return (n_bytes * n_bytes).bit_length() - 1


def bands_of(sample: list[tuple[int, float]], spreads: float, least_spread: float, least_rows: int, wide: tuple[Band, ...] = WIDE) -> tuple[Band, ...]:
    """``wide``, with limits of its own for each half octave that ``sample`` (bytes, ratio) covers.

    The limits lie ``spreads`` deviations from the median ratio, the deviation
    being the median absolute one and the distance at least ``least_spread`` of
    the median. A half octave with fewer than ``least_rows`` rows counts its two
    neighbours' too, and stays wide if that is not enough.
    """
    by_class = defaultdict(list)
    for n_bytes, ratio in sample:
        by_class[length_class(n_bytes)].append(ratio)
    limits = {}
    for c in by_class:
        near = by_class[c] if len(by_class[c]) >= least_rows else [r for k in (c - 1, c, c + 1) for r in by_class.get(k, [])]
        if len(near) >= least_rows:
            middle = float(np.median(near))
            away = max(spreads * MAD_SIGMA * float(np.median(np.abs(np.array(near) - middle))), least_spread * middle)
            limits[c] = (round(middle - away, 3), round(middle + away, 3))
    # Lengths are whole: the half octaves' bounds are rounded up.
    bound = lambda c: -int(-(2 ** (c / 2)) // 1)
    edges = {b.below for b in wide} | {bound(x) for c in limits for x in (c, c + 1)}
    bands, start = [], 1
    for below in sorted(edges):
        known, beyond = limits.get(length_class(start)), band_for(wide, start)
        bands.append(Band(below, *(known or (beyond.low, beyond.high))))
        start = below
    return tuple(bands)


def measure(text: str | None, rules: BandRules, compressor) -> dict:
    text = text or ""
    raw = text.encode("utf-8")
    words = raw.split()  # bytes: exactly the six ASCII spaces
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    n, n_repeat = len(words), repeated_window_words(words)
    ratio = len(raw) / len(compressor.compress(raw)) if raw else 0.0
    band = band_for(rules.bands, len(raw))
    step, bad = rules.chunk_bytes, 0
    judged = [c for c in (raw[i : i + step] for i in range(0, len(raw), step)) if 2 * len(c) >= step]
    for chunk in judged:
        own = band_for(rules.bands, len(chunk))
        bad += not own.low <= len(chunk) / len(compressor.compress(chunk)) <= own.high
    base_failed = n < rules.min_words or 100 * n_repeat > rules.max_repeat_percent * n
    inside = band.low <= ratio <= band.high and bad <= rules.max_bad_chunk_share * len(judged)
    return {
        "n_words": n,
        "word_chars": len(text) - sum(map(text.count, SPACES)),
        "n_symbols": sum(map(text.count, SYMBOLS)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": n_repeat,
        "n_bytes": len(raw),
        "zstd_ratio": ratio,
        "n_chunks": len(judged),
        "n_bad_chunks": bad,
        "base_failed": base_failed,
        "kept": inside and not base_failed,
    }


def with_quality(docs: DataFrame, text_col: str = "text", out: str = "quality", rules: BandRules | None = None) -> tuple[DataFrame, str]:
    """``docs`` with one struct column of base metrics, ratios and the verdict; also that column's name.

    Every column and row is kept; a clashing ``out`` gets underscores in front.
    A null or empty text has no words: all counts 0, ratio 0, base_failed. Equal
    texts get equal results, in whatever table they stand; an empty table gives
    an empty one.
    """
    arrow_batches(docs.sparkSession)
    rules, out = rules or BandRules(), fresh_name(docs, out)
    position = docs.columns.index(text_col)

    def run(batches):
        import zstandard

        compressor = zstandard.ZstdCompressor(level=rules.level)
        for batch in batches:
            found = [measure(t.as_py(), rules, compressor) for t in batch.column(position)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, METRICS)], names=[*batch.schema.names, out])

    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{fields}, `{out}` {METRICS_DDL}"), out


def verdict(quality: Column) -> Column:
    return quality["kept"]


def keep_good(docs: DataFrame, text_col: str = "text", rules: BandRules | None = None) -> DataFrame:
    """The rows of ``docs`` that the rules keep, columns unchanged."""
    judged, out = with_quality(docs, text_col, rules=rules)
    return judged.filter(verdict(column(out))).drop(out)


def fit_bands(good: DataFrame, text_col: str = "text", spreads: float = 4.5, least_spread: float = 0.06, least_rows: int = 20, max_rows: int = MAX_LABELLED, rules: BandRules | None = None) -> tuple[Band, ...]:
    """Limits by length from ``good``, documents labelled good; for ``BandRules(bands=...)``.

    Of those that pass the base rules, the ``max_rows`` with the smallest text
    hashes are the sample, the same in any partitioning; their lengths and ratios are
    all that reaches the driver. Without a row the limits are the wide ones.
    """
    judged, out = with_quality(good.select(column(text_col)), text_col, rules=rules)
    found = judged.filter(~column(out)["base_failed"]).select(F.xxhash64(column(text_col)).alias("hash"), column(out)["n_bytes"].alias("n_bytes"), column(out)["zstd_ratio"].alias("ratio"))
    sample = found.orderBy("hash", "n_bytes", "ratio").limit(max_rows).collect()
    return bands_of([(r.n_bytes, r.ratio) for r in sample], spreads, least_spread, least_rows)


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: BandRules | None = None) -> DataFrame:
    """One row per document: doc_id, base metrics, ratios, base_failed and kept."""
    judged, out = with_quality(docs.select(column(id_col).alias("doc_id"), column(text_col).alias("text")), "text", rules=rules)
    return judged.select("doc_id", F.col(f"{out}.*"))
