"""Periodic runs of words by recursive frequency splitting.

A run is a stretch of words with a smallest period ``q`` that holds at least
``min_periods`` periods and ``min_words`` words and that no neighbouring word
extends. Every word of a run occurs in it at least ``min_periods`` times, so a
word found less often within a segment (at first the document) lies in no run
and splits it; the parts are counted anew until no part splits any more, and
parts shorter than a run are dropped. The surviving segments are scanned by
lags: for blocks of 1, 2, 4, ... words, each position takes the lag to its
block's next occurrence, and a stretch of equal lags is a run. A block of
``size`` words finds the periods above half its size up to its size: within a
run a block as long as the period first recurs one period on, so no lag has to
be tried out, and the scan takes n log n steps a level whatever the text is.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import arrow_batches, column, fresh_name, once

MIN_WORDS = 24
MIN_PERIODS = 3
# Words scanned together; a longer document is scanned by itself.
BLOCK_WORDS = 1 << 19
WORD = r"[^\x20\x09-\x0D]+"

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS_DDL = "struct<n_words:bigint,runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>"


def surviving(ids: np.ndarray, sizes: np.ndarray, min_words: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions that splitting leaves, ascending, and the number of the segment that each lies in.

    ``ids`` are the words of several documents of ``sizes`` words. Segments
    that lost a word are counted again, the others are finished.
    """
    width = int(ids.max()) + 1 if len(ids) else 1
    segment = np.repeat(np.arange(len(sizes)), sizes)
    at = np.flatnonzero(np.repeat(sizes >= min_words, sizes))
    segment, done, next_number = segment[at], [], len(sizes)
    finished = [np.zeros(0, np.int64)]
    while len(at):
        _, inverse, counts = np.unique(segment * width + ids[at], return_inverse=True, return_counts=True)
        rare = counts[inverse] < least
        numbers = np.unique(segment, return_inverse=True)[1]
        split = np.zeros(numbers.max() + 1, bool)
        split[numbers[rare]] = True
        whole = ~split[numbers]
        done.append(at[whole])
        finished.append(segment[whole])
        left = ~whole & ~rare
        at, parent = at[left], segment[left]
        first = np.ones(len(at), bool)
        first[1:] = (np.diff(at) != 1) | (np.diff(parent) != 0)
        part = np.cumsum(first) - 1
        long = np.bincount(part, minlength=1)[part] >= min_words
        at, segment = at[long], part[long] + next_number
        next_number += int(first.sum())
    at, segment = np.concatenate([*done, np.zeros(0, np.int64)]), np.concatenate(finished)
    order = np.argsort(at, kind="stable")
    return at[order], segment[order]


def lag_scan(ids: np.ndarray, at: np.ndarray, segment: np.ndarray, min_words: int, min_periods: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs within the surviving segments, starts as positions in ``ids``."""
    found = [(np.zeros(0, np.int64),) * 3]
    if not len(at):
        return found[0]
    # Segments one after the other with a gap of one between them, so that no block spans two.
    number = np.concatenate(([0], np.cumsum(np.diff(segment) != 0)))
    place = np.arange(len(at)) + number
    origin = np.zeros(place[-1] + 1, np.int64)
    origin[place] = at
    longest, width = int(np.bincount(number).max()), int(ids.max()) + 1
    blocks = np.unique(number * width + ids[at], return_inverse=True)[1]
    size = 1
    while len(place) and (size // 2 + 1) * min_periods <= longest:
        order = np.argsort(blocks, kind="stable")
        same = blocks[order][1:] == blocks[order][:-1]
        lag = np.zeros(len(place), np.int64)
        lag[order[:-1][same]] = place[order[1:][same]] - place[order[:-1][same]]
        # Stretches of neighbouring positions with one lag.
        near = np.flatnonzero((lag > size // 2) & (lag <= size))
        if len(near):
            begins = np.ones(len(near), bool)
            begins[1:] = (np.diff(place[near]) != 1) | (np.diff(lag[near]) != 0)
            first = np.flatnonzero(begins)
            last = np.append(first[1:], len(near)) - 1
            period = lag[near[first]]
            length = place[near[last]] - place[near[first]] + size + period
            good = length >= np.maximum(min_words, min_periods * period)
            found.append((origin[place[near[first[good]]]], length[good], period[good]))
        # Blocks twice as long, of those that occur again.
        again = np.zeros(len(place), bool)
        again[order[:-1][same]] = True
        again[order[1:][same]] = True
        dense = np.full(len(origin) + size, -1, np.int64)
        dense[place[again]] = blocks[again]
        place = place[again]
        right = dense[place + size]
        place, left, right = place[right >= 0], dense[place[right >= 0]], right[right >= 0]
        blocks = np.unique(left * (int(right.max(initial=0)) + 1) + right, return_inverse=True)[1]
        size *= 2
    start, length, period = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def scan_texts(texts: list[bytes | None], min_words: int, min_periods: int) -> tuple[list[int], list[list[dict]], list[bytes]]:
    """Per text: its number of words, its runs, and the words that no run repeats, joined by spaces."""
    words = [(t or b"").split() for t in texts]  # bytes: exactly the six ASCII spaces
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    number: defaultdict = defaultdict()
    number.default_factory = number.__len__
    ids = np.fromiter((number[w] for ws in words for w in ws), np.int64, int(sizes.sum()))
    at, segment = surviving(ids, sizes, min_words, min_periods)
    start, length, period = lag_scan(ids, at, segment, min_words, min_periods)
    ends = np.cumsum(sizes)
    doc = np.searchsorted(ends, start, side="right")
    runs: list[list[dict]] = [[] for _ in words]
    for d, s, n, q in zip(doc.tolist(), (start - (ends - sizes)[doc]).tolist() if len(doc) else [], length.tolist(), period.tolist()):
        runs[d].append({"start": s, "length": n, "period": q})
    collapsed = []
    for ws, own in zip(words, runs):
        if own:
            gone = np.zeros(len(ws) + 1, np.int64)
            for r in own:
                gone[r["start"] + r["period"]] += 1
                gone[r["start"] + r["length"]] -= 1
            ws = [ws[i] for i in np.flatnonzero(np.cumsum(gone)[:-1] == 0)]
        collapsed.append(b" ".join(ws))
    return sizes.tolist(), runs, collapsed


def blocks_of(texts: list[bytes | None]) -> list[list[bytes | None]]:
    """``texts`` in order, cut into lists of about ``BLOCK_WORDS`` words (six bytes a word)."""
    out: list[list[bytes | None]] = [[]]
    held = 0
    for t in texts:
        if out[-1] and held + len(t or b"") > 6 * BLOCK_WORDS:
            out.append([])
            held = 0
        out[-1].append(t)
        held += len(t or b"")
    return out


def with_runs(docs: DataFrame, text_col: str = "text", out: str = "periodic", carry: list[str] | None = None, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> tuple[DataFrame, str]:
    """``docs`` (or its columns ``carry``) with a struct of n_words, ``runs`` and ``collapsed``; also that column's name.

    ``runs`` holds (start, length, period) by start, then period, in words from
    0; ``collapsed`` is the text's words joined by single spaces without those
    that lie in a run after its first period. Every row is kept; a clashing
    ``out`` gets underscores in front. A null, empty or blank text has no words
    and no runs and collapses to an empty string; equal texts get equal results;
    no rows give no rows.
    """
    if min_periods < 3 or min_words < 1:
        raise ValueError("min_periods must be 3 or more, min_words 1 or more")
    arrow_batches(docs.sparkSession)
    carry = docs.columns if carry is None else carry
    held = docs.select(*[column(c) for c in carry])
    out = fresh_name(held, out)
    text = fresh_name(held, "text_to_scan")
    fed = docs.select(*[column(c) for c in carry], F.encode(column(text_col), "UTF-8").alias(text))

    def run(batches):
        for batch in batches:
            sizes, runs, collapsed = [], [], []
            for texts in blocks_of(batch.column(len(carry)).to_pylist()):
                for whole, part in zip((sizes, runs, collapsed), scan_texts(texts, min_words, min_periods)):
                    whole.extend(part)
            found = pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.array(runs, pa.list_(RUN)), pa.array(collapsed, pa.string())], names=["n_words", "runs", "collapsed"])
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(carry)], found], names=[*carry, out])

    fields = "".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}, " for f in held.schema.fields)
    return fed.mapInArrow(run, f"{fields}`{out}` {RUNS_DDL}"), out


def strongest(runs: Column) -> Column:
    """The run of greatest length / period (compared as fractions); ties: smallest start, then period. Null if there is none."""

    def better(a: Column, b: Column) -> Column:
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        later = (a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["period"] <= b["period"]))
        return F.when((left > right) | ((left == right) & later), a).otherwise(b)

    return F.aggregate(F.slice(runs, 2, F.greatest(F.size(runs), F.lit(1))), F.get(runs, F.lit(0)), better)


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): texts of one id in ten get a tail that repeats, at a place and with a period set by the id's CRC-32."""
    chosen = F.crc32(column(id_col).cast("string"))
    slim = docs.select(column(id_col).alias("doc_id"), column(text_col).alias("text"), chosen.alias("h"))
    slim = once(slim, "w", F.when(F.col("h") % 10 == 0, F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0))))
    slim = slim.withColumn("n", F.size("w").cast("long")).withColumn("g", F.expr("h div 10")).withColumn("a", F.col("g") % F.when(F.col("n") > 0, F.col("n")))
    slim = slim.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    tail = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - F.col("a") - 1), lambda j: F.get(F.col("w"), (F.col("a") + j % F.col("p")).cast("int")))
    repeated = F.array_join(F.concat(F.slice("w", 1, F.col("a").cast("int")), tail), " ")
    return slim.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


def runs_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_runs, the strongest run, and digests of the runs and of the collapsed text."""
    found, out = with_runs(docs, text_col, carry=[id_col])
    runs = column(out)["runs"]
    best = strongest(runs)
    listed = F.array_join(F.transform(runs, lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    return found.select(
        column(id_col).alias("doc_id"),
        F.size(runs).cast("long").alias("n_runs"),
        best.alias("best"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2(column(out)["collapsed"], 256).alias("collapsed_sha256"),
    ).select("doc_id", "n_runs", "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def oracle_sql(min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> str:
    """DuckDB SQL of ``runs_report(planted(documents))``: every pair of equal words of a document, then islands by lag."""
    return f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS h
  FROM documents),
n AS (SELECT *, len(w) AS n, h // 10 AS g FROM d),
a AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM n),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
t AS MATERIALIZED (SELECT r, n, i, w[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END] AS word FROM (SELECT *, unnest(range(n)) AS i FROM p)),
same AS (SELECT x.r, y.i - x.i AS q, x.i FROM t x JOIN t y ON x.r = y.r AND x.word = y.word AND y.i > x.i WHERE {min_periods} * (y.i - x.i) <= x.n),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM same),
stretches AS (SELECT r, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY r, q, k HAVING count(*) + q >= greatest({min_words}, {min_periods} * q)),
runs AS MATERIALIZED (SELECT r, start, length, min(q) AS period FROM stretches GROUP BY ALL),
gone AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT t.r, string_agg(word, ' ' ORDER BY i) AS collapsed FROM t ANTI JOIN gone USING (r, i) GROUP BY t.r),
listed AS (SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed FROM runs GROUP BY r),
best AS (
  SELECT b.* FROM runs b ANTI JOIN runs o ON o.r = b.r AND (o.length * b.period > b.length * o.period
    OR (o.length * b.period = b.length * o.period AND (o.start < b.start OR (o.start = b.start AND o.period < b.period)))))
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM d LEFT JOIN listed USING (r) LEFT JOIN kept USING (r) LEFT JOIN best USING (r)
"""
