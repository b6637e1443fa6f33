"""Token counts of whole texts; huge documents by overlap resynchronisation.

A huge document is cut into overlapping chunks that are encoded apart. Two
neighbours are spliced in their overlap at a boundary that is proven stable:
a space after a non-space, where both tokenizer layouts cut before any merge
whatever stands around it, strictly inside both chunks. Both chunks must name
the same first and last such boundary of the overlap and give the same ids
between them; otherwise the document is cut again with wider chunks and
overlaps, until one chunk holds it whole.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import Stored, arrow_batches, column
from meterline.llm.tokens import Encoder, tokenizer_path

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 512
# After a failed alignment, chunks and overlaps grow by this factor.
WIDEN = 4

STABLE = re.compile(r"(?<=\S)(?= )")


class Counter:
    """Token counts by the library that belongs to the file: tokenizers for .json, sentencepiece for .model."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            import sentencepiece

            pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = None
            self.count = lambda text: len(pieces.encode(text, num_threads=1))
        else:
            encoder = Encoder(path)
            self.encode, self.count = encoder.encode, encoder.count
        self.splits = self.encode is not None and encoder.layout != "other"


def cut_chunks(text: str, chunk: int, overlap: int) -> Iterator[tuple[int, int, bool, str]]:
    """(k, start, last, part): chunk k spans ``[k * chunk, (k + 1) * chunk + overlap)`` of the text."""
    for k in range(max(1, -(-len(text) // chunk))):
        start, stop = k * chunk, min(len(text), (k + 1) * chunk + overlap)
        yield k, start, stop == len(text), text[start:stop]
        if stop == len(text):
            return


def overlap_edge(starts: list[int], ids: list[bytes], text: str, lo: int, hi: int) -> tuple[int, int, int] | None:
    """(first, last, crc): the outermost stable boundaries strictly between ``lo`` and ``hi``, and the chunk's ids between the two."""
    stable = [p for p in (m.start() for m in STABLE.finditer(text, lo, min(hi + 1, len(text)))) if lo < p < hi]
    if not stable:
        return None
    i, j = bisect_left(starts, stable[0]), bisect_left(starts, stable[-1])
    if starts[i] != stable[0] or starts[j] != stable[-1]:
        return None
    return stable[0], stable[-1], zlib.crc32(b"".join(ids[i:j]))


def measure_chunk(encoder: Encoder, start: int, last: bool, text: str, chunk: int, overlap: int) -> tuple:
    """Encode one whole chunk: tokens between its splice points, and the evidence for either splice in document positions."""
    starts, ids = encoder.spans(text)
    left = overlap_edge(starts, ids, text, 0, min(overlap, len(text))) if start else None
    right = None if last else overlap_edge(starts, ids, text, chunk, chunk + overlap)
    if (start and left is None) or (not last and right is None):
        return 0, left, right
    i = bisect_left(starts, left[0]) if start else 0
    j = len(starts) if last else bisect_left(starts, right[0])
    move = lambda e: None if e is None else (e[0] + start, e[1] + start, e[2])
    return sum(map(len, ids[i:j])) // 4, move(left), move(right)


def count_huge(huge: DataFrame, tokenizer: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """(row, n_tokens) of ``huge`` (row, text), whose rows are distinct."""
    evidence = "struct<first:bigint,last:bigint,crc:bigint>"
    arrow_evidence = pa.struct([("first", pa.int64()), ("last", pa.int64()), ("crc", pa.int64())])
    done: DataFrame | None = None
    pending = huge
    while True:

        def cut(batches: Iterator[pa.RecordBatch], chunk=chunk, overlap=overlap) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    for k, start, last, part in cut_chunks(text.as_py(), chunk, overlap):
                        yield pa.RecordBatch.from_arrays([pa.array([row], pa.int64()), pa.array([k], pa.int64()), pa.array([start], pa.int64()), pa.array([last]), pa.array([part])], names=["row", "k", "start", "last", "part"])

        def measure(batches: Iterator[pa.RecordBatch], chunk=chunk, overlap=overlap) -> Iterator[pa.RecordBatch]:
            encoder = Encoder(tokenizer_path(tokenizer))
            for batch in batches:
                starts, lasts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
                found = [measure_chunk(encoder, s, z, t.as_py(), chunk, overlap) for s, z, t in zip(starts, lasts, batch.column(4))]
                as_struct = lambda e: None if e is None else dict(zip(("first", "last", "crc"), e))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), batch.column(3), pa.array([f[0] for f in found], pa.int64()), pa.array([as_struct(f[1]) for f in found], arrow_evidence), pa.array([as_struct(f[2]) for f in found], arrow_evidence)],
                    names=["row", "k", "last", "n", "left_edge", "right_edge"],
                )

        # Dealt by chunk, so that one huge document spreads over tasks.
        chunks = pending.mapInArrow(cut, "row bigint, k bigint, start bigint, last boolean, part string").repartition("row", "k")
        found = Stored(chunks.mapInArrow(measure, f"row bigint, k bigint, last boolean, n bigint, left_edge {evidence}, right_edge {evidence}"), "chunk-counts").df
        after = found.select("row", (F.col("k") - 1).alias("k"), F.col("left_edge").alias("next_edge"))
        spliced = found.join(after, ["row", "k"], "left")
        agrees = F.col("last") | F.coalesce(F.col("right_edge") == F.col("next_edge"), F.lit(False))
        sums = Stored(spliced.groupBy("row").agg(F.sum("n").alias("n_tokens"), F.min(agrees).alias("aligned")), "huge-counts").df
        good = sums.filter("aligned").select("row", "n_tokens")
        done = good if done is None else done.unionByName(good)
        failed = sums.filter("NOT aligned").select("row")
        if not failed.limit(1).count():
            return done
        pending = Stored(pending.join(failed, "row", "left_semi"), "huge-again").df
        chunk, overlap = chunk * WIDEN, overlap * WIDEN


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = 2048, huge_chars: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit (n_tokens > ``max_tokens``).

    Counts are the library's for the whole text without added special tokens;
    special strings inside a text count as the library's default has it. A null
    text counts as empty; null ids and repeated rows are kept. Tokenizers
    without provable cuts (other layouts, .model files) are never chunked.
    """
    arrow_batches(docs.sparkSession)
    splits = Counter(tokenizer_path(tokenizer)).splits
    slim = docs.select(column(id_col).alias("doc_id"), F.coalesce(column(text_col), F.lit("")).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = Counter(tokenizer_path(tokenizer)).count
        for batch in batches:
            counts = [count(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    sized = slim.withColumn("n_bytes", F.octet_length("text").cast("long"))
    usual = sized.filter(F.char_length("text") <= huge_chars) if splits else sized
    out = usual.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    if splits:
        huge = Stored(sized.filter(F.char_length("text") > huge_chars).withColumn("row", F.monotonically_increasing_id()), "huge").df
        counted = count_huge(huge.select("row", "text"), tokenizer, huge_chars, overlap)
        out = out.unionByName(huge.select("row", "doc_id", "n_bytes").join(counted, "row").drop("row"))
    return out.withColumn("over_limit", F.col("n_tokens") > max_tokens)
