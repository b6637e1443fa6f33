"""Token-id files with direct access to any token.

Ids are stored as directly addressable codes: level 1 holds the low bits of
every id and a bitmap of which ids go on; level 2 the next bits of those, and
so on. The j-th set bit of a bitmap continues as entry j of the next level, and
a rank directory counts the set bits before each block, so any token is read by
one lookup per level and nothing else is decoded.

A file table is Parquet with one row per segment: whole documents in ascending
id order, at least one, up to ``segment_tokens`` tokens. ``codes`` is
self-contained: magic, bits per level, level sizes, then per level its chunks,
bitmap and rank directory.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterline.llm.common import arrow_batches, column
from meterline.llm.tokens import Encoder, tokenizer_path
from meterline.session import scratch_path

MAGIC = b"DAC1"
END_ID = 0
SEGMENT_TOKENS = 1 << 19
# Bits per rank block: one 32-bit count for each 64 bytes of bitmap.
RANK_BLOCK = 512


def encode_codes(ids: np.ndarray) -> bytes:
    """Directly addressable codes of unsigned 32-bit ids, eight bits a level."""
    rest, levels = ids.astype(np.uint32), []
    while True:
        more = rest >> np.uint32(8)
        goes_on = more > 0
        bitmap = np.packbits(goes_on, bitorder="little")
        ones = np.add.reduceat(goes_on.astype(np.uint32), np.arange(0, len(rest), RANK_BLOCK)) if len(rest) else np.zeros(0, np.uint32)
        rank = np.concatenate(([0], np.cumsum(ones)[:-1])).astype("<u4") if len(rest) else np.zeros(0, "<u4")
        levels.append((len(rest), (rest & np.uint32(255)).astype(np.uint8).tobytes(), bitmap.tobytes(), rank.tobytes()))
        if not goes_on.any():
            break
        rest = more[goes_on]
    head = MAGIC + struct.pack("<BB", 8, len(levels)) + b"".join(struct.pack("<Q", n) for n, *_ in levels)
    return head + b"".join(part for _, *parts in levels for part in parts)


class Codes:
    """Random access to the ids of one segment."""

    def __init__(self, raw: bytes):
        if raw[:4] != MAGIC:
            raise ValueError("not a token segment")
        self.bits, n_levels = struct.unpack_from("<BB", raw, 4)
        sizes = struct.unpack_from(f"<{n_levels}Q", raw, 6)
        at, self.levels = 6 + 8 * n_levels, []
        for n in sizes:
            n_bitmap, n_rank = -(-n // 8), -(-n // RANK_BLOCK)
            chunks = np.frombuffer(raw, np.uint8, n, at)
            bitmap = np.frombuffer(raw, np.uint8, n_bitmap, at + n)
            rank = np.frombuffer(raw, "<u4", n_rank, at + n + n_bitmap)
            self.levels.append((chunks, bitmap, rank))
            at += n + n_bitmap + 4 * n_rank

    def __len__(self) -> int:
        return len(self.levels[0][0])

    @staticmethod
    def _rank(bitmap: np.ndarray, rank: np.ndarray, i: int) -> int:
        """Set bits before position ``i``: the directory's count, then at most one block's bits."""
        block = i // RANK_BLOCK
        if block >= len(rank):  # i is one past the end, on a block's edge
            block -= 1
        lo = block * RANK_BLOCK
        bits = np.unpackbits(bitmap[lo // 8 : -(-i // 8)], bitorder="little")[: i - lo]
        return int(rank[block]) + int(bits.sum())

    def token(self, i: int) -> int:
        """Token ``i`` alone: one chunk, one bit and one rank per level."""
        value = 0
        for shift, (chunks, bitmap, rank) in enumerate(self.levels):
            value |= int(chunks[i]) << (self.bits * shift)
            if not bitmap[i >> 3] >> (i & 7) & 1:
                break
            i = self._rank(bitmap, rank, i)
        return value

    def tokens(self, i: int, j: int) -> np.ndarray:
        """Tokens ``i`` to ``j`` (end open)."""
        out, where = np.zeros(j - i, np.uint32), None
        for shift, (chunks, bitmap, rank) in enumerate(self.levels):
            part = chunks[i:j].astype(np.uint32) << np.uint32(self.bits * shift)
            if where is None:
                out |= part
            else:
                out[where] |= part
            lo = i // 8
            bits = np.unpackbits(bitmap[lo : -(-j // 8)], bitorder="little")[i - 8 * lo : j - 8 * lo].astype(bool)
            ones = np.flatnonzero(bits)
            if not len(ones):
                break
            where = ones if where is None else where[ones]
            i = self._rank(bitmap, rank, i)
            j = i + len(ones)
        return out


def write_token_files(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", segment_tokens: int = SEGMENT_TOKENS) -> None:
    """Encode every whole text, end it with ``END_ID`` and write the ids in ascending id order to the file table ``path``.

    Null ids come first; rows of one id are ordered by their text, and equal
    rows are written once each. A null text counts as empty and so has the end
    id only. An empty table gives a table without segments.
    """
    arrow_batches(docs.sparkSession)
    slim = docs.select(column(id_col).alias("doc_id"), F.coalesce(column(text_col), F.lit("")).alias("text"))
    # The text's hash is part of the range key, so a repeated id may spread over tasks.
    ranged = slim.withColumn("h", F.xxhash64("text")).repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text").drop("h")
    kind = slim.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part = Encoder(tokenizer_path(tokenizer)), TaskContext.get().partitionId()
        ids, sizes, blobs, held, first, no = [], [], [], 0, 0, 0
        id_type = None

        def segment() -> pa.RecordBatch:
            nonlocal ids, sizes, blobs, held, first, no
            codes = encode_codes(np.frombuffer(b"".join(blobs), "<u4"))
            row = [pa.array([part], pa.int64()), pa.array([no], pa.int64()), pa.array([first], pa.int64()), pa.array([held], pa.int64()), pa.array([ids], pa.list_(id_type)), pa.array([sizes], pa.list_(pa.int64())), pa.array([codes], pa.binary())]
            ids, sizes, blobs, first, no, held = [], [], [], first + held, no + 1, 0
            return pa.RecordBatch.from_arrays(row, names=["part", "segment", "first_in_part", "n_tokens", "doc_ids", "doc_tokens", "codes"])

        for batch in batches:
            id_type = batch.schema.field(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                blob = encoder.encode(text.as_py()) + END_ID.to_bytes(4, "little")
                if held and held + len(blob) // 4 > segment_tokens:
                    yield segment()
                ids.append(doc_id)
                sizes.append(len(blob) // 4)
                blobs.append(blob)
                held += len(blob) // 4
        if held:
            yield segment()

    table = ranged.mapInArrow(run, f"part bigint, segment bigint, first_in_part bigint, n_tokens bigint, doc_ids array<{kind}>, doc_tokens array<bigint>, codes binary")
    # No page compression: a code must be addressable where it lies.
    table.write.option("compression", "none").option("parquet.enable.dictionary", "false").parquet(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The file table with ``first_token``: tokens of all documents before the segment."""
    files = spark.read.parquet(path)
    per_part = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # One row per written partition, whatever the number of tokens.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_part.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return files.join(F.broadcast(base), "part").withColumn("first_token", F.col("base") + F.col("first_in_part")).drop("base")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Every document read back from the files by direct access: doc_id, start, n_tokens, ids_crc32."""
    arrow_batches(spark)
    segments = read_segments(spark, path).select("first_token", "doc_ids", "doc_tokens", "codes")
    kind = segments.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, doc_ids, sizes, raw in zip(*(c for c in batch.columns)):
                codes, at, rows = Codes(raw.as_py()), 0, []
                for n in sizes.as_py():
                    rows.append((first.as_py() + at, n, zlib.crc32(codes.tokens(at, at + n).astype("<u4").tobytes())))
                    at += n
                starts, counts, crcs = zip(*rows)
                yield pa.RecordBatch.from_arrays([doc_ids.values, pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return segments.mapInArrow(run, f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_at(spark: SparkSession, path: str, position: int) -> int:
    """One token of the whole corpus by its position."""
    hit = read_segments(spark, path).filter((F.col("first_token") <= position) & (position < F.col("first_token") + F.col("n_tokens"))).select("first_token", "codes").collect()
    if not hit:
        raise IndexError(position)
    return Codes(bytes(hit[0].codes)).token(position - hit[0].first_token)


def written_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write ``docs`` as token files in the shared folder and read every document back."""
    path = scratch_path(docs.sparkSession, "token-files")
    write_token_files(docs, path, tokenizer)
    return read_documents(docs.sparkSession, path)
