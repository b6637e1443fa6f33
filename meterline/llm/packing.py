"""Best-fit packing of token pieces into sequences, hierarchically.

Pieces are dealt into groups that each pack best-fit decreasing on their own.
Nearly full bins leave as finished sequences; underfull bins go up a tree as
items themselves, ``fan_in`` groups at a time, for further best-fit rounds.

Within a group best-fit leaves at most one bin filled to half or less (two of
them would have shared a bin), and two fuller bins never merge. So a node has at
most one such small bin from each of its ``fan_in`` children, and each takes up
at most one fuller bin, for which no bin serves better than the emptiest. A group
that sends up its ``fan_in`` emptiest bins for each round still to come, and one
more, nearly full or not, holds back none that a best merging of whole bins
needs: ``sent_at_least`` sets that floor, and ``nearly_full`` and
``forward_bins`` only choose what goes up beyond it. The other bins are finished
as they are, no item is dropped, and a node's input stays bounded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import Stored, arrow_batches, column, fresh_name
from meterline.llm.tokens import Encoder, tokenizer_path

END_ID = 0
SEQUENCE_TOKENS = 2048
# Items of one local packing (about 20 MB of pandas rows).
GROUP_ITEMS = 100_000
FAN_IN = 16
# A bin that lacks at most this many tokens is nearly full.
NEARLY_FULL = 8
FORWARD_BINS = 4096


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = SEQUENCE_TOKENS, with_ids: bool = False) -> DataFrame:
    """Pieces of every whole text: doc_id, piece, start, length, ids_crc32 (and ``ids``, little-endian uint32 bytes).

    A text's ids are the tokenizer's without special tokens, then ``END_ID``;
    only longer ones are cut, into pieces of ``capacity`` and a last rest. A
    null text counts as empty: one piece that holds the end id. Ids may be
    null or repeated; every row gives its own pieces.
    """
    arrow_batches(docs.sparkSession)
    step = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_path(tokenizer))
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.encode(text.as_py() or "") + END_ID.to_bytes(4, "little")
                for piece, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part), part))
            cols = list(zip(*rows)) if rows else [()] * 6
            kinds = [batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][: 6 if with_ids else 5]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    slim = docs.select(column(id_col).alias("doc_id"), column(text_col).alias("text"))
    ddl = f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return slim.mapInArrow(run, ddl + (", ids binary" if with_ids else ""))


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each item and the fill of each bin; ``lengths`` in the order of packing.

    The open bins of each residual form a stack, and one integer has a bit per
    residual that has any, so the tightest fit is its lowest bit from the
    item's length on.
    """
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    have, fills = 0, []
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, size in enumerate(lengths.tolist()):
        fitting = have >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                have &= ~(1 << room)
        else:
            room, b = capacity, len(fills)
            fills.append(0)
        where[i], offset[i] = b, capacity - room
        fills[b] += size
        left = room - size
        if left:
            open_bins[left].append(b)
            have |= 1 << left
    return where, offset, np.array(fills, np.int64)


def sent_at_least(nodes: int, fan_in: int) -> int:
    """How many of its emptiest bins each of a round's ``nodes`` must send up so that later rounds can merge all they could."""
    rounds = 0
    while nodes > 1:
        rounds, nodes = rounds + 1, -(-nodes // fan_in)
    return fan_in * rounds + 1


def _pack_group(level: int, capacity: int, nearly_full: int, forward: int, least: int, last: bool):
    """Grouped-map function: pack one node's items; ``up`` says whether an item's bin goes up the tree."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        # A fixed order whatever the arrival: a lost task packs the same way again.
        rows = rows.sort_values(["size", "item"], ascending=[False, True], kind="stable", ignore_index=True)
        where, offset, fills = best_fit(rows["size"].to_numpy(), capacity)
        up = np.zeros(len(fills), bool)
        if not last:
            emptiest = np.argsort(fills, kind="stable")
            under = fills[emptiest] < capacity - nearly_full
            under[forward:] = False
            under[:least] = fills[emptiest[:least]] < capacity
            up[emptiest[under]] = True
        node = int(rows["node"].iloc[0])
        bins = (np.int64(level) << 56) + (np.int64(node) << 24) + where
        return pd.DataFrame({"item": rows["item"], "bin": bins, "at": offset, "fill": fills[where], "up": up[where], "node": node})

    return run


def best_fit_pack(pieces: DataFrame, capacity: int = SEQUENCE_TOKENS, group_items: int = GROUP_ITEMS, fan_in: int = FAN_IN, nearly_full: int = NEARLY_FULL, forward_bins: int = FORWARD_BINS) -> DataFrame:
    """``pieces`` (any columns and a ``length`` of 1 ... capacity) with ``sequence_id`` and ``offset``.

    Pieces of one sequence lie gapless from offset 0 and are never cut. No
    pieces give no rows; equal and repeated rows are packed each by itself. A
    column that is called ``sequence_id`` or ``offset`` already is replaced.
    """
    ddl = "item bigint, bin bigint, at bigint, fill bigint, up boolean, node bigint"
    own = fresh_name(pieces, "item")
    numbered = Stored(pieces.drop("sequence_id", "offset").withColumn(own, F.monotonically_increasing_id()), "pieces").df
    nodes = max(1, -(-numbered.count() // group_items))
    items = numbered.select(column(own).alias("item"), F.col("length").alias("size"), F.pmod(F.xxhash64(column(own)), F.lit(nodes)).alias("node"))
    level = 0
    local = Stored(items.groupBy("node").applyInPandas(_pack_group(0, capacity, nearly_full, forward_bins, sent_at_least(nodes, fan_in), nodes == 1), ddl), "bins-0").df
    finished = local.filter("NOT up").select("item", F.col("bin").alias("sequence_id"), F.col("at").alias("offset"))
    # What goes up: each first-round bin, the bin that holds it now and its place there.
    carried = local.filter("up").select("bin", "fill", "node").distinct().select(F.col("bin").alias("first"), "bin", F.lit(0).cast("long").alias("at"), "fill", "node")
    done = []
    while nodes > 1:
        level, nodes = level + 1, -(-nodes // fan_in)
        held = Stored(carried.withColumn("node", F.floor(F.col("node") / fan_in)), f"carried-{level}").df
        whole = held.select(F.col("bin").alias("item"), F.col("fill").alias("size"), "node").distinct()
        moves = Stored(whole.groupBy("node").applyInPandas(_pack_group(level, capacity, nearly_full, forward_bins, sent_at_least(nodes, fan_in), nodes == 1), ddl), f"bins-{level}").df
        moves = moves.select(F.col("item").alias("bin"), F.col("bin").alias("into"), F.col("at").alias("shift"), F.col("fill").alias("filled"), "up")
        moved = held.select("first", "bin", "at", "node").join(moves, "bin").select("first", F.col("into").alias("bin"), (F.col("at") + F.col("shift")).alias("at"), F.col("filled").alias("fill"), "node", "up")
        moved = Stored(moved, f"moved-{level}").df
        done.append(moved.filter("NOT up").select("first", F.col("bin").alias("sequence_id"), F.col("at").alias("shift")))
        carried = moved.filter("up").drop("up")
    if done:
        final = done[0]
        for more in done[1:]:
            final = final.unionByName(more)
        risen = local.filter("up").select("item", F.col("bin").alias("first"), "at").join(final, "first")
        finished = finished.unionByName(risen.select("item", "sequence_id", (F.col("at") + F.col("shift")).alias("offset")))
    return numbered.join(finished.withColumnRenamed("item", own), own).drop(own)


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = SEQUENCE_TOKENS, with_ids: bool = False) -> DataFrame:
    """Every document's pieces with their sequence and place; see ``token_pieces`` and ``best_fit_pack``."""
    return best_fit_pack(token_pieces(docs, tokenizer, id_col, text_col, capacity, with_ids), capacity)
