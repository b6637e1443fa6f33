import random
import zlib
from array import array

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from meterline.llm.packing import best_fit, best_fit_pack, pack_documents

from .helpers import EDGE_TEXTS, docs_frame, prose

NAME = "word_bpe_49k.json"


def want_pieces(rows, capacity):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(NAME))
    out = []
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for n, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            out.append((doc, n, at, len(part), zlib.crc32(array("I", part).tobytes())))
    return sorted(out, key=str)


def assert_packed(rows, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return by_sequence


def test_documents_are_cut_and_packed(spark):
    rng = random.Random(1)
    rows = list(enumerate([*EDGE_TEXTS, *(prose(rng, rng.randrange(1, 300)) for _ in range(60)), prose(rng, 3000), "<|endoftext|> x <|startoftext|>"]))
    rows += [(None, "no id"), (None, None), (4, "one two"), (4, "one two")]
    got = pack_documents(docs_frame(spark, rows, extra=True), NAME, capacity=512, with_ids=True).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == want_pieces(rows, 512)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in got)
    sequences = assert_packed(got, 512)
    total = sum(r.length for r in got)
    assert len(sequences) <= -(-total // 512) + 2


def test_tree_of_rounds_keeps_every_item(spark):
    rng = random.Random(2)
    for lengths in ([rng.randrange(1, 101) for _ in range(3000)], [60] * 500 + [30], [51] * 300, [1] * 1000, [100] * 50):
        df = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "id bigint, length bigint")
        got = best_fit_pack(df, capacity=100, group_items=40, fan_in=4, nearly_full=2, forward_bins=30).collect()
        assert sorted((r.id, r.length) for r in got) == list(enumerate(lengths))
        sequences = assert_packed(got, 100)
        whole = len(best_fit(np.array(sorted(lengths, reverse=True)), 100)[2])
        assert len(sequences) <= whole * 1.08 + 3  # groups of 40 items only


def test_no_bin_that_could_merge_is_held_back(spark):
    """However few bins may go up, and however full one must be to leave, the sequences are as few as if all went up."""
    # Groups end with one small bin each beside bins of 60, or of 95 and a rest of 5 or less.
    for seed, lengths in enumerate(([60] * 400 + [39] * 380, [95] * 300 + [5, 4] * 160, [55] * 300 + [7] * 700)):
        random.Random(seed).shuffle(lengths)
        df = spark.createDataFrame(list(enumerate(lengths)), "id bigint, length bigint").coalesce(1)

        def sequences(**limits):
            got = best_fit_pack(df, capacity=100, group_items=40, fan_in=4, **limits).collect()
            assert sorted((r.id, r.length) for r in got) == list(enumerate(lengths))
            return len(assert_packed(got, 100))

        assert sequences(forward_bins=1, nearly_full=50) == sequences(forward_bins=10**6, nearly_full=0)


def test_columns_of_any_name_stay(spark):
    df = spark.createDataFrame([(i, f"x{i}", 30, -1, "mine") for i in range(10)], "item bigint, _item string, length bigint, offset int, sequence_id string")
    got = best_fit_pack(df, capacity=100)
    assert got.columns == ["item", "_item", "length", "sequence_id", "offset"]
    rows = got.collect()
    assert sorted((r["item"], r["_item"]) for r in rows) == [(i, f"x{i}") for i in range(10)]
    assert len(assert_packed(rows, 100)) == 4


def test_best_fit_takes_the_tightest_bin():
    where, offset, fills = best_fit(np.array([70, 60, 50, 30, 40, 29]), 100)
    assert where.tolist() == [0, 1, 2, 0, 1, 2]
    assert offset.tolist() == [0, 0, 0, 70, 60, 50]
    assert fills.tolist() == [100, 100, 79]


def test_same_layout_again(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([(i, rng.randrange(1, 90)) for i in range(500)], "id bigint, length bigint").repartition(5, "id")
    layout = lambda: sorted((r.id, r.sequence_id, r.offset) for r in best_fit_pack(df, capacity=100, group_items=60, fan_in=3).collect())
    assert layout() == layout()


def test_empty_table(spark):
    assert pack_documents(docs_frame(spark, []), NAME).count() == 0
