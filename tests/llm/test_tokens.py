import random
import zlib
from array import array

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from meterline.llm.token_counts import token_counts
from meterline.llm.token_files import Codes, encode_codes, read_documents, token_at, write_token_files
from meterline.llm.tokens import Encoder, tokenizer_path
from meterline.session import scratch_path

from .helpers import EDGE_TEXTS, docs_frame, prose

NAMES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
ODD = ["  a", "a  b", "a \n b", "it's don't ''s I'LL", "a<|endoftext|> b", "<|startoftext|>x<|endoftext|>", "é é ﬁ Σας İstanbul ß ŉ", "日本語 テスト", "a ́b", "12 345,6 7.", "tab\there \t x", "x\x85y \x1cz", " \x85 b", "ªº µ", "Å K", "​ x‍ y", "foo.. bar!? baz|qux\nnext line\n\nlast"]


@pytest.mark.parametrize("name", NAMES)
def test_memo_gives_the_librarys_ids(name):
    rng = random.Random(1)
    marks = list(" \n\t.'sé<|aB1 ́ßst ")
    texts = [t or "" for t in EDGE_TEXTS] + ODD + ["".join(rng.choice(marks) for _ in range(rng.randrange(1, 30))) for _ in range(1500)] + [prose(rng, 200)]
    tokenizer, encoder = Tokenizer.from_file(public_tokenizers.path(name)), Encoder(tokenizer_path(name))
    assert encoder.layout != "other"
    for text in texts:
        ids = array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        assert encoder.encode(text) == ids
        assert b"".join(encoder.spans(text)[1]) == ids


def test_codes_give_any_token():
    rng = np.random.default_rng(2)
    for ids in (np.zeros(0), np.array([0]), np.array([255, 256, 65535, 65536, 2**32 - 1]), rng.integers(0, 50257, 5000), rng.integers(0, 256, 1024), rng.integers(0, 2**32, 513)):
        ids = ids.astype(np.uint32)
        codes = Codes(encode_codes(ids))
        assert len(codes) == len(ids)
        assert codes.tokens(0, len(ids)).tolist() == ids.tolist()
        for _ in range(50):
            if len(ids):
                i = int(rng.integers(0, len(ids)))
                j = int(rng.integers(i, len(ids) + 1))
                assert codes.token(i) == ids[i]
                assert codes.tokens(i, j).tolist() == ids[i:j].tolist()


@pytest.mark.parametrize("segment", [1, 300, 1 << 19])
def test_files_round_trip(spark, segment):
    rng = random.Random(3)
    rows = [(100 - i, t) for i, t in enumerate([*EDGE_TEXTS, *ODD, *(prose(rng, rng.randrange(400)) for _ in range(30))])]
    rows += [(None, "no id"), (5, "five"), (5, "five"), (5, "again five")]
    path = scratch_path(spark, "test-token-files")
    write_token_files(docs_frame(spark, rows, extra=True), path, NAMES[0], segment_tokens=segment)
    got = sorted(read_documents(spark, path).collect(), key=lambda r: r.start)
    tokenizer = Tokenizer.from_file(public_tokenizers.path(NAMES[0]))
    ids = lambda t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    crc = lambda x: zlib.crc32(array("I", x).tobytes())
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=str) == sorted(((i, len(ids(t)), crc(ids(t))) for i, t in rows), key=str)
    known = next(r for r in got if r.doc_id == 100 - EDGE_TEXTS.index("one two"))
    assert [token_at(spark, path, known.start + k) for k in range(2)] == ids("one two")[:2]
    with pytest.raises(IndexError):
        token_at(spark, path, at)


def test_empty_files(spark):
    path = scratch_path(spark, "test-token-files")
    write_token_files(docs_frame(spark, []), path, NAMES[0])
    assert read_documents(spark, path).count() == 0


@pytest.mark.parametrize("name", [*NAMES, "piece_bpe_32k.model"])
def test_counts(spark, name):
    rng = random.Random(4)
    texts = [*EDGE_TEXTS, *ODD, prose(rng, 3000), "x" * 9000, "y" * 700 + " " + prose(rng, 500), "é́" * 4000, prose(rng, 300) + "\n" * 900 + prose(rng, 200), " " * 3000]
    rows = list(enumerate(texts)) + [(None, prose(rng, 700)), (None, None), (1, prose(rng, 700)), (1, prose(rng, 700))]
    got = token_counts(docs_frame(spark, rows, extra=True), name, max_tokens=100, huge_chars=600, overlap=40).collect()
    if name.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        count = lambda t: len(pieces.encode(t))
    else:
        tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        count = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)
    want = [(i, len((t or "").encode()), count(t or ""), count(t or "") > 100) for i, t in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert token_counts(docs_frame(spark, []), name).count() == 0
