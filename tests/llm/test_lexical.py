import math
import random
import re
from collections import Counter

import numpy as np

from meterline.llm import lexical

from .helpers import EDGE_TEXTS, docs_frame

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
CAPITALS = str.maketrans({c: chr(ord(c) + 32) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def terms(text):
    return TERM.findall((text or "").translate(CAPITALS))


def brute(rows, items, k=20):
    docs = [(i, Counter(terms(t))) for i, t in rows if terms(t)]
    n_docs, n_words = len(docs), sum(c.total() for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in docs:
            m = 75 + 25 * c.total() * n_docs // n_words
            s = sum(n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t, n in Counter(terms(text)).items() if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def zipf_text(rng, n):
    return " ".join(f"t{min(int(rng.paretovariate(0.7)), 3000)}" + rng.choice(["", "", ".", ",\n"]) for _ in range(n))


def corpus(rng, n=300):
    rows = list(enumerate([*EDGE_TEXTS, "T1 t2-T3 tü1 Ü", "t1 " * 500, *(zipf_text(rng, rng.randrange(1, 60)) for _ in range(n))]))
    rows += [(None, rows[20][1]), (None, None), (15, rows[15][1]), (15, rows[15][1]), (15, "t1 t2 t3"), *((900 + i, "t5 t6 t7") for i in range(40))]
    items = [(i, zipf_text(rng, rng.randrange(1, 30))) for i in range(12)] + [(50, "t5 t6"), (51, "nowhere"), (52, ""), (53, None), (None, "t2 t2 T2 t9"), (54, "t1 ünï"), (54, "t1 ünï")]
    return rows, items


def test_against_brute_force(spark, monkeypatch):
    rows, items = corpus(random.Random(21))
    want = brute(rows, items)
    df = docs_frame(spark, rows, extra=True)
    queries = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "item_id AS score", "1 AS item_no")
    assert sorted(map(tuple, lexical.ranked_search(df, queries).collect()), key=str) == want
    # Many segments, many blocks of items, and steps so short that reading really stops between them.
    monkeypatch.setattr(lexical, "SEGMENT_DOCS", 17)
    monkeypatch.setattr(lexical, "FIRST_STEP", 1)
    got = lexical.ranked_search(df.repartition(5), queries, block_bytes=300)
    assert [c for c, _ in got.dtypes] == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_ids_of_any_type_and_empty_tables(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x y"), ("c", None)], "doc_id string, text string")
    queries = spark.createDataFrame([("q", "X")], "item_id string, text string")
    got = lexical.ranked_search(docs, queries, k=2).collect()
    # x is in all three documents: its weight is floor(1000 ln(8/7)).
    assert [(r.item_id, r.rank, r.doc_id) for r in sorted(got)] == [("q", 1, "a"), ("q", 2, "b")]
    assert lexical.ranked_search(docs.limit(0), queries).count() == 0
    assert lexical.ranked_search(docs, queries.limit(0)).count() == 0
    assert lexical.ranked_search(docs.filter("text IS NULL"), queries).count() == 0


def searched(texts, text, k, floor=0):
    docs = [d for d in map(lexical.terms_of, texts) if d]
    block = lexical.QueryBlock([(0, text)])
    found = lexical.segment_arrays(docs)
    df = Counter(t for d in docs for t in set(d))
    lists = lexical.Lists(found, block.wanted, len(docs), sum(map(len, docs)))
    item = [(block.wanted[t], n * lexical.term_weight(len(docs), df[t])) for t, n in block.items[0][1].items() if t in df]
    got = lists.best(item, k, floor)
    return lists, sorted(zip((-got[1]).tolist(), got[0].tolist()))


def test_reading_stops_early_with_all_ties(monkeypatch):
    rng = random.Random(22)
    texts = [zipf_text(rng, 30) for _ in range(4000)] + ["rare1 rare2 common"] * 30 + ["common filler"] * 3000
    lists, got = searched(texts, "rare1 rare2 common", 5)
    assert len(got) == 30 and len({s for s, _ in got}) == 1  # equal to the 5th best: all are handed on
    assert lists.met < 1000
    want = searched(texts, "rare1 rare2 common", 5000)[1]
    assert got == [x for x in want if x[0] <= want[4][0]]
    assert searched(texts, "rare1 rare2 common", 5, floor=-got[0][0] + 1)[1] == []


def test_direct_access_moves_the_best_position():
    # The lists hold the same documents in opposite orders: what is read from one closes gaps in the other.
    texts = [" ".join(["a"] * (i + 1) + ["b"] * (40 - i)) for i in range(40)]
    lists, got = searched([*texts, *["c"] * 60], "a b", 3)
    assert len(got) >= 3 and lists.met <= 40
    postings = lists.postings(np.array([0, 39]))
    assert postings[0].tolist() == [0, 0, 1, 1]


def test_norm_beyond_64_bits():
    docs = [["x"] * 5, ["x", "y"]]
    found = lexical.segment_arrays([[w.encode() for w in d] for d in docs])
    lists = lexical.Lists(found, {b"x": 0, b"y": 1}, 1 << 61, 1 << 62)
    small = lexical.Lists(found, {b"x": 0, b"y": 1}, 2, 4)
    assert lists.impacts.tolist() == small.impacts.tolist()
