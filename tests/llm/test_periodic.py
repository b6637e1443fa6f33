import hashlib
import random
import zlib

import numpy as np

from meterline.llm import periodic
from meterline.llm.catalog import QUERIES

from .helpers import EDGE_TEXTS, docs_frame, prose


def brute_runs(words, min_words=24, min_periods=3):
    """Every maximal stretch per lag; a stretch keeps its smallest lag."""
    found = {}
    for q in range(1, len(words) // min_periods + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(min_words, min_periods * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def brute_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_of(text):
    return [w.decode() for w in (text or "").encode().split()]


def brute_planted(doc_id, text):
    words = words_of(text)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def random_words(rng):
    """Short alphabets, planted periods, nested and neighbouring runs."""
    out = []
    for _ in range(rng.randrange(1, 8)):
        block = [rng.choice("abcd") for _ in range(rng.randrange(1, 12))]
        out += block * rng.randrange(1, 9)
        out += [rng.choice("abcdefgh") for _ in range(rng.randrange(0, 6))]
    return out


def scanned(texts, **limits):
    sizes, runs, collapsed = periodic.scan_texts([t.encode() if t is not None else None for t in texts], **({"min_words": 24, "min_periods": 3} | limits))
    return sizes, [[(r["start"], r["length"], r["period"]) for r in own] for own in runs], [c.decode() for c in collapsed]


def test_scan_against_every_lag():
    rng = random.Random(11)
    texts = [" ".join(random_words(rng)) for _ in range(400)] + ["a " * 200, "a b " * 50 + "a", "a a b " * 20 + "a a a b b", ""]
    for limits in ({}, {"min_words": 6}, {"min_words": 10, "min_periods": 4}):
        sizes, runs, collapsed = scanned(texts, **limits)
        assert sizes == [len(words_of(t)) for t in texts]
        for t, own, rest in zip(texts, runs, collapsed):
            assert own == brute_runs(words_of(t), **limits)
            assert rest == brute_collapsed(words_of(t), own)
    assert sum(map(len, runs)) > 100


def test_documents_of_one_block_do_not_mix():
    rng = random.Random(12)
    half = prose(rng, 10)
    texts = [half, half, half, " ".join([half] * 3), half]
    assert scanned(texts)[1] == [[], [], [], [(0, 30, 10)], []]


def test_splitting_leaves_only_words_of_possible_runs():
    rng = random.Random(13)
    words = [w for i in range(300) for w in (rng.choice("abc"), f"only{i}")] + ["x", "y", "z"] * 10
    ids = np.unique(words, return_inverse=True)[1]
    at, _ = periodic.surviving(ids, np.array([len(words)]), 24, 3)
    assert at.tolist() == list(range(600, 630))


def test_long_text_is_scanned_whole():
    rng = random.Random(14)
    words = [f"w{rng.randrange(40)}" for _ in range(120_000)]
    words[100_000:100_000] = ["p", "q", "r", "s", "t"] * 3000
    assert (100_000, 15_000, 5) in scanned([" ".join(words)])[1][0]
    doubled = [f"u{i}" for i in range(20_000)] * 3
    assert scanned([" ".join(doubled)])[1][0] == [(0, 60_000, 20_000)]


def test_rows_against_brute_force(spark, monkeypatch):
    rng = random.Random(15)
    rows = list(enumerate([*EDGE_TEXTS, *(" ".join(random_words(rng)) for _ in range(120)), prose(rng, 400), "same\x0bwords\x0chere\r" * 30, " a b " * 40]))
    rows += [(None, rows[20][1]), (None, None), (21, rows[21][1]), (21, rows[21][1]), (21, rows[30][1])]
    wanted = []
    for i, t in rows:
        words = brute_planted(i, t)
        runs = brute_runs(words)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
        digests = (hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{n},{q}\n" for s, n, q in runs), brute_collapsed(words, runs)))
        wanted.append((i, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *digests))
    df = docs_frame(spark, rows, extra=True).withColumnRenamed("kept", "periodic").withColumnRenamed("lines", "w")
    got = periodic.runs_report(periodic.planted(df))
    assert [c for c, _ in got.dtypes] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(wanted, key=str)
    assert sum(r[1] for r in wanted) > 50
    assert periodic.runs_report(periodic.planted(df.limit(0))).count() == 0


def test_all_columns_are_carried_beside_a_clashing_name(spark):
    df = docs_frame(spark, [(1, "a b " * 20), (2, None)]).selectExpr("*", "doc_id AS periodic", "text AS text_to_scan")
    found, out = periodic.with_runs(df)
    assert found.columns == [*df.columns, "_periodic"] and out == "_periodic"
    rows = {r.doc_id: r for r in found.collect()}
    assert rows[1][out].collapsed == "a b" and rows[1][out].runs[0].asDict() == {"start": 0, "length": 40, "period": 2}
    assert rows[1].periodic == 1 and rows[2][out].asDict() == {"n_words": 0, "runs": [], "collapsed": ""}


def test_query_covers_the_table(spark):
    sf = "/root/testdata/sf0.001"
    got = QUERIES["op11_periodic_runs"](spark, sf)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = got.collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        assert r.n_runs == len(brute_runs(brute_planted(r.doc_id, docs[r.doc_id])))
