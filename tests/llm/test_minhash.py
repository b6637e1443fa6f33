import random

import numpy as np

from meterline.llm import minhash
from meterline.llm.decontaminate import WordHashes

from .helpers import EDGE_TEXTS, docs_frame, prose


def shingles(text):
    words = (text or "").encode().lower().split()
    k = min(3, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def brute(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            both = len(x & y)
            if x and y and 100 * both >= percent * (len(x) + len(y) - both):
                root[find(i)] = find(j)
    ids = {}
    for i, (doc, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(doc)
    out = []
    for i, (doc, _) in enumerate(rows):
        least = min((x for x in ids[find(i)] if x is not None), default=None) if sets[i] else doc
        out.append((doc, len(sets[i]), least, least == doc))
    return sorted(out, key=str)


def edited(rng, text, n):
    words = text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(rng):
    rows = [*EDGE_TEXTS, "Two WORDS", "two words", "a b c", "A b\tc", "a b c d"]
    for _ in range(40):
        base = prose(rng, rng.randrange(5, 300))
        rows += [base, base.upper(), *(edited(rng, base, rng.randrange(0, 12)) for _ in range(rng.randrange(4)))]
    # Chains: each is linked to the next, the ends are far apart.
    words = [f"c{i}" for i in range(400)]
    rows += [" ".join(words[i * 12 : i * 12 + 200]) for i in range(12)]
    # Texts that share one long passage and are not similar.
    shared = prose(rng, 120)
    rows += [f"{shared} {prose(rng, rng.randrange(60, 140))}" for _ in range(40)]
    rng.shuffle(rows)
    out = list(enumerate(rows))
    return [*out, (None, out[30][1]), (None, None), (None, "lonely text of a row without id"), (31, out[31][1]), (31, out[31][1]), (31, out[50][1])]


def test_against_brute_force(spark):
    rng = random.Random(31)
    rows = corpus(rng)
    got = minhash.near_duplicates(docs_frame(spark, rows, extra=True).withColumnRenamed("item", "cls"))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    want = brute(rows)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert sum(not r[3] for r in want) > 60


def test_crowd_of_near_copies_takes_a_pair_a_member(spark, monkeypatch):
    """A thousand copies with own edits, two of which are linked to others but not to the hub, and near misses."""
    rng = random.Random(32)
    base = prose(rng, 150)
    rows = [edited(rng, base, 2) for _ in range(600)] + [edited(rng, base, 9) for _ in range(12)] + [edited(rng, base, 30) for _ in range(30)]
    rows = list(enumerate(rows))
    made = []
    real = minhash.Stored

    class Counted(real):
        def __init__(self, df, name, **options):
            super().__init__(df, name, **options)
            if name in ("minhash-likely", "minhash-links"):
                made.append(self.df.count())

    monkeypatch.setattr(minhash, "Stored", Counted)
    want = brute(rows)
    for size in (2048, 100):  # one block, and many of hubs and members
        monkeypatch.setattr(minhash, "BLOCK_CLASSES", size)
        assert sorted(map(tuple, minhash.near_duplicates(docs_frame(spark, rows)).collect()), key=str) == want
    # Candidates and links of both runs; all pairs of the crowd would be 206,000.
    assert sum(made) < 2 * 8 * len(rows), made


def test_blocks_count_and_link_alike():
    rng = np.random.default_rng(36)
    sets = [np.unique(rng.integers(0, 9000, rng.integers(0, 400), dtype=np.uint64)) for _ in range(40)]
    hubs, members = sets[:15], sets[15:] + sets[:2]
    both = minhash.common_counts(hubs, members)
    assert both.tolist() == [[float(len(np.intersect1d(x, y))) for y in members] for x in hubs]
    linked = rng.random((15, 27)) < 0.08
    hub_comps, member_comps = rng.integers(0, 30, 15), rng.integers(0, 30, 27)
    links = minhash.spanning_links(linked, hub_comps, member_comps)
    assert len(links) < 30
    join = lambda edges: {frozenset(c) for c in closure(edges, {*hub_comps.tolist(), *member_comps.tolist()})}
    assert join(links) == join([(hub_comps[h], member_comps[m]) for h, m in zip(*np.nonzero(linked))])


def closure(edges, vertices):
    groups = {v: {v} for v in vertices}
    for a, b in edges:
        if groups[a] is not groups[b]:
            groups[a] |= groups[b]
            for v in groups[b]:
                groups[v] = groups[a]
    return groups.values()


def test_rows_that_stay(spark):
    rng = random.Random(33)
    base = prose(rng, 80)
    rows = [(3, base), (1, base), (2, edited(rng, base, 1)), (9, None), (8, ""), (7, prose(rng, 50))]
    df = docs_frame(spark, rows, extra=True).selectExpr("*", "doc_id AS kept_id")
    out = minhash.keep_one(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 7, 8, 9]
    assert minhash.near_duplicates(df.limit(0)).count() == 0
    assert sorted(minhash.near_duplicates(docs_frame(spark, [(1, None), (2, " ")])).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_threshold_and_signatures():
    assert [minhash.threshold(64, p) for p in (85, 100)] == [34, 64]
    factors, shifts = minhash.permutations(64)
    assert (factors % np.uint64(2) == 1).all()
    rng, hashes, far = random.Random(34), WordHashes(), []
    for _ in range(300):
        base = prose(rng, 200)
        x, y = (minhash.shingle_set(t, 3, hashes) for t in (base, edited(rng, base, 4)))
        s = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        hits = (minhash.signature(x, factors, shifts) == minhash.signature(y, factors, shifts)).sum()
        far.append((hits - 64 * s) / (64 * s * (1 - s) + 1e-9) ** 0.5)
    assert abs(np.mean(far)) < 0.3 and 0.7 < np.std(far) < 1.3


def test_very_long_text_in_blocks():
    rng, hashes = random.Random(35), WordHashes()
    text = prose(rng, 30_000)
    whole = minhash.shingle_set(text, 3, hashes)
    factors, shifts = minhash.permutations(8)
    assert len(whole) > 2 * minhash.HASH_BLOCK
    assert minhash.signature(whole, factors, shifts).tolist() == (whole * factors + shifts).min(axis=1).tolist()
