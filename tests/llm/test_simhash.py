import random

import pytest
import xxhash

from meterline.llm import simhash
from meterline.llm.simhash import allocate, fingerprint, keep_one, near_duplicates

from .helpers import EDGE_TEXTS, docs_frame, prose


def brute_print(text, k=3):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(prints, distance):
    """Smallest id per row, by union-find over all pairs."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= distance:
                root[find(i)] = find(j)
    best = {}
    for i, (doc, _) in enumerate(prints):
        if doc is not None:
            best[find(i)] = min(best.get(find(i), doc), doc)
    return [best.get(find(i)) for i in range(len(prints))]


def planted(rng):
    """Originals with lightly and heavily edited copies, exact copies, and edge cases."""
    rows = []
    for _ in range(25):
        words = prose(rng, 300).split()
        rows.append(" ".join(words))
        for _ in range(rng.randrange(6)):
            copy = list(words)
            for _ in range(rng.choice([0, 1, 1, 2, 5])):
                copy[rng.randrange(len(copy))] = prose(rng, 1)
            rows.append(" ".join(copy))
    rows += [rows[0], rows[0].upper(), *EDGE_TEXTS]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_fingerprint_is_the_contracts():
    rng = random.Random(1)
    for text in [*EDGE_TEXTS, prose(rng, 500), "É É a", "A B c", "a\x0bb\x1fc d"]:
        assert fingerprint(text, 3) == brute_print(text)


@pytest.mark.parametrize("bucket", [1, 48])
@pytest.mark.parametrize("distance", [0, 1, 2])
def test_components_against_all_pairs(spark, monkeypatch, bucket, distance):
    # bucket 1: every bucket takes the radius-1 balls; 48: pairwise
    monkeypatch.setattr(simhash, "PAIRWISE_BUCKET", bucket)
    rows = planted(random.Random(2)) + [(None, "null id row with words"), (None, "one"), (3, "one")]
    got = near_duplicates(docs_frame(spark, rows, extra=True), max_distance=distance).collect()
    prints = [(i, brute_print(t)) for i, t in rows]
    want = sorted(((i, p, c) for (i, p), c in zip(prints, brute_components(prints, distance))), key=str)
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=str) == want


def test_dense_group_is_linked_whole(spark):
    # a walk of single-bit steps over few weak bits: one component with a long diameter
    rng, value, prints = random.Random(3), 0x0123456789ABCDEF, []
    for _ in range(400):
        value ^= 1 << rng.randrange(14)
        prints.append(value)
    prints += [v ^ (0xFF << 40) for v in prints[:50]]
    df = spark.createDataFrame([(simhash.signed(p),) for p in sorted(set(prints))], "fp bigint")
    links = simhash.near_links(df, 2)
    assert all((r.a ^ r.b).bit_count() <= 2 for r in ((type("L", (), {"a": x.a % (1 << 64), "b": x.b % (1 << 64)})) for x in links.collect()))
    roots = {r.v: r.root for r in simhash.components(links).collect()}
    flat = [(simhash.signed(p), p) for p in sorted(set(prints))]
    want = brute_components(flat, 2)
    groups = {}
    for (v, _), c in zip(flat, want):
        groups.setdefault(c, set()).add(roots.get(v, v))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_allocation_is_the_cheapest():
    import itertools

    rng = random.Random(4)
    for groups in (1, 2, 3):
        cost = [[0.0, *sorted(rng.random() * 100 for _ in range(3))] for _ in range(groups)]
        total, ts = allocate(cost, 2 - groups + 1)
        options = [c for c in itertools.product(range(-1, 3), repeat=groups) if sum(c) == 2 - groups + 1]
        assert sum(ts) == 2 - groups + 1
        assert abs(total - min(sum(cost[g][t + 1] for g, t in enumerate(c)) for c in options)) < 1e-9


def test_keep_one_leaves_one_row_of_each_component(spark):
    rows = planted(random.Random(5)) + [(0, "a repeated id"), (None, "no id at all"), (None, "no id at all"), (None, "one")]
    df = docs_frame(spark, rows, extra=True)
    out = keep_one(df)
    assert out.columns == df.columns
    prints = [(i, brute_print(t)) for i, t in rows]
    kept = out.collect()
    fps = [brute_print(r.text) for r in kept]
    assert sum(r.doc_id is None for r in kept) == 1
    # every kept pair of different ids lies apart; every dropped row has a kept one in its component
    components = brute_components([(n, p) for n, (_, p) in enumerate(prints)], 2)
    where = {p: c for (_, p), c in zip(prints, components)}
    assert len({where[p] for p in fps}) == len(fps)
    assert {where[p] for p in fps} >= {c for (i, _), c in zip(rows, components) if rows[c][0] is not None and i != 0}


def test_keep_one_tells_rows_of_a_repeated_id_apart(spark):
    # ids repeat with different texts, within a component and across components
    texts = [t for _, t in planted(random.Random(6))]
    rng = random.Random(7)
    rows = [(rng.choice([None, *range(12)]), t) for t in texts] + [(100 + i, t) for i, t in enumerate(texts) if i % 3 == 0]
    rows += [(200, "one survivor id"), (200, "of two components"), (-1, "zz own component"), (-1, texts[0])]
    df = docs_frame(spark, rows, extra=True)
    components = brute_components([(n, brute_print(t)) for n, (_, t) in enumerate(rows)], 2)
    best = {}
    for c, (i, t) in zip(components, rows):
        key = (i is None, i or 0, t is not None, t or "")
        best[c] = min(best.get(c, (key, i, t)), (key, i, t), key=lambda x: x[0])
    got = keep_one(df)
    assert got.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(((i, t) for _, i, t in best.values()), key=str)


def test_empty_table(spark):
    df = docs_frame(spark, [])
    assert near_duplicates(df).count() == 0
    assert keep_one(df).count() == 0
    with pytest.raises(ValueError):
        near_duplicates(df, max_distance=3)
