import random
import re
from collections import Counter

import numpy as np

from meterline.llm.decontaminate import HammingIndex, contaminated, keep_clean

from .helpers import EDGE_TEXTS, docs_frame, prose


def fold(text):
    return re.sub(r"[\x00-\x7f]", lambda m: m[0].lower() if m[0].isalnum() else " ", text or "").split(" ")


def bag(words):
    k = min(5, len(words))
    return Counter(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def brute(docs, items):
    """Best (similarity, earliest) window of every document and item over all windows."""
    out = {}
    for doc, text in docs:
        words = [w for w in fold(text) if w]
        for item, other in items:
            theirs = [w for w in fold(other) if w]
            n = len(theirs)
            for at in range(len(words) - n + 1 if n else 0):
                k = min(5, n)
                mine = words[at : at + n]
                a = Counter(tuple(mine[i : i + k]) for i in range(n - k + 1))
                b = bag(theirs)
                both = sum((a & b).values())
                s = both / (a.total() + b.total() - both)
                if s >= 0.8 and (s, -at) > out.get((doc, item), (0, 0)):
                    out[doc, item] = (s, -at)
    return sorted(((d, i, round(s, 9), -at) for (d, i), (s, at) in out.items()), key=str)


def planted(rng):
    items = [(i, prose(rng, rng.choice([3, 12, 30, 55]))) for i in range(25)] + [(25, ""), (26, "..."), (27, None)]
    items.append((28, items[0][1]))
    docs = list(enumerate(EDGE_TEXTS))
    for d in range(60):
        words = prose(rng, rng.randrange(30, 200)).split()
        if rng.random() < 0.6:
            item = rng.choice(items[:25])[1].split()
            for _ in range(rng.choice([0, 0, 1, 2, 8])):
                item[rng.randrange(len(item))] = prose(rng, 1)
            at = rng.randrange(len(words))
            words[at:at] = [w + rng.choice(["", ",", "."]) for w in item]
        docs.append((100 + d, " ".join(words).upper() if rng.random() < 0.2 else " ".join(words)))
    return docs, items


def test_against_all_windows(spark):
    docs, items = planted(random.Random(1))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for block in (1 << 22, 700):
        got = contaminated(docs_frame(spark, docs, extra=True), bench, block_bytes=block).collect()
        assert sorted(((r.doc_id, r.item_id, round(r.similarity, 9), r.first_word) for r in got), key=str) == brute(docs, items)
    assert len({r.doc_id for r in got}) > 15


def test_filter_drops_only_contaminated_documents(spark):
    docs, items = planted(random.Random(2))
    docs += [(None, items[3][1] + " and more"), (None, "clean without an id"), (None, None)]
    df = docs_frame(spark, docs, extra=True)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    out = keep_clean(df, bench)
    assert out.columns == df.columns
    bad = {d for d, *_ in brute([(n, t) for n, (_, t) in enumerate(docs)], items)}
    want = [docs[n] for n in range(len(docs)) if n not in bad]
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(want, key=str)
    assert keep_clean(df.limit(0), bench).count() == 0
    assert keep_clean(df, bench.limit(0)).count() == len(docs)


def test_items_without_an_id_are_searched_too(spark):
    docs, items = planted(random.Random(4))
    items = [(None if i is not None and i % 3 == 0 else i, t) for i, t in items]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = {}
    for n, (i, t) in enumerate(items):
        for d, _, s, at in brute(docs, [(n, t)]):
            best = want.get((d, i), (0, 0, 0))
            want[d, i] = max(best, (s, -at, -len([w for w in fold(t) if w])))
    for block in (1 << 22, 700):
        got = contaminated(docs_frame(spark, docs), bench, block_bytes=block).collect()
        assert {(r.doc_id, r.item_id): (round(r.similarity, 9), -r.first_word, -r.n_words) for r in got} == want
        assert len(got) == len(want)
    assert any(i is None for _, i in want)
    bad = {d for d, _ in want}
    assert sorted(r.doc_id for r in keep_clean(docs_frame(spark, docs), bench).collect()) == sorted(d for d, _ in docs if d not in bad)


def test_rows_that_share_an_id_are_judged_one_by_one(spark):
    docs, items = planted(random.Random(5))
    rows = [(None if d % 7 == 0 else d % 5, t) for d, t in docs] + [docs[-1], docs[-1]]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    bad = {d for d, *_ in brute([(n, t) for n, (_, t) in enumerate(rows)], items)}
    want = [r for n, r in enumerate(rows) if n not in bad]
    got = keep_clean(docs_frame(spark, rows, extra=True), bench).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(want, key=str)
    assert 5 < len(want) < len(rows)


def test_index_returns_all_within_the_radius():
    rng = np.random.default_rng(3)
    prints = [int(x) for x in rng.integers(0, 2**63, 300)]
    for radius in (3, 16, 24):
        index = HammingIndex(prints, radius)
        for _ in range(30):
            value = prints[int(rng.integers(300))] ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 30)), replace=False))
            assert index.within(value) == {i for i, p in enumerate(prints) if (p ^ value).bit_count() <= radius}


def test_item_ids_of_any_type(spark):
    docs, items = planted(random.Random(5))
    df = docs_frame(spark, docs)
    want = brute(docs, items)
    named = spark.createDataFrame([(f"item {i}", t) for i, t in items], "item_id string, text string")
    got = contaminated(df, named)
    assert got.schema["item_id"].dataType.simpleString() == "string"
    assert sorted(((r.doc_id, int(r.item_id[5:]), round(r.similarity, 9), r.first_word) for r in got.collect()), key=str) == want
    for kind in ("int", "date"):
        cast = "date_add(date'2000-01-01', CAST(item_id AS int))" if kind == "date" else "CAST(item_id AS int)"
        got = contaminated(df, spark.createDataFrame(items, "item_id bigint, text string").selectExpr(f"{cast} AS item_id", "text"))
        assert got.schema["item_id"].dataType.simpleString() == kind
        assert got.count() == len(want)
    assert contaminated(df, named.limit(0)).schema["item_id"].dataType.simpleString() == "string"
