import hashlib
import random
import re

from meterline.llm.substring import remove_passages, repeated_passages

from .helpers import EDGE_TEXTS, docs_frame, prose

WORD = re.compile("[^\x20\x09-\x0d]+")


def ranked(rows):
    return sorted({(i, t) for i, t in rows if t is not None}, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(r[1].encode()).hexdigest()))


def brute(rows, min_words=50, seed_words=4):
    """Units, first occurrences and word by word extension, one document at a time."""
    docs, seen, first, texts, out = ranked(rows), {}, {}, {}, []
    for at, (i, t) in enumerate(docs):
        spots = [m.span() for m in WORD.finditer(t)]
        words = [w.decode() for w in t.encode().lower().split()]
        words = [w + "\n" if k + 1 < len(words) and "\n" in t[spots[k][1] : spots[k + 1][0]] else w for k, w in enumerate(words)]
        texts[at] = words
        if t in seen:
            if len(words) >= min_words:
                out.append((i, spots[0][0], spots[-1][1] - spots[0][0], len(words), docs[seen[t]][0]))
            continue
        seen[t] = at
        ends = [k + 1 for k, w in enumerate(words) if w[-1] in ".!?,;:\n"]
        covered = {}
        for start in [0, *ends]:
            end = next((e for e in ends if e >= start + seed_words), None)
            if end is None:
                break
            unit = tuple(words[start:end])
            if unit not in first:
                first[unit] = (at, start)
                continue
            f, there = first[unit]
            low = high = 0
            while start - low > 0 and there - low > 0 and words[start - low - 1] == texts[f][there - low - 1]:
                low += 1
            while start + high < len(words) and there + high < len(texts[f]) and words[start + high] == texts[f][there + high]:
                high += 1
            if low + high >= min_words:
                for k in range(start - low, start + high):
                    covered.setdefault(k, set()).add(f)
        run = []
        for k in [*sorted(covered), None]:
            if run and (k is None or k != run[-1] + 1):
                ids = [docs[f][0] for x in run for f in covered[x] if docs[f][0] is not None]
                out.append((i, spots[run[0]][0], spots[run[-1]][1] - spots[run[0]][0], len(run), min(ids, default=None)))
                run = []
            run.append(k)
    return sorted(out, key=str)


def marked(rng, n):
    """Prose with clause marks and line breaks here and there."""
    return "".join(w + rng.choice([" "] * 8 + [", ", ". ", "\n", ",\n"]) for w in prose(rng, n).split(" ")).rstrip()


def planted(rng):
    passages = [marked(rng, 60), marked(rng, 120), prose(rng, 80), "stock line", marked(rng, 30)]
    texts = [*EDGE_TEXTS]
    for _ in range(50):
        parts = [marked(rng, rng.randrange(1, 40)) for _ in range(rng.randrange(1, 5))]
        for p in passages:
            if rng.random() < 0.4:
                words = p.split(" ")
                cut = " ".join(words[rng.randrange(8) : len(words) - rng.randrange(8)])
                parts.insert(rng.randrange(len(parts) + 1), rng.choice([p, cut, p.upper(), p.replace(" ", "  "), "\n".join(p.split())]))
        texts.append(rng.choice([" ", "\n"]).join(parts))
    texts += [texts[30], texts[30].replace(" ", " edited ", 1), "the the " * 60, "over and over again, " * 40]
    return [*enumerate(texts), (3, texts[20]), (None, texts[21]), (None, None), (25, texts[25]), (25, texts[25])]


def test_against_brute_force(spark):
    for seed, limits in ((1, {}), (2, {"min_words": 20, "seed_words": 3})):
        rows = planted(random.Random(seed))
        got = repeated_passages(docs_frame(spark, rows, extra=True), **limits).drop("text_key")
        assert got.columns == ["doc_id", "start", "length", "n_words", "first_doc_id"]
        want = brute(rows, **limits)
        assert sorted(map(tuple, got.collect()), key=str) == want
        assert len(want) > 30


def test_passages_inside_lines_have_exact_bounds(spark):
    rng = random.Random(5)
    passage = " ".join(marked(rng, 90).split())
    edited = passage.split(" ")
    edited[60] = "changed"
    before, after = "own words that end here without a mark ", " and own words go on"
    rows = [(1, f"{prose(rng, 30)} {passage} {prose(rng, 30)}"), (2, before + passage + after), (3, before.title() + " ".join(edited) + after), (4, prose(rng, 200))]
    got = {r.doc_id: r for r in repeated_passages(docs_frame(spark, rows)).collect()}
    assert set(got) == {2, 3}
    # What doc 2 and 3 say before the passage is under 50 words by itself but joined to it.
    assert (got[2].start, got[2].length, got[2].n_words) == (len(before), len(passage), 90)
    assert got[3].n_words >= 60 and rows[2][1][got[3].start : got[3].start + got[3].length].lower().endswith(edited[59])


def test_copies_in_a_crowd(spark):
    rng = random.Random(6)
    text, passage = marked(rng, 150), marked(rng, 70)
    rows = [(i, text) for i in range(300)] + [(400 + i, f"{prose(rng, 20)} {passage} {prose(rng, 20)}") for i in range(200)]
    got = repeated_passages(docs_frame(spark, rows)).collect()
    assert sorted(r.doc_id for r in got) == [*range(1, 300), *range(401, 600)]
    # By chance the word beside a passage may be alike as well.
    assert {(r.n_words, r.first_doc_id) for r in got} <= {(150, 0), (70, 400), (71, 400), (72, 400)}


def strip(text, spans):
    if text is None:
        return None
    for start, length in sorted(spans, reverse=True):
        text = text[:start] + text[start + length + 1 :]
    return text


def test_removal_keeps_rows_and_offsets(spark):
    rows = [(k, t) for k, (_, t) in enumerate(planted(random.Random(3)))]
    df = docs_frame(spark, rows, extra=True)
    out = remove_passages(df)
    assert out.columns == [*df.columns, "removed_spans"]
    spans = {}
    for doc, start, length, *_ in brute(rows):
        spans.setdefault(doc, set()).add((start, length))
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert {(s.start, s.length) for s in r.removed_spans} == spans.get(r.doc_id, set())
        assert r.text == strip(dict(rows)[r.doc_id], spans.get(r.doc_id, set()))


def test_clean_and_empty(spark):
    rng = random.Random(4)
    clean = [(i, "\n".join([prose(rng, 40), "a stock line, known to many texts.", prose(rng, 10)])) for i in range(10)]
    assert repeated_passages(docs_frame(spark, clean)).count() == 0
    assert repeated_passages(docs_frame(spark, [])).count() == 0
    assert remove_passages(docs_frame(spark, [])).count() == 0
