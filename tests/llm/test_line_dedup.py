import hashlib
import random

from meterline.llm.line_dedup import CHUNKINGS, line_dedup

from .helpers import EDGE_TEXTS, docs_frame, prose


def chunks_of(lines):
    """Different (first line from 0, n) of all chunkings."""
    h, out = [hashlib.md5(line.encode()).hexdigest() for line in lines], set()
    for k in range(CHUNKINGS):
        own = [int(x[7 * k : 7 * k + 7], 16) for x in h]
        starts = [i for i in range(len(own)) if i == 0 or i + 1 < len(own) and own[i] < own[i + 1]]
        out |= {(a, b - a) for a, b in zip(starts, [*starts[1:], len(own)])}
    return out


def brute(rows):
    spots = {}
    key = lambda i, t: (i is not None, i or 0, hashlib.md5(t.encode()).hexdigest())
    for i, t in rows:
        lines = [] if t is None else t.split("\n")
        for first, n in chunks_of(lines):
            part = lines[first : first + n]
            if sum(bool(line.strip(" ")) for line in part) >= 2:
                spots.setdefault("\n".join(part), set()).add((*key(i, t), first, n))
    earliest = {chunk: min(found) for chunk, found in spots.items()}
    out = []
    for i, t in rows:
        if t is None:
            out.append((i, None, 0, 0, 0, 0))
            continue
        lines = t.split("\n")
        chunks = chunks_of(lines)
        gone = [(f, n) for f, n in chunks if earliest.get("\n".join(lines[f : f + n]), (*key(i, t), f, n)) != (*key(i, t), f, n)]
        less = {x for f, n in gone for x in range(f, f + n)}
        out.append((i, "\n".join(line for x, line in enumerate(lines) if x not in less), len(lines), len(chunks), len(gone), len(less)))
    return sorted(out, key=str)


def planted(rng):
    shared = "\n".join(prose(rng, 8) for _ in range(30))
    texts = [*EDGE_TEXTS, shared, "a new first line\n" + shared, "\n" * 9]
    for _ in range(30):
        own = [prose(rng, 6) for _ in range(rng.randrange(1, 20))]
        if rng.random() < 0.5:
            at = rng.randrange(len(own) + 1)
            own[at:at] = shared.split("\n")[rng.randrange(5) :]
        texts.append("\n".join(own))
    texts += [texts[-1], texts[-1] + "\n" + texts[-1]]
    return list(enumerate(texts))


def test_against_brute_force(spark):
    rng = random.Random(1)
    rows = planted(rng)
    rows += [(None, rows[10][1]), (None, None), (12, rows[12][1]), (12, rows[12][1]), (12, rows[11][1])]
    got = line_dedup(docs_frame(spark, rows, extra=True), report=True).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
    assert sum(r.removed_chunks for r in got) > 50


def test_insertions_move_only_nearby_boundaries(spark):
    rng = random.Random(2)
    body = [prose(rng, 7) for _ in range(60)]
    got = {r.doc_id: r for r in line_dedup(docs_frame(spark, [(1, "\n".join(body)), (2, "\n".join(["inserted", *body]))]), report=True).collect()}
    assert got[1].removed_chunks == 0
    assert got[2].removed_lines >= 40


def test_rows_columns_and_clean_texts_stay(spark):
    rng = random.Random(3)
    rows = [(i, "\n".join(prose(rng, 9) for _ in range(12))) for i in range(20)] + [(None, None), (30, "")]
    df = docs_frame(spark, rows, extra=True)
    out = line_dedup(df)
    assert out.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(rows, key=str)
    assert line_dedup(df.limit(0)).count() == 0


def test_short_passages_in_unrelated_documents(spark):
    """Share of documents that lose some of a passage an earlier one holds, and of its lines, by the passage's lines (over 50 words each)."""
    rng, rows, where = random.Random(4), [], {}
    for n in (2, 3, 4, 6, 8, 10):
        for _ in range(150):
            passage = [prose(rng, 56 // n + 1) for _ in range(n)]
            for copy in range(2):
                own = [[prose(rng, 9) for _ in range(rng.randrange(1, 7))] for _ in range(2)]
                where[len(rows)] = (n, copy, passage)
                rows.append((len(rows), "\n".join([*own[0], *passage, *own[1]])))
    got = {r.doc_id: r for r in line_dedup(docs_frame(spark, rows), report=True).collect()}
    found, lines = {}, {}
    for i, (n, copy, passage) in where.items():
        left = set(got[i].text.split("\n"))
        gone = sum(p not in left for p in passage)
        assert got[i].removed_lines == gone and (copy or not gone)  # nothing but a second copy's passage goes
        if copy:
            found.setdefault(n, []).append(gone > 0)
            lines.setdefault(n, []).append(gone / n)
    found, lines = ({n: sum(v) / len(v) for n, v in d.items()} for d in (found, lines))
    print(found, lines)
    assert all(found[n] >= 0.9 for n in (4, 6, 8, 10))
    assert lines[4] < lines[6] < lines[10] and lines[10] >= 0.7
