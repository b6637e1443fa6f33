import random
from collections import Counter

import zstandard

from meterline.llm.quality import PROSE, WIDE, BandRules, bands_of, fit_bands, keep_good, quality_report

from .helpers import EDGE_TEXTS, docs_frame, prose


def brute(text, bands=PROSE):
    import re

    def inside(part):
        low, high = next((b.low, b.high) for b in bands if len(part) < b.below)
        return low <= (len(part) / len(c.compress(part)) if part else 0.0) <= high

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    c, raw = zstandard.ZstdCompressor(level=3), text.encode()
    chunks = [x for x in (raw[i : i + 4096] for i in range(0, len(raw), 4096)) if len(x) >= 2048]
    kept = not failed and inside(raw) and sum(not inside(x) for x in chunks) <= 0.3 * len(chunks)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed, kept)


def test_against_brute_force(spark):
    rng = random.Random(5)
    texts = [*EDGE_TEXTS, prose(rng, 400), prose(rng, 3000), "go on and on " * 300, prose(rng, 60) + " " + "ab " * 30, "".join(chr(rng.randrange(0x4E00, 0x9FA5)) + " " for _ in range(4000)), "a\x0bb\x0cc d e " * 20]
    rows = list(enumerate(texts)) + [(None, prose(rng, 80)), (0, None), (3, texts[3])]
    for bands in (PROSE, WIDE):
        got = quality_report(docs_frame(spark, rows), rules=BandRules(bands=bands)).collect()
        assert len(got) == len(rows)
        want = Counter((i, *brute(t, bands)) for i, t in rows)
        assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in got) == want


def test_bands_reject_repetition_and_noise(spark):
    rng = random.Random(6)
    clean = prose(rng, 900)
    noise = " ".join("".join(chr(rng.randrange(0x3400, 0x9FA5)) for _ in range(8)) for _ in range(1500))
    half = prose(rng, 700) + " " + " ".join(f"w{i % 7}x{i % 11}" for i in range(3000))
    got = {r.doc_id: r for r in quality_report(docs_frame(spark, [(1, clean), (2, half), (3, noise)]), rules=BandRules(bands=WIDE)).collect()}
    assert got[1].kept
    assert not got[2].kept
    assert got[3].zstd_ratio < 1.6


def test_filter_keeps_columns_rows_and_clashing_names(spark):
    rng = random.Random(7)
    good = [(i, prose(rng, 200)) for i in range(5)]
    df = docs_frame(spark, good + [(9, "short"), (None, prose(rng, 90)), (10, None)], extra=True)
    rules = BandRules(bands=WIDE)
    out = keep_good(df, rules=rules)
    assert out.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in out.collect()) == [(False, i) for i in range(5)] + [(True, None)]
    assert keep_good(df.limit(0)).count() == 0


def own_bands(rng):
    """Limits fitted on prose of these tests: 60 to 1,500 words."""
    c = zstandard.ZstdCompressor(level=3)
    texts = [prose(rng, round(60 * 25 ** (k / 599))).encode() for k in range(600)]
    return bands_of([(len(t), len(t) / len(c.compress(t))) for t in texts], 4.5, 0.02, 20)


def test_bands_reject_what_passes_the_base_rules(spark):
    # Texts of 2,400 to 5,800 bytes: templates and random words leave the wide bands, tables the fitted ones.
    # Random marks strewn into prose (1001) compress like longer prose: no ratio tells them apart, and they stay.
    rng = random.Random(8)
    own = [prose(rng, rng.randrange(420, 660)) for _ in range(330)]
    junk = {
        1001: " ".join(w + rng.choice(["###", "$$$", "&&&", "***"]) for w in prose(rng, 440).split()),
        1002: " | ".join(prose(rng, 400).split()),
        1003: " ".join(f"amount total {i}" for i in range(200)),
        1004: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(8)) for _ in range(400)),
    }
    rules = BandRules(bands=fit_bands(docs_frame(spark, list(enumerate(own))), spreads=4.0, least_spread=0.05))
    got = {r.doc_id: r for r in quality_report(docs_frame(spark, [*enumerate(own), *junk.items()]), rules=rules).collect()}
    assert not any(r.base_failed for r in got.values())
    assert all(got[i].kept for i in range(len(own)))
    assert {i for i in junk if got[i].kept} == {1001}
    wide = {r.doc_id: r.kept for r in quality_report(docs_frame(spark, list(junk.items())), rules=BandRules(bands=WIDE)).collect()}
    assert wide == {1001: True, 1002: True, 1003: False, 1004: False}
    alone = quality_report(docs_frame(spark, list(junk.items())), rules=rules).collect()
    assert {r.doc_id for r in alone if r.kept} == {1001}


def test_chunks_have_the_limits_of_their_own_length(spark):
    # Half prose, half templates: the whole text's ratio is inside wide limits for its length, a third of its chunks is not.
    rng = random.Random(10)
    bands = tuple(b for b in own_bands(rng) if b.below <= 8192) + tuple(b for b in WIDE if b.below > 8192)
    mixed = prose(rng, 3000) + " " + " ".join(f"amount total {i * 7}" for i in range(1500))
    rows = [(1, mixed), (2, prose(rng, 4500))]
    got = {r.doc_id: r for r in quality_report(docs_frame(spark, rows), rules=BandRules(bands=bands)).collect()}
    assert WIDE[-1].low <= got[1].zstd_ratio <= WIDE[-1].high and not got[1].base_failed
    assert not got[1].kept and got[1].n_bad_chunks > 0.3 * got[1].n_chunks
    assert got[2].kept and got[2].n_bad_chunks == 0


def test_verdict_does_not_depend_on_the_other_rows(spark):
    rng = random.Random(9)
    rows = [(i, prose(rng, rng.randrange(30, 900))) for i in range(120)] + [(200 + i, " | ".join(prose(rng, 90 + 7 * i).split())) for i in range(60)]
    rules = BandRules(bands=own_bands(rng))
    judge = lambda part: {(r.doc_id, r.kept) for r in quality_report(docs_frame(spark, part), rules=rules).collect()}
    whole = judge(rows)
    assert {k for _, k in whole} == {True, False}
    assert set().union(*(judge(rows[s::10]) for s in range(10))) == whole
    copies = [(1000 + i, rows[0][1]) for i in range(400)]
    assert {v for v in judge(rows + copies) if v[0] < 1000} == whole


def test_fitted_limits_are_the_same_in_any_partitioning(spark):
    rng = random.Random(11)
    rows = [(i, prose(rng, rng.randrange(60, 700))) for i in range(150)] + [(None, None), (0, ""), (1, "short")]
    df = docs_frame(spark, rows, extra=True)
    whole = fit_bands(df)
    assert whole == fit_bands(df.repartition(7)) and whole != WIDE
    assert [b.below for b in whole] == sorted(b.below for b in whole) and whole[-1].below == float("inf")
    assert len({b.below for b in whole}) == len(whole)
    bounded = fit_bands(df, max_rows=60)
    assert bounded == fit_bands(df.repartition(3), max_rows=60) and bounded != whole
    assert fit_bands(df.limit(0)) == WIDE


def test_an_id_column_named_like_a_metric(spark):
    df = docs_frame(spark, [(1, "a b c")]).withColumnRenamed("doc_id", "kept")
    got = quality_report(df, id_col="kept")
    assert got.columns.count("kept") == 1 and got.first().doc_id == 1
