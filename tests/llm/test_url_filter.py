import re

import duckdb
import pytest

from meterline.llm.catalog import URL_RULES
from meterline.llm.url_filter import BLOCK_PERCENT, FLOW_PERCENT, LINK, RESIDUAL, SCALE, Rule, judge_urls, oracle_sql

RULES = [Rule("allow", "good.org", "/"), Rule("block", "bad.org", "/"), *URL_RULES]

PAGES = [
    (1, "http://good.org/", '<a href="http://friend.io/x">'),
    (2, "https://FRIEND.io/p?q#f", "<a href='//Pal.io'> <a href=http://friend.io/self>"),
    (3, "http://shady.io", '<a href="https://bad.org/a"> <a href="https://bad.org/b">'),
    (4, "http://shadier.io/", '<a href="http://shady.io/">'),
    (5, "http://bad.org/z", None),
    (6, None, '<a href="http://bad.org/">'),
    (7, "no scheme", ""),
    (8, "", "<html>"),
    (9, "http://www.example.com/en/1", ""),
    (10, "http://m.example.com/en/1", ""),
    (11, "http://x.net/es/", ""),
    (12, "http://x.net/de/", ""),
    (13, "http://y.net/fr/2?a=b", ""),
    (14, "http://example.com", ""),
    (15, "ftp://com/", ""),
    (16, "http://notcom/", ""),
    (17, "http:///en/", ""),
    (17, "http:///en/", ""),
    (None, "http://pal.io/a://b", ""),
]


def brute(pages, rules):
    def parts(url):
        if url is None or "://" not in url:
            return "", ""
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        return "".join(c.lower() if c.isascii() else c for c in host), re.match(r"[^?#]*", rest[len(host) :])[0]

    def rule(host, path):
        fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        return min(fit, key=lambda r: (-len(r.text), r.text, r.path, r.verdict), default=None)

    named = [(i, *parts(u), h or "") for i, u, h in pages]
    edges = {(host, dst.lower()) for _, host, _, html in named if host for dst in re.findall(LINK, html) if dst.lower() != host}
    hosts = {h for _, h, _, _ in named} | {x for e in edges for x in e}
    seeds = {"trust": {}, "distrust": {}}
    for h in hosts:
        own = [rule(h, p) for _, host, p, _ in named if host == h]
        for kind, verdict in (("trust", "allow"), ("distrust", "block")):
            seeds[kind][h] = SCALE * sum(r is not None and r.verdict == verdict for r in own) // len(own) if own else 0
    scores, keep = {}, 100 - FLOW_PERCENT
    for kind, seed in seeds.items():
        links = edges if kind == "trust" else {(b, a) for a, b in edges}
        passes = lambda h: kind == "trust" or seeds["trust"][h] <= seeds["distrust"][h]  # noqa: B023, E731
        into, degree = {h: [] for h in hosts}, dict.fromkeys(hosts, 0)
        for a, b in links:
            into[b].append(a)
            degree[a] += 1
        s, brings = {h: v * keep // 100 for h, v in seed.items()}, lambda s, h: sum(s[a] // degree[a] for a in into[h] if passes(a))  # noqa: B023
        for _ in range(200):  # far beyond the residual
            s = {h: (seed[h] * keep + FLOW_PERCENT * brings(s, h)) // 100 for h in hosts}
        scores[kind] = s
    # ``links``, ``degree`` and ``brings`` are distrust's now.
    could = {h: sum(SCALE * keep // 100 // degree[a] for a in into[h]) for h in hosts}
    by_links = {h: could[h] > 0 and 100 * brings(scores["distrust"], h) >= BLOCK_PERCENT * could[h] for h in hosts}
    bad = {h: scores["distrust"][h] > scores["trust"][h] and (100 * seeds["distrust"][h] >= BLOCK_PERCENT * SCALE or by_links[h]) for h in hosts}
    out = []
    for i, h, p, _ in named:
        r, t, d = rule(h, p), scores["trust"][h], scores["distrust"][h]
        out.append((i, h, p, r.text if r else None, r.verdict if r else "block" if bad[h] else "allow", t, d))
    return sorted(out, key=str)


@pytest.mark.parametrize("rules", [RULES, URL_RULES])
def test_against_brute_force(spark, rules):
    df = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").selectExpr("*", "'x' AS host", "'y' AS path", "'z' AS rule", "1 AS rules")
    got = sorted(map(tuple, judge_urls(df, rules, residual=0).collect()), key=str)
    assert got == brute(PAGES, rules)
    # The residual bounds what is left out, and no verdict hangs on it here.
    near = sorted(map(tuple, judge_urls(df, rules).collect()), key=str)
    assert [r[:5] for r in near] == [r[:5] for r in got]
    for k in (5, 6):
        assert all(0 <= a[k] - b[k] <= RESIDUAL for a, b in zip(got, near))


def test_distrust_reaches_those_who_link_to_blocked_hosts(spark):
    df = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    got = {r.page_id: r for r in judge_urls(df, RULES).collect()}
    assert got[3].verdict == "block" and got[3].rule is None
    assert got[2].verdict == "allow" and got[2].trust > 0
    assert judge_urls(df.limit(0), RULES).count() == 0


def farm(n):
    """n hosts that link to a blocked host only, one of which a trusted host links to; with few of them also a ring, whose scores settle slowly."""
    pages = [(0, "http://bad.org/", "")]
    pages += [(i, f"http://farm{i}.io/", '<a href="http://bad.org/x">') for i in range(1, n + 1)]
    pages += [(10_001, "http://good.org/", '<a href="http://farm1.io/"><a href="http://ring1.io/">')]
    pages += [(10_002, "http://ring1.io/", '<a href="http://ring2.io/">'), (10_003, "http://ring2.io/", '<a href="http://ring1.io/">' if n < 10 else "")]
    # One blocked host among five links of the same rank.
    pages += [(10_004, "http://wide.io/", "".join(f'<a href="http://w{k}.io/">' for k in range(4)) + f'<a href="http://lone{n}.bad.org/">')]
    return [*pages, (10_005, f"http://lone{n}.bad.org/", "")]


@pytest.mark.parametrize("n", [2, 10, 1000])
def test_linkers_of_a_blocked_host_are_blocked_however_many_they_are(spark, n):
    pages = farm(n)
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    got = {r.page_id: r for r in judge_urls(df, RULES).collect()}
    assert all(got[i].verdict == "block" and got[i].rule is None for i in range(2, n + 1))
    assert got[1].verdict == ("allow" if got[1].trust >= got[1].distrust else "block")
    assert got[1].trust > 0 and got[10_002].trust > got[10_003].trust > 0
    assert got[10_002].verdict == got[10_003].verdict == "allow"
    assert got[10_004].distrust > got[10_004].trust and got[10_004].verdict == "allow"
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", pages)
    assert sorted(con.execute(oracle_sql(RULES)).fetchall()) == sorted(map(tuple, got.values()))


def test_a_hot_trusted_host_does_not_shield_linkers_of_blocked_hosts(spark):
    # good.org links to 500 hosts; half of these link to bad.org too, and their share of trust is as small as that of distrust.
    pages = [(0, "http://good.org/", "".join(f'<a href="http://h{i}.io/">' for i in range(500))), (-1, "http://bad.org/", "")]
    pages += [(i + 1, f"http://h{i}.io/", '<a href="http://bad.org/">' if i < 250 else "") for i in range(500)]
    pages += [(1000 + i, f"http://x{i}.io/", '<a href="http://good.org/">') for i in range(300)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    got = {r.page_id: r for r in judge_urls(df, RULES).collect()}
    assert all(got[i].verdict == "block" for i in range(1, 251))
    assert all(got[i].verdict == "allow" for i in [*range(251, 501), *range(1000, 1300)])
    assert sorted(map(tuple, judge_urls(df, RULES, residual=0).collect()), key=str) == brute(pages, RULES)
