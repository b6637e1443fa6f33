"""URL filters: longest matching rule, else link-graph propagation per host.

Trust flows from hosts with allowed pages along links (personalised PageRank),
distrust from hosts with blocked pages against them: whoever links to a bad
host becomes suspect. Scores are integers (``SCALE`` is a host whose pages are
all seeds), so sums do not depend on their order and a run can be repeated
exactly. Everything here is DataFrame and SQL functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.common import Stored, column

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SCALE = 1_000_000_000
# Share of a score that flows on, in percent.
FLOW_PERCENT = 85
# Rounds of flow end once what all further rounds could still add to all hosts
# together is at most this: a millionth of one fully seeded host's score.
RESIDUAL = SCALE // 1_000_000
# A host without a rule for a page is blocked if its distrust exceeds its trust
# and its own pages, or its links, bring this percentage of what they could.
BLOCK_PERCENT = 50

LINK = r"""(?i)href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path); both empty for a null or a url without ``://``."""
    at = F.locate("://", url)
    rest = F.substring(url, at + 3, F.length(url))
    known = url.isNotNull() & (at > 0)
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.when(known, host).otherwise(""), F.when(known, path).otherwise("")


def rules_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    rows = [(r.verdict, r.host, r.path, r.text) for r in rules]
    return spark.createDataFrame(rows, "verdict string, rule_host string, rule_path string, rule string")


def host_suffixes(host: Column) -> Column:
    """The host itself and every domain above it."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def rules_by_host(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``hosts`` (host) with ``rules``: those of the host or a domain above it, longest first."""
    named = hosts.select("host", F.explode(host_suffixes(F.col("host"))).alias("rule_host"))
    entry = F.struct((-F.length("rule")).alias("order"), "rule", "rule_path", "verdict")
    fitting = named.join(rules, "rule_host").groupBy("host").agg(F.array_sort(F.collect_set(entry)).alias("rules"))
    return hosts.join(fitting, "host", "left")


def best_rule(rules: Column, path: Column) -> Column:
    """The first (longest) rule whose path starts the url's path; null if there is none."""
    return F.get(F.filter(rules, lambda r: F.startswith(path, r["rule_path"])), F.lit(0))


def host_edges(pages: DataFrame, html_col: str) -> DataFrame:
    """Distinct (src, dst) between different hosts; ``pages`` has ``host``."""
    found = F.explode(F.array_distinct(F.regexp_extract_all(column(html_col), F.lit(LINK), F.lit(1))))
    linked = pages.filter("host <> ''").select(F.col("host").alias("src"), found.alias("dst"))
    return linked.withColumn("dst", F.translate("dst", UPPER, LOWER)).filter("src <> dst").distinct()


def propagate(hosts: DataFrame, edges: DataFrame, flow_percent: int = FLOW_PERCENT, residual: int = RESIDUAL) -> DataFrame:
    """(host, trust, distrust, linked, linkable) after the flow over ``edges``; ``hosts`` has host, trust_seed, distrust_seed.

    Each round adds to a host's own share what its neighbours pass on, divided
    by their number of links; a host without links passes nothing, and one
    seeded with more trust than distrust passes no distrust to its linkers.
    Scores only grow, and what a round adds in all shrinks by the flow, so that all later
    rounds add at most flow / (1 - flow) times as much: rounds end when that is
    ``residual`` or less (0: when no score changes). ``linked`` is the distrust
    that a host's links pass to it, ``linkable`` what they would pass if each
    linked host had a fully seeded host's own share. It is the host's own
    measure: both are divided by the same in-degrees.
    """
    out_degree = edges.groupBy("src").agg(F.count("*").alias("n_out"))
    in_degree = edges.groupBy("dst").agg(F.count("*").alias("n_in"))
    graph = Stored(edges.join(out_degree, "src").join(in_degree, "dst"), "host-graph").df
    flows = graph.select(F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), F.col("n_out").alias("n"))
    flows = flows.unionByName(graph.select(F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), F.col("n_in").alias("n")))
    trust = F.struct(F.lit("trust").alias("kind"), F.col("trust_seed").alias("seed"), F.lit(True).alias("passes"))
    distrust = F.struct(F.lit("distrust").alias("kind"), F.col("distrust_seed").alias("seed"), (F.col("trust_seed") <= F.col("distrust_seed")).alias("passes"))
    scored = hosts.select("host", F.explode(F.array(trust, distrust)).alias("x")).select("host", "x.*")
    keep = 100 - flow_percent
    start = F.expr(f"seed * {keep} div 100")
    share = F.expr("if(passes, score div n, 0)")
    scores = Stored(scored.select("host", "kind", "seed", "passes", start.alias("score"), start.alias("moved")), "host-scores")
    while (scores.df.agg(F.sum("moved")).first()[0] or 0) * flow_percent > residual * keep:
        passed = flows.join(scores.df, ["kind", "host"]).groupBy("kind", F.col("to").alias("host")).agg(F.sum(share).alias("passed"))
        new = scores.df.join(passed, ["kind", "host"], "left")
        total = F.expr(f"(seed * {keep} + coalesce(passed, 0) * {flow_percent}) div 100")
        after = Stored(new.select("host", "kind", "seed", "passes", total.alias("score"), (total - F.col("score")).alias("moved")), "host-scores")
        scores.release()
        scores = after
    full = SCALE * keep // 100
    reach = flows.filter("kind = 'distrust'").join(scores.df, ["kind", "host"]).groupBy(F.col("to").alias("host"))
    reach = reach.agg(F.sum(share).alias("linked"), F.sum(F.expr(f"{full} div n")).alias("linkable"))
    by_kind = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("score")))
    out = scores.df.groupBy("host").agg(by_kind("trust").alias("trust"), by_kind("distrust").alias("distrust"))
    none = F.lit(0).cast("long")
    return out.join(reach, "host", "left").select("host", "trust", "distrust", F.coalesce("linked", none).alias("linked"), F.coalesce("linkable", none).alias("linkable"))


def judge_urls(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", html_col: str = "html", flow_percent: int = FLOW_PERCENT, residual: int = RESIDUAL, block_percent: int = BLOCK_PERCENT) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, trust, distrust.

    Without a rule a page is blocked if its host's distrust exceeds its trust
    and either the blocked share of the host's pages or the distrust of its
    links reaches ``block_percent`` of the most it could be. The links' measure
    does not shrink with the number of others that link to a blocked host, and
    hosts that many link to count less in it than hosts few link to.

    A null url, or one without ``://``, has empty host and path, no rule and
    the verdict of a host without scores (allow). Null pages have no links;
    null ids and repeated rows are kept, and repeated rows count repeatedly in
    their host's seed share. No pages give no rows.
    """
    host, path = url_parts(column(url_col))
    named = pages.select(column(id_col).alias("page_id"), host.alias("host"), path.alias("path"), column(html_col).alias("html"))
    edges = Stored(host_edges(named, "html"), "host-edges").df
    linked = edges.select(F.col("src").alias("host")).unionByName(edges.select(F.col("dst").alias("host")))
    hosts = Stored(named.select("host").unionByName(linked).distinct(), "hosts").df
    with_rules = Stored(rules_by_host(hosts, rules_table(pages.sparkSession, rules)), "host-rules").df
    # Pages meet their hosts on the hosts' side of a join that may be split where one host has many pages.
    slim = named.drop("html")
    ruled = slim.join(with_rules, "host").withColumn("best", best_rule(F.col("rules"), F.col("path")))
    share = lambda verdict: F.sum(F.when(F.col("best.verdict") == verdict, 1).otherwise(0))
    seeds = ruled.groupBy("host").agg(F.count("*").alias("n"), share("allow").alias("good"), share("block").alias("bad"))
    seeded = hosts.join(seeds, "host", "left").select("host", F.coalesce(F.expr(f"good * {SCALE} div n"), F.lit(0)).alias("trust_seed"), F.coalesce(F.expr(f"bad * {SCALE} div n"), F.lit(0)).alias("distrust_seed"))
    seeded = Stored(seeded, "host-seeds").df
    scores = propagate(seeded, edges, flow_percent, residual).join(seeded.select("host", "distrust_seed"), "host")
    own, links = F.expr(f"100 * distrust_seed >= {block_percent} * {SCALE}L"), F.expr(f"linkable > 0 AND 100 * linked >= {block_percent} * linkable")
    by_score = F.when((F.col("distrust") > F.col("trust")) & (own | links), "block").otherwise("allow")
    scores = scores.select("host", "trust", "distrust", by_score.alias("by_score"))
    known = Stored(with_rules.join(scores, "host"), "host-verdicts").df
    judged = slim.join(known, "host").withColumn("best", best_rule(F.col("rules"), F.col("path")))
    return judged.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce(F.col("best.verdict"), F.col("by_score")).alias("verdict"), "trust", "distrust")


def oracle_sql(rules: list[Rule], flow_percent: int = FLOW_PERCENT, residual: int = RESIDUAL, block_percent: int = BLOCK_PERCENT) -> str:
    """DuckDB SQL of ``judge_urls`` over ``pages``, the rounds as a recursion."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({quote(r.verdict)}, {quote(r.host)}, {quote(r.path)}, {quote(r.text)})" for r in rules)
    keep = 100 - flow_percent
    return f"""
WITH RECURSIVE rules(verdict, rule_host, rule_path, rule) AS (VALUES {values}),
parts AS (
  SELECT page_id, html, instr(url, '://') AS pos, substr(url, instr(url, '://') + 3) AS rest FROM pages),
named AS MATERIALIZED (
  SELECT page_id, html,
    CASE WHEN pos > 0 THEN translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') ELSE '' END AS host,
    CASE WHEN pos > 0 THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM parts),
edges AS MATERIALIZED (
  SELECT DISTINCT src, dst FROM (
    SELECT host AS src, translate(unnest(regexp_extract_all(html, {quote(LINK)}, 1)), '{UPPER}', '{LOWER}') AS dst FROM named WHERE host <> '')
  WHERE src <> dst),
hosts AS (SELECT host FROM named UNION SELECT src FROM edges UNION SELECT dst FROM edges),
fit AS (
  SELECT n.rowid AS r, ru.verdict, ru.rule, row_number() OVER (PARTITION BY n.rowid ORDER BY length(ru.rule) DESC, ru.rule, ru.rule_path, ru.verdict) AS k
  FROM (SELECT row_number() OVER () AS rowid, * FROM named) n JOIN rules ru
  ON (n.host = ru.rule_host OR ends_with(n.host, '.' || ru.rule_host)) AND starts_with(n.path, ru.rule_path)),
judged AS MATERIALIZED (
  SELECT n.*, f.rule, f.verdict FROM (SELECT row_number() OVER () AS rowid, * FROM named) n LEFT JOIN fit f ON f.r = n.rowid AND f.k = 1),
seeds AS (
  SELECT h.host, coalesce(j.good * {SCALE} // j.n, 0) AS t, coalesce(j.bad * {SCALE} // j.n, 0) AS d
  FROM hosts h LEFT JOIN (
    SELECT host, count(*) AS n, count(*) FILTER (verdict = 'allow') AS good, count(*) FILTER (verdict = 'block') AS bad FROM judged GROUP BY 1) j USING (host)),
flows AS MATERIALIZED (
  SELECT 'trust' AS kind, src AS host, dst, count(*) OVER (PARTITION BY src) AS n FROM edges
  UNION ALL SELECT 'distrust', dst, src, count(*) OVER (PARTITION BY dst) FROM edges),
s0 AS MATERIALIZED (
  SELECT 'trust' AS kind, host, CAST(t AS BIGINT) AS seed, 1 AS passes, CAST(t * {keep} // 100 AS BIGINT) AS score FROM seeds
  UNION ALL SELECT 'distrust', host, CAST(d AS BIGINT), CAST(t <= d AS INT), CAST(d * {keep} // 100 AS BIGINT) FROM seeds),
rounds AS (
  SELECT 0 AS round, kind, host, seed, passes, score, score AS moved FROM s0
  UNION ALL
  SELECT round + 1, kind, host, seed, passes, total, total - score FROM (
    SELECT s.*, CAST((s.seed * {keep} + coalesce(p.passed, 0) * {flow_percent}) // 100 AS BIGINT) AS total
    FROM rounds s LEFT JOIN (
      SELECT f.kind, f.dst AS host, CAST(sum(s.passes * (s.score // f.n)) AS BIGINT) AS passed
      FROM flows f JOIN rounds s ON s.kind = f.kind AND s.host = f.host GROUP BY 1, 2) p
    ON p.kind = s.kind AND p.host = s.host)
  WHERE (SELECT sum(moved) FROM rounds) * {flow_percent} > {residual * (100 - flow_percent)}),
settled AS MATERIALIZED (SELECT * FROM rounds WHERE round = (SELECT max(round) FROM rounds)),
reach AS (
  SELECT f.dst AS host, CAST(sum(s.passes * (s.score // f.n)) AS BIGINT) AS linked, CAST(sum({SCALE * (100 - flow_percent) // 100} // f.n) AS BIGINT) AS linkable
  FROM flows f JOIN settled s ON s.kind = f.kind AND s.host = f.host WHERE f.kind = 'distrust' GROUP BY 1)
SELECT j.page_id, j.host, j.path, j.rule,
  coalesce(j.verdict, CASE WHEN d.score > t.score AND (100 * d.seed >= {block_percent * SCALE} OR (r.linkable > 0 AND 100 * r.linked >= {block_percent} * r.linkable)) THEN 'block' ELSE 'allow' END) AS verdict,
  t.score AS trust, d.score AS distrust
FROM judged j JOIN settled t ON t.host = j.host AND t.kind = 'trust' JOIN settled d ON d.host = j.host AND d.kind = 'distrust' LEFT JOIN reach r ON r.host = j.host
"""
