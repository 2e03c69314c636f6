"""URL filters: rules by host and path, and trust and distrust spread over the host graph for what no rule decides."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.steps import cut
from .common import attach, host_of, KeyFilter, packed, path_of, salt_of

#: (verdict, host, path)
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
HREF = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*["']?([^"'\s>]*)"""
ABSOLUTE = r"^[A-Za-z][A-Za-z0-9+.-]*://"
SALTS = 16  # a host's links are dealt to so many tasks


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule (host and path together) that fits, as struct(rule, verdict); null if none. Rules are a small literal list."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links from one host to another. A link without a scheme, or // before its host, stays on its host;
    links within a host tell nothing about others and are left out."""
    link = F.explode(F.regexp_extract_all("html", F.lit(HREF), 1)).alias("href")
    links = pages.select("host", link).select("host", F.when(F.col("href").startswith("//"), F.concat(F.lit("http:"), "href")).otherwise(F.col("href")).alias("href"))
    away = links.filter(F.col("href").rlike(ABSOLUTE)).select(F.col("host").alias("src"), host_of(F.col("href")).alias("dst"))
    return away.filter("src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))


def shares(edges: DataFrame, at: str, to: str) -> DataFrame:
    """(src, _salt, dst, share): edges from `at` to `to`, each with its share of all that leave its source."""
    leaving = edges.groupBy(at).agg(F.sum("n").alias("all"))
    found = attach(edges, leaving, at, to, SALTS)
    return cut(found.select(F.col(at).alias("src"), salt_of(to, SALTS).alias("_salt"), F.col(to).alias("dst"), (F.col("n") / F.col("all")).alias("share")))


def spread(edges: DataFrame, seeds: DataFrame, rounds: int, damping: float) -> DataFrame:
    """Personalised PageRank from seeds (host, seed) along edges (src, _salt, dst, share): (host, mass), where a host's own
    seed counts in full, and what comes in over k links by damping ** k. A source's mass is copied to its salts, so a host
    with a large share of all links is no hot key."""
    mass = seeds.select("host", F.col("seed").alias("mass"))
    if edges.isEmpty():
        return mass
    spots = cut(edges.select("src", "_salt").distinct())
    for k in range(rounds):
        there = spots.join(mass.filter("mass > 0").withColumnRenamed("host", "src"), "src")
        sent = edges.join(there, ["src", "_salt"]).groupBy(F.col("dst").alias("host")).agg(F.sum(F.col("mass") * F.col("share")).alias("got"))
        mass = seeds.join(sent, "host", "left").select("host", (F.col("seed") + damping * F.coalesce("got", F.lit(0.0))).alias("mass"))
        if k % 4 == 3:
            mass = cut(mass)
    return mass


def rounds_for(damping: float, tolerance: float) -> int:
    """Rounds after which less than tolerance of a seed is still on its way: damping ** rounds is."""
    return math.ceil(math.log(tolerance) / math.log(damping))


def host_verdicts(judged: DataFrame, tolerance: float, damping: float, least: float, threshold: float) -> DataFrame:
    """(host, trust, distrust, bad) of the hosts of judged (host, r, html)."""
    share = lambda verdict: F.avg(F.when(F.col("r.verdict") == verdict, 1.0).otherwise(0.0))
    hosts = cut(judged.groupBy("host").agg(share("allow").alias("trusted"), share("block").alias("blocked")))
    edges = cut(host_edges(judged).join(hosts.select(F.col("host").alias("dst")), "dst", "left_semi"))
    rounds = rounds_for(damping, tolerance)
    trust = spread(shares(edges, "src", "dst"), hosts.select("host", F.col("trusted").alias("seed")), rounds, damping)
    distrust = spread(shares(edges, "dst", "src"), hosts.select("host", F.col("blocked").alias("seed")), rounds, damping)
    both = trust.join(distrust.withColumnRenamed("mass", "distrust"), "host").select("host", F.round("mass", 9).alias("trust"), F.round("distrust", 9).alias("distrust"))
    bad = (F.col("distrust") >= least) & (F.round(F.col("distrust") - threshold * (F.col("distrust") + F.col("trust")), 9) > 0)
    return cut(both.withColumn("bad", bad))


def ruled(pages: DataFrame, rules) -> DataFrame:
    keyed = pages.select("*", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return keyed.withColumn("r", rule_of(F.col("host"), F.col("path"), rules))


def judge_urls(pages: DataFrame, rules=RULES, tolerance: float = 0.02, damping: float = 0.85, least: float = 0.1, threshold: float = 0.5, id_col: str = "page_id") -> DataFrame:
    """One row a page: the id, host, path, rule, verdict, trust and distrust.

    Seeds: a host's share of pages that rules allow is its trust, the share that rules block its distrust. Trust runs
    along links (personalised PageRank, each link a share of its host's links to other hosts); distrust runs against them,
    from a blocked host to those that link to it. A page without a rule is blocked if its host has a distrust of `least` or
    more (a wholly blocked host has 1), and that is more than `threshold` of its trust and distrust together; else it is
    allowed, and so are hosts that nothing reaches. Rounds end when less than `tolerance` of a seed is on its way. Only
    the host graph is iterated over; it is aggregated before it is shuffled.
    Null or schemeless urls have empty host and path; null html has no links; long pages are read whole where they lie;
    repeated rows are judged each; a column of any other name is not read. An empty table gives an empty result."""
    judged = ruled(pages.select(F.col(id_col).alias("id"), "url", "html"), rules)
    verdicts = host_verdicts(judged, tolerance, damping, least, threshold)
    flat = judged.select("id", "host", "path", F.col("r.rule").alias("rule"), F.col("r.verdict").alias("ruled"))
    return attach(flat, verdicts, "host", "id").select(
        F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("ruled", F.when(F.col("bad"), "block").otherwise("allow")).alias("verdict"), "trust", "distrust"
    )


def keep_allowed(pages: DataFrame, rules=RULES, tolerance: float = 0.02, damping: float = 0.85, least: float = 0.1, threshold: float = 0.5) -> DataFrame:
    """pages (url, html and any other columns) whose url is allowed; rows and columns stay as they are.

    A page goes by its own rule or its host, so null and repeated ids do no harm. Only unruled pages whose host a bitmap of
    the bad ones lets through are shuffled; other pages are kept or dropped where they are read. An empty table stays empty."""
    judged = ruled(pages.select("url", "html"), rules)
    bad = cut(host_verdicts(judged, tolerance, damping, least, threshold).filter("bad").select(F.col("host").alias("_host"), F.lit(True).alias("_bad")))
    keyed = packed(pages, _host=host_of(F.col("url")), url=F.col("url")).withColumn("verdict", rule_of(F.col("_host"), path_of(F.col("url")), rules)["verdict"])
    marked = KeyFilter(bad, F.col("_host")).mark(keyed.filter("verdict is null or verdict = 'allow'"), F.col("_host"), "may")
    open_ = attach(marked.filter("may and verdict is null"), bad, "_host", "url").filter("_bad is null")
    return marked.filter("not may or verdict is not null").select("row.*").unionByName(open_.select("row.*"))


def op2_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "host", "path", "rule", "verdict")


def oracle(rules=RULES, tolerance: float = 0.02, damping: float = 0.85, least: float = 0.1, threshold: float = 0.5) -> str:
    """The same in DuckDB SQL, with the rounds written out."""
    ranked = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fit = lambda h, p: f"(host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}')"
    rule = " ".join(f"WHEN {fit(h, p)} THEN '{h}{p}'" for _, h, p in ranked)
    verdict = " ".join(f"WHEN {fit(h, p)} THEN '{v}'" for v, h, p in ranked)
    rounds, steps = rounds_for(damping, tolerance), []
    for name, at, to, seed in (("t", "src", "dst", "trusted"), ("b", "dst", "src", "blocked")):
        steps.append(f"{name}e AS MATERIALIZED (SELECT {at} AS a, {to} AS o, n / sum(n) OVER (PARTITION BY {at}) AS share FROM edges)")
        steps.append(f"{name}0 AS MATERIALIZED (SELECT host, CAST({seed} AS DOUBLE) AS mass FROM hosts)")
        steps += [
            f"{name}{k + 1} AS MATERIALIZED (SELECT h.host, h.{seed} + {damping} * coalesce(s.got, 0) AS mass FROM hosts h LEFT JOIN"
            f" (SELECT e.o, sum(m.mass * e.share) AS got FROM {name}e e JOIN {name}{k} m ON m.host = e.a GROUP BY e.o) s ON s.o = h.host)"
            for k in range(rounds)
        ]
    host = lambda c: rf"translate(coalesce(regexp_extract({c}, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    href = HREF.replace("'", "''")
    return f"""
WITH p AS MATERIALIZED (SELECT page_id, html, {host("url")} AS host, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
j AS MATERIALIZED (SELECT *, CASE {rule} END AS rule, CASE {verdict} END AS ruled FROM p),
hosts AS MATERIALIZED (SELECT host, avg(CASE WHEN ruled = 'allow' THEN 1.0 ELSE 0.0 END) AS trusted, avg(CASE WHEN ruled = 'block' THEN 1.0 ELSE 0.0 END) AS blocked FROM j GROUP BY host),
l AS (SELECT host AS src, CASE WHEN starts_with(h, '//') THEN 'http:' || h ELSE h END AS h FROM (SELECT host, unnest(regexp_extract_all(html, '{href}', 1)) AS h FROM j)),
edges AS MATERIALIZED (SELECT src, {host("h")} AS dst, count(*) AS n FROM l WHERE regexp_matches(h, '{ABSOLUTE}') AND {host("h")} <> src AND {host("h")} IN (SELECT host FROM hosts) GROUP BY ALL),
{", ".join(steps)}
SELECT page_id, j.host, path, rule, coalesce(ruled, CASE WHEN round(b.mass, 9) >= {least} AND round(round(b.mass, 9) - {threshold} * (round(b.mass, 9) + round(t.mass, 9)), 9) > 0 THEN 'block' ELSE 'allow' END) AS verdict
FROM j JOIN t{rounds} t ON t.host = j.host JOIN b{rounds} b ON b.host = j.host
"""


OP2_SQL = oracle()
