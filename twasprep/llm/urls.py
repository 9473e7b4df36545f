"""URL filter: host rules, then trust and distrust spread over the link graph (native).

The longest matching rule decides. A host that no rule reaches is judged by
two personalised PageRank vectors over host edges: trust flows along links from
hosts with an allowed url, distrust flows against links from hosts with a
blocked url (pages and link targets alike, crawled or not; a host that links to bad hosts is suspect). A host is blocked if
the distrust that reached it over links (its own restart mass left out: a rule
blocks a path, not the whole host) exceeds ``ratio`` times its trust and the
floor ``least``. Scores are in units of the uniform share 1 / hosts, before they
are rounded or compared with the tolerance: verdicts and precision are the same
for any number of hosts.

Edge cases: a null url or one without '://' has an empty host and path, no rule
and the verdict allow (no evidence); null or empty html has no links; repeated
pages repeat their rows and weigh their links again; an empty table gives no
rows; without links or seeds every vector is zero outside the seeds; of rules
that fit equally long the first listed wins; html of any length is searched
whole; other columns are not read, whatever their names.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twasprep.llm.common import materialise

#: Fixed rules of the production query: (host, path, verdict).
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"),
         ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
DAMPING = 0.85
TOLERANCE = 1e-6  # rounds go on until no host's score changes by more (of a uniform share)
ROUNDS = 12  # rounds of the SQL twin, as LINK is its pattern (scheme required, host only)
RATIO = 1.0
LEAST = 0.5
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?[a-z][a-z0-9+.-]*://([^/?#"'\s>]*)"""

#: The operator's own pattern: the url of an absolute or protocol-relative link.
TARGET = r"""(?i)<a\s[^>]*?href\s*=\s*["']?((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]*)"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 1)
    path = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 2)
    lower = F.translate(host, string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text, rule verdict) of the longest rule that fits, else nulls."""
    name = verdict = None
    for h, p, v in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        if name is None:
            name, verdict = F.when(fits, h + p), F.when(fits, v)
        else:
            name, verdict = name.when(fits, h + p), verdict.when(fits, v)
    if name is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return name, verdict


def links_of(pages: DataFrame) -> DataFrame:
    """(src, dst, path, n): absolute and protocol-relative links, summed."""
    host, _ = host_and_path(F.col("url"))
    links = pages.select(host.alias("src"), F.explode(F.regexp_extract_all(
        F.coalesce(F.col("html"), F.lit("")), F.lit(TARGET), 1)).alias("to"))
    dst, path = host_and_path(F.when(F.col("to").startswith("//"), F.concat(
        F.lit("http:"), F.col("to"))).otherwise(F.col("to")))
    return links.select("src", dst.alias("dst"), path.alias("path")).where("dst <> ''") \
        .groupBy("src", "dst", "path").agg(F.count(F.lit(1)).alias("n"))


def host_edges(links: DataFrame) -> DataFrame:
    """(src, dst, n): links between different hosts, summed."""
    return links.where("src <> '' and src <> dst") \
        .groupBy("src", "dst").agg(F.sum("n").alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING,
              rounds: int | None = None, hosts: int = 1) -> DataFrame:
    """Personalised PageRank (kind, host, score) for several kinds at once.

    ``edges``: kind, src, dst, n. ``seeds``: kind, host, mass (sums to 1 per
    kind). Mass of hosts without out-links returns to the seeds' next round
    share by not being spread (scores then sum to less than one). Without
    ``rounds`` it goes on until no score changes by ``TOLERANCE / hosts``; each
    round shrinks the change by ``damping``, so it ends.
    """
    out = edges.groupBy("kind", "src").agg(F.sum("n").alias("total"))
    share = materialise(edges.join(out, ["kind", "src"]).select(
        "kind", "src", "dst", (F.col("n") / F.col("total")).alias("share")), "share")
    ranks = seeds.select("kind", "host", F.col("mass").alias("score"))
    if share.isEmpty():
        # nothing to spread: the fixed point is the seeds' own restart mass
        return ranks.withColumn("score", F.col("score") * (1.0 - damping))
    base = seeds.select("kind", "host", (F.col("mass") * (1.0 - damping)).alias("score"))
    before, i = materialise(ranks, "ranks"), 0
    while rounds is None or i < rounds:
        i += 1
        sent = share.join(ranks, (share["kind"] == ranks["kind"]) & (share["src"] == ranks["host"])) \
            .select(share["kind"], F.col("dst").alias("host"),
                    (F.col("score") * F.col("share") * damping).alias("score"))
        ranks = base.unionByName(sent).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        if i % 4 == 0:
            ranks = materialise(ranks, "ranks")
            change = ranks.unionByName(before.withColumn("score", -F.col("score"))) \
                .groupBy("kind", "host").agg(F.abs(F.sum("score")).alias("d")).agg(F.max("d")).first()[0]
            if rounds is None and (change or 0.0) * hosts < TOLERANCE:
                break
            before = ranks
    return ranks


def host_scores(ranks: DataFrame, hosts: int) -> DataFrame:
    """(host, trust, distrust) in units of the uniform share, rounded so that the
    order of summation can't show."""
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("score")).otherwise(0.0)) * float(hosts)
    return ranks.groupBy("host").agg(of("trust").alias("t"), of("distrust").alias("d")).select(
        "host", F.round("t", 9).alias("trust"), F.abs(F.round("d", 9)).alias("distrust"))


def filter_urls(pages: DataFrame, rules=RULES, damping: float = DAMPING, rounds: int | None = None,
                ratio: float = RATIO, least: float = LEAST) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust (one row per page)."""
    host, path = host_and_path(F.col("url"))
    judged = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, by_rule = rule_of(F.col("host"), F.col("path"), rules)
    judged = judged.withColumn("rule", rule).withColumn("_by_rule", by_rule)
    links = materialise(links_of(pages), "links")
    to_rule = rule_of(F.col("dst"), F.col("path"), rules)[1]
    seeds = judged.select("host", "_by_rule").unionByName(
        links.select(F.col("dst").alias("host"), to_rule.alias("_by_rule"))) \
        .where("_by_rule is not null and host <> ''") \
        .select(F.when(F.col("_by_rule") == "allow", "trust").otherwise("distrust").alias("kind"),
                "host").distinct()
    per_kind = seeds.groupBy("kind").agg(F.count(F.lit(1)).alias("m"))
    seeds = materialise(seeds.join(F.broadcast(per_kind), "kind").select(
        "kind", "host", (F.lit(1.0) / F.col("m")).alias("mass")), "seeds")
    e = materialise(host_edges(links), "edges")
    both = e.select(F.lit("trust").alias("kind"), "src", "dst", "n").unionByName(
        e.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"),
                 F.col("src").alias("dst"), "n"))
    n_hosts = judged.agg(F.countDistinct("host")).first()[0]
    ranks = propagate(both, seeds, damping, rounds, n_hosts)
    restart = seeds.where("kind = 'distrust'").select(
        "kind", "host", (F.col("mass") * -(1.0 - damping)).alias("score"))
    scores = host_scores(ranks.unionByName(restart), n_hosts)
    out = judged.join(scores, "host", "left").fillna(0.0, ["trust", "distrust"])
    bad = (F.col("distrust") > ratio * F.col("trust")) & (F.col("distrust") > least)
    return out.select("page_id", "host", "path", "rule", F.coalesce(
        "_by_rule", F.when(bad, "block").otherwise("allow")).alias("verdict"), "trust", "distrust")
