"""Operator 7 [native]: URL filters by link-graph propagation.

Rules (host, path) decide what they fit: a host and its subdomains, paths that start
with the rule's; the longest rule wins.  What no rule fits is decided per host by
two personalised PageRanks over the host graph:

* trust starts at hosts by their number of allowed pages and follows links;
* distrust starts at hosts by their number of blocked pages and follows links
  backwards (who links to a blocked host is suspect).

A host is blocked where distrust exceeds ``threshold`` times trust; without any
mass it is allowed.  Mass is in pages, so neither side is blown up by being rare;
mass of hosts without a way on returns to the seeds.  Rounds go on until no host
moves by more than ``TOLERANCE`` of the seed mass (the damping bounds their number).

Everything is DataFrame code.  Pages are read once for hosts and once for
links; links are summed per (source, target) before the shuffle, so a host with a third
of all pages is a few rows; the rounds work on one row a host and one an edge.

Defined results: a null url, or one without ``://``, has empty host and path,
fits no rule and is allowed; null html has no links; relative links and links
to the own host are no edges; repeated pages count again; ties between rules of one
length go to the greater string; an empty table gives an empty result.  Only page_id, url
and html are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cachescope.llm.common import materialise

# (verdict, host, path)
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
DAMPING = 0.85
TOLERANCE = 1e-9
THRESHOLD = 2.0          # distrust over trust from which a host is blocked
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def best_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (length, rule, verdict) of the longest rule that fits, or null."""
    fits = []
    for verdict, rule_host, rule_path in rules:
        text = rule_host + rule_path
        ok = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        fits.append(F.when(ok, F.struct(F.lit(len(text)).alias("length"), F.lit(text).alias("rule"),
                                        F.lit(verdict).alias("verdict"))))
    return F.array_max(F.array(*fits))


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between different hosts in the pages' html."""
    refs = F.regexp_extract_all(F.col("html"), F.lit(r"""(?i)\bhref\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""),
                                F.lit(1))
    links = pages.select(url_host(F.col("url")).alias("src"), F.explode(refs).alias("to"))
    target = F.when(F.col("to").startswith("//"), F.concat(F.lit("x:"), F.col("to"))).otherwise(F.col("to"))
    links = links.select("src", url_host(target).alias("dst")).where("src <> '' and dst <> '' and src <> dst")
    return links.groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(links: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, trust, distrust) from links (src, dst, n) and seeds (host, allowed, blocked)."""
    kinds = (links.select(F.lit("trust").alias("kind"), "src", "dst", "n")
             .unionByName(links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"),
                                       F.col("src").alias("dst"), "n")))
    out = kinds.groupBy("kind", "src").agg(F.sum("n").alias("out"))
    edges = materialise(kinds.join(out, ["kind", "src"]).select(
        "kind", "src", "dst", (F.col("n") / F.col("out")).alias("share")), "host-edges")
    start = (seeds.select(F.lit("trust").alias("kind"), "host", F.col("allowed").cast("double").alias("seed"))
             .unionByName(seeds.select(F.lit("distrust").alias("kind"), "host",
                                       F.col("blocked").cast("double").alias("seed"))))
    nodes = start.unionByName(edges.select("kind", F.col("dst").alias("host"), F.lit(0.0).alias("seed")))
    nodes = nodes.groupBy("kind", "host").agg(F.sum("seed").alias("seed"))
    goes = edges.select("kind", F.col("src").alias("host"), F.lit(1.0).alias("_on")).distinct()
    totals = nodes.groupBy("kind").agg(F.sum("seed").alias("_total"))            # two rows
    total = F.col("_total")
    rank = materialise(nodes.join(F.broadcast(totals), "kind").join(goes, ["kind", "host"], "left").select(
        "kind", "host", "seed", F.col("_on").isNotNull().alias("on"),
        F.when(total > 0, F.col("seed") / total).otherwise(F.lit(0.0)).alias("jump"),
        F.col("seed").alias("mass")), "host-rank")
    while True:
        flow = (rank.join(edges, (rank["kind"] == edges["kind"]) & (rank["host"] == edges["src"]))
                .groupBy(edges["kind"].alias("kind"), F.col("dst").alias("host"))
                .agg(F.sum(F.col("mass") * F.col("share")).alias("flow")))
        # mass that has nowhere to go returns to the seeds
        stuck = rank.groupBy("kind").agg(F.sum("seed").alias("all"),
                                         F.sum(F.when(~F.col("on"), F.col("mass")).otherwise(0.0)).alias("stuck"))
        new = rank.join(flow, ["kind", "host"], "left").join(F.broadcast(stuck), "kind")     # two rows
        mass = (1 - damping) * F.col("seed") + damping * (
            F.coalesce("flow", F.lit(0.0)) + F.col("stuck") * F.col("jump"))
        new = materialise(new.select("kind", "host", "seed", "on", "jump", mass.alias("mass"),
                                     F.abs(mass - F.col("mass")).alias("moved"), "all"), "host-rank")
        open_ = new.where(F.col("moved") > tolerance * F.col("all")).limit(1).count()
        rank = new.drop("moved", "all")
        if not open_:
            break
    return rank.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == "trust", F.col("mass")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("kind") == "distrust", F.col("mass")).otherwise(0.0)).alias("distrust"))




def judge_urls(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust of every page."""
    urls = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    urls = urls.withColumn("_best", best_rule(F.col("host"), F.col("path"), rules))
    urls = urls.select("page_id", "host", "path", F.col("_best.rule").alias("rule"), F.col("_best.verdict").alias("_v"))
    urls = materialise(urls, "urls")
    seeds = urls.where("host <> ''").groupBy("host").agg(
        F.sum((F.col("_v") == "allow").cast("long")).alias("allowed"),
        F.sum((F.col("_v") == "block").cast("long")).alias("blocked"))
    seeds = materialise(seeds.select("host", F.coalesce("allowed", F.lit(0)).alias("allowed"),
                                     F.coalesce("blocked", F.lit(0)).alias("blocked")), "host-seeds")
    links = materialise(host_links(pages), "host-links")
    scores = materialise(propagate(links, seeds), "host-scores")
    judged = urls.join(scores, "host", "left")
    method = F.when(F.coalesce("distrust", F.lit(0.0)) > threshold * F.coalesce("trust", F.lit(0.0)),
                    "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("_v", method).alias("verdict"),
                         F.coalesce("trust", F.lit(0.0)).alias("trust"),
                         F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
