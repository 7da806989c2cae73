"""URL verdicts by rules, and by trust and distrust propagated over the host graph.

A page whose url fits a rule gets the verdict of the longest rule. Every other
page gets the verdict of its host: personalised PageRank spreads trust along
links from hosts with allowed pages, and distrust against the links from hosts
with blocked pages (a host that links to bad hosts is suspect). A host is
blocked when its distrust reaches ``least`` and makes up more than ``share`` of
its trust and distrust together. The walks go on until no score can be further
than ``within`` from its limit.

Every round is one join of host edges with host scores and one grouped sum, all
in Spark, over tables written to the shared folder; edges are counted with
map-side aggregation first, so a hot host sends one row per pair of hosts.

Defined cases: a null url or one without ``://`` has an empty host and path and
fits no rule; null html has no links; repeated links between two hosts count
once per page row; links of a host to itself are ignored; an unknown host gets
``default``; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fjord.llm.common import ascii_lower, stage

# (verdict, host, path prefix): a rule fits its host and all subdomains
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
MOST_ROUNDS = 1000  # scores that have not settled by then are an error
ROUNDS_PER_SUM = 8  # rounds whose additions are summed up together
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): what follows the first ``://`` up to / ? # and then up to ? #."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (n, verdict, rule) of the longest fitting rule, else null; on equal length block wins.

    ``rules`` is a configuration list that becomes a literal of the plan.
    """
    fits = [
        F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
               F.struct(F.lit(len(h + p)).alias("n"), F.lit(v).alias("verdict"), F.lit(h + p).alias("rule")))
        for v, h, p in rules
    ]
    return F.array_max(F.array(*fits))


def host_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Distinct host pairs (src, dst) with the number of page rows that link; own links left out."""
    host, _ = split_url(F.col(url_col))
    found = F.array_distinct(F.transform(F.regexp_extract_all(F.col(html_col), F.lit(LINK), F.lit(1)), ascii_lower))
    return (pages.select(host.alias("src"), F.explode(found).alias("dst"))
            .filter("src <> dst and src <> ''").groupBy("src", "dst").agg(F.count("*").alias("n")))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = 0.85, within: float = 1e-6) -> DataFrame:
    """Rows (host, trust, distrust) from seeds (host, trusted, blocked: 0 to 1) over edges (src, dst, n).

    score = (1 - damping) * seed + damping * what the neighbours pass on, each in
    proportion to its links; what a host without links would pass on is lost.
    A round passes on only what the last one added, and the score is the sum of
    all rounds. What is on its way shrinks by ``damping`` a round at least, so
    what is still missing anywhere is at most damping / (1 - damping) of it: the
    walks end when that is ``within``.
    """
    edges = stage(edges)
    kinds = [seeds.select("host", F.lit(k).alias("kind"), (F.col(c) * (1 - damping)).alias("v"))
             for k, c in enumerate(("trusted", "blocked"))]
    moving = stage(kinds[0].unionByName(kinds[1]).filter("v > 0"))
    steps = edges.select(F.lit(0).alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"), "n").unionByName(
        edges.select(F.lit(1).alias("kind"), F.col("dst").alias("a"), F.col("src").alias("b"), "n"))
    total = steps.groupBy("kind", "a").agg(F.sum("n").alias("all"))
    steps = stage(steps.join(total, ["kind", "a"]).select("kind", "a", "b", (F.col("n") / F.col("all") * damping).alias("w")))
    score, added, left = moving, [], 0 if edges.isEmpty() else MOST_ROUNDS
    while left:
        left -= 1
        moving = stage(steps.join(moving.select("kind", F.col("host").alias("a"), "v"), ["kind", "a"])
                       .groupBy(F.col("b").alias("host"), "kind").agg(F.sum(F.col("v") * F.col("w")).alias("v")))
        added.append(moving)
        if len(added) == ROUNDS_PER_SUM or not left:
            score = stage(reduce(DataFrame.unionByName, added, score).groupBy("host", "kind").agg(F.sum("v").alias("v")))
            added, way = [], moving.agg(F.sum("v")).first()[0] or 0.0
            if way * damping / (1 - damping) <= within:
                break
            if not left:
                raise RuntimeError(f"scores have not settled after {MOST_ROUNDS} rounds: {way} moved in the last one")
    return score.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == 0, F.col("v")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("kind") == 1, F.col("v")).otherwise(0.0)).alias("distrust"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, id_col: str = "page_id",
          url_col: str = "url", html_col: str = "html", least: float = 0.01, share: float = 0.75,
          default: str = "allow", within: float = 1e-6) -> DataFrame:
    """Per page row: id, host, path, rule (or null), verdict (allow or block), trust and distrust of its host."""
    host, path = split_url(F.col(url_col))
    judged = (pages.select(F.col(id_col).alias("__id"), host.alias("host"), path.alias("path"))
              .withColumn("__r", longest_rule(F.col("host"), F.col("path"), rules)))
    seeds = stage(judged.filter("host <> ''").groupBy("host").agg(
        F.avg((F.coalesce(F.col("__r.verdict"), F.lit("")) == "allow").cast("double")).alias("trusted"),
        F.avg((F.coalesce(F.col("__r.verdict"), F.lit("")) == "block").cast("double")).alias("blocked")))
    scores = stage(propagate(seeds, host_edges(pages, url_col, html_col), within=within))
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    by_host = (F.when(F.col("trust").isNull(), F.lit(default))
               .when((distrust >= least) & (distrust > share * (trust + distrust)), F.lit("block"))
               .otherwise(F.lit("allow")))
    return judged.join(scores, "host", "left").select(
        F.col("__id").alias(id_col), "host", "path", F.col("__r.rule").alias("rule"),
        F.coalesce(F.col("__r.verdict"), by_host).alias("verdict"), trust.alias("trust"), distrust.alias("distrust"))
