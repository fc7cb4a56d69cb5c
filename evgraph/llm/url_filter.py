"""URL verdicts by rules, and for the rest by trust and distrust that spread over links.

Host edges come from the links of the pages, counted once per pair of hosts. Personalised
PageRank carries trust from the hosts of allowed pages along the edges, and distrust from the
hosts of blocked pages against them. A host is blocked when its distrust is above its trust
by ``ratio``. Relative links stay inside their host, so they are self-links: they hold rank where
it is and are dropped, which is the same as normalising over the other hosts.

Edge cases: a url that is null or has no ``://`` has empty host and path, fits no rule, and is
allowed; null html has no links; repeated pages and links weigh as often as they occur;
hosts that neither trust nor distrust reaches are allowed; the empty table gives the empty
table; further columns are left out of the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from evgraph.session import checkpointed, written

RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null."""
    fits = []
    for rule, verdict in rules:
        name, _, rest = rule.partition("/")
        under = (host == name) | F.endswith(host, F.lit("." + name))
        fits.append((rule, F.when(under & F.startswith(path, F.lit("/" + rest)), F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")))))
    return F.coalesce(*[fit for _, fit in sorted(fits, key=lambda x: -len(x[0]))])


def link_targets(html: Column) -> Column:
    """The hosts that absolute links lead to, repeats kept."""
    links = F.regexp_extract_all(html, F.lit(r"""(?i)\bhref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""), 1)
    return F.transform(F.coalesce(links, F.array().cast("array<string>")), lambda h: F.translate(h, _UPPER, _LOWER))


def spread(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, rounds: int = 20) -> DataFrame:
    """(host, rank): personalised PageRank of ``edges`` (src, dst, weight) from ``seeds``
    (host, share; shares sum to 1). Rank that reaches a host without links goes back to the seeds."""
    total = edges.groupBy("src").agg(F.sum("weight").alias("_total"))
    shares = written(edges.join(total, "src").select("src", "dst", (F.col("weight") / F.col("_total")).alias("part")), "edges")
    seeds = written(seeds, "seeds")
    rank = seeds.select("host", F.col("share").alias("rank"))
    if shares.isEmpty() or seeds.isEmpty():
        return rank
    for _ in range(rounds):
        moved = shares.join(rank.withColumnRenamed("host", "src"), "src").select(
            F.col("dst").alias("host"), (damping * F.col("rank") * F.col("part")).alias("rank")
        )
        moved = moved.groupBy("host").agg(F.sum("rank").alias("rank"))
        moved = checkpointed(moved)
        kept = moved.agg(F.sum("rank")).first()[0] or 0.0
        home = seeds.select("host", (F.col("share") * (1.0 - kept)).alias("rank"))
        rank = moved.unionByName(home).groupBy("host").agg(F.sum("rank").alias("rank"))
    return rank


def judge(pages: DataFrame, rules=RULES, ratio: float = 1.0, damping: float = 0.85, rounds: int = 20) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust."""
    url = F.col("url")
    read = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), link_targets(F.col("html")).alias("links"))
    read = written(read.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules)), "pages")
    edges = (
        read.where("host != ''")
        .select(F.col("host").alias("src"), F.explode("links").alias("dst"))
        .where("src != dst")
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
    )
    edges = written(edges, "links")
    judged = read.where("fit is not null").groupBy("host").agg(
        F.sum(F.when(F.col("fit.verdict") == "allow", 1.0).otherwise(0.0)).alias("allow"),
        F.sum(F.when(F.col("fit.verdict") == "block", 1.0).otherwise(0.0)).alias("block"),
    )
    judged = written(judged, "judged")

    def seeds(kind: str) -> DataFrame:
        own = judged.where(F.col(kind) > 0)
        total = own.agg(F.sum(kind)).first()[0] or 1.0
        return own.select("host", (F.col(kind) / total).alias("share"))

    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    trust = spread(edges, seeds("allow"), damping, rounds).withColumnRenamed("rank", "trust")
    distrust = spread(back, seeds("block"), damping, rounds).withColumnRenamed("rank", "distrust")
    ranks = trust.join(distrust, "host", "full").fillna(0.0, ["trust", "distrust"])
    verdict = F.when(F.col("distrust") > ratio * F.col("trust"), "block").otherwise("allow")
    ranks = written(ranks.select(F.col("host").alias("_host"), "trust", "distrust", verdict.alias("_verdict")), "ranks")
    return read.join(ranks, F.col("host") == F.col("_host"), "left").select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", "_verdict", F.lit("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
