"""Identifiers, ancestry, paths and same-entity decisions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from evgraph.operators.components import components
from evgraph.session import checkpointed, written


def local_id(kind: str, *keys: Column | str) -> Column:
    """A deterministic id from a kind and its natural key. Separators inside a part are
    escaped and a null part has a mark of its own, so different keys never read alike."""

    def part(key: Column) -> Column:
        text = F.replace(key.cast("string"), F.lit("\\"), F.lit("\\\\"))
        return F.coalesce(F.replace(text, F.lit("|"), F.lit("\\|")), F.lit("\\N"))

    return F.sha2(F.concat_ws("|", F.lit(kind), *[part(F.col(k) if isinstance(k, str) else k) for k in keys]), 256)


def normalised_identifier(raw: Column) -> Column:
    return F.regexp_replace(F.upper(raw), "[^A-Z0-9]", "")


def crosswalk(identifiers: DataFrame) -> DataFrame:
    """Every identifier record with its link: records sharing (kind, normalised value).

    Linked records share ``link_id`` instead of being paired, so an identifier held by
    a third of all records still costs one row per record. The raw value is kept.
    """
    rows = identifiers.withColumn("value_norm", normalised_identifier(F.col("value_raw")))
    per_source = rows.groupBy("kind", "value_norm", "source").agg(F.count(F.lit(1)).alias("_n"))
    links = per_source.groupBy("kind", "value_norm").agg(
        F.sum("_n").alias("n_records"), (F.count(F.lit(1)) > 1).alias("across_sources")
    ).select(
        F.col("kind").alias("_kind"), F.col("value_norm").alias("_norm"), "n_records", "across_sources",
        local_id("link", "kind", "value_norm").alias("link_id"),
    )
    return rows.join(
        links, (F.col("kind") == F.col("_kind")) & (F.col("value_norm") == F.col("_norm"))
    ).drop("_kind", "_norm")


def identifier_conflicts(identifiers: DataFrame) -> DataFrame:
    """Identifiers held by several entities, and entities with several identifiers of a kind."""
    held = identifiers.select(
        "entity", "kind", normalised_identifier(F.col("value_raw")).alias("value")
    ).distinct()
    shared = held.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        F.lit("shared_identifier").alias("conflict"), "kind", F.col("value").alias("subject"), "n"
    )
    several = held.groupBy("kind", "entity").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        F.lit("several_identifiers").alias("conflict"), "kind", F.col("entity").alias("subject"), "n"
    )
    return shared.unionByName(several)


def ancestry(parents: DataFrame) -> DataFrame:
    """The path from each entity to its root: entity, path, depth, root.

    Only entities that are themselves parents take part in the level-by-level walk;
    the many leaves are attached to finished paths in one join at the end. The walk goes on until
    nothing new is reached, however long the chains; a path never meets an entity twice, so cycles
    end it. What leads to no root, being on a cycle or under one, comes back with a null path.
    """
    links = written(parents.select("child", "parent").distinct(), "links")
    inner_nodes = links.select(F.col("parent").alias("child")).distinct()
    inner = checkpointed(links.join(inner_nodes, "child", "left_semi"))
    leaves = links.join(inner_nodes, "child", "left_anti")
    roots = inner_nodes.join(links.select("child"), "child", "left_anti")
    found = frontier = checkpointed(
        roots.select(
            F.col("child").alias("entity"), F.array("child").alias("path"), F.lit(0).alias("depth"),
            F.col("child").alias("root"),
        )
    )

    above = ["path", "depth", "root"]

    def attached(below: DataFrame, done: DataFrame, how: str) -> DataFrame:
        up = done.select(F.col("entity").alias("_up"), *above)
        return below.join(up, F.col("parent") == F.col("_up"), how).select(
            F.col("child").alias("entity"), F.array_prepend("path", F.col("child")).alias("path"),
            (F.col("depth") + 1).alias("depth"), "root",
        )

    while True:
        step = attached(inner, frontier, "inner")
        frontier = checkpointed(step.where(~F.array_contains(F.slice("path", F.lit(2), F.size("path")), F.col("entity"))))
        if frontier.isEmpty():
            break
        found = found.unionByName(frontier)
    rootless = (
        inner.select(F.col("child").alias("entity")).distinct()
        .join(found.select("entity"), "entity", "left_anti")
        .select("entity", *[F.lit(None).cast(found.schema[c].dataType).alias(c) for c in above])
    )
    return found.unionByName(attached(leaves, found, "left")).unionByName(rootless)


def _reach(inner: DataFrame, ends: DataFrame, hops: int) -> list[DataFrame]:
    """For 1 to ``hops`` hops, (node, reach): the best product of confidences on the way to an end from each node
    in at most that many hops. Walks may repeat a node, so it bounds what a simple path can reach from above."""
    first = written(ends.groupBy(F.col("src").alias("node")).agg(F.max("confidence").alias("reach")), "reach")
    found = [first]
    for _ in range(hops - 1):
        up = found[-1].select(F.col("node").alias("_via"), F.col("reach").alias("_r"))
        longer = inner.join(up, F.col("dst") == F.col("_via")).select(F.col("src").alias("node"), (F.col("confidence") * F.col("_r")).cast(SCORE).alias("reach"))
        both = longer.unionByName(first.select("node", F.col("reach").cast(SCORE).alias("reach")))
        found.append(written(both.groupBy("node").agg(F.max("reach").alias("reach")), "reach"))
    return found


SCORE = "decimal(24,12)"


def buyer_paths(edges: DataFrame, starts: Sequence[str], buyers: Sequence[str], k: int = 3, max_hops: int = 3) -> DataFrame:
    """The k best simple paths from each node of a start type to a node of a buyer type, of at most ``max_hops`` edges
    in whatever order of types, scored by the product of edge confidences. Of equal scores the shorter path comes
    first, then the smaller one.

    Paths grow from their starts one hop a round. A buyer ends a path, so at each node a path needs only the node's k
    best edges to buyers. A path goes on only to nodes it has not met, and only where the best way on from there
    (``_reach``) could still beat the start's k-th best path; longer paths lose ties, so equal is not enough. Confidences
    must be decimals; edges without a positive one support nothing and form no path.
    """
    best_edge = edges.where(F.col("confidence") > 0).groupBy("src_type", "src", "dst_type", "dst").agg(F.max("confidence").alias("confidence"))
    hops = written(best_edge, "hops")
    ends, inner = hops.where(F.col("dst_type").isin(*buyers)), hops.where(~F.col("dst_type").isin(*buyers) & ~F.col("src_type").isin(*buyers))
    ends = ends.where(~F.col("src_type").isin(*buyers))
    order = Window.partitionBy("src").orderBy(F.desc("confidence"), "dst")
    last = ends.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k)
    last = written(last.select(F.col("src").alias("_n"), F.col("dst").alias("_d"), F.col("confidence").alias("_c")), "last-hops")
    steps = inner.select(F.col("src").alias("_n"), F.col("dst").alias("_d"), F.col("confidence").alias("_c"))
    reach = _reach(inner, ends, max_hops - 1) if max_hops > 1 else []
    rank = F.row_number().over(Window.partitionBy("start").orderBy(F.desc("score"), "n_hops", "path"))
    begun = hops.where(F.col("src_type").isin(*starts)).select(F.col("src").alias("start")).distinct()
    frontier = begun.select("start", F.col("start").alias("node"), F.array("start").alias("met"), F.lit(1).cast(SCORE).alias("score"))
    best = None
    for n in range(1, max_hops + 1):
        score = (F.col("score") * F.col("_c")).cast(SCORE)
        ended = frontier.join(last, F.col("node") == F.col("_n")).select(
            "start", score.alias("score"), F.lit(n).alias("n_hops"), F.array_join(F.array_append("met", F.col("_d")), ">").alias("path")
        )
        ended = ended if best is None else best.drop("rank").unionByName(ended)
        best = ended.withColumn("rank", rank).where(F.col("rank") <= k)
        if n == max_hops:
            break
        best = written(best, "paths")
        kth = best.where(F.col("rank") == k).select(F.col("start").alias("_s"), F.col("score").alias("_kth"))
        onward = reach[max_hops - n - 1].select(F.col("node").alias("_to"), "reach")
        ways = steps.join(onward, F.col("_d") == F.col("_to")).select("_n", "_d", "_c", (F.col("_c") * F.col("reach")).cast(SCORE).alias("_way"))
        grown = frontier.join(kth, F.col("start") == F.col("_s"), "left").join(
            ways, (F.col("node") == F.col("_n")) & (F.col("_kth").isNull() | ((F.col("score") * F.col("_way")).cast(SCORE) > F.col("_kth")))
        )
        grown = grown.where(~F.array_contains("met", F.col("_d")))
        frontier = written(grown.select("start", F.col("_d").alias("node"), F.array_append("met", F.col("_d")).alias("met"), score.alias("score")), "frontier")
        if frontier.isEmpty():
            break
    return best.select("start", "path", F.round("score", 6).alias("score"), "n_hops", "rank")


def normalised_name(name: Column) -> Column:
    return F.regexp_replace(F.lower(name), "[^a-z0-9]", "")


def matching_names(records: DataFrame) -> DataFrame:
    """Pairs of distinct names in a block that are one edit apart, with a decision.

    Equal names collapse first. Two names one edit apart become equal after deleting at
    most one character from each, so they meet in an equality join on those deletions:
    no name is compared with its whole block. Names whose numbers agree are the same
    entity; those whose numbers differ are left to review.
    """
    names = records.select("block", normalised_name(F.col("name")).alias("norm")).distinct()
    length = F.length("norm")
    deletions = F.transform(
        F.sequence(F.lit(1), F.greatest(length, F.lit(1))),
        lambda i: F.concat(F.substr("norm", F.lit(1), i - 1), F.substr("norm", i + 1)),
    )
    keyed = names.select("block", "norm", F.explode(F.array_distinct(F.array_append(deletions, F.col("norm")))).alias("cut"))
    a = keyed.select("block", "cut", F.col("norm").alias("name_a"))
    b = keyed.select("block", "cut", F.col("norm").alias("name_b"))
    digits_a, digits_b = (F.regexp_replace(c, "[^0-9]", "") for c in ("name_a", "name_b"))
    return (
        a.join(b, ["block", "cut"])
        .where("name_a < name_b")
        .select("block", "name_a", "name_b")
        .distinct()
        .withColumn("distance", F.levenshtein("name_a", "name_b"))
        .where("distance <= 1")
        .withColumn("decision", F.when(digits_a == digits_b, "match").otherwise("review"))
    )


def _clusters(pairs: DataFrame, name: str) -> DataFrame:
    """(block, norm, ``name``): the smallest name linked with each by ``pairs`` (block, name_a, name_b)."""
    node = lambda c: F.struct("block", F.col(c).alias("norm"))
    labels, _ = components(pairs.select(node("name_a").alias("a"), node("name_b").alias("b")))
    return labels.select("id.block", "id.norm", F.col("label.norm").alias(name))


def resolve_entities(records: DataFrame) -> DataFrame:
    """Each record with its cluster, the smallest name linked with its own by ``match`` decisions, and the
    review group it waits in: the smallest name that matches and undecided pairs together lead to, null
    where no pair of the group is undecided.

    Components take a number of rounds that grows with the logarithm of the longest chain. Only distinct names take
    part, so copies of one name cost nothing.
    """
    pairs = written(matching_names(records).select("block", "name_a", "name_b", "decision"), "name-pairs")
    named = records.withColumn("norm", normalised_name(F.col("name")))
    groups = _clusters(pairs, "review_group")
    undecided = pairs.where("decision = 'review'").select("block", F.col("name_a").alias("norm")).distinct()
    waiting = groups.join(undecided, ["block", "norm"], "left_semi").select("block", "review_group").distinct()
    groups = groups.join(waiting, ["block", "review_group"], "left_semi").select("block", "norm", "review_group")
    found = named.join(_clusters(pairs.where("decision = 'match'"), "cluster"), ["block", "norm"], "left").join(groups, ["block", "norm"], "left")
    return found.select("record", "source", "name", "block", F.coalesce("cluster", "norm").alias("cluster"), "review_group")
