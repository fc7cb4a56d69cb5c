"""Queries over the graph itself: documents, validation, ranking, report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from evgraph.catalog.base import query
from evgraph.functions.evidence import is_missing, nested, role_weight, shown, to_confidence, with_round3
from evgraph.operators import ranking, validation
from evgraph.plans import report
from evgraph.session import scratch_path
from evgraph.sources import derived, graph_json, split_json
from evgraph.sources.tables import Tables

EVIDENCE = ["evidence.source_url", "evidence.observed_at", "evidence.confidence"]


PACKED = "gzip"  # of the JSON Lines that the queries below write only to read them again


def write_documents(t: Tables) -> str:
    """One graph document per line: node-only, edge-only, never a grouped one, so no
    document grows with the data."""
    out = scratch_path(t.spark, "graph-documents")
    node_docs = derived.nodes(t).select(
        F.concat(F.lit('{"nodes":['), graph_json.node_json(), F.lit("]}")).alias("value")
    )
    edge_docs = derived.edges(t).select(
        F.concat(F.lit('{"edges":['), graph_json.edge_json(), F.lit("]}")).alias("value")
    )
    graph_json.write_lines(node_docs.unionByName(edge_docs), out, PACKED)
    return out


def read_documents(t: Tables) -> DataFrame:
    return graph_json.read_graph(t.spark, write_documents(t))


@query(
    "scan_graph_json", "nodes", "edges",
    sql="SELECT (SELECT count(*) FROM nodes) + (SELECT count(*) FROM edges) AS documents, "
        "(SELECT count(*) FROM nodes) AS node_lists, (SELECT count(*) FROM edges) AS edge_lists",
)
def scan_graph_json(t: Tables) -> DataFrame:
    def has(name: str):
        return F.count_if(F.try_variant_get("graph", f"$.{name}", "variant").isNotNull())

    return read_documents(t).agg(
        F.count(F.lit(1)).alias("documents"), has("nodes").alias("node_lists"), has("edges").alias("edge_lists")
    )


@query("unnest_nodes", "nodes", sql="SELECT id, type, name FROM nodes")
def unnest_nodes(t: Tables) -> DataFrame:
    return graph_json.nodes(read_documents(t)).select("id", "type", "name")


@query("unnest_edges", "edges", sql="SELECT src, dst, type, source_url, observed_at, confidence FROM edges")
def unnest_edges(t: Tables) -> DataFrame:
    return graph_json.edges(read_documents(t)).select("src", "dst", "type", *EVIDENCE)


ITEMS_PER_DOCUMENT = 1_000_000
CUT_PACKED = "bzip2"  # of the pretty documents: readers can cut it
CUT_BYTES = "1m"  # of it, as many lines as in 16 MB of plain text


def write_pretty_documents(t: Tables) -> str:
    """All edges as pretty-printed documents of about a million edges, one per file."""
    out, edges = scratch_path(t.spark, "pretty-documents"), derived.edges(t)
    documents = -(-edges.count() // ITEMS_PER_DOCUMENT) + 1
    columns = ["src", "dst", "type", "evidence"]
    rows = edges.withColumn("place", F.xxhash64(*columns)).withColumn("document", F.pmod("place", F.lit(documents)))
    by = Window.partitionBy("document").orderBy("place", *columns)
    # one shuffle and one order for the ends of a document, the commas and the file
    rows = rows.repartition(documents, "document").withColumns({"_n": F.row_number().over(by), "_more": F.lead("place").over(by).isNotNull()})
    record = F.struct(F.col("src").alias("from"), F.col("dst").alias("to"), "type", "evidence")
    text = F.to_json(record, {"pretty": "true", "ignoreNullFields": "true"})
    head = '{\n  "note": {"edges": [1, 2]},\n  "nodes": [ ],\n  "edges": [\n'
    value = F.concat(F.when(F.col("_n") == 1, head).otherwise(""), text, F.when(F.col("_more"), ",").otherwise("\n]\n}"))
    rows.select("document", value.alias("value")).write.partitionBy("document").option("compression", CUT_PACKED).text(out)
    return out


@query("split_graph_json", "edges", sql="SELECT src, dst, type, source_url, observed_at, confidence FROM edges")
def split_graph_json(t: Tables) -> DataFrame:
    """Edges of pretty-printed documents whose lists are cut by many tasks."""
    _, edges = split_json.read_split(t.spark, write_pretty_documents(t), CUT_BYTES)
    return edges.select("src", "dst", "type", *EVIDENCE)


@query(
    "sink_graph", "nodes", "edges",
    sql="SELECT 'node' AS part, id AS a, name AS b, type, NULL AS confidence FROM nodes "
        "UNION ALL SELECT 'edge', src, dst, type, confidence FROM edges",
)
def sink_graph(t: Tables) -> DataFrame:
    out = scratch_path(t.spark, "graph")
    graph_json.write_graph(derived.nodes(t), derived.edges(t), out, PACKED)
    node_rows, edge_rows = graph_json.read_written_graph(t.spark, out)
    return node_rows.select(
        F.lit("node").alias("part"), F.col("id").alias("a"), F.col("name").alias("b"), "type",
        F.lit(None).cast("string").alias("confidence"),
    ).unionByName(
        edge_rows.select(
            F.lit("edge").alias("part"), F.col("src").alias("a"), F.col("dst").alias("b"), "type",
            "evidence.confidence",
        )
    )


@query("sink_ranked", "scored", sql="SELECT src, dst, type, source_url, score FROM scored")
def sink_ranked(t: Tables) -> DataFrame:
    out = scratch_path(t.spark, "ranked")
    graph_json.write_ranked(ranking.score_edges(derived.edges(t)), out, PACKED)
    schema = "`from` string, `to` string, type string, evidence struct<source_url:string>, score double"
    return t.spark.read.schema(schema).json(out).select(
        F.col("from").alias("src"), F.col("to").alias("dst"), "type", "evidence.source_url", "score"
    )


@query("sink_gaps", "gaps", sql="SELECT kind, message FROM gaps")
def sink_gaps(t: Tables) -> DataFrame:
    out = scratch_path(t.spark, "gaps")
    graph_json.write_gaps(validation.gaps(derived.nodes(t), derived.edges(t)), out)
    return graph_json.read_gaps(t.spark, out).select("kind", "message")


@query(
    "rerun_idempotent", "nodes", "edges", "gaps",
    sql="SELECT r AS run, nodes, edges, gaps, ranked FROM (SELECT (SELECT count(*) FROM nodes) AS nodes, "
        "(SELECT count(*) FROM edges) AS edges, (SELECT count(*) FROM gaps) AS gaps, "
        "(SELECT count(*) FROM edges) AS ranked), (VALUES (1), (2)) AS runs(r)",
)
def rerun_idempotent(t: Tables) -> DataFrame:
    """The report written twice to one folder; the second run replaces the first."""
    source, out = write_documents(t), scratch_path(t.spark, "report")
    runs = []
    for run in (1, 2):
        report.run(t.spark, source, out, compression=PACKED)
        kept = scratch_path(t.spark, f"run-{run}")
        report.count_outputs(t.spark, out).withColumn("run", F.lit(run)).write.parquet(kept)
        runs.append(t.spark.read.parquet(kept))
    return runs[0].unionByName(runs[1])


@query(
    "nested_get_default", "edges",
    sql="SELECT src, dst, coalesce(source_url, 'none') AS source_url, coalesce(observed_at, 'none') AS observed_at, "
        "coalesce(confidence, '0') AS confidence FROM edges",
)
def nested_get_default(t: Tables) -> DataFrame:
    return derived.edges(t).select(
        "src", "dst", nested("evidence", "source_url", "none").alias("source_url"),
        nested("evidence", "observed_at", "none").alias("observed_at"),
        nested("evidence", "confidence", "0").alias("confidence"),
    )


@query(
    "filter_invalid_node_type", "nodes", "allowed",
    sql="SELECT id, type, name FROM nodes WHERE type IS NULL OR type NOT IN (SELECT type FROM allowed)",
)
def filter_invalid_node_type(t: Tables) -> DataFrame:
    return validation.invalid_nodes(derived.nodes(t))


@query(
    "filter_null_or_empty", "edges",
    sql="SELECT src, dst, type, source_url, observed_at, confidence FROM edges WHERE confidence IS NULL OR confidence = ''",
)
def filter_null_or_empty(t: Tables) -> DataFrame:
    return derived.edges(t).where(is_missing(F.col("evidence.confidence"))).select("src", "dst", "type", *EVIDENCE)


@query("extend_record", "scored", sql="SELECT src, dst, type, source_url, observed_at, confidence, score FROM scored")
def extend_record(t: Tables) -> DataFrame:
    given = derived.edges(t).withColumn("score", F.lit(-1.0))
    return ranking.score_edges(given).select("src", "dst", "type", *EVIDENCE, "score")


@query("distinct_key_set", "nodes", sql="SELECT DISTINCT id FROM nodes")
def distinct_key_set(t: Tables) -> DataFrame:
    return validation.node_ids(derived.nodes(t))


@query("dangling_edges", "dangling", sql="SELECT src, dst, type, source_url, observed_at, confidence FROM dangling")
def dangling_edges(t: Tables) -> DataFrame:
    return validation.dangling_edges(derived.nodes(t), derived.edges(t)).select("src", "dst", "type", *EVIDENCE)


@query("weight_lookup", "scored", sql="SELECT src, dst, type, weight FROM scored")
def weight_lookup(t: Tables) -> DataFrame:
    return ranking.with_weight(derived.edges(t)).select("src", "dst", "type", "weight")


@query(
    "graph_summary", "nodes", "edges", "gaps",
    sql="SELECT (SELECT count(*) FROM nodes) AS nodes, (SELECT count(*) FROM edges) AS edges, "
        "(SELECT count(*) FROM gaps) AS gaps",
)
def graph_summary(t: Tables) -> DataFrame:
    node_rows, edge_rows = derived.nodes(t), derived.edges(t)
    return validation.graph_summary(node_rows, edge_rows, validation.gaps(node_rows, edge_rows))


@query(
    "stable_sort_desc", "scored",
    sql="SELECT src, dst, type, source_url, score, rank() OVER (ORDER BY score DESC) AS rank FROM scored",
)
def stable_sort_desc(t: Tables) -> DataFrame:
    ranked = ranking.with_rank(ranking.score_edges(derived.edges(t)))
    return ranking.stable_sort_desc(ranked).select("src", "dst", "type", "evidence.source_url", "score", "rank")


@query(
    "top_edge", "scored",
    sql="SELECT src, dst, type, source_url, observed_at, confidence, score FROM scored "
        "ORDER BY score DESC, src, dst, type, source_url NULLS FIRST, observed_at NULLS FIRST, "
        "confidence NULLS FIRST LIMIT 10",
)
def top_edge(t: Tables) -> DataFrame:
    """The ten best edges: a bounded heap per task, no full sort."""
    scored = ranking.score_edges(derived.edges(t))
    return ranking.top_edges(scored, 10).select("src", "dst", "type", *EVIDENCE, "score")


@query("unpivot_evidence", "missing", sql="SELECT src, dst, field_pos, field, value FROM missing")
def unpivot_evidence(t: Tables) -> DataFrame:
    return validation.missing_evidence(derived.edges(t)).select("src", "dst", "field_pos", "field", "value")


@query("union_gaps", "gaps", sql="SELECT phase, rule, field_pos, kind, node_id, src, dst, field FROM gaps")
def union_gaps(t: Tables) -> DataFrame:
    found = validation.gaps(derived.nodes(t), derived.edges(t))
    return found.select("phase", "rule", "field_pos", "kind", "node_id", "src", "dst", "field")


@query(
    "to_float_default", "scored", sql="SELECT src, dst, confidence, number FROM scored",
)
def to_float_default(t: Tables) -> DataFrame:
    raw = F.col("evidence.confidence")
    return derived.edges(t).select("src", "dst", raw.alias("confidence"), to_confidence(raw).alias("number"))


@query("score_product", "scored", sql="SELECT src, dst, type, weight * number AS product FROM scored")
def score_product(t: Tables) -> DataFrame:
    product = role_weight(F.col("type")) * to_confidence(F.col("evidence.confidence"))
    return derived.edges(t).select("src", "dst", "type", product.alias("product"))


@query("round3", "scored", sql="SELECT src, dst, type, round(weight * number, 3) AS rounded FROM scored")
def rounded(t: Tables) -> DataFrame:
    product = role_weight(F.col("type")) * to_confidence(F.col("evidence.confidence"))
    return with_round3(derived.edges(t).select("src", "dst", "type", product.alias("product")), "product", "rounded").drop("product")


@query("gap_message", "gaps", sql="SELECT kind, message, count(*) AS n FROM gaps GROUP BY ALL")
def gap_message(t: Tables) -> DataFrame:
    found = validation.gaps(derived.nodes(t), derived.edges(t))
    return found.groupBy("kind", "message").agg(F.count(F.lit(1)).alias("n"))


@query(
    "validate_graph", "gaps",
    sql="SELECT kind, coalesce(node_id, '') AS node_id, coalesce(src, '') AS src, coalesce(dst, '') AS dst, message "
        "FROM gaps",
)
def validate_graph(t: Tables) -> DataFrame:
    found = validation.validate_graph(derived.nodes(t), derived.edges(t))

    def known(name: str):
        return F.coalesce(F.col(name), F.lit("")).alias(name)

    return found.select("kind", known("node_id"), known("src"), known("dst"), shown(F.col("message")).alias("message"))


@query("rank_edges", "scored", sql="SELECT src, dst, type, source_url, observed_at, confidence, score FROM scored")
def rank_edges(t: Tables) -> DataFrame:
    return ranking.rank_edges(derived.edges(t)).select("src", "dst", "type", *EVIDENCE, "score")


@query(
    "graph_report", "nodes", "edges", "gaps",
    sql="SELECT (SELECT count(*) FROM nodes) AS nodes, (SELECT count(*) FROM edges) AS edges, "
        "(SELECT count(*) FROM gaps) AS gaps",
)
def graph_report(t: Tables) -> DataFrame:
    """Read documents, validate, rank, write three outputs, return the counts."""
    return report.run(t.spark, write_documents(t), scratch_path(t.spark, "report"), compression=PACKED)
