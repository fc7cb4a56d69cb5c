"""Queries over identifiers, hierarchy, paths and names."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from evgraph.catalog.base import query
from evgraph.catalog.sql import fragment
from evgraph.operators import identity, validation
from evgraph.sources import derived
from evgraph.sources.tables import Tables

fragment("norm_identifier", """
  SELECT *, regexp_replace(upper(value_raw), '[^A-Z0-9]', '', 'g') AS value_norm FROM identifier""", "identifier")


@query(
    "identifier_crosswalk", "norm_identifier",
    sql="""SELECT entity, source, kind, value_raw, value_norm,
      count(*) OVER (PARTITION BY kind, value_norm) AS n_records,
      min(source) OVER (PARTITION BY kind, value_norm) <> max(source) OVER (PARTITION BY kind, value_norm)
        AS across_sources, sha256(concat_ws('|', 'link', kind, value_norm)) AS link_id
      FROM norm_identifier""",
)
def identifier_crosswalk(t: Tables) -> DataFrame:
    return identity.crosswalk(derived.identifiers(t))


@query(
    "identifier_conflicts", "norm_identifier",
    sql="""SELECT 'shared_identifier' AS conflict, kind, value_norm AS subject, count(DISTINCT entity) AS n
      FROM norm_identifier GROUP BY kind, value_norm HAVING count(DISTINCT entity) > 1
      UNION ALL SELECT 'several_identifiers', kind, entity, count(DISTINCT value_norm)
      FROM norm_identifier GROUP BY kind, entity HAVING count(DISTINCT value_norm) > 1""",
)
def identifier_conflicts(t: Tables) -> DataFrame:
    return identity.identifier_conflicts(derived.identifiers(t))


DUPLICATE_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS subject, 'duplicate_key' AS check_name, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_rows, "
    f"count(*) FILTER (n > 1) AS n_keys FROM (SELECT count(*) AS n FROM {table} GROUP BY {key})"
    for name, table, key in (
        ("nodes", "nodes", "id"), ("lineitem", "lineitem", "l_orderkey, l_linenumber"),
        ("orders", "orders", "o_orderkey"), ("documents", "documents", "doc_id"), ("events", "events", "event_id"),
    )
)
ORPHAN_SQL = " UNION ALL ".join(
    f"SELECT '{name}', 'orphan_reference', count(*), count(DISTINCT {col}) FROM {child} "
    f"WHERE {col} NOT IN (SELECT {key} FROM {parent})"
    for name, child, col, parent, key in (
        ("lineitem.order", "lineitem", "l_orderkey", "orders", "o_orderkey"),
        ("lineitem.document", "lineitem", "l_partkey", "documents", "doc_id"),
        ("orders.customer", "orders", "o_custkey", "customer", "c_custkey"),
        ("edges.src", "edges", "src", "nodes", "id"), ("edges.dst", "edges", "dst", "nodes", "id"),
    )
)


@query("natural_key_check", "nodes", "edges", sql=f"{DUPLICATE_SQL} UNION ALL {ORPHAN_SQL}")
def natural_key_check(t: Tables) -> DataFrame:
    return validation.key_audit(
        {
            "nodes": (derived.nodes(t), ["id"], {}),
            "edges": (derived.edges(t), [], {"edges.src": ("src", "nodes"), "edges.dst": ("dst", "nodes")}),
            "lineitem": (
                t.lineitem, ["l_orderkey", "l_linenumber"],
                {"lineitem.order": ("l_orderkey", "orders"), "lineitem.document": ("l_partkey", "documents")},
            ),
            "orders": (t.orders, ["o_orderkey"], {"orders.customer": ("o_custkey", "customer")}),
            "customer": (t.customer, ["c_custkey"], {}),
            "documents": (t.documents, ["doc_id"], {}),
            "events": (t.events, ["event_id"], {}),
        },
        unique=["nodes", "lineitem", "orders", "documents", "events"],
    )


@query(
    "deterministic_id",
    sql="""SELECT 'award' AS kind, l_orderkey AS a, l_linenumber AS b,
        sha256(concat_ws('|', 'award', l_orderkey, l_linenumber)) AS local_id FROM lineitem
      UNION ALL SELECT 'solicitation', o_orderkey, 0, sha256(concat_ws('|', 'solicitation', o_orderkey)) FROM orders
      UNION ALL SELECT 'office', s_suppkey, 0, sha256(concat_ws('|', 'office', s_suppkey)) FROM supplier""",
)
def deterministic_id(t: Tables) -> DataFrame:
    def ids(df: DataFrame, kind: str, *keys: str) -> DataFrame:
        second = F.col(keys[1]) if len(keys) > 1 else F.lit(0)
        return df.select(
            F.lit(kind).alias("kind"), F.col(keys[0]).alias("a"), second.alias("b"),
            identity.local_id(kind, *keys).alias("local_id"),
        )

    return (
        ids(t.lineitem, "award", "l_orderkey", "l_linenumber")
        .unionByName(ids(t.orders, "solicitation", "o_orderkey"))
        .unionByName(ids(t.supplier, "office", "s_suppkey"))
    )


@query(
    "ancestry_path", "org_parent", recursive=True,
    sql=""", up AS (
        SELECT child AS entity, parent AS node, child || '>' || parent AS path, 1 AS depth FROM org_parent
        UNION ALL SELECT entity, p.parent, path || '>' || p.parent, depth + 1 FROM up JOIN org_parent p ON p.child = node)
      SELECT entity, path, depth, node AS root FROM up WHERE node NOT IN (SELECT child FROM org_parent)
      UNION ALL SELECT DISTINCT parent, parent, 0, parent FROM org_parent WHERE parent NOT IN (SELECT child FROM org_parent)""",
)
def ancestry_path(t: Tables) -> DataFrame:
    found = identity.ancestry(derived.org_parents(t))
    return found.withColumn("path", F.array_join("path", ">"))


@query(
    "buyer_paths", "path_edge",
    sql=""", step AS (SELECT *, dst LIKE 'contracting:%' AS ends FROM path_edge),
      two AS (SELECT a.src AS start, a.src || '>' || a.dst AS path, a.dst AS node, a.confidence AS score FROM step a
        WHERE a.src LIKE 'solicitation:%' AND NOT a.ends),
      three AS (SELECT start, path || '>' || b.dst AS path, b.dst AS node, score * b.confidence AS score
        FROM two JOIN step b ON b.src = node AND NOT b.ends),
      buyer AS (SELECT src, dst, confidence FROM step WHERE ends
        QUALIFY row_number() OVER (PARTITION BY src ORDER BY confidence DESC, dst) <= 3),
      found AS (
        SELECT src AS start, src || '>' || dst AS path, CAST(confidence AS DECIMAL(12,6)) AS score, 1 AS n_hops FROM buyer
          WHERE src LIKE 'solicitation:%'
        UNION ALL SELECT start, path || '>' || dst, score * confidence, 2 FROM two JOIN buyer ON src = node
        UNION ALL SELECT start, path || '>' || dst, score * confidence, 3 FROM three JOIN buyer ON src = node)
      SELECT start, path, CAST(score AS DOUBLE) AS score, n_hops, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY start ORDER BY score DESC, n_hops, path) AS rank FROM found) WHERE rank <= 3""",
)
def buyer_paths(t: Tables) -> DataFrame:
    return identity.buyer_paths(derived.path_edges(t), ["solicitation"], ["contracting_office"], 3, 3)


fragment("norm_name", """
  SELECT DISTINCT block, regexp_replace(lower(name), '[^a-z0-9]', '', 'g') AS norm FROM name_record""", "name_record")
fragment("name_pair", """
  SELECT a.block, a.norm AS name_a, b.norm AS name_b, levenshtein(a.norm, b.norm) AS distance,
    CASE WHEN regexp_replace(a.norm, '[^0-9]', '', 'g') = regexp_replace(b.norm, '[^0-9]', '', 'g') THEN 'match'
      ELSE 'review' END AS decision
  FROM norm_name a JOIN norm_name b ON a.block = b.block AND a.norm < b.norm
  WHERE levenshtein(a.norm, b.norm) <= 1""", "norm_name")


@query("entity_resolution", "name_pair", sql="SELECT block, name_a, name_b, distance, decision FROM name_pair")
def entity_resolution(t: Tables) -> DataFrame:
    return identity.matching_names(derived.name_records(t))


@query(
    "entity_clusters", "name_pair", recursive=True,
    sql=""", reach AS (
        SELECT block, norm, norm AS other FROM norm_name
        UNION SELECT r.block, r.norm, CASE WHEN p.name_a = r.other THEN p.name_b ELSE p.name_a END
        FROM reach r JOIN name_pair p ON p.block = r.block AND p.decision = 'match' AND r.other IN (p.name_a, p.name_b)),
      wide AS (
        SELECT block, norm, norm AS other FROM norm_name
        UNION SELECT r.block, r.norm, CASE WHEN p.name_a = r.other THEN p.name_b ELSE p.name_a END
        FROM wide r JOIN name_pair p ON p.block = r.block AND r.other IN (p.name_a, p.name_b)),
      grouped AS (SELECT block, norm, min(other) AS review_group FROM wide GROUP BY ALL),
      waiting AS (SELECT DISTINCT g.block, review_group FROM grouped g JOIN name_pair p ON p.block = g.block
        AND p.name_a = g.norm AND p.decision = 'review')
      SELECT n.record, n.source, n.name, n.block, min(r.other) AS cluster, any_value(w.review_group) AS review_group
      FROM name_record n JOIN reach r ON r.block = n.block
        AND r.norm = regexp_replace(lower(n.name), '[^a-z0-9]', '', 'g')
      JOIN grouped g ON g.block = r.block AND g.norm = r.norm
      LEFT JOIN waiting w ON w.block = g.block AND w.review_group = g.review_group
      GROUP BY n.record, n.source, n.name, n.block""",
)
def entity_clusters(t: Tables) -> DataFrame:
    return identity.resolve_entities(derived.name_records(t))
