"""The derived tables again, as SQL for the checking engine.

``with_tables("edges", "nodes", body=...)`` puts the fragments a query needs, and the
fragments those need, before its body.
"""

from __future__ import annotations

FRAGMENTS: dict[str, tuple[tuple[str, ...], str]] = {}


def fragment(name: str, sql: str, *needs: str) -> None:
    FRAGMENTS[name] = (needs, sql)


def with_tables(*names: str, body: str, recursive: bool = False) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in FRAGMENTS[name][0]:
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    head = ",\n".join(f"{name} AS ({FRAGMENTS[name][1]})" for name in ordered)
    return f"WITH {'RECURSIVE ' if recursive else ''}{head}\n{body.strip()}"


fragment("nodes", """
  SELECT 'agency:' || r_regionkey AS id, 'agency' AS type, r_name AS name FROM region
  UNION ALL SELECT 'subagency:' || n_nationkey, 'subagency', n_name FROM nation
  UNION ALL SELECT 'office:' || s_suppkey,
    CASE WHEN s_suppkey % 17 = 3 THEN 'vendor' WHEN s_suppkey % 17 = 5 THEN NULL ELSE 'program_office' END, s_name
    FROM supplier WHERE s_suppkey % 29 <> 7
  UNION ALL SELECT 'contracting:' || c_custkey, 'contracting_office', c_name FROM customer
  UNION ALL SELECT 'program:' || p_partkey, 'program', p_name FROM part
  UNION ALL SELECT 'solicitation:' || o_orderkey, 'solicitation', o_orderpriority FROM orders
  UNION ALL SELECT 'award:' || l_orderkey || '-' || l_linenumber, 'award', l_linestatus FROM lineitem
  UNION ALL SELECT DISTINCT 'company:' || p_brand, 'company', p_brand FROM part
  UNION ALL SELECT DISTINCT 'person:' || user_id, 'person', CAST(user_id AS VARCHAR) FROM events""")

fragment("edges", """
  SELECT 'office:' || l_suppkey AS src, 'program:' || l_partkey AS dst,
    ['owns_mission','owns_program','funds','procures_for','administers','holds','cites'][l_linenumber] AS type,
    CASE WHEN l_quantity = 50 AND l_linenumber = 1 THEN ''
         ELSE 'https://example.invalid/order/' || l_orderkey END AS source_url,
    CASE WHEN l_quantity = 50 AND l_linenumber = 2 THEN NULL
         ELSE strftime(l_shipdate, '%Y-%m-%d') END AS observed_at,
    CASE WHEN l_quantity = 50 AND l_linenumber = 3 THEN NULL WHEN l_quantity = 50 AND l_linenumber = 4 THEN ''
         ELSE CAST(round(1 - l_discount, 2) AS VARCHAR) END AS confidence
  FROM lineitem""")

fragment("weights", """
  SELECT * FROM (VALUES ('owns_mission', 4.0::DOUBLE), ('owns_program', 4.0), ('funds', 3.0), ('procures_for', 3.0),
    ('administers', 2.0), ('holds', 1.0)) AS w(type, weight)""")

fragment("scored", """
  SELECT e.*, coalesce(w.weight, 0.5::DOUBLE) AS weight,
    coalesce(TRY_CAST(e.confidence AS DOUBLE), 0) AS number,
    round(coalesce(w.weight, 0.5::DOUBLE) * coalesce(TRY_CAST(e.confidence AS DOUBLE), 0), 3) AS score
  FROM edges e LEFT JOIN weights w ON e.type = w.type""", "edges", "weights")

fragment("allowed", """
  SELECT * FROM (VALUES ('agency'), ('subagency'), ('program_office'), ('contracting_office'), ('program'),
    ('person'), ('solicitation'), ('award'), ('company')) AS a(type)""")

fragment("dangling", """
  SELECT * FROM edges e
  WHERE NOT EXISTS (SELECT 1 FROM nodes n WHERE n.id IS NOT DISTINCT FROM e.src)
     OR NOT EXISTS (SELECT 1 FROM nodes n WHERE n.id IS NOT DISTINCT FROM e.dst)""", "nodes", "edges")

fragment("missing", """
  SELECT * FROM (
    SELECT src, dst, 0 AS field_pos, 'source_url' AS field, source_url AS value FROM edges
    UNION ALL SELECT src, dst, 1, 'observed_at', observed_at FROM edges
    UNION ALL SELECT src, dst, 2, 'confidence', confidence FROM edges)
  WHERE value IS NULL OR value = ''""", "edges")

fragment("gaps", """
  SELECT 0 AS phase, 0 AS rule, 0 AS field_pos, 'invalid_node_type' AS kind, id AS node_id, NULL AS src, NULL AS dst,
    'type' AS field, 'invalid node type: ' || coalesce(type, 'None') AS message
  FROM nodes WHERE type IS NULL OR type NOT IN (SELECT type FROM allowed)
  UNION ALL SELECT 1, 0, 0, 'dangling_edge', NULL, src, dst, NULL, 'dangling edge: ' || src || ' -> ' || dst FROM dangling
  UNION ALL SELECT 1, 1, field_pos, 'missing_evidence', NULL, src, dst, field,
    'edge missing evidence.' || field || ': ' || src || ' -> ' || dst FROM missing""",
  "nodes", "allowed", "dangling", "missing")

fragment("evidence", """
  SELECT o_orderkey AS opp, l_suppkey AS office,
    ['explicit_owner','office_code','poc_context','contracting_office','industry_code','notice_prefix',
     'semantic'][l_linenumber] AS kind,
    CAST(round(1 - l_discount, 2) AS DECIMAL(4,2)) AS confidence, CAST(l_shipdate AS DATE) AS available_at,
    CAST(o_orderdate AS DATE) AS published_at, l_returnflag = 'R' AS refutes, l_partkey AS doc_id,
    l_linestatus AS line_status
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")

fragment("org_version", """
  SELECT s_suppkey AS office, 1 AS version, s_name || ' v1' AS name, DATE '1995-01-01' AS valid_from,
    DATE '1998-01-01' + CAST(s_suppkey % 365 AS INTEGER) AS valid_to FROM supplier
  UNION ALL SELECT s_suppkey, 2, s_name || ' v2', DATE '1998-01-01' + CAST(s_suppkey % 365 AS INTEGER), NULL
  FROM supplier WHERE s_suppkey % 10 <> 9""")

fragment("assertion", """
  SELECT sha256(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d'))) AS id,
    l_partkey AS subject, 'owned_by' AS predicate, l_suppkey AS object, CAST(l_shipdate AS DATE) AS valid_from,
    CAST(l_shipdate AS DATE) + 180 AS valid_to, CAST(round(1 - l_discount, 2) AS DECIMAL(4,2)) AS confidence,
    l_partkey AS doc_id
  FROM lineitem WHERE l_linenumber <= 3""")

fragment("role_assertion", """
  SELECT l_orderkey AS opp, ['owner','owner','owner','program_management','funding','technical','award'][l_linenumber]
    AS role, l_suppkey AS office FROM lineitem
  UNION ALL SELECT o_orderkey, 'contracting', o_custkey FROM orders""")

fragment("identifier", """
  SELECT 'office:' || s_suppkey AS entity, 'directory' AS source, 'office_code' AS kind,
    CASE WHEN s_suppkey % 2 = 0 THEN 'pmw ' || (100 + s_suppkey % 90) ELSE ' Pmw-' || (100 + s_suppkey % 90) || ' ' END
    AS value_raw FROM supplier
  UNION ALL SELECT 'office:' || s_suppkey, 'directory', 'office_code', 'PMW/' || (200 + s_suppkey % 90)
    FROM supplier WHERE s_suppkey % 13 = 6
  UNION ALL SELECT 'office:' || s_suppkey, 'directory', 'activity_code', 'n' || lpad(CAST(s_nationkey AS VARCHAR), 5, '0')
    FROM supplier
  UNION ALL SELECT 'award:' || l_orderkey || '-' || l_linenumber, 'award', 'office_code', 'PMW-' || (100 + l_suppkey % 90)
    FROM lineitem""")

fragment("org_parent", """
  SELECT 'office:' || s_suppkey AS child, 'subagency:' || s_nationkey AS parent FROM supplier
  UNION ALL SELECT 'subagency:' || n_nationkey, 'agency:' || n_regionkey FROM nation
  UNION ALL SELECT DISTINCT 'award:' || l_orderkey || '-' || l_linenumber, 'office:' || l_suppkey FROM lineitem""")

fragment("path_edge", """
  SELECT src, dst, max(confidence) AS confidence FROM (
    SELECT CASE WHEN l_linenumber IN (1, 2, 6) THEN 'solicitation:' || l_orderkey WHEN l_linenumber IN (3, 4)
        THEN 'office:' || l_suppkey ELSE 'program:' || l_partkey END AS src,
      CASE WHEN l_linenumber IN (1, 2, 5) THEN 'office:' || l_suppkey WHEN l_linenumber IN (3, 6) THEN 'program:' || l_partkey
        ELSE 'contracting:' || o_custkey END AS dst,
      CAST(round(1 - l_discount, 2) AS DECIMAL(4,2)) AS confidence
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
  WHERE confidence > 0 GROUP BY src, dst""")

fragment("name_record", """
  SELECT 'a:' || s_suppkey AS record, 'registry' AS source, s_name AS name, s_nationkey AS block FROM supplier
  UNION ALL SELECT 'b:' || s_suppkey, 'notices',
    CASE WHEN s_suppkey % 3 = 0
      THEN substr(replace(upper(s_name), '#', ' '), 1, 3) || substr(replace(upper(s_name), '#', ' '), 5)
      ELSE replace(upper(s_name), '#', ' ') END, s_nationkey FROM supplier""")

fragment("contact_obs", """
  SELECT event_id AS obs, user_id AS person, user_id % 10 AS office,
    CASE event_type WHEN 'purchase' THEN 'Program Manager' WHEN 'signup' THEN 'Contracting Officer'
      WHEN 'click' THEN 'Technical Lead' WHEN 'view' THEN 'Director' WHEN 'error' THEN 'Small Business Liaison' END
      AS raw_title,
    CASE event_type WHEN 'purchase' THEN 'owns_program' WHEN 'signup' THEN 'signs_contracts'
      WHEN 'click' THEN 'technical_contact' WHEN 'error' THEN 'industry_engagement' END AS signal,
    CASE event_type WHEN 'purchase' THEN 'program_leadership' WHEN 'signup' THEN 'contracting'
      WHEN 'click' THEN 'technical' WHEN 'view' THEN 'program_leadership' WHEN 'error' THEN 'small_business' END
      AS category,
    ts AS seen_at, CAST(ts AS DATE) AS observed_at
  FROM events""")

fragment("procurement", """
  SELECT l_suppkey AS office, p_brand AS program, p_name AS scope, p_type AS element, o_orderpriority AS method,
    o_custkey AS contracting, CAST(l_shipdate AS DATE) AS event_at, CAST(l_extendedprice AS DECIMAL(18,2)) AS value,
    o_orderstatus AS status, l_returnflag AS flag, l_orderkey AS notice
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""")

fragment("budget_long", """
  SELECT l_suppkey AS office, 'approp-' || (l_suppkey % 5) AS appropriation, p_type AS element,
    p_type || '-' || (l_suppkey % 3) AS project, CASE WHEN l_suppkey % 2 = 0 THEN 'K' ELSE 'M' END AS unit,
    year(l_shipdate) AS fiscal_year, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(20,2)) AS amount
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY ALL""")

fragment("budget_year", """
  SELECT unnest(range(least(min(fiscal_year) + 1, max(fiscal_year)), max(fiscal_year) + 1)) AS y
  FROM (SELECT year(l_shipdate) AS fiscal_year FROM lineitem)""")

fragment("retrieval", """
  SELECT doc_id, 'https://' || source || '.example.invalid/' || (doc_id % 7) AS url,
    'https://' || source || '.example.invalid/' || CASE WHEN doc_id % 13 = 4 THEN 'archive/' ELSE '' END || (doc_id % 7) AS final_url,
    'https://' || source || '.example.invalid/' AS discovered_on,
    CASE WHEN doc_id % 9 <> 4 THEN DATE '2023-01-01' + CAST(doc_id % 300 AS INTEGER) END AS published_on,
    TIMESTAMP '2024-01-01' + to_hours(doc_id) AS retrieved_at,
    CASE WHEN doc_id % 11 <= 5 THEN 'retrieved' WHEN doc_id % 11 = 6 THEN 'authenticated'
      WHEN doc_id % 11 = 7 THEN 'expired' WHEN doc_id % 11 = 8 THEN 'missing' WHEN doc_id % 11 = 9 THEN 'blocked'
      ELSE 'manual' END AS status, 'text/plain' AS mime, text
  FROM documents""")

fragment("marked", """
  SELECT doc_id, array_to_string(list_transform(string_split(
      CASE WHEN doc_id % 5 = 0 THEN text || chr(10) || 'Office PMW-' || (100 + doc_id % 90)
        || ' element 0' || lpad(CAST(doc_id % 1000000 AS VARCHAR), 6, '0') || 'N notice N'
        || lpad(CAST(doc_id % 100000 AS VARCHAR), 5, '0') || '-24-R-' || lpad(CAST(doc_id % 10000 AS VARCHAR), 4, '0')
        || CASE WHEN doc_id % 7 = 2 THEN chr(12) ELSE '' END
        || ' FY' || (1995 + doc_id % 7) || ' under N' || lpad(CAST(doc_id % 99991 AS VARCHAR), 5, '0') || '-23-'
        || ['C','D','F'][doc_id // 5 % 3 + 1] || '-' || lpad(CAST(doc_id % 9973 AS VARCHAR), 4, '0') || ' RDT&E amount $' || (1 + doc_id % 900) || '.5 '
        || ['K','M','B','in thousands'][doc_id % 4 + 1] ELSE text END, chr(10)),
      lambda line, i: CASE WHEN (i - 1) % 10 = 0 THEN '# ' WHEN (i - 1) % 10 = 5 THEN '## ' ELSE '' END || line
        || CASE WHEN doc_id % 7 = 2 AND (i - 1) % 4 = 3 THEN chr(12) ELSE '' END), chr(10)) AS text
  FROM documents""")

fragment("lines", """
  SELECT *, CAST(coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY line_no
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS line_start
  FROM (SELECT doc_id, contains(text, chr(12)) AS fed, unnest(range(len(ls))) AS line_no, unnest(ls) AS line
    FROM (SELECT *, string_split(text, chr(10)) AS ls FROM marked))""", "marked")

fragment("page", """
  SELECT *, start_char + length(text) AS end_char, first_line + nl AS last_line FROM (
    SELECT doc_id, page_no, text, nl, CAST(coalesce(sum(length(text) + 1) OVER before, 0) AS BIGINT) AS start_char,
      CAST(CASE WHEN fed THEN coalesce(sum(nl) OVER before, 0) ELSE (page_no - 1) * 5 END AS BIGINT) AS first_line
    FROM (SELECT *, length(text) - length(replace(text, chr(10), '')) AS nl FROM (
      SELECT doc_id, true AS fed, unnest(range(1, len(ps) + 1)) AS page_no, unnest(ps) AS text
        FROM (SELECT doc_id, string_split(text, chr(12)) AS ps FROM marked WHERE contains(text, chr(12)))
      UNION ALL SELECT doc_id, false, line_no // 5 + 1, string_agg(line, chr(10) ORDER BY line_no)
        FROM lines WHERE NOT fed GROUP BY ALL))
    WINDOW before AS (PARTITION BY doc_id ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""",
  "lines", "marked")

fragment("platform", """
  SELECT DISTINCT name, office FROM (
    SELECT l_suppkey AS office, unnest(CASE WHEN p_size >= 45 THEN [replace(p_brand, '#', ' ') || ' ' || p_name, p_name]
      ELSE [replace(p_brand, '#', ' ') || ' ' || p_name] END) AS name
    FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_linenumber = 3)""")

fragment("platform_mention", """
  WITH ws AS (SELECT doc_id, regexp_extract_all(lower(text || coalesce(chr(10) || 'Support for the ' || p_brand || ', ' || upper(p_name)
      || ' fleet.', '')), '[a-z0-9]+') AS w FROM documents LEFT JOIN part ON p_partkey = doc_id),
    spelled AS (SELECT DISTINCT array_to_string(regexp_extract_all(lower(name), '[a-z0-9]+'), ' ') AS gram FROM platform),
    every AS (SELECT doc_id, pos, n, array_to_string(w[pos:pos + n - 1], ' ') AS gram FROM (
      SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS pos
      FROM ws, (SELECT DISTINCT len(string_split(gram, ' ')) AS n FROM spelled))),
    hit AS (SELECT * FROM every SEMI JOIN spelled USING (gram))
  SELECT DISTINCT doc_id, gram FROM hit h WHERE NOT EXISTS (SELECT 1 FROM hit l WHERE l.doc_id = h.doc_id
    AND l.n > h.n AND l.pos <= h.pos AND l.pos + l.n >= h.pos + h.n)""", "platform")

fragment("registry", """
  SELECT source AS source_id, ['budget','forecasts','notices','awards','directory','doctrine'][n % 6 + 1] AS family,
    unnest([['organization','people'], ['agency_intent','planned'], ['active','people'], ['award','systems'],
     ['planned','active']][n % 5 + 1]) AS stage, 30 * (1 + n % 4) AS cadence_days,
    CASE WHEN n % 7 = 3 THEN 'restricted' ELSE 'public' END AS access, n_documents
  FROM (SELECT source, CAST(substr(source, 4) AS INTEGER) AS n, count(*) AS n_documents FROM documents GROUP BY source)""")
