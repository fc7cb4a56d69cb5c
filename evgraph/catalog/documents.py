"""Queries over documents, pages, chunks, facts and sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from evgraph.catalog.base import query
from evgraph.catalog.sql import fragment
from evgraph.operators import documents as docs, lineage, temporal
from evgraph.operators.identity import local_id
from evgraph.schema import SOURCE_STAGES
from evgraph.session import scratch_path, written
from evgraph.sources import derived
from evgraph.sources.graph_json import export_jsonl
from evgraph.sources.tables import Tables

FAMILIES = ["budget", "forecasts", "notices", "awards", "directory", "doctrine"]
CHECKED_ON = "2024-03-20"
SEARCH_TERMS = ["notice", "office", "amount", "the", "worthless"]


@query(
    "source_registry", "registry",
    sql="SELECT source_id, family, stage, cadence_days, access, n_documents FROM registry",
)
def source_registry(t: Tables) -> DataFrame:
    return docs.source_registry(derived.registry_raw(t))


@query(
    "source_staleness", "retrieval",
    sql=f"""SELECT source, cadence_days, strftime(last_at, '%Y-%m-%d') AS last_retrieved_on, n_documents, n_retrieved,
      DATE '{CHECKED_ON}' - last_at AS age_days,
      CASE WHEN last_at IS NULL THEN 'undated' WHEN DATE '{CHECKED_ON}' - last_at <= cadence_days THEN 'fresh' ELSE 'stale' END AS freshness
      FROM (SELECT d.source, 30 * (1 + any_value(CAST(substr(d.source, 4) AS INTEGER)) % 4) AS cadence_days,
          max(CAST(r.retrieved_at AS DATE)) FILTER (r.status = 'retrieved') AS last_at, count(*) AS n_documents,
          count(*) FILTER (r.status = 'retrieved') AS n_retrieved
        FROM documents d JOIN retrieval r ON r.doc_id = d.doc_id GROUP BY d.source)""",
)
def source_staleness(t: Tables) -> DataFrame:
    retrievals = derived.retrievals(t, "source")
    return temporal.source_staleness(derived.registry_raw(t), retrievals, CHECKED_ON)


FAMILY_SQL = ", ".join(f"count(DISTINCT source_id) FILTER (family = '{f}') AS {f}" for f in FAMILIES)


@query(
    "source_stage_coverage", "registry",
    sql=f"""SELECT s.stage, {FAMILY_SQL}, count(DISTINCT source_id) AS n_sources,
      CASE WHEN count(source_id) = 0 THEN 'none' ELSE 'covered' END AS coverage
      FROM (VALUES ('organization'), ('people'), ('agency_intent'), ('congressional'), ('planned'), ('systems'),
        ('active'), ('award')) AS s(stage) LEFT JOIN registry r ON r.stage = s.stage GROUP BY s.stage""",
)
def source_stage_coverage(t: Tables) -> DataFrame:
    registry = docs.source_registry(derived.registry_raw(t))
    return docs.stage_coverage(registry, SOURCE_STAGES, FAMILIES)


@query(
    "document_manifest", "retrieval",
    sql="""SELECT url, final_url, doc_id, discovered_on, strftime(published_on, '%Y-%m-%d') AS published_on, display_name, mime, size_bytes, sha256, status,
      strftime(first_at, '%Y-%m-%d %H:%M:%S') AS first_retrieved_at,
      strftime(retrieved_at, '%Y-%m-%d %H:%M:%S') AS retrieved_at, n_retrievals
      FROM (SELECT *, regexp_extract(url, '([^/]+)/?$', 1) AS display_name, strlen(text) AS size_bytes,
        sha256(text) AS sha256, min(retrieved_at) OVER (PARTITION BY url) AS first_at,
        count(*) OVER (PARTITION BY url) AS n_retrievals,
        row_number() OVER (PARTITION BY url ORDER BY retrieved_at DESC, doc_id DESC) AS r FROM retrieval) WHERE r = 1""",
)
def document_manifest(t: Tables) -> DataFrame:
    return docs.build_manifest(derived.retrievals(t))


@query(
    "document_revisions", "retrieval",
    sql="""SELECT url, doc_id, strftime(retrieved_at, '%Y-%m-%d %H:%M:%S') AS retrieved_at, sha256, changed,
      CAST(sum(CAST(changed AS INTEGER)) OVER (PARTITION BY url ORDER BY retrieved_at, doc_id) AS BIGINT) AS revision
      FROM (SELECT *, sha256(text) AS sha256, coalesce(sha256(text) <> lag(sha256(text)) OVER (PARTITION BY url
        ORDER BY retrieved_at, doc_id), true) AS changed FROM retrieval)""",
)
def document_revisions(t: Tables) -> DataFrame:
    return docs.revisions(derived.retrievals(t))


@query(
    "access_status_report", "retrieval",
    sql="""SELECT host, status, CAST(grouping(host, status) AS BIGINT) AS level, count(*) AS n_documents
      FROM (SELECT regexp_extract(url, '://([^/]+)', 1) AS host, status FROM retrieval)
      GROUP BY ROLLUP (host, status)""",
)
def access_status_report(t: Tables) -> DataFrame:
    return docs.access_report(derived.retrievals(t))


@query(
    "link_enumeration",
    sql=r"""WITH hrefs AS (
        SELECT page_id, url, regexp_extract(url, '^([A-Za-z]+://[^/?#]+)', 1) AS root, regexp_replace(replace(trim(
            unnest(regexp_extract_all(html || CASE WHEN page_id % 3 = 0 THEN '<a href=../d/./f' || page_id % 9 || '.pdf>u</a><A HREF = ''?p='
              || page_id % 5 || '#x''>q</A><a href="../../../g/../h?d=../e">h</a>' ELSE '' END,
              '(?i)[ \t\n\r\f"''/]href[ \t\n\r\f]*=[ \t\n\r\f]*("[^"]*"|''[^'']*''|[^ \t\n\r\f"''>]+)', 1)), '"'' '),
            '&amp;', '&'), '#.*$', '') AS href FROM pages),
      based AS (
        SELECT *, coalesce(nullif(substr(regexp_replace(url, '[?#].*$', ''), length(root) + 1), ''), '/') AS path,
          regexp_extract(href, '^[^?]*') AS target FROM hrefs
        WHERE href <> '' AND NOT regexp_matches(href, '(?i)^(mailto|javascript|tel|data):')),
      aimed AS (
        SELECT *, CASE WHEN href LIKE '/%' THEN target ELSE regexp_replace(path, '[^/]*$', '') || target END AS way FROM based),
      links AS (
        SELECT page_id, CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN href
          WHEN href LIKE '//%' THEN regexp_extract(url, '^([A-Za-z]+:)', 1) || href
          WHEN href LIKE '?%' THEN root || path || href
          ELSE root || list_reduce(string_split(way, '/')[2:], lambda done, step: CASE step WHEN '.' THEN done
              WHEN '..' THEN regexp_replace(done, '/[^/]*$', '') ELSE done || '/' || step END, '')
            || CASE WHEN regexp_matches(way, '(^|/)[.][.]?$') THEN '/' ELSE '' END || substr(href, length(target) + 1) END AS link
        FROM aimed)
      SELECT link, min(page_id) AS discovered_on, count(DISTINCT page_id) AS n_pages,
        regexp_matches(link, '(?i)\.(pdf|xlsx?|docx?|csv|zip)([?#]|$)') AS is_document
      FROM links WHERE link IS NOT NULL GROUP BY link""",
)
def link_enumeration(t: Tables) -> DataFrame:
    return docs.enumerate_links(derived.link_pages(t))


fragment("id_pattern", r"""
  SELECT * FROM (VALUES ('office_code', '\b(?:PMW|PMA|PMS|PEO)[ -]?[0-9]{3}\b'), ('program_element', '\b[0-9]{7}[A-Z]\b'),
    ('notice', '\b[A-Z][0-9]{5}-[0-9]{2}-[BQR]-[0-9]{4}\b'), ('contract', '\b[A-Z][0-9]{5}-[0-9]{2}-[CLP]-[0-9]{4}\b'),
    ('vehicle', '\b[A-Z][0-9]{5}-[0-9]{2}-[ADG]-[0-9]{4}\b'), ('award', '\b[A-Z][0-9]{5}-[0-9]{2}-F-[0-9]{4}\b'),
    ('activity_code', '\b[A-Z][0-9]{5}\b'), ('appropriation', '\b(?:RDT&E|O&M|MILCON|OPN|APN|SCN|WPN)\b'),
    ('fiscal_year', '\bFY ?[0-9]{4}\b')) AS p(kind, pattern)""")
fragment("heading", r"""
  SELECT doc_id, line_no, length(regexp_extract(line, '^(#+) ', 1)) AS level,
    regexp_replace(line, '^#+ +', '') AS title FROM lines WHERE regexp_matches(line, '^#+ ')""", "lines")
fragment("section", """
  SELECT doc_id, line_no, CASE WHEN level = 1 THEN title ELSE concat_ws(' > ', (
      SELECT arg_max(a.title, a.line_no) FROM heading a WHERE a.doc_id = h.doc_id AND a.level = 1 AND a.line_no < h.line_no),
    title) END AS path FROM heading h""", "heading")
fragment("piece", r"""
  SELECT doc_id, unnest(range(len(ps))) AS i, unnest(ps) AS piece FROM (
    SELECT doc_id, regexp_extract_all(text, '(?:\A[ \t\n\r\f]+)?[^ \t\n\r\f]+[ \t\n\r\f]*') AS ps FROM marked)""", "marked")
fragment("chunk_text", """
  SELECT doc_id, CAST(i // 200 AS INTEGER) AS chunk_no, count(*) AS token_count, string_agg(piece, '' ORDER BY i) AS text
  FROM piece GROUP BY ALL""", "piece")
fragment("chunk_span", r"""
  SELECT *, CASE WHEN fed THEN feeds_before + 1 ELSE start_line // 5 + 1 END AS start_page,
    CASE WHEN fed THEN end_feeds + 1 ELSE end_line // 5 + 1 END AS end_page, start_char + length(text) AS end_char FROM (
    SELECT *, start_line + length(body) - length(replace(body, chr(10), '')) AS end_line,
      feeds_before + length(body) - length(replace(body, chr(12), '')) AS end_feeds FROM (
      SELECT *, regexp_replace(text, '[ \t\n\r\f]+\z', '') AS body,
        bool_or(contains(text, chr(12))) OVER (PARTITION BY doc_id) AS fed,
        CAST(coalesce(sum(length(text) - length(replace(text, chr(10), ''))) OVER before, 0) AS BIGINT) AS start_line,
        CAST(coalesce(sum(length(text) - length(replace(text, chr(12), ''))) OVER before, 0) AS BIGINT) AS feeds_before,
        CAST(coalesce(sum(length(text)) OVER before, 0) AS BIGINT) AS start_char
      FROM chunk_text
      WINDOW before AS (PARTITION BY doc_id ORDER BY chunk_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))""",
  "chunk_text")


@query(
    "section_path", "lines", "section",
    sql="""SELECT doc_id, line_no, line, last_value(path IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no) AS section_path
      FROM lines LEFT JOIN section USING (doc_id, line_no)""",
)
def section_path(t: Tables) -> DataFrame:
    return docs.section_path(derived.marked_documents(t))


@query(
    "chunking", "chunk_span", "section",
    sql="""SELECT sha256(concat_ws('|', 'chunk', c.doc_id, chunk_no, 'v1')) AS chunk_id, c.doc_id, chunk_no, start_line,
      end_line, start_page, end_page, start_char, end_char, token_count,
      sha256(text) AS content_hash, 'v1' AS version, s.path AS section_path
      FROM chunk_span c ASOF LEFT JOIN section s ON c.doc_id = s.doc_id AND c.start_line >= s.line_no""",
)
def chunking(t: Tables) -> DataFrame:
    return docs.chunk(derived.marked_documents(t)).drop("text")


@query(
    "identifier_extraction", "page", "id_pattern",
    sql=r"""SELECT doc_id, page_no, kind, unnest(regexp_extract_all(text, pattern)) AS value FROM page,
      id_pattern""",
)
def identifier_extraction(t: Tables) -> DataFrame:
    return docs.extract_ids(docs.pages(derived.marked_documents(t)), "doc_id", "page_no")


@query(
    "contact_extraction", "page",
    sql=r"""SELECT doc_id, page_no, kind, lower(unnest(regexp_extract_all(text, pattern))) AS value FROM page,
      (VALUES ('email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}'),
        ('phone', '\(?\b[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}\b')) AS p(kind, pattern)""",
)
def contact_extraction(t: Tables) -> DataFrame:
    return docs.extract_contacts(docs.pages(derived.marked_documents(t)), "doc_id", "page_no")


@query(
    "money_normalisation", "page",
    sql=r"""WITH m AS (SELECT doc_id, page_no, unnest(regexp_extract_all(text,
        '\$ ?[0-9][0-9,]*(?:\.[0-9]+)?(?: ?(?:in thousands|in millions|thousand|million|billion|[KMB])\b)?')) AS match FROM page),
      u AS (SELECT *, regexp_extract(match, '[0-9] ?([A-Za-z][A-Za-z ]*)$', 1) AS unit FROM m)
      SELECT doc_id, page_no, match, unit, CAST(TRY_CAST(replace(regexp_extract(match, '([0-9][0-9,]*(?:\.[0-9]+)?)', 1),
        ',', '') AS DECIMAL(20,2)) * CAST(CASE WHEN unit IN ('K','thousand','in thousands') THEN 1000
        WHEN unit IN ('M','million','in millions') THEN 1000000 WHEN unit IN ('B','billion') THEN 1000000000 ELSE 1 END
        AS DECIMAL(12,0)) AS DOUBLE) AS amount FROM u""".replace("WITH m AS", ", m AS", 1),
)
def money_normalisation(t: Tables) -> DataFrame:
    return docs.money(docs.pages(derived.marked_documents(t)), "doc_id", "page_no")


@query(
    "page_segmentation", "page",
    sql="SELECT doc_id, page_no, first_line, last_line, start_char, end_char, text FROM page",
)
def page_segmentation(t: Tables) -> DataFrame:
    return docs.pages(derived.marked_documents(t))


@query(
    "chunk_reconstruction", "marked", "chunk_text",
    sql="""SELECT m.doc_id, count(chunk_no) AS n_chunks, sha256(any_value(m.text)) AS content_hash,
      sha256(string_agg(c.text, '' ORDER BY chunk_no)) AS rebuilt_hash,
      sha256(string_agg(c.text, '' ORDER BY chunk_no)) = sha256(any_value(m.text)) AS intact
      FROM marked m LEFT JOIN chunk_text c USING (doc_id) GROUP BY m.doc_id""",
)
def chunk_reconstruction(t: Tables) -> DataFrame:
    marked = derived.marked_documents(t)
    return docs.reconstruct(docs.chunk(marked), marked)


fragment("fact", r"""
  SELECT sha256(concat_ws('|', 'fact', doc_id, line_no, kind, value)) AS fact_id, doc_id, line_no, kind, value,
    CAST(min(line_start + coalesce(list_sum(list_transform(between[1:i], lambda x: length(x))), 0)
      + coalesce(list_sum(list_transform(vals[1:i - 1], lambda x: length(x))), 0)) AS BIGINT) AS start_char
  FROM (SELECT doc_id, line_no, line_start, kind, vals, between, unnest(range(1, len(vals) + 1)) AS i, unnest(vals) AS value
    FROM (SELECT doc_id, line_no, line_start, kind, regexp_extract_all(line, pattern) AS vals,
        regexp_split_to_array(line, pattern) AS between FROM lines,
      id_pattern))
  GROUP BY doc_id, line_no, kind, value""",
  "lines", "id_pattern")


@query(
    "evidence_lineage", "fact", "chunk_span", "page",
    sql="""SELECT sha256(concat_ws('|', 'assertion', fact_id)) AS assertion_id, fact_id, f.doc_id, line_no, f.start_char,
      chunk_no, sha256(c.text) AS content_hash, page_no
      FROM fact f JOIN chunk_span c ON c.doc_id = f.doc_id AND f.start_char >= c.start_char AND f.start_char < c.end_char
      JOIN page p ON p.doc_id = f.doc_id AND f.start_char >= p.start_char AND f.start_char < p.end_char""",
)
def evidence_lineage(t: Tables) -> DataFrame:
    marked = derived.marked_documents(t)
    facts = written(docs.facts(marked), "facts")
    assertions = facts.select(local_id("assertion", "fact_id").alias("assertion_id"), "fact_id")
    return lineage.trace(assertions, facts, docs.chunk(marked), docs.pages(marked))


@query(
    "passage_search", "page",
    sql=f"""SELECT doc_id, page_no, text AS passage, len(list_distinct(hits)) AS n_terms, len(hits) AS n_hits FROM (
      SELECT *, list_filter(regexp_extract_all(lower(text), '[a-z0-9]+'), lambda w: list_contains({SEARCH_TERMS}, w)) AS hits
      FROM page) WHERE len(hits) > 0""",
)
def passage_search(t: Tables) -> DataFrame:
    hits = docs.search(docs.pages(derived.marked_documents(t)), SEARCH_TERMS)
    return hits.select("doc_id", "page_no", F.col("text").alias("passage"), "n_terms", "n_hits")


@query(
    "export_jsonl", "retrieval", "chunk_text", "fact",
    sql="""SELECT 'manifest' AS export, count(DISTINCT url) AS n_lines, min(url) AS first_key, max(url) AS last_key FROM retrieval
      UNION ALL SELECT 'chunks', count(*), min(h), max(h) FROM
        (SELECT sha256(concat_ws('|', 'chunk', doc_id, chunk_no, 'v1')) AS h FROM chunk_text)
      UNION ALL SELECT 'facts', count(*), min(fact_id), max(fact_id) FROM fact""",
)
def export_exports(t: Tables) -> DataFrame:
    """Manifest, chunks and facts written as sorted JSON Lines and read back."""
    marked, out = derived.marked_documents(t), scratch_path(t.spark, "export")
    exports = {
        "manifest": (docs.build_manifest(derived.retrievals(t)), "url"),
        "chunks": (docs.chunk(marked), "chunk_id"),
        "facts": (docs.facts(marked), "fact_id"),
    }
    parts = []
    for name, (df, by) in exports.items():
        export_jsonl(df, f"{out}/{name}", [by])
        back = t.spark.read.schema(f"{by} string").json(f"{out}/{name}")
        parts.append(back.agg(
            F.count(F.lit(1)).alias("n_lines"), F.min(by).alias("first_key"), F.max(by).alias("last_key")
        ).select(F.lit(name).alias("export"), "n_lines", "first_key", "last_key"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
