"""Documents: retrieval history, pages, sections, chunks, extraction, search.

A document is one row, so cutting it up is a narrow step: arrays are built inside the
row and exploded, with no shuffle and no window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from evgraph.functions import text as tx
from evgraph.operators.identity import local_id
from evgraph.operators.ordered import ROWS, with_buckets, with_previous, with_running_sum
from evgraph.session import written

EXTRACTION_VERSION = "v1"


def build_manifest(retrievals: DataFrame) -> DataFrame:
    """The latest retrieval per URL, with the address it ended at and its publication date (null where unknown). Size
    and hash are taken before the shuffle, so the text itself never moves."""
    light = retrievals.select(
        "url", "final_url", "doc_id", "discovered_on", "published_on", "retrieved_at", "status", "mime",
        F.regexp_extract("url", "([^/]+)/?$", 1).alias("display_name"),
        F.octet_length("text").alias("size_bytes"), F.sha2("text", 256).alias("sha256"),
    )
    newest = F.struct("retrieved_at", "doc_id")
    kept = F.struct(
        "final_url", "doc_id", "discovered_on", "published_on", "display_name", "mime", "size_bytes", "sha256", "status"
    )
    return light.groupBy("url").agg(
        F.max_by(kept, newest).alias("_latest"),
        F.min("retrieved_at").alias("first_retrieved_at"),
        F.max("retrieved_at").alias("retrieved_at"),
        F.count(F.lit(1)).alias("n_retrievals"),
    ).select("url", "_latest.*", "first_retrieved_at", "retrieved_at", "n_retrievals")


def revisions(retrievals: DataFrame, rows: int = ROWS) -> DataFrame:
    """Retrievals with a revision number that grows only when the content hash changes.
    The history of a URL of more than ``rows`` retrievals is cut at its own quantiles, so it spreads over tasks
    even where all of it lies in one day."""
    order = ["retrieved_at", "doc_id"]
    # hashed once: the ordered passes below read the light table several times
    light = written(retrievals.select("url", "doc_id", "retrieved_at", F.sha2("text", 256).alias("sha256")), "hashes")
    light = written(with_buckets(light, ["url"], order, "_part", rows), "parts")
    compared = with_previous(light, ["url"], order, "sha256", F.col("_part"), "_previous")
    compared = compared.withColumn(
        "changed", F.coalesce(F.col("sha256") != F.col("_previous"), F.lit(True))
    ).withColumn("_step", F.col("changed").cast("int"))
    return with_running_sum(compared, ["url"], order, "_step", F.col("_part"), "revision").drop("_previous", "_step", "_part")


def access_report(retrievals: DataFrame) -> DataFrame:
    """Counts per host and status, with host totals and the grand total."""
    hosted = retrievals.select(F.regexp_extract("url", "://([^/]+)", 1).alias("host"), "status")
    return hosted.rollup("host", "status").agg(
        F.grouping_id().alias("level"), F.count(F.lit(1)).alias("n_documents")
    )


def _without_dots(path: Column) -> Column:
    """An absolute path without ``.`` and ``..`` segments; ``..`` at the root stays there."""
    steps = F.slice(F.split(path, "/", -1), F.lit(2), F.greatest(F.size(F.split(path, "/", -1)) - 1, F.lit(0)))

    def walk(done: Column, step: Column) -> Column:
        up = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(step == ".", done).when(step == "..", up).otherwise(F.array_append(done, step))

    kept = F.aggregate(steps, F.array().cast("array<string>"), walk)
    kept = F.when(path.rlike(r"(^|/)\.\.?$"), F.array_append(kept, F.lit(""))).otherwise(kept)
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), F.concat(F.lit("/"), F.array_join(kept, "/"))).otherwise(path)


def enumerate_links(pages: DataFrame) -> DataFrame:
    """Links on fetched pages, resolved against the page and deduplicated, first inside
    each page, then over all of them.

    A link may be quoted or bare, in either case of ``href``. Fragments go; a link that is a fragment alone is the page
    itself and no link. Dot segments are resolved in relative links; a query alone keeps the page's path. Pages without
    a URL give their absolute links."""
    bare = F.regexp_replace("url", "[?#].*$", "")
    root = F.regexp_extract("url", "^([A-Za-z]+://[^/?#]+)", 1)
    path = F.coalesce(F.nullif(F.substr(bare, F.length(root) + 1), F.lit("")), F.lit("/"))
    space = r"[ \t\n\r\f]"
    pattern = rf"""(?i)[ \t\n\r\f"'/]href{space}*={space}*("[^"]*"|'[^']*'|[^ \t\n\r\f"'>]+)"""

    def cleaned(raw: Column) -> Column:
        href = F.replace(F.btrim(raw, F.lit("\"' ")), F.lit("&amp;"), F.lit("&"))
        return F.regexp_replace(href, "(?s)#.*$", "")

    hrefs = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(pattern), F.lit(1)), cleaned))
    hrefs = F.filter(hrefs, lambda href: (href != "") & ~href.rlike("(?i)^(mailto|javascript|tel|data):"))

    def resolved(href):
        target = F.regexp_extract(href, "^[^?]*", 0)
        query = F.substr(href, F.length(target) + 1)
        folder = F.regexp_replace("_path", "[^/]*$", "")
        way = F.when(href.startswith("/"), target).otherwise(F.concat(folder, target))
        return (
            F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), href)
            .when(href.startswith("//"), F.concat(F.regexp_extract("url", "^([A-Za-z]+:)", 1), href))
            .when(href.startswith("?"), F.concat("_root", "_path", href))
            .otherwise(F.concat("_root", _without_dots(way), query))
        )

    based = pages.select("page_id", "url", root.alias("_root"), path.alias("_path"), hrefs.alias("_hrefs"))
    return (
        based.select("page_id", F.explode(F.array_distinct(F.transform("_hrefs", resolved))).alias("link"))
        .where(F.col("link").isNotNull())
        .groupBy("link")
        .agg(F.min("page_id").alias("discovered_on"), F.count(F.lit(1)).alias("n_pages"))
        .withColumn("is_document", F.col("link").rlike(r"(?i)\.(pdf|xlsx?|docx?|csv|zip)([?#]|$)"))
    )


def pages(documents: DataFrame, lines_per_page: int = 5) -> DataFrame:
    """Numbered pages, empty ones kept. Form feeds separate pages where a text has
    them; other texts are paged by line count. Lines are those of the whole text, so a line
    that holds a form feed lies on both pages; every character but the separators lies on one, from ``start_char``
    up to ``end_char``."""
    by_feed = F.split("text", "\f", -1)

    def by_lines(all_lines):
        last = F.floor((F.size(all_lines) - 1) / lines_per_page).cast("int")
        return F.transform(
            F.sequence(F.lit(0), last),
            lambda p: F.array_join(F.slice(all_lines, p * lines_per_page + 1, F.lit(lines_per_page)), "\n"),
        )

    by_count = tx.let(tx.lines(F.col("text")), by_lines)
    fed = F.contains("text", F.lit("\f"))
    cut = F.when(fed, by_feed).otherwise(by_count)

    def numbered(parts, breaks_before, chars_before):
        def one(part, p):
            first, start = F.when(fed, breaks_before(p)).otherwise(p * lines_per_page), chars_before(p)
            return F.struct(
                (p + 1).alias("page_no"), first.alias("first_line"), (first + tx.newlines(part)).alias("last_line"),
                start.alias("start_char"), (start + F.length(part)).alias("end_char"), part.alias("text"),
            )

        return F.transform(parts, one)

    def sums(parts, measure, body):
        return tx.let(F.transform(parts, measure), lambda values: tx.with_prefix_sums(values, body))

    numbered_pages = tx.let(cut, lambda parts: sums(
        parts, tx.newlines, lambda breaks: sums(parts, lambda part: F.length(part) + 1, lambda chars: numbered(parts, breaks, chars))
    ))
    return documents.select("doc_id", F.inline(numbered_pages))


def section_path(documents: DataFrame) -> DataFrame:
    """Every line with the path of the heading in force; null before the first one."""
    opening = F.array(F.struct(F.lit(0).alias("line_no"), F.lit(None).cast("string").alias("path")))

    def opened(marks):
        first = F.coalesce(F.get(marks, F.lit(0))["line_no"], F.lit(-1))
        return F.when(first == 0, marks).otherwise(F.concat(opening, marks))

    def cut(all_lines, starts):
        def section(start, i):
            stop = F.coalesce(F.get(starts, i + 1)["line_no"], F.size(all_lines))
            return F.struct(
                start["line_no"].alias("first"), start["path"].alias("path"),
                F.slice(all_lines, start["line_no"] + 1, stop - start["line_no"]).alias("lines"),
            )

        return F.transform(starts, section)

    sections = tx.let(
        tx.lines(F.col("text")),
        lambda all_lines: tx.let(
            tx.let(tx.headings(F.col("text")), opened), lambda starts: cut(all_lines, starts)
        ),
    )
    return documents.select("doc_id", F.explode(sections).alias("s")).select(
        "doc_id", F.col("s.first").alias("_first"), F.col("s.path").alias("section_path"),
        F.posexplode("s.lines").alias("_i", "line"),
    ).select("doc_id", (F.col("_first") + F.col("_i")).alias("line_no"), "line", "section_path")


def chunk(documents: DataFrame, budget: int = 200, lines_per_page: int = 5, also: tuple[str, ...] = ()) -> DataFrame:
    """Chunks of ``budget`` words that join back to the exact text, each with its range of
    lines, pages and characters, section path, word count, content hash and extraction version; columns of
    ``also`` are those of the document."""
    def cut(pieces):
        last = F.floor((F.size(pieces) - 1) / budget).cast("int")
        whole = F.struct(F.lit(0).alias("tokens"), F.col("text").alias("text"))
        parts = F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
            lambda k: F.struct(
                F.least(F.lit(budget), F.size(pieces) - k * budget).alias("tokens"),
                F.array_join(F.slice(pieces, k * budget + 1, F.lit(budget)), "").alias("text"),
            ),
        )
        return F.when(F.size(pieces) == 0, F.array(whole)).otherwise(parts)

    def described(parts, line_before, feed_before, char_before, heading_at):
        def one(part, k):
            body = F.regexp_replace(part["text"], r"[ \t\n\r\f]+\z", "")
            page = lambda line, feeds: F.when(fed, feeds + 1).otherwise(F.floor(line / lines_per_page) + 1)
            return tx.let(F.struct(line_before(k).alias("line"), feed_before(k).alias("feeds"), char_before(k).alias("char")), lambda at: F.struct(
                k.alias("chunk_no"), at["line"].alias("start_line"), (at["line"] + tx.newlines(body)).alias("end_line"),
                page(at["line"], at["feeds"]).alias("start_page"),
                page(at["line"] + tx.newlines(body), at["feeds"] + tx.feeds(body)).alias("end_page"),
                at["char"].alias("start_char"), (at["char"] + F.length(part["text"])).alias("end_char"),
                heading_at(at["line"]).alias("section_path"), part["tokens"].alias("token_count"), part["text"].alias("text"),
            ))

        return F.transform(parts, one)

    def sums(parts, measure, body):
        return tx.let(F.transform(parts, lambda part: measure(part["text"])), lambda values: tx.with_prefix_sums(values, body))

    fed = F.contains("text", F.lit("\f"))
    pieces = F.regexp_extract_all("text", F.lit(tx.PIECE_PATTERN), F.lit(0))
    chunks = tx.let(tx.let(pieces, cut), lambda parts: tx.let(tx.headings(F.col("text")), lambda marks: sums(
        parts, tx.newlines, lambda line_before: sums(parts, tx.feeds, lambda feed_before: sums(
            parts, F.length, lambda char_before: tx.with_heading_at(
                marks, lambda heading_at: described(parts, line_before, feed_before, char_before, heading_at)
            )
        ))
    )))
    rows = documents.select("doc_id", *also, F.inline(chunks))
    return rows.select(
        local_id("chunk", "doc_id", "chunk_no", F.lit(EXTRACTION_VERSION)).alias("chunk_id"), "doc_id", "chunk_no",
        "start_line", "end_line", "start_page", "end_page", "start_char", "end_char", "section_path", "token_count",
        F.sha2("text", 256).alias("content_hash"), F.lit(EXTRACTION_VERSION).alias("version"), "text", *also,
    )


def reconstruct(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """Whether each document's ordered chunks give its text back, by hash. A group is
    one document, which was one row before it was cut."""
    rebuilt = chunks.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_chunks"),
        F.sha2(
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_no", "text"))), lambda c: c["text"]), ""),
            256,
        ).alias("rebuilt_hash"),
    )
    hashes = documents.select("doc_id", F.sha2("text", 256).alias("content_hash"))
    return hashes.join(rebuilt, "doc_id", "left").withColumn(
        "intact", F.coalesce(F.col("rebuilt_hash") == F.col("content_hash"), F.lit(False))
    )


def extract(texts: DataFrame, patterns: dict[str, str], *place: str) -> DataFrame:
    """One row per pattern match, with the ``place`` columns it was found at."""
    return texts.select(*place, F.inline(tx.found(F.col("text"), patterns)))


def extract_ids(texts: DataFrame, *place: str) -> DataFrame:
    return extract(texts, tx.IDENTIFIER_PATTERNS, *place)


def extract_contacts(texts: DataFrame, *place: str) -> DataFrame:
    return extract(texts, tx.CONTACT_PATTERNS, *place).withColumn("value", F.lower("value"))


def money(texts: DataFrame, *place: str) -> DataFrame:
    matches = F.regexp_extract_all("text", F.lit(tx.MONEY_PATTERN), F.lit(0))
    match = F.col("match")
    return texts.select(*place, F.explode(matches).alias("match")).select(
        *place, "match", tx.money_unit(match).alias("unit"), tx.money_amount(match).alias("amount")
    )


def facts(documents: DataFrame, with_line: bool = False, kinds: Sequence[str] | None = None) -> DataFrame:
    """Identifiers found in each line, each once, with a deterministic fact id and the characters it spans;
    ``with_line`` adds the line itself, ``kinds`` looks for some kinds only."""
    patterns = {kind: tx.IDENTIFIER_PATTERNS[kind] for kind in kinds or tx.IDENTIFIER_PATTERNS}

    def started(all_lines):
        return tx.let(F.transform(all_lines, lambda line: F.length(line) + 1), lambda sizes: tx.with_prefix_sums(
            sizes, lambda before: F.transform(all_lines, lambda line, i: F.struct(i.alias("line_no"), before(i).alias("start"), line.alias("text")))
        ))

    by_line = documents.select("doc_id", F.inline(tx.let(tx.lines(F.col("text")), started)))
    # one look tells whether a line holds any identifier; only such lines are searched kind by kind
    by_line = by_line.where(F.col("text").rlike("|".join(f"(?:{p})" for p in patterns.values())))
    hits = by_line.select("doc_id", "line_no", "start", F.col("text").alias("line"), F.inline(tx.found_at(F.col("text"), patterns)))
    start = F.col("start") + F.col("at")
    return hits.select(
        local_id("fact", "doc_id", "line_no", "kind", "value").alias("fact_id"), "doc_id", "line_no", "kind", "value",
        start.alias("start_char"), (start + F.length("value")).alias("end_char"), *(["line"] if with_line else []),
    )


def search(passages: DataFrame, terms: list[str]) -> DataFrame:
    """Passages holding any of the terms, with how many terms and how often. One pass
    over the passages; the terms are constants of the scan stage."""
    wanted = F.array(*[F.lit(term.lower()) for term in terms])
    hits = F.filter(tx.words(F.col("text")), lambda w: F.array_contains(wanted, w))
    return (
        passages.withColumn("_hits", hits)
        .where(F.size("_hits") > 0)
        .withColumn("n_terms", F.size(F.array_distinct("_hits")))
        .withColumn("n_hits", F.size("_hits"))
        .drop("_hits")
    )


def source_registry(raw: DataFrame) -> DataFrame:
    """One row per source and stage it covers."""
    return raw.select(
        "source_id", "family", F.explode("stages").alias("stage"), "cadence_days", "access", "n_documents"
    )


def stage_coverage(registry: DataFrame, stages: tuple[str, ...], families: list[str]) -> DataFrame:
    """Per stage, sources per family and all sources, of whatever family; stages without a
    source are kept and marked."""
    spark = registry.sparkSession
    every = spark.createDataFrame([(s,) for s in stages], "stage string")
    wide = registry.groupBy("stage").agg(
        *[F.countDistinct(F.when(F.col("family") == f, F.col("source_id"))).alias(f) for f in families],
        F.countDistinct("source_id").alias("n_sources"),
    )
    counted = every.join(wide, "stage", "left").select(
        "stage", *[F.coalesce(c, F.lit(0)).alias(c) for c in (*families, "n_sources")]
    )
    return counted.withColumn(
        "coverage", F.when(F.col("n_sources") == 0, "none").otherwise("covered")
    )
