"""Evidence-graph tables derived from the given ones, defects included.

The given tables are clean, so unknown types, dangling ends and missing evidence are
planted by rule; FIXTURES.md lists the rules and the counts they must give.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from evgraph.sources.tables import Tables


def key(prefix: str, col: str) -> Column:
    return F.concat(F.lit(f"{prefix}:"), F.col(col).cast("string"))


def nodes(t: Tables) -> DataFrame:
    s = F.col("s_suppkey")
    office_type = (
        F.when(s % 17 == 3, "vendor").when(s % 17 == 5, F.lit(None)).otherwise(F.lit("program_office"))
    )

    def of(df: DataFrame, node_id: Column, node_type: Column | str, name: Column) -> DataFrame:
        kind = F.lit(node_type) if isinstance(node_type, str) else node_type
        return df.select(node_id.alias("id"), kind.alias("type"), name.alias("name"))

    award = F.concat(key("award", "l_orderkey"), F.lit("-"), F.col("l_linenumber").cast("string"))
    parts = [
        of(t.region, key("agency", "r_regionkey"), "agency", F.col("r_name")),
        of(t.nation, key("subagency", "n_nationkey"), "subagency", F.col("n_name")),
        of(t.supplier.where(s % 29 != 7), key("office", "s_suppkey"), office_type, F.col("s_name")),
        of(t.customer, key("contracting", "c_custkey"), "contracting_office", F.col("c_name")),
        of(t.part, key("program", "p_partkey"), "program", F.col("p_name")),
        of(t.orders, key("solicitation", "o_orderkey"), "solicitation", F.col("o_orderpriority")),
        of(t.lineitem, award, "award", F.col("l_linestatus")),
        of(t.part.select("p_brand").distinct(), key("company", "p_brand"), "company", F.col("p_brand")),
        of(
            t.events.select("user_id").distinct(), key("person", "user_id"), "person",
            F.col("user_id").cast("string"),
        ),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# Relationship type by line number 1 to 7; the last is an unknown type.
EDGE_TYPES = ("owns_mission", "owns_program", "funds", "procures_for", "administers", "holds", "cites")


def edges(t: Tables) -> DataFrame:
    line, planted = F.col("l_linenumber"), F.col("l_quantity") == 50
    url = F.concat(F.lit("https://example.invalid/order/"), F.col("l_orderkey").cast("string"))
    confidence = F.round(1 - F.col("l_discount"), 2).cast("string")
    return t.lineitem.select(
        key("office", "l_suppkey").alias("src"),
        key("program", "l_partkey").alias("dst"),
        F.element_at(F.array(*[F.lit(x) for x in EDGE_TYPES]), line).alias("type"),
        F.struct(
            F.when(planted & (line == 1), "").otherwise(url).alias("source_url"),
            F.when(~(planted & (line == 2)), F.date_format("l_shipdate", "yyyy-MM-dd")).alias("observed_at"),
            F.when(planted & (line == 3), F.lit(None))
            .when(planted & (line == 4), "")
            .otherwise(confidence)
            .alias("confidence"),
        ).alias("evidence"),
    )


# Evidence kind by line number 1 to 7; the first three are decisive.
LINE_KINDS = (
    "explicit_owner", "office_code", "poc_context", "contracting_office", "industry_code", "notice_prefix",
    "semantic",
)


def opportunities(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("opp"),
        F.to_date("o_orderdate").alias("published_at"),
        F.col("o_custkey").alias("contracting"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("method"),
    )


def evidence(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("opp"),
        F.col("l_suppkey").alias("office"),
        F.element_at(F.array(*[F.lit(k) for k in LINE_KINDS]), F.col("l_linenumber")).alias("kind"),
        F.round(1 - F.col("l_discount"), 2).cast("decimal(4,2)").alias("confidence"),
        F.to_date("l_shipdate").alias("available_at"),
        (F.col("l_returnflag") == "R").alias("refutes"),
        F.col("l_partkey").alias("doc_id"),
        F.col("l_linestatus").alias("line_status"),
    )


def dated_evidence(t: Tables) -> DataFrame:
    """Evidence with the date its opportunity was published; the only form that needs the join."""
    return evidence(t).join(opportunities(t).select("opp", "published_at"), "opp")


def org_versions(t: Tables) -> DataFrame:
    """First version closes in 1998; every tenth office has no second one."""
    s = F.col("s_suppkey")
    switch = F.date_add(F.lit("1998-01-01").cast("date"), (s % 365).cast("int"))
    first = F.struct(
        F.lit(1).alias("version"), F.concat("s_name", F.lit(" v1")).alias("name"),
        F.lit("1995-01-01").cast("date").alias("valid_from"), switch.alias("valid_to"),
    )
    second = F.struct(
        F.lit(2).alias("version"), F.concat("s_name", F.lit(" v2")).alias("name"),
        switch.alias("valid_from"), F.lit(None).cast("date").alias("valid_to"),
    )
    versions = F.when(s % 10 == 9, F.array(first)).otherwise(F.array(first, second))
    return t.supplier.select(s.alias("office"), F.explode(versions).alias("v")).select("office", "v.*")


def assertions(t: Tables) -> DataFrame:
    """``program owned_by office`` from all ownership lines, those of decisive kinds, valid 180 days."""
    start = F.to_date("l_shipdate")
    natural = F.concat_ws(
        "|", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.date_format("l_shipdate", "yyyy-MM-dd")
    )
    return t.lineitem.where(F.col("l_linenumber") <= 3).select(
        F.sha2(natural, 256).alias("id"),
        F.col("l_partkey").alias("subject"),
        F.lit("owned_by").alias("predicate"),
        F.col("l_suppkey").alias("object"),
        start.alias("valid_from"),
        F.date_add(start, 180).alias("valid_to"),
        F.round(1 - F.col("l_discount"), 2).cast("decimal(4,2)").alias("confidence"),
        F.col("l_partkey").alias("doc_id"),
    )


# Role by line number; the customer of the order is the contracting office.
LINE_ROLES = ("owner", "owner", "owner", "program_management", "funding", "technical", "award")


def role_assertions(t: Tables) -> DataFrame:
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("opp"),
        F.element_at(F.array(*[F.lit(r) for r in LINE_ROLES]), F.col("l_linenumber")).alias("role"),
        F.col("l_suppkey").alias("office"),
    )
    buyers = t.orders.select(
        F.col("o_orderkey").alias("opp"), F.lit("contracting").alias("role"), F.col("o_custkey").alias("office")
    )
    return lines.unionByName(buyers)


def identifiers(t: Tables) -> DataFrame:
    """Identifiers as three sources spell them: office codes that collide above ninety
    offices, activity codes shared by every office of a nation, a second code for some."""
    s = F.col("s_suppkey")
    code = (100 + s % 90).cast("string")
    supplier = t.supplier
    directory = supplier.select(
        key("office", "s_suppkey").alias("entity"), F.lit("directory").alias("source"),
        F.lit("office_code").alias("kind"),
        F.when(s % 2 == 0, F.concat(F.lit("pmw "), code)).otherwise(F.concat(F.lit(" Pmw-"), code, F.lit(" ")))
        .alias("value_raw"),
    )
    second = supplier.where(s % 13 == 6).select(
        key("office", "s_suppkey").alias("entity"), F.lit("directory").alias("source"),
        F.lit("office_code").alias("kind"),
        F.concat(F.lit("PMW/"), (200 + s % 90).cast("string")).alias("value_raw"),
    )
    activity = supplier.select(
        key("office", "s_suppkey").alias("entity"), F.lit("directory").alias("source"),
        F.lit("activity_code").alias("kind"),
        F.concat(F.lit("n"), F.lpad(F.col("s_nationkey").cast("string"), 5, "0")).alias("value_raw"),
    )
    awards = t.lineitem.select(
        F.concat(key("award", "l_orderkey"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("entity"),
        F.lit("award").alias("source"), F.lit("office_code").alias("kind"),
        F.concat(F.lit("PMW-"), (100 + F.col("l_suppkey") % 90).cast("string")).alias("value_raw"),
    )
    return directory.unionByName(second).unionByName(activity).unionByName(awards)


def org_parents(t: Tables) -> DataFrame:
    offices = t.supplier.select(key("office", "s_suppkey").alias("child"), key("subagency", "s_nationkey").alias("parent"))
    subagencies = t.nation.select(
        key("subagency", "n_nationkey").alias("child"), key("agency", "n_regionkey").alias("parent")
    )
    award = F.concat(key("award", "l_orderkey"), F.lit("-"), F.col("l_linenumber").cast("string"))
    awards = t.lineitem.select(award.alias("child"), key("office", "l_suppkey").alias("parent")).distinct()
    return offices.unionByName(subagencies).unionByName(awards)


def path_edges(t: Tables) -> DataFrame:
    """One edge per line, by its number, with exact decimal confidence: solicitations lead to offices and, skipping
    them, to programs; offices to programs and back; both to the contracting office of the order, the buyer."""
    confidence = F.round(1 - F.col("l_discount"), 2).cast("decimal(4,2)")
    ends = {
        "solicitation": key("solicitation", "l_orderkey"), "office": key("office", "l_suppkey"),
        "program": key("program", "l_partkey"), "contracting_office": key("contracting", "o_custkey"),
    }
    # The types an edge joins, by line number.
    kinds = {
        1: ("solicitation", "office"), 2: ("solicitation", "office"), 3: ("office", "program"), 4: ("office", "contracting_office"),
        5: ("program", "office"), 6: ("solicitation", "program"), 7: ("program", "contracting_office"),
    }

    def joined(lines: DataFrame, numbers: list[int]) -> DataFrame:
        def pick(value):
            cases = [F.when(F.col("l_linenumber") == n, value(kinds[n])) for n in numbers]
            return F.coalesce(*cases)

        return lines.where(F.col("l_linenumber").isin(*numbers)).select(
            pick(lambda k: F.lit(k[0])).alias("src_type"), pick(lambda k: ends[k[0]]).alias("src"),
            pick(lambda k: F.lit(k[1])).alias("dst_type"), pick(lambda k: ends[k[1]]).alias("dst"), confidence.alias("confidence"),
        )

    bought = [n for n, k in kinds.items() if k[1] == "contracting_office"]
    buyers = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return joined(t.lineitem, [n for n in kinds if n not in bought]).unionByName(
        joined(t.lineitem.where(F.col("l_linenumber").isin(*bought)).join(buyers, "l_orderkey"), bought)
    )


def name_records(t: Tables) -> DataFrame:
    """Supplier names from two sources; the second is upper case, spells ``#`` as a
    space and drops the fourth character for every third supplier."""
    s, name = F.col("s_suppkey"), F.col("s_name")
    first = t.supplier.select(
        F.concat(F.lit("a:"), s.cast("string")).alias("record"), F.lit("registry").alias("source"),
        name.alias("name"), F.col("s_nationkey").alias("block"),
    )
    spelled = F.regexp_replace(F.upper(name), "#", " ")
    dropped = F.concat(F.substring(spelled, 1, 3), F.substr(spelled, F.lit(5)))
    second = t.supplier.select(
        F.concat(F.lit("b:"), s.cast("string")).alias("record"), F.lit("notices").alias("source"),
        F.when(s % 3 == 0, dropped).otherwise(spelled).alias("name"), F.col("s_nationkey").alias("block"),
    )
    return first.unionByName(second)


def contact_observations(t: Tables) -> DataFrame:
    # The raw title seen with each event type.
    titles = {
        "purchase": "Program Manager",
        "signup": "Contracting Officer",
        "click": "Technical Lead",
        "view": "Director",
        "error": "Small Business Liaison",
    }
    # What each event type shows about the person; None is a title only.
    signals = {
        "purchase": "owns_program",
        "signup": "signs_contracts",
        "click": "technical_contact",
        "view": None,
        "error": "industry_engagement",
    }
    kind = F.col("event_type")
    title = signal = None
    for name in titles:
        title = F.when(kind == name, titles[name]) if title is None else title.when(kind == name, titles[name])
        signal = (
            F.when(kind == name, F.lit(signals[name])) if signal is None
            else signal.when(kind == name, F.lit(signals[name]))
        )
    return t.events.select(
        F.col("event_id").alias("obs"),
        F.col("user_id").alias("person"),
        (F.col("user_id") % 10).alias("office"),
        title.alias("raw_title"),
        signal.alias("signal"),
        F.col("ts").alias("seen_at"),
        F.to_date("ts").alias("observed_at"),
    )


def procurements(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_orderpriority", "o_custkey", "o_orderstatus")
    parts = t.part.select("p_partkey", "p_brand", "p_name", "p_type")
    return (
        t.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("l_suppkey").alias("office"),
            F.col("p_brand").alias("program"),
            F.col("p_name").alias("scope"),
            F.col("p_type").alias("element"),
            F.col("o_orderpriority").alias("method"),
            F.col("o_custkey").alias("contracting"),
            F.to_date("l_shipdate").alias("event_at"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("value"),
            F.col("o_orderstatus").alias("status"),
            F.col("l_returnflag").alias("flag"),
            F.col("l_orderkey").alias("notice"),
        )
    )


def stage_records(t: Tables) -> DataFrame:
    """One row per identifier and stage reached, dated around the order."""
    at, status = F.to_date("o_orderdate"), F.col("o_orderstatus")
    stages = F.array(
        F.when(F.col("o_orderkey") % 4 != 0, F.struct(F.lit("forecast").alias("stage"), F.date_sub(at, 90).alias("at"))),
        F.struct(F.lit("notice").alias("stage"), at.alias("at")),
        F.when(status.isin("F", "P"), F.struct(F.lit("award").alias("stage"), F.date_add(at, 60).alias("at"))),
        F.when(status == "F", F.struct(F.lit("modification").alias("stage"), F.date_add(at, 200).alias("at"))),
    )
    return (
        t.orders.select(F.col("o_orderkey").alias("identifier"), F.explode(F.array_compact(stages)).alias("s"))
        .select("identifier", "s.*")
    )


def fiscal_years(t: Tables) -> tuple[int, ...]:
    """Every year from the first to the last in which anything was shipped."""
    year = F.year("l_shipdate")
    span = t.lineitem.agg(F.min(year).alias("first"), F.max(year).alias("last")).first()
    return tuple(range(span["first"], span["last"] + 1)) if span["first"] is not None else ()


def budget_wide(t: Tables, years: Sequence[int]) -> DataFrame:
    """One row per office and element, one column per fiscal year, amounts in units."""
    parts = t.part.select("p_partkey", "p_type")
    rows = t.lineitem.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    year, amount = F.year("l_shipdate"), F.col("l_extendedprice").cast("decimal(18,2)")
    office = F.col("office")
    return (
        rows.groupBy(F.col("l_suppkey").alias("office"), F.col("p_type").alias("element"))
        .agg(*[F.sum(F.when(year == y, amount)).cast("decimal(20,2)").alias(f"fy{y}") for y in years])
        .select(
            "office", F.concat(F.lit("approp-"), (office % 5).cast("string")).alias("appropriation"), "element",
            F.concat("element", F.lit("-"), (office % 3).cast("string")).alias("project"),
            F.when(office % 2 == 0, "K").otherwise("M").alias("unit"), *[f"fy{y}" for y in years],
        )
    )


def retrievals(t: Tables, *also: str) -> DataFrame:
    d = F.col("doc_id")
    host = F.concat(F.lit("https://"), F.col("source"), F.lit(".example.invalid/"))
    status = (
        F.when(d % 11 <= 5, "retrieved").when(d % 11 == 6, "authenticated").when(d % 11 == 7, "expired")
        .when(d % 11 == 8, "missing").when(d % 11 == 9, "blocked").otherwise("manual")
    )
    return t.documents.select(
        d.alias("doc_id"),
        F.concat(host, (d % 7).cast("string")).alias("url"),
        F.when(d % 13 == 4, F.concat(host, F.lit("archive/"), (d % 7).cast("string")))
        .otherwise(F.concat(host, (d % 7).cast("string"))).alias("final_url"),
        host.alias("discovered_on"),
        F.when(d % 9 != 4, F.date_add(F.lit("2023-01-01").cast("date"), (d % 300).cast("int"))).alias("published_on"),
        F.expr(
            "timestamp_ntz'2024-01-01 00:00:00'"
            " + make_dt_interval(cast(doc_id div 24 as int), cast(doc_id % 24 as int), 0, 0)"
        ).alias("retrieved_at"),
        status.alias("status"),
        F.lit("text/plain").alias("mime"),
        "text",
        *also,
    )


def platforms(t: Tables) -> DataFrame:
    """name, office: platforms by the brand and name of a program, and general ones by the name alone where the
    program is large, with the offices that hold such a program."""
    parts = t.part.select("p_partkey", "p_size", "p_name", F.concat(F.replace("p_brand", F.lit("#"), F.lit(" ")), F.lit(" "), F.col("p_name")).alias("_long"))
    holders = t.lineitem.where(F.col("l_linenumber") == 3).select(F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("office"))
    names = F.array_compact(F.array(F.col("_long"), F.when(F.col("p_size") >= 45, F.col("p_name"))))
    return holders.join(parts.select("p_partkey", F.explode(names).alias("name")), "p_partkey").select("name", "office").distinct()


def platform_documents(t: Tables) -> DataFrame:
    """Documents with a planted line that names the platform of the program of the same number."""
    names = t.part.select(F.col("p_partkey").alias("doc_id"), F.concat(F.lit("\nSupport for the "), "p_brand", F.lit(", "), F.upper("p_name"), F.lit(" fleet.")).alias("_line"))
    return t.documents.select("doc_id", "text").join(names, "doc_id", "left").select("doc_id", F.concat("text", F.coalesce("_line", F.lit(""))).alias("text"))


def marked_documents(t: Tables, *also: str) -> DataFrame:
    """Documents with planted headings and, in every fifth, a line of identifiers; columns of ``also`` are kept.

    Every tenth line becomes a heading, and the line midway between two a sub-heading. In every seventh document
    every fourth line ends in a form feed, and one splits the line of identifiers.
    """
    d = F.col("doc_id")

    def pad(col: Column, width: int) -> Column:
        return F.lpad(col.cast("string"), width, "0")

    unit = F.element_at(F.array(*[F.lit(u) for u in ("K", "M", "B", "in thousands")]), (d % 4 + 1).cast("int"))
    instrument = F.element_at(F.array(*[F.lit(x) for x in "CDF"]), (F.floor(d / 5) % 3 + 1).cast("int"))
    marker = F.concat(
        F.lit("\nOffice PMW-"), (100 + d % 90).cast("string"),
        F.lit(" element 0"), pad(d % 1000000, 6), F.lit("N notice N"), pad(d % 100000, 5), F.lit("-24-R-"),
        pad(d % 10000, 4), F.when(d % 7 == 2, F.lit("\f")).otherwise(F.lit("")), F.lit(" FY"), (1995 + d % 7).cast("string"), F.lit(" under N"), pad(d % 99991, 5), F.lit("-23-"), instrument, F.lit("-"), pad(d % 9973, 4), F.lit(" RDT&E amount $"),
        (1 + d % 900).cast("string"), F.lit(".5 "), unit,
    )
    text = F.when(d % 5 == 0, F.concat("text", marker)).otherwise(F.col("text"))
    mark = lambda i: F.when(i % 10 == 0, F.lit("# ")).when(i % 10 == 5, F.lit("## ")).otherwise(F.lit(""))
    end = lambda i: F.when((d % 7 == 2) & (i % 4 == 3), F.lit("\f")).otherwise(F.lit(""))
    headed = F.transform(F.split(text, "\n", -1), lambda line, i: F.concat(mark(i), line, end(i)))
    return t.documents.select("doc_id", *also, F.array_join(headed, "\n").alias("text"))


def link_pages(t: Tables) -> DataFrame:
    """Pages with three more links in every third: unquoted with dot segments, a query alone with a fragment, and one
    that climbs past the root and holds dots in its query."""
    p = F.col("page_id")
    more = F.concat(
        F.lit("<a href=../d/./f"), (p % 9).cast("string"), F.lit(".pdf>u</a><A HREF = '?p="), (p % 5).cast("string"),
        F.lit("#x'>q</A><a href=\"../../../g/../h?d=../e\">h</a>"),
    )
    return t.pages.select("page_id", "url", F.concat("html", F.when(p % 3 == 0, more).otherwise(F.lit(""))).alias("html"))


def registry_raw(t: Tables) -> DataFrame:
    """A registry entry per source that has documents; no source covers the
    congressional stage."""
    n = F.substring("source", 4, 9).cast("int")
    # Source families, by source number.
    families = F.array(*[F.lit(f) for f in ("budget", "forecasts", "notices", "awards", "directory", "doctrine")])
    # The stage pairs a source covers, by source number.
    pairs = (
        ("organization", "people"), ("agency_intent", "planned"), ("active", "people"), ("award", "systems"),
        ("planned", "active"),
    )
    stages = F.array(*[F.array(*[F.lit(s) for s in pair]) for pair in pairs])
    return t.documents.groupBy("source").agg(F.count(F.lit(1)).alias("n_documents")).select(
        F.col("source").alias("source_id"),
        F.element_at(families, (n % 6 + 1).cast("int")).alias("family"),
        F.element_at(stages, (n % 5 + 1).cast("int")).alias("stages"),
        (30 * (1 + n % 4)).alias("cadence_days"),
        F.when(n % 7 == 3, "restricted").otherwise("public").alias("access"),
        "n_documents",
    )
