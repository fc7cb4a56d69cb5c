"""Column expressions over text. All work inside the row that holds the text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# Identifier patterns by kind.
IDENTIFIER_PATTERNS = {
    "office_code": r"\b(?:PMW|PMA|PMS|PEO)[ -]?[0-9]{3}\b",
    "program_element": r"\b[0-9]{7}[A-Z]\b",
    # instrument numbers: activity code, year, a letter for the kind of instrument, serial
    "notice": r"\b[A-Z][0-9]{5}-[0-9]{2}-[BQR]-[0-9]{4}\b",
    "contract": r"\b[A-Z][0-9]{5}-[0-9]{2}-[CLP]-[0-9]{4}\b",
    "vehicle": r"\b[A-Z][0-9]{5}-[0-9]{2}-[ADG]-[0-9]{4}\b",
    "award": r"\b[A-Z][0-9]{5}-[0-9]{2}-F-[0-9]{4}\b",
    "activity_code": r"\b[A-Z][0-9]{5}\b",
    "appropriation": r"\b(?:RDT&E|O&M|MILCON|OPN|APN|SCN|WPN)\b",
    "fiscal_year": r"\bFY ?[0-9]{4}\b",
}
# Public contact channel patterns by kind.
CONTACT_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "phone": r"\(?\b[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}\b",
}
MONEY_PATTERN = (
    r"\$ ?[0-9][0-9,]*(?:\.[0-9]+)?(?: ?(?:in thousands|in millions|thousand|million|billion|[KMB])\b)?"
)
# Dollar scale by unit word.
MONEY_UNITS = {
    "K": 1_000, "thousand": 1_000, "in thousands": 1_000,
    "M": 1_000_000, "million": 1_000_000, "in millions": 1_000_000,
    "B": 1_000_000_000, "billion": 1_000_000_000,
}
WORD_PATTERN = "[a-z0-9]+"
# A word with the white space after it; the first also takes leading white space, so
# the pieces of a text always join back to the text.
PIECE_PATTERN = r"(?:\A[ \t\n\r\f]+)?[^ \t\n\r\f]+[ \t\n\r\f]*"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value computed once per row. A column used inside a higher-order
    function's lambda may otherwise be computed again for every element."""
    return F.transform(F.array(value), body)[0]


def lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0))


def found(text: Column, patterns: dict[str, str]) -> Column:
    """Array of (kind, value) for every match of every pattern."""
    def labelled(kind: str, pattern: str) -> Column:
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        return F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))

    hits = [labelled(kind, pattern) for kind, pattern in patterns.items()]
    return F.concat(*hits)


def found_at(text: Column, patterns: dict[str, str]) -> Column:
    """Array of (kind, value, at) of the distinct matches of every pattern, ``at`` being the characters before the
    first of equal ones. What lies between matches gives their places."""
    def placed(kind: str, pattern: str) -> Column:
        def located(values: Column, between: Column) -> Column:
            steps = F.transform(values, lambda v, i: F.length(v) + F.length(F.get(between, i)))
            return with_prefix_sums(steps, lambda before: F.transform(values, lambda v, i: F.struct(
                F.lit(kind).alias("kind"), v.alias("value"), (before(i) + F.length(F.get(between, i))).alias("at"))))

        return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda values: let(
            F.split(text, pattern, -1), lambda between: located(values, between)
        ))

    def first_of_equals(hits: Column) -> Column:
        same = lambda h, e: (h["kind"] == e["kind"]) & (h["value"] == e["value"])
        return F.filter(hits, lambda h, i: (i == 0) | ~same(h, F.get(hits, i - 1)))

    return let(F.array_sort(F.concat(*[placed(kind, pattern) for kind, pattern in patterns.items()])), first_of_equals)


def headings(text: Column) -> Column:
    """Array of (line_no, path) per heading. ``#`` opens a section, deeper marks a
    sub-section whose path starts with the section's heading."""
    numbered = F.transform(lines(text), lambda line, i: F.struct(i.alias("line_no"), line.alias("line")))
    marked = F.filter(numbered, lambda x: x["line"].rlike("^#+ "))
    marks = F.transform(
        marked,
        lambda x: F.struct(
            x["line_no"].alias("line_no"),
            F.length(F.regexp_extract(x["line"], r"^(#+) ", 1)).alias("level"),
            F.regexp_replace(x["line"], r"^#+ +", "").alias("title"),
        ),
    )

    def titled(part: Column) -> Column:
        top = F.get(part, F.lit(0))
        section = F.when(top["level"] == 1, top["title"])
        return F.transform(part, lambda m: F.struct(
            m["line_no"].alias("line_no"),
            F.when(m["level"] == 1, m["title"]).otherwise(F.concat_ws(" > ", section, m["title"])).alias("path"),
        ))

    def by_section(every: Column) -> Column:
        at = F.transform(every, lambda m, i: F.when(m["level"] == 1, i))
        return let(F.array_union(F.array(F.lit(0)), F.array_compact(at)), lambda starts: F.flatten(
            F.transform(starts, lambda s, j: let(
                F.slice(every, s + 1, F.coalesce(F.get(starts, j + 1), F.size(every)) - s), titled
            ))
        ))

    return let(marks, by_section)


BLOCK = 128


def _blocks(values: Column, summary: Callable[[Column], Column]) -> Column:
    """``summary`` of each run of BLOCK values."""
    count = F.ceil(F.size(values) / BLOCK).cast("int")
    return F.when(count > 0, F.transform(
        F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))),
        lambda b: summary(F.slice(values, b * BLOCK + 1, F.lit(BLOCK))),
    )).otherwise(F.array().cast("array<int>"))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, b: a + b)


def with_prefix_sums(values: Column, body: Callable[[Callable[[Column], Column]], Column]) -> Column:
    """``body`` of a function from k to the sum of the first k values. Whole blocks are
    summed once, so a long text costs far less than its square."""
    def sums(block_totals: Column) -> Callable[[Column], Column]:
        def before(k: Column) -> Column:
            block = F.floor(k / BLOCK).cast("int")
            rest = F.slice(values, block * BLOCK + 1, k - block * BLOCK)
            return _total(F.slice(block_totals, F.lit(1), block)) + _total(rest)

        return before

    return let(_blocks(values, _total), lambda totals: body(sums(totals)))


def with_heading_at(marks: Column, body: Callable[[Callable[[Column], Column]], Column]) -> Column:
    """``body`` of a function from a line number to the path of the heading in force."""
    def lookup(first_lines: Column) -> Callable[[Column], Column]:
        def at(line: Column) -> Column:
            block = F.size(F.filter(first_lines, lambda first: first <= line)) - 1
            inside = F.slice(marks, F.greatest(block, F.lit(0)) * BLOCK + 1, F.lit(BLOCK))
            return F.try_element_at(F.filter(inside, lambda m: m["line_no"] <= line), F.lit(-1))["path"]

        return at

    firsts = _blocks(marks, lambda block: F.get(block, F.lit(0))["line_no"])
    return let(firsts, lambda lines_of: body(lookup(lines_of)))


def term_counts(text: Column) -> Column:
    """Array of (term, tf) of the distinct words, counted as run lengths of the sorted
    words, so that counting needs no shuffle."""
    def runs(ordered: Column) -> Column:
        terms = F.array_distinct(ordered)
        starts = let(terms, lambda ts: F.transform(
            ts, lambda term: F.struct(term.alias("term"), F.array_position(ordered, term).alias("at"))
        ))
        return let(starts, lambda every: F.transform(every, lambda x, i: F.struct(
            x["term"].alias("term"),
            (F.coalesce(F.get(every, i + 1)["at"], F.size(ordered) + 1) - x["at"]).alias("tf"),
        )))

    return let(F.sort_array(words(text)), runs)


def newlines(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))


def feeds(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\f"), F.lit("")))


def money_amount(match: Column) -> Column:
    """A money match as dollars; null when the number does not fit."""
    number = F.replace(F.regexp_extract(match, r"([0-9][0-9,]*(?:\.[0-9]+)?)", 1), F.lit(","), F.lit(""))
    units = F.create_map(*[F.lit(x) for pair in MONEY_UNITS.items() for x in pair])
    scale = F.coalesce(F.try_element_at(units, money_unit(match)), F.lit(1))
    return F.try_multiply(number.try_cast("decimal(20,2)"), scale).try_cast("decimal(20,2)")


def money_unit(match: Column) -> Column:
    return F.regexp_extract(match, r"[0-9] ?([A-Za-z][A-Za-z ]*)$", 1)
