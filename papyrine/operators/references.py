"""Reference lists: formats, identifiers with their context, and what to show where the list is lost."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from papyrine.functions.patterns import D, NS, S, first_of_each, let, lines, located, matches, rewrite, strip
from papyrine.operators.headings import bibliography

_NAME = r"[A-Z][a-zA-Z'\-]+"
_YEAR = r"(?:19|20)\p{Nd}{2}[a-z]?"

#: Shapes of a reference line, in order of credit. Fixed values.
FORMATS = {
    "numbered": rf"\A{S}*[-*]?{S}*{D}+\.{S}+{NS}",
    "bracketed_authoryear": rf"\A\[?{_NAME},{S}+[A-Z]\.",
    "embo_style": rf"\A{S}*[-*]?{S}*{_NAME}{S}+[A-Z]{{1,4}}(?:,|{S}).*\({S}*{_YEAR}{S}*\)",
    "elife_style": rf"\A{S}*[-*]?{S}*{_NAME}{S}+[A-Z]{{1,4}}(?:,|\.).*?\.{S}*{_YEAR}\.{S}+[A-Z]",
    "loose_year_paren": rf"\({S}*{_YEAR}{S}*\)",
}
CREDIBLE = 5

PMID = rf"(?i)\bPMID:?{S}*({D}{{5,9}})\b"
DOI = rf"(?i)\b(?:doi:?{S}*)?(10\.{D}{{4,9}}/[^{S[1:-1]})\]]+)"
SPAN = 120


def _hits(part: Column, pattern: str) -> Column:
    return F.size(F.filter(part, lambda x: matches(x, pattern)))


def format_counts(text: Column) -> dict[str, Column]:
    """Lines of the bibliography, or of the whole text if it has none, in each format; a line may count in several."""
    ls = lines(text)
    section = bibliography(text)
    part = F.when(section.isNotNull(), F.slice(ls, F.coalesce(section["line"], F.lit(0)) + 1, F.greatest(F.size(ls), F.lit(1)))).otherwise(ls)
    return {k: _hits(part, p) for k, p in FORMATS.items()}


def best_estimate(counts: dict[str, Column]) -> Column:
    """The first format with a credible number of lines, otherwise the largest number."""
    return F.coalesce(*[F.when(c >= CREDIBLE, c) for c in counts.values()], F.greatest(*counts.values()))


def snippet(text: Column, pos: Column, span: int = SPAN) -> Column:
    """One sentence or so around an offset.

    Every boundary in the window that lies well before the offset moves the start, by its place in the
    original window: boundaries add up. The end is cut at a full stop in the second half.
    """
    start = F.greatest(F.lit(0), pos - span)
    end = F.least(F.length(text), pos + span)
    chunk = F.substring(text, start + 1, end - start)
    # the pieces between boundaries: each boundary is one character
    pieces = F.split(chunk, rf"[.\n](?={S}|\z)", -1)

    def step(a: Column, piece: Column) -> Column:
        at = a["at"] + F.length(piece)
        return F.struct((at + 1).alias("at"), F.when(at < (pos - a["start"]) - 20, a["start"] + at + 1).otherwise(a["start"]).alias("start"))

    bounds = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    moved = F.aggregate(bounds, F.struct(F.lit(0).alias("at"), start.cast("int").alias("start")), step, lambda a: a["start"])
    whole = strip(let(moved, lambda m: F.substring(text, m + 1, F.greatest(F.lit(0), end - m))))

    def cut(kept: Column) -> Column:
        last = F.length(kept) - F.locate(".", F.reverse(kept))
        return F.when(F.contains(kept, F.lit(".")) & (last > F.floor(F.length(kept) / 2)), F.substring(kept, F.lit(1), last + 1)).otherwise(kept)

    return strip(rewrite(let(whole, cut), [(f"{S}+", " ")]))


def identifiers(text: Column) -> Column:
    """Structs ``id, start`` of PMIDs, then of DOIs, the first place of each."""
    pmids = F.transform(located(text, PMID, (1,)), lambda m: F.struct(F.concat(F.lit("PMID:"), m["g1"]).alias("id"), m["start"].alias("start")))
    dois = F.transform(located(text, DOI, (1,)), lambda m: F.struct(F.concat(F.lit("doi:"), F.regexp_replace(m["g1"], r"[.,;:>)\\]+\z", "")).alias("id"), m["start"].alias("start")))
    return first_of_each(F.concat(pmids, dois), "id", "struct<id:string,start:int>")


def entries(text: Column) -> Column:
    """Structs ``id, snippet`` of the identifiers."""
    return F.transform(identifiers(text), lambda x: F.struct(x["id"].alias("id"), snippet(text, x["start"]).alias("snippet")))


def audit(text: Column) -> list[Column]:
    """The reference audit: section, counts by format, estimate, identifiers and whether the list seems lost."""
    section, counts, ids = bibliography(text), format_counts(text), identifiers(text)
    n = lambda p: F.size(F.filter(ids, lambda x: x["id"].startswith(p)))
    return [
        section.isNotNull().alias("has_references_section"),
        section["heading"].alias("section_heading"),
        section["line"].alias("section_start_line"),
        n("PMID:").alias("n_pmids"),
        n("doi:").alias("n_dois"),
        *[c.alias(f"n_{k}") for k, c in counts.items()],
        best_estimate(counts).alias("n_refs_estimate"),
        (section.isNull() & (F.size(ids) == 0) & (F.greatest(*counts.values()) < CREDIBLE)).alias("likely_truncated"),
    ]


def references_document(text: Column, refs_at: Column) -> Column:
    """The references file: the section's own text, a list made of identifiers, or a note that there is none."""
    block = strip(F.substring(text, refs_at + 1, F.length(text)))
    at = F.locate("\n", block)
    own = F.when(at > 1, strip(F.substring(block, at + 1, F.length(block)))).otherwise(block)
    found = entries(text)
    listed = F.array_join(F.transform(found, lambda e, i: F.concat((i + 1).cast("string"), F.lit(". `"), e["id"], F.lit("` — "), e["snippet"])), "\n")
    lost = "# References\n\n*Reconstructed from inline PMID/DOI tokens — the source PDF lacked a parseable bibliography section.*\n\n"
    return (
        F.when(refs_at.isNotNull(), F.concat(F.lit("# References\n\n"), own, F.lit("\n")))
        .when(F.size(found) > 0, F.concat(F.lit(lost), listed, F.lit("\n")))
        .otherwise(F.lit("# References\n\n*No machine-parseable references found in source.*\n"))
    )
