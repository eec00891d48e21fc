"""Headings of a document, with their places, and what kind of section they open."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from papyrine.functions.patterns import D, S, java, lines, located, matches, strip, strip_stars

HEADING = rf"(?m)^(#{{1,6}}){S}+([^\n]+?){S}*$"

#: Titles of sections, fixed values.
KINDS = {
    "abstract": "abstract|summary",
    "introduction": "introduction|background",
    "methods": rf"methods?|materials?{S}+and{S}+methods?|experimental{S}+procedures?|star{S}*methods?",
    "results": "results?",
    "discussion": "discussion|conclusions?|concluding remarks",
    "acknowledgements": "acknowledge?ments?|acknowledgements?|funding|author contributions?",
    "references": rf"references?|bibliography|literature{S}+cited",
    "supplement": "supplementary|supporting information|appendix",
    "glossary": "glossary",
}
BANNER = rf"(?i)europe pmc|funders group|author manuscript|received:|accepted:|published:|copyright|cc[{S[1:-1]}-]?by|published online|article| graphical abstract|in brief|highlights|correspondence|summary|article info|\Areference{S}*\z"
BIBLIOGRAPHY = rf"(?im)^#{{1,6}}{S}+\**{S}*(?:References|Bibliography|Literature{S}+Cited|Works{S}+Cited){S}*\**{S}*$"


def kind_pattern(kind: str) -> str:
    return rf"(?i)\A\**{S}*(?:{KINDS[kind]}){S}*\**{S}*\z"


def headings(text: Column) -> Column:
    """Structs ``level, title, line, start, end`` of all headings with a title; lines count from 1, offsets from 0."""
    found = F.transform(
        located(text, HEADING, (1, 2)),
        lambda h: F.struct(
            F.length(h["g1"]).alias("level"),
            strip_stars(h["g2"]).alias("title"),
            h["line"].alias("line"),
            h["start"].alias("start"),
            h["end"].alias("end"),
        ),
    )
    return F.filter(found, lambda h: h["title"] != "")


def line_headings(text: Column) -> Column:
    """Structs ``level, text`` of lines that are headings."""
    own = rf"\A(#{{1,6}}){S}+(.+?){S}*\z"
    hits = F.filter(lines(text), lambda x: x.rlike(own))
    return F.transform(hits, lambda x: F.struct(F.length(F.regexp_extract(x, own, 1)).alias("level"), strip(F.regexp_extract(x, own, 2)).alias("text")))


def section_kind(title: Column) -> Column:
    """The first kind that the title names, ``box`` for numbered boxes, otherwise null."""
    kind = F.lit(None).cast("string")
    for name in reversed(KINDS):
        kind = F.when(matches(title, kind_pattern(name)), F.lit(name)).otherwise(kind)
    return F.when(kind.isNull() & matches(title, rf"(?i)\A\**{S}*box{S}+{D}"), F.lit("box")).otherwise(kind)


def is_banner(title: Column) -> Column:
    return matches(title, BANNER)


def bibliography(text: Column) -> Column:
    """``heading, line`` of the first heading of a bibliography, null if there is none."""
    before = F.split(text, java(BIBLIOGRAPHY), 2)
    heading = strip(F.regexp_extract(text, f"({java(BIBLIOGRAPHY)})", 1))
    return F.when(matches(text, BIBLIOGRAPHY), F.struct(heading.alias("heading"), F.size(F.split(before[0], "\n", -1)).alias("line")))
