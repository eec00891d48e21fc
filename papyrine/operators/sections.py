"""Cutting a cleaned document into at most eight sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyrine.functions.patterns import S, java, let, lines, matches, strip, strip_stars
from papyrine.operators.cleaning import clean_section
from papyrine.operators.headings import HEADING, headings, is_banner, kind_pattern

MOST, PREFACE, TITLE_BLOCK, SLUG = 8, 200, 800, 25
REVIEWS = "(?i)natrev|annurev|trends|cshpersp|curropin|review"
_SECTION = "struct<slug:string,title:string,start:int,end:int,level:int>"


def slugify(text: Column, longest: int = SLUG) -> Column:
    s = strip_stars(F.lower(text))
    s = F.regexp_replace(F.regexp_replace(s, rf"\A(?:the|a|an){S}+", ""), "[^a-z0-9]+", "_")
    s = F.btrim(s, F.lit("_"))
    s = F.rtrim(F.left(s, F.lit(longest)), F.lit("_"))
    return F.coalesce(F.nullif(s, F.lit("")), F.lit("section"))


def document_type(text: Column, heads: Column, journal: Column) -> Column:
    """preprint, paper or review."""
    start = F.left(F.lower(text), F.lit(2000))
    has = lambda kind: F.exists(heads, lambda h: matches(h["title"], kind_pattern(kind)))
    return (
        F.when(F.contains(start, F.lit("biorxiv")) | F.contains(start, F.lit("medrxiv")), "preprint")
        .when(has("methods") & has("results"), "paper")
        .when(F.coalesce(journal.rlike(REVIEWS), F.lit(False)), "review")
        .when(has("results"), "paper")
        .otherwise("review")
    )


def references_start(heads: Column) -> Column:
    """Offset of the first heading that opens the references, null without one."""
    return F.get(F.transform(F.filter(heads, lambda h: matches(h["title"], kind_pattern("references"))), lambda h: h["start"]), F.lit(0))


def anchors(heads: Column, end: Column) -> Column:
    """The headings that open sections: of the first level that has three, else of the first three levels together."""
    fit = lambda h: (h["start"] < end) & (h["level"] <= 3) & (F.length(h["title"]) >= 3) & ~is_banner(h["title"])

    def chosen(kept: Column) -> Column:
        of = lambda n: F.filter(kept, lambda h: h["level"] == n)
        return F.when(F.size(of(1)) >= 3, of(1)).when(F.size(of(2)) >= 3, of(2)).when(F.size(of(3)) >= 3, of(3)).otherwise(kept)

    return let(F.filter(heads, fit), chosen)


def _merged(sections: Column) -> Column:
    """One step of merging: the shortest section joins its right neighbour, the last one its left."""
    free = F.transform(sections, lambda s, i: F.when(s["slug"] != "00_abstract", F.struct((s["end"] - s["start"]).alias("n"), i.alias("i"))))
    least = F.array_min(F.filter(free, lambda x: x.isNotNull()))["i"]

    def joined(left: Column) -> Column:
        a, b = F.get(sections, left), F.get(sections, left + 1)
        both = F.struct(a["slug"].alias("slug"), F.concat(a["title"], F.lit(" & "), b["title"]).alias("title"), a["start"].alias("start"), b["end"].alias("end"), a["level"].alias("level"))
        return F.concat(F.slice(sections, F.lit(1), left), F.array(both), F.slice(sections, left + 3, F.greatest(F.size(sections), F.lit(1))))

    return let(let(least, lambda i: F.when(i + 1 < F.size(sections), i).otherwise(i - 1)), joined)


def _numbered(sections: Column) -> Column:
    return F.transform(
        sections,
        lambda s, i: F.struct(
            F.concat(F.lpad((i + 1).cast("string"), 2, "0"), F.lit("_"), F.coalesce(F.nullif(F.regexp_replace(s["slug"], r"\A\p{Nd}+_?", ""), F.lit("")), F.lit("section"))).alias("slug"),
            s["title"].alias("title"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            s["level"].alias("level"),
        ),
    )


def plan(docs: DataFrame) -> DataFrame:
    """Adds ``heads, refs_at, body_end, sections`` to rows that have ``text``.

    Sections are spans of the text up to the references: one for each anchor, before them an abstract
    if enough text precedes the first, and a single body without anchors. More than eight are merged,
    the shortest first. Everything is computed inside the row.
    """
    d = docs.withColumn("heads", headings(F.col("text")))
    d = d.withColumn("refs_at", references_start(F.col("heads")))
    d = d.withColumn("body_end", F.coalesce("refs_at", F.length("text")))
    d = d.withColumn("anchors", anchors(F.col("heads"), F.col("body_end")))
    size = F.size("anchors")
    spans = F.transform(
        "anchors",
        lambda a, i: F.struct(slugify(a["title"]).alias("slug"), a["title"].alias("title"), a["start"].alias("start"), F.coalesce(F.get("anchors", i + 1)["start"], F.col("body_end")).alias("end"), a["level"].alias("level")).cast(_SECTION),
    )
    first = F.get("anchors", F.lit(0))["start"]
    preface = strip(F.regexp_replace(strip(F.substring(F.col("text"), F.lit(1), first)), java(r"(?m)^#{1,6}[^\n]*$"), ""))
    abstract = F.array(F.struct(F.lit("00_abstract").alias("slug"), F.lit("Abstract").alias("title"), F.lit(0).alias("start"), first.alias("end"), F.lit(None).cast("int").alias("level")).cast(_SECTION))
    whole = F.array(F.struct(F.lit("01_body").alias("slug"), F.lit("Body").alias("title"), F.lit(0).alias("start"), F.col("body_end").alias("end"), F.lit(None).cast("int").alias("level")).cast(_SECTION))
    d = d.withColumn("sections", F.when(F.length(preface) > PREFACE, F.concat(abstract, spans)).otherwise(spans))
    surplus = F.size("sections") - MOST
    merged = F.when(surplus > 0, F.aggregate(F.sequence(F.lit(1), F.greatest(surplus, F.lit(1))), F.col("sections"), lambda acc, _: _merged(acc))).otherwise(F.col("sections"))
    return d.withColumn("sections", F.when(size == 0, whole).otherwise(_numbered(merged))).drop("anchors")


def comparable(title: Column) -> Column:
    return F.lower(F.regexp_replace(title, r"[^\p{L}\p{N}_]+", ""))


def without_title_block(docs: DataFrame) -> DataFrame:
    """Drops the first section of ``sections`` where it only repeats ``title`` above a short block."""
    first = F.get("sections", F.lit(0))
    body = strip(F.substring(F.col("text"), first["start"] + 1, first["end"] - first["start"]))
    drop = (comparable(first["title"]) == comparable(F.col("title"))) & (F.length(body) < TITLE_BLOCK)
    rest = _numbered(F.slice("sections", F.lit(2), F.greatest(F.size("sections"), F.lit(1))))
    return docs.withColumn("sections", F.when(drop, rest).otherwise(F.col("sections")))


def section_text(text: Column, section: Column) -> Column:
    """The section as a file of one top heading: its own title, further top headings one level down."""
    own = java(HEADING).replace("(?md)^", r"\A").replace("$", r"\z")
    rows = lines(strip(F.substring(text, section["start"] + 1, section["end"] - section["start"])))

    def shown(marked: Column) -> Column:
        def kept(first: Column) -> Column:
            return F.filter(F.transform(marked, lambda x, i: F.when(i + 1 != first, F.when(x["level"] == "#", F.concat(F.lit("## "), F.regexp_extract(x["line"], own, 2))).otherwise(x["line"]))), lambda x: x.isNotNull())

        return let(F.array_position(F.transform(marked, lambda x: x["level"] != ""), F.lit(True)), kept)

    told = let(F.transform(rows, lambda x: F.struct(x.alias("line"), F.regexp_extract(x, own, 1).alias("level"))), shown)
    body = F.array_join(F.concat(F.array(F.concat(F.lit("# "), section["title"]), F.lit("")), told), "\n")
    return F.concat(F.regexp_replace(body, rf"{S}+\z", ""), F.lit("\n"))


def section_rows(planned: DataFrame, doc: str = "doc_id") -> DataFrame:
    """``doc, n, slug, title, start, end, body, cleaned`` of every section."""
    rows = planned.select(doc, "text", F.posexplode_outer("sections").alias("i", "s")).where("s is not null")
    rows = rows.select(doc, (F.col("i") + 1).alias("n"), F.col("s.slug").alias("slug"), F.col("s.title").alias("title"), F.col("s.start").alias("start"), F.col("s.end").alias("end"), section_text(F.col("text"), F.col("s")).alias("body"))
    return rows.withColumn("cleaned", clean_section(F.col("body")))
