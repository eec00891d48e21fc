"""One row per paper: everything the separate operators find, put together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyrine.functions.patterns import S, count, lines, matches
from papyrine.operators import cleaning, figures, references, sections, tables, titles
from papyrine.operators.deliveries import once
from papyrine.session import spread
from papyrine.sources.filenames import parse_filename, sanitise

EXTRACTOR = "papyrine (batch)"


def papers(manuscripts: DataFrame) -> DataFrame:
    """``doc_id, stem, md, text`` of extracted papers, each once, ``text`` cleaned, and ``extracted_at`` where it is known."""
    known = [c for c in ("extracted_at",) if c in manuscripts.columns]
    src = spread(once(manuscripts.where(F.col("marker_md").isNotNull()), "doc_id", "stem", "marker_md", *known), "doc_id")
    return src.select("doc_id", sanitise(F.col("stem")).alias("stem"), F.col("marker_md").alias("md"), *known).withColumn("text", cleaning.mechanical_clean(F.col("md")))


def docling_facts(docling: DataFrame) -> DataFrame:
    """``doc_id, docling_title, n_pages, n_pictures, docling_headings`` once per paper."""
    facts = F.struct(F.col("title").alias("docling_title"), "n_pages", "n_pictures", F.size("headings").alias("docling_headings"))
    return docling.where("doc_id is not null").groupBy("doc_id").agg(F.first(facts).alias("f")).select("doc_id", "f.*", F.lit(True).alias("has_docling"))


def distinct_images(images: DataFrame) -> DataFrame:
    """Images have no key of their own; a row delivered again is equal in all columns but the load time."""
    return images.select("doc_id", "path", "source", "w", "h", "error").distinct()


def decide(manuscripts: DataFrame, docling: DataFrame) -> DataFrame:
    """``doc_id, stem, text, md, pick, name`` and the docling facts: papers with their title decision and filename metadata."""
    rows = papers(manuscripts).join(docling_facts(docling), "doc_id", "left").withColumn("has_docling", F.coalesce("has_docling", F.lit(False)))
    rows = titles.pick(rows)
    return rows.withColumns({"name": parse_filename(F.col("stem")), "title": F.coalesce(F.nullif(F.col("pick.recommended"), F.lit("")), titles.from_filename(F.col("stem")))})


def planned(manuscripts: DataFrame, docling: DataFrame) -> DataFrame:
    """Papers with their sections, without a title block."""
    return sections.without_title_block(sections.plan(decide(manuscripts, docling)))


def paper_meta(manuscripts: DataFrame, docling: DataFrame, images: DataFrame) -> DataFrame:
    """One row per paper with the fields of its metadata; what is not known is null, never invented.

    Texts are read once and never shuffled but for the join with the docling facts; the other inputs
    are reduced to a row per paper before they meet.
    """
    plan = planned(manuscripts, docling)
    plan = plan.withColumns({"_style": cleaning.dominant_style(F.col("text")), "_ids": F.size(references.identifiers(F.col("text"))), "_bib": references.bibliography(F.col("text")).isNotNull()})
    counted = references.format_counts(F.col("text"))
    plan = plan.withColumns({f"_n_{k}": c for k, c in counted.items()})
    counts = {k: F.col(f"_n_{k}") for k in counted}
    style, n_ids = F.col("_style"), F.col("_ids")
    facts = plan.select(
        "doc_id", "stem", "title",
        F.col("pick.source").alias("title_source"),
        F.col("pick.warnings").alias("title_warnings"),
        F.lit(None).cast("string").alias("authors"),
        F.col("name.year").alias("year"),
        sections.document_type(F.col("text"), F.col("heads"), F.col("name.journal")).alias("type"),
        F.col("name.doi").alias("doi"), F.col("name.pmid").alias("pmid"), F.col("name.journal").alias("journal"),
        F.lit(None).cast("string").alias("funder"), F.lit(None).cast("string").alias("grant_id"),
        F.lit("_raw/source.pdf").alias("source_pdf"), F.lit(EXTRACTOR).alias("extractor"), *[c for c in ("extracted_at",) if c in plan.columns],
        "n_pages",
        F.size("sections").alias("n_sections"),
        F.when(F.col("refs_at").isNotNull(), references.best_estimate(counts)).otherwise(n_ids).alias("n_references"),
        (~F.col("_bib") & (n_ids == 0) & (F.greatest(*counts.values()) < references.CREDIBLE)).alias("refs_likely_truncated"),
        style["style"].alias("citation_style"),
        F.coalesce(style["n"], F.lit(0)).alias("n_citations_inline"),
        F.transform("sections", lambda s: F.concat(s["slug"], F.lit(".md"))).alias("sections"),
    )
    kept = figures.classify(distinct_images(images)).where("kept").groupBy("doc_id").agg(F.count(F.lit(1)).cast("int").alias("n_figures"))
    verdicts = tables.classify(tables.table_blocks(plan.select("doc_id", "text")))
    data = verdicts.where("verdict = 'data'").groupBy("doc_id").agg(F.count(F.lit(1)).cast("int").alias("n_tables"))
    joined = facts.join(kept, "doc_id", "left").join(data, "doc_id", "left")
    return joined.withColumns({"n_figures": F.coalesce("n_figures", F.lit(0)), "n_tables": F.coalesce("n_tables", F.lit(0))})


def sanity_counts(text: Column) -> list[Column]:
    """Reference lines that are numbered, and superscripts."""
    return [F.size(F.filter(lines(text), lambda x: matches(x, rf"\A{S}*\p{{Nd}}+\.{S}"))).alias("n_numbered"), count(text, "<sup>").alias("n_sup")]


def output_counts(sections_: DataFrame, figure_records: DataFrame, data_tables: DataFrame, references_: DataFrame, doc: str = "doc_id") -> DataFrame:
    """``doc, n_sections, n_sup, n_jpeg, n_tables, n_listed``: what is found in a paper's files, to be set beside its metadata.

    Sections and their superscripts, figures of the JPEG kind, table files, and numbered lines of the references file.
    """
    parts = [
        sections_.groupBy(doc).agg(F.count(F.lit(1)).alias("n_sections"), F.sum(count(F.col("cleaned"), "<sup>")).alias("n_sup")),
        figure_records.groupBy(doc).agg(F.count_if(F.col("path").endswith(".jpeg")).alias("n_jpeg")),
        data_tables.groupBy(doc).agg(F.count(F.lit(1)).alias("n_tables")),
    ]
    listed = F.size(F.filter(lines(F.col("content")), lambda x: matches(x, rf"\A\p{{Nd}}+\.{S}")))
    rows = references_.select(doc, listed.cast("bigint").alias("n_listed"))
    for part in parts:
        rows = rows.join(part, doc, "left")
    return rows.select(doc, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_sections", "n_sup", "n_jpeg", "n_tables", "n_listed")])


def red_flags(meta: DataFrame, plan: DataFrame, docling: DataFrame) -> DataFrame:
    """``doc_id, flags``: what a reader should look at in each paper, empty if nothing."""
    per = plan.select(
        "doc_id",
        F.coalesce(F.array_min(F.transform("sections", lambda s: s["end"] - s["start"])), F.lit(0)).alias("shortest"),
        F.size(F.filter("heads", lambda h: h["level"] <= 6)).alias("n_heads"),
        count(F.substring(F.col("text"), F.lit(1), F.col("body_end")), "<sup>").alias("sup_body"),
        F.aggregate("sections", F.lit(0), lambda n, s: n + count(F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"]), "<sup>")).alias("sup_sections"),
    )
    rows = meta.join(per, "doc_id", "left").join(docling_facts(docling).select("doc_id", "n_pictures", "docling_headings"), "doc_id", "left")
    flags = F.array_compact(
        F.array(
            F.when(F.col("n_sections") > sections.MOST, F.lit("too many sections")),
            F.when(F.col("sup_body") != F.col("sup_sections"), F.lit("citations lost between sections")),
            F.when((F.col("n_references") < 5) & F.col("type").isin("paper", "grant"), F.lit("few references")),
            F.when(F.col("shortest") < 200, F.lit("short section")),
            # authors are not extracted, so that they would be missing everywhere
            F.when(F.col("title").isNull(), F.lit("title missing")),
            F.when(F.abs(F.col("n_pictures") - F.col("n_figures")) > 1, F.lit("figure counts differ")),
            F.when(F.abs(F.col("docling_headings") - F.col("n_heads")) > 2, F.lit("heading counts differ")),
            F.when(F.col("title_source") == "filename", F.lit("title from the file name")),
        )
    )
    return rows.select("doc_id", flags.alias("flags"))


def readme(meta: DataFrame, plan: DataFrame, figure_records: DataFrame, data_tables: DataFrame) -> DataFrame:
    """``doc_id, content``: the index page of a paper, with front matter and links to its parts."""

    def listed(rows: DataFrame, kind: str, label: str, text: str) -> DataFrame:
        nn = F.lpad(F.col("n").cast("string"), 2, "0")
        line = F.concat(F.lit(f"- [[{kind}s/{kind}_"), nn, F.lit(f"|{label} "), F.col("n").cast("string"), F.when(F.col(text) != "", F.concat(F.lit(" — "), F.col(text))).otherwise(""), F.lit("]]"))
        return rows.groupBy("doc_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", line.alias("l")))), lambda x: x["l"]), "\n").alias(f"{kind}_lines"))

    toc = plan.select("doc_id", F.array_join(F.transform("sections", lambda s: F.concat(F.lit("- [[sections/"), s["slug"], F.lit("|"), s["title"], F.lit("]]"))), "\n").alias("toc"))
    m = meta.join(toc, "doc_id").join(listed(figure_records, "figure", "Figure", "caption"), "doc_id", "left").join(listed(data_tables, "table", "Table", "preview"), "doc_id", "left")
    or_null = lambda c, quote=False: F.coalesce(F.concat(F.lit('"'), c, F.lit('"')) if quote else c.cast("string"), F.lit("null"))
    or_dash = lambda c: F.coalesce(c.cast("string"), F.lit("—"))
    title = F.replace(F.col("title"), F.lit('"'), F.lit("'"))
    front = [
        ("title", F.concat(F.lit('"'), title, F.lit('"'))), ("authors", F.lit("null")), ("year", or_null(F.col("year"))), ("type", F.col("type")), ("doi", or_null(F.col("doi"), True)),
        ("journal", or_null(F.col("journal"), True)), ("pmid", or_null(F.col("pmid"))), ("source", F.col("source_pdf")), ("extracted", F.date_format(F.current_date(), "yyyy-MM-dd")), ("extractor", F.col("extractor")),
    ]
    head = F.concat_ws("\n", F.lit("---"), *[F.concat(F.lit(f"{k}: "), v) for k, v in front], F.lit("tags:"), F.concat(F.lit("  - "), F.col("type")), F.lit("---"))
    about = F.concat(
        F.lit("> **Source:** `"), F.col("stem"), F.lit(".pdf`\n> **Type:** "), F.col("type"), F.lit(" · **Year:** "), or_dash(F.col("year")),
        F.lit(" · **DOI:** "), or_dash(F.col("doi")), F.lit(" · **PMID:** "), or_dash(F.col("pmid")),
    )
    block = lambda name, c: F.when(c.isNotNull(), F.concat(F.lit(f"## {name}\n\n"), c, F.lit("\n\n"))).otherwise("")
    content = F.concat(
        head, F.lit("\n\n# "), title, F.lit("\n\n"), about, F.lit("\n\n## Sections\n\n"), F.col("toc"), F.lit("\n\n"), block("Figures", F.col("figure_lines")), block("Tables", F.col("table_lines")),
        F.lit("## References\n\n[[references|"), F.col("n_references").cast("string"), F.lit(" references]]\n"),
    )
    return m.select("doc_id", content.alias("content"))
