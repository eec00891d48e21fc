"""Queries of the operators on papers. Every query runs over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrine.functions.patterns import rewrite
from papyrine.operators import cleaning, figures, headings, papers, references, sections, tables, titles
from papyrine.plans.core_sql import ORACLE as ORACLE
from papyrine.operators.deliveries import distinct_rows, once
from papyrine.session import spread, table
from papyrine.sources.filenames import parse_filename, sanitise
from papyrine.sources.files import docling_meta, key_values, pending

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = table(spark, sf_dir, "manuscript").where("marker_md is not null")
    return spread(once(src, "doc_id", "marker_md"), "doc_id").select("doc_id", F.col("marker_md").alias("md"))


def _docling(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = table(spark, sf_dir, "manuscript").where("docling_md is not null")
    return spread(once(src, "doc_id", "docling_md"), "doc_id")


def _papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return papers.papers(table(spark, sf_dir, "manuscript"))


def _images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return figures.classify(papers.distinct_images(table(spark, sf_dir, "image")))


def _planned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return papers.planned(table(spark, sf_dir, "manuscript"), table(spark, sf_dir, "docling_meta"))


def _meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return papers.paper_meta(table(spark, sf_dir, "manuscript"), table(spark, sf_dir, "docling_meta"), table(spark, sf_dir, "image"))


def _pass(name: str, rules: cleaning.Rules) -> None:
    QUERIES[name] = lambda spark, sf_dir: _raw(spark, sf_dir).select("doc_id", rewrite(F.col("md"), rules).alias("text"))


for _name, _rules in cleaning.PASSES.items():
    _pass(f"clean_{_name}", _rules)
for _name, _rules in cleaning.SECTION_PASSES.items():
    _pass(f"post_{_name}", _rules)
_pass("post_clean", cleaning.POST)


@query
def mechanical_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _papers(spark, sf_dir).select("doc_id", "text")


@query
def clean_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _papers(spark, sf_dir).select("doc_id", *cleaning.clean_stats(F.col("text")))


@query
def post_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _raw(spark, sf_dir).select("doc_id", F.length("md").alias("before"), F.length(cleaning.clean_section(F.col("md"))).alias("after"), (F.col("md") != cleaning.clean_section(F.col("md"))).alias("changed"))
    return rows.agg(F.count_if("changed").alias("n_changed"), F.sum(F.col("before") - F.col("after")).alias("n_removed"))


@query
def citation_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    style = cleaning.dominant_style(F.col("text"))
    return _papers(spark, sf_dir).select("doc_id", *cleaning.citation_counts(F.col("text")), style["style"].alias("style"), F.coalesce(style["n"], F.lit(0)).alias("n_dominant"))


@query
def heading_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _papers(spark, sf_dir).select("doc_id", F.explode_outer(headings.headings(F.col("text"))).alias("h")).where("h is not null")
    return rows.select("doc_id", F.col("h.level"), F.col("h.title"), F.col("h.line"), F.col("h.start").alias("start_pos"), F.col("h.end").alias("end_pos"))


@query
def heading_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _docling(spark, sf_dir).select("doc_id", F.posexplode_outer(headings.line_headings(F.col("docling_md"))).alias("i", "h")).where("h is not null")
    return rows.select("doc_id", F.col("i").alias("n"), F.col("h.level"), F.col("h.text"))


@query
def section_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _papers(spark, sf_dir).select("doc_id", F.explode_outer(headings.headings(F.col("text"))).alias("h")).where("h is not null")
    rows = rows.select("doc_id", F.col("h.start").alias("start_pos"), headings.section_kind(F.col("h.title")).alias("kind"), headings.is_banner(F.col("h.title")).alias("banner"))
    return rows


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.table_blocks(_papers(spark, sf_dir))


def _verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.classify(_blocks(spark, sf_dir))


@query
def table_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _blocks(spark, sf_dir).select("doc_id", "start_line", F.size("lines").alias("n_lines"), F.array_join("lines", "\n").alias("block"))


@query
def table_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _verdicts(spark, sf_dir).withColumn("reasons", F.array_join("reasons", "; "))


@query
def table_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.audit(_verdicts(spark, sf_dir))


@query
def data_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = _blocks(spark, sf_dir)
    return tables.data_tables(blocks, tables.classify(blocks))


@query
def refs_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _papers(spark, sf_dir).select("doc_id", *references.audit(F.col("text")))


@query
def ref_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _papers(spark, sf_dir).select("doc_id", F.explode_outer(references.identifiers(F.col("text"))).alias("e")).where("e is not null")
    return rows.select("doc_id", F.col("e.id").alias("ref_id"), F.col("e.start").alias("start_pos"))


@query
def ref_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _papers(spark, sf_dir).select("doc_id", F.explode_outer(references.entries(F.col("text"))).alias("e")).where("e is not null")
    return rows.select("doc_id", F.col("e.id").alias("ref_id"), F.col("e.snippet").alias("snippet"))


@query
def references_md(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _papers(spark, sf_dir).withColumn("refs_at", sections.references_start(headings.headings(F.col("text"))))
    return rows.select("doc_id", references.references_document(F.col("text"), F.col("refs_at")).alias("content"))


@query
def title_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "docling_meta").where("doc_id is not null").select("doc_id", "title", titles.rejection(F.col("title")).alias("reason")).distinct()


@query
def title_from_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "shred_batch").select("stem", titles.from_filename(F.col("stem")).alias("title")).distinct()


@query
def title_body_h1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _papers(spark, sf_dir).select("doc_id", titles.body_h1(F.col("text")).alias("title"))


@query
def title_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docling(spark, sf_dir).select("doc_id", titles.detect(F.col("docling_md")).alias("title"))


@query
def title_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = papers.decide(table(spark, sf_dir, "manuscript"), table(spark, sf_dir, "docling_meta"))
    return rows.select("doc_id", F.col("pick.recommended").alias("title"), F.col("pick.source").alias("source"), F.col("pick.rejection_reason").alias("reason"))


@query
def title_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = table(spark, sf_dir, "meta").select("doc_id", F.col("title").alias("meta_title"))
    docling = table(spark, sf_dir, "docling_meta").select("doc_id", F.col("title").alias("docling_title"))
    return meta.join(docling, "doc_id").where(F.lower(F.trim("meta_title")) != F.lower(F.trim("docling_title"))).distinct()


@query
def filename_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "shred_batch").select("stem", parse_filename(sanitise(F.col("stem"))).alias("f")).distinct()
    return rows.select("stem", "f.*")


@query
def slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _papers(spark, sf_dir).select(F.explode_outer(headings.headings(F.col("text"))).alias("h")).where("h is not null")
    return rows.select(F.col("h.title").alias("title"), sections.slugify(F.col("h.title")).alias("slug")).distinct()


@query
def doc_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _papers(spark, sf_dir).withColumn("heads", headings.headings(F.col("text")))
    return rows.select("doc_id", sections.document_type(F.col("text"), F.col("heads"), parse_filename(F.col("stem"))["journal"]).alias("doc_type"))


@query
def section_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _papers(spark, sf_dir).withColumn("heads", headings.headings(F.col("text")))
    end = F.coalesce(sections.references_start(F.col("heads")), F.length("text"))
    rows = rows.withColumn("body_end", end).select("doc_id", "body_end", F.posexplode_outer(sections.anchors(F.col("heads"), F.col("body_end"))).alias("i", "a")).where("a is not null")
    return rows.select("doc_id", F.col("i").alias("n"), F.col("a.start").alias("start_pos"), F.col("a.level").alias("level"), "body_end")


@query
def section_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sections.plan(_papers(spark, sf_dir)).select("doc_id", F.posexplode_outer("sections").alias("i", "s")).where("s is not null")
    return rows.select("doc_id", (F.col("i") + 1).alias("n"), F.col("s.slug").alias("slug"), F.col("s.title").alias("title"), F.col("s.start").alias("start_pos"), F.col("s.end").alias("end_pos"))


@query
def section_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.section_rows(_planned(spark, sf_dir)).select("doc_id", "n", "slug", "title", "cleaned")


@query
def figure_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _images(spark, sf_dir).select("doc_id", "path", "source", "w", "h", "area", "aspect", "kept", "reason")


@query
def figure_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return figures.audit(_images(spark, sf_dir))


@query
def figure_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return figures.drop_reasons(_images(spark, sf_dir))


@query
def caption_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _papers(spark, sf_dir).select("doc_id", "text")
    return figures.require_captions(_images(spark, sf_dir), texts).select("doc_id", "path", "source", "w", "h", "kept", "reason")


@query
def captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _papers(spark, sf_dir).select("doc_id", F.explode_outer(figures.captions(F.col("text"))).alias("c")).where("c is not null")
    return rows.select("doc_id", F.col("c.n").alias("n"), F.col("c.caption").alias("caption"))


@query
def figure_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _papers(spark, sf_dir).select("doc_id", "text")
    return figures.figure_records(_images(spark, sf_dir), texts).select("doc_id", "n", "path", "caption")


@query
def image_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "image").select("path", F.nullif(F.regexp_extract("path", figures.PAGE_IN_NAME, 1), F.lit("")).cast("int").alias("page")).distinct()


@query
def sanity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _papers(spark, sf_dir).select("doc_id", *papers.sanity_counts(F.col("text")))


@query
def output_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _papers(spark, sf_dir).select("doc_id", "text")
    blocks = tables.table_blocks(texts)
    refs = references_md(spark, sf_dir)
    return papers.output_counts(section_texts(spark, sf_dir), figures.figure_records(_images(spark, sf_dir), texts), tables.data_tables(blocks, tables.classify(blocks)), refs)


@query
def count_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = table(spark, sf_dir, "meta").where("doc_id is not null").groupBy("doc_id").agg(F.max("n_figures").alias("n_figures"), F.max("n_tables").alias("n_tables"))
    docling = table(spark, sf_dir, "docling_meta").where("doc_id is not null").groupBy("doc_id").agg(F.max("n_pictures").alias("n_pictures"), F.max("n_tables").alias("docling_tables"))
    both = meta.join(docling, "doc_id", "full")
    return both.select("doc_id", "n_figures", "n_pictures", F.coalesce(F.abs(F.col("n_figures") - F.col("n_pictures")) > 1, F.lit(False)).alias("figures_differ"), F.coalesce(F.col("n_tables") != F.col("docling_tables"), F.lit(False)).alias("tables_differ"))


@query
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "shred_batch").select("run_id", "journal", "status").distinct()
    return runs.groupBy("journal").agg(F.count_if(F.col("status").isin("ok", "skipped")).alias("n_ok"), F.count(F.lit(1)).alias("n_runs"))


@query
def skip_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "shred_batch").where("status = 'ok'")
    return pending(table(spark, sf_dir, "manuscript").select("stem").distinct(), done)


@query
def docling_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The docling metadata written as JSON and read back as a source reads it."""
    names = ("title", "headings", "n_pages", "n_pictures", "n_tables", "n_texts", "saved_pictures", "runtime_seconds")
    rows = distinct_rows(table(spark, sf_dir, "docling_meta").select("doc_id", F.to_json(F.struct(*names)).alias("json")))
    rows = rows.select("doc_id", docling_meta(F.col("json")).alias("d"))
    told = F.array_join(F.transform("d.headings", lambda h: F.concat_ws(" ", h["level"].cast("string"), h["text"])), "\n")
    return rows.select("doc_id", "d.title", "d.n_pages", "d.n_pictures", "d.n_tables", "d.n_texts", F.array_size("d.saved_pictures").alias("n_saved"), told.alias("told"))


@query
def key_value_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key-value lines as the extractor prints them; the last of equal keys counts, other lines do not."""
    lines = F.concat_ws("\n", F.lit("status=begun"), F.concat(F.lit("stem="), "stem"), F.lit("no pair"), F.concat(F.lit("status=a="), "status"))
    rows = table(spark, sf_dir, "shred_batch").select("run_id", lines.alias("text")).distinct().select("run_id", key_values(F.col("text")).alias("kv"))
    return rows.select("run_id", F.try_element_at("kv", F.lit("stem")).alias("stem"), F.try_element_at("kv", F.lit("status")).alias("status"))


@query
def paper_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = {c: F.array_join(c, " | ") for c in ("title_warnings", "sections")}
    return _meta(spark, sf_dir).drop("extracted_at").withColumns(lists)


@query
def paper_readme(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _papers(spark, sf_dir).select("doc_id", "text")
    blocks = tables.table_blocks(texts)
    records = figures.figure_records(_images(spark, sf_dir), texts)
    return papers.readme(_meta(spark, sf_dir), _planned(spark, sf_dir), records, tables.data_tables(blocks, tables.classify(blocks)))


@query
def qc_red_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return papers.red_flags(_meta(spark, sf_dir), _planned(spark, sf_dir), table(spark, sf_dir, "docling_meta")).withColumn("flags", F.array_join("flags", "; "))
