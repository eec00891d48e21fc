"""From a folder of PDF files to a folder of files for each paper.

    python -m papyrine.plans.pipeline TARGET OUT --marker package.module:function [--docling package.module:function]
                                      [--images WORK] [--require-caption]

``TARGET`` is a PDF file or a folder, ``OUT`` a folder that all executors share. Papers that have their
metadata and index page already are skipped. Every run appends its rows to ``OUT/_log``; the exit code is 0 if
all papers are done, 1 if some failed or nothing was found, 2 if the call is wrong.
"""

from __future__ import annotations

import argparse
import importlib
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrine.operators import figures, papers, references, sections, tables
from papyrine.session import checkpoint
from papyrine.sinks import files as sinks
from papyrine.sources import files as sources


def done(spark: SparkSession, out: str) -> DataFrame:
    """``stem`` of papers below ``out`` that have both their metadata and their index page."""
    found = spark.createDataFrame([], "stem string, name string")
    for name in ("meta.json", "README.md"):
        try:
            listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", name).load(out).select("path")
        except Exception as e:  # noqa: BLE001, a folder that is not there yet holds nothing
            if "PATH_NOT_FOUND" not in str(e):
                raise
            continue
        found = found.unionByName(listed.select(F.element_at(F.split("path", "/"), -2).alias("stem"), F.lit(name).alias("name")))
    return found.groupBy("stem").agg(F.count_distinct("name").alias("n")).where("n = 2").select("stem")


def shred(spark: SparkSession, target: str, out: str, marker: sources.Marker, docling: sources.Docling | None = None, images: str | None = None, require_caption: bool = False) -> DataFrame:
    """Writes the files of every paper not done yet and returns the log: ``stem, path, status, error, n_sections, n_figures, n_tables, n_references, title, title_source, type``."""
    found = sources.pdfs(spark, target, contents=True)
    before = checkpoint(done(spark, out))
    todo = sources.pending(found, before)
    extracted = checkpoint(sources.extract(todo, marker, docling))
    good = extracted.where("error is null").withColumn("doc_id", F.xxhash64("stem"))
    manuscripts = good.select("doc_id", "stem", "marker_md", F.current_timestamp().alias("extracted_at"))
    meta_of = sources.docling_meta(F.col("docling_json"))
    docs = good.where("docling_json is not null").select("doc_id", meta_of.alias("d")).where("d is not null").select("doc_id", "d.*")
    pictures = spark.createDataFrame([], "doc_id bigint, path string, source string, w int, h int, error string")
    if images:
        listed = sources.images(spark, images).withColumn("stem", F.element_at(F.split(F.regexp_extract("path", r"^(.*?)/(?:marker_out|docling_out)/", 1), "/"), -1))
        pictures = checkpoint(listed.join(good.select("stem", "doc_id"), "stem").select("doc_id", "path", "source", "w", "h", "error"))
    kept = figures.classify(pictures)
    texts = papers.papers(manuscripts).select("doc_id", "text")
    if require_caption:
        kept = figures.require_captions(kept, texts)
    planned = checkpoint(papers.planned(manuscripts, docs))
    blocks = tables.table_blocks(texts)
    data = tables.data_tables(blocks, tables.classify(blocks))
    records = checkpoint(figures.figure_records(kept, texts))
    meta = checkpoint(papers.paper_meta(manuscripts, docs, pictures))
    stems = good.select("doc_id", "stem")
    refs = planned.select("doc_id", references.references_document(F.col("text"), F.col("refs_at")).alias("content"))
    named = lambda rows, name: rows.join(stems, "doc_id").select("stem", F.lit(name).alias("name"), "content")

    sinks.write_files(sinks.raw_files(good.join(found.select("stem", "content"), "stem")), out)
    sinks.write_files(sinks.section_files(sections.section_rows(planned), stems), out)
    sinks.write_files(sinks.numbered_files(records, stems, "figures", "figure", "sidecar"), out)
    if images:
        sinks.write_files(sources.contents(sinks.figure_copies(records, stems), images), out)
    sinks.write_files(sinks.numbered_files(data, stems, "tables", "table", "content"), out)
    sinks.write_files(named(refs, "references.md"), out)
    sinks.write_files(sinks.audit_files(tables.classify(blocks), stems, "table_audit.json"), out)
    sinks.write_files(sinks.audit_files(kept, stems, "figure_audit.json"), out)
    # what tells that a paper is done comes last
    sinks.write_files(named(papers.readme(meta, planned, records, data), "README.md"), out)
    sinks.write_files(sinks.meta_json(meta), out)

    facts = meta.select("stem", F.lit("ok").alias("status"), "n_sections", "n_figures", "n_tables", "n_references", "title", "title_source", "type")
    failed = extracted.where("error is not null").select("stem", F.regexp_extract("error", r"^\w+", 0).alias("status"), "error")
    skipped = before.select("stem", F.lit("skipped").alias("status"))
    log = facts.unionByName(failed, allowMissingColumns=True).unionByName(skipped, allowMissingColumns=True)
    return found.select("stem", "path").join(log, "stem")


def _named(spec: str | None):
    if not spec:
        return None
    module, _, name = spec.partition(":")
    return getattr(importlib.import_module(module), name)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="papyrine.plans.pipeline")
    parser.add_argument("target")
    parser.add_argument("out")
    parser.add_argument("--marker", required=True)
    parser.add_argument("--docling")
    parser.add_argument("--images")
    parser.add_argument("--require-caption", action="store_true")
    try:
        a = parser.parse_args(argv)
        marker, docling = _named(a.marker), _named(a.docling)
        sources.check_extractors(marker, docling)
    except (SystemExit, ValueError, ImportError, AttributeError) as e:
        print(e, file=sys.stderr)
        return 2
    spark = spark or SparkSession.builder.getOrCreate()
    try:
        log = checkpoint(shred(spark, a.target, a.out, marker, docling, a.images, a.require_caption))
    except Exception as e:  # noqa: BLE001, told by its name
        if "PATH_NOT_FOUND" not in str(e):
            raise
        print(f"Not found: {a.target}", file=sys.stderr)
        return 1
    sinks.append_log(log, f"{a.out}/_log")
    n, ok = log.count(), log.where("status in ('ok', 'skipped')").count()
    print(f"Done: {ok}/{n} succeeded.")
    return 0 if n and ok == n else 1


if __name__ == "__main__":
    sys.exit(main())
