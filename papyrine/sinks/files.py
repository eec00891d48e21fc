"""Results as tables, as JSON lines and as folders of files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, mode: str = "overwrite", buckets: int | None = None, key: str = "doc_id") -> None:
    """A parquet table; range-clustered by ``key`` where asked, so that later reads of a paper touch few files."""
    (df.repartitionByRange(buckets, key).sortWithinPartitions(key) if buckets else df).write.mode(mode).parquet(path)


def append_log(df: DataFrame, path: str) -> None:
    """Rows appended to a log of JSON lines; null fields are left out."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("append").text(path)


def meta_json(meta: DataFrame) -> DataFrame:
    """``stem, name, content``: the metadata of each paper as a file."""
    return meta.select("stem", F.lit("meta.json").alias("name"), F.to_json(F.struct(*[c for c in meta.columns if c not in ("doc_id", "stem")]), {"ignoreNullFields": "false", "pretty": "true"}).alias("content"))


def section_files(sections: DataFrame, stems: DataFrame) -> DataFrame:
    return sections.join(stems, "doc_id").select("stem", F.concat(F.lit("sections/"), F.col("slug"), F.lit(".md")).alias("name"), F.col("cleaned").alias("content"))


def numbered_files(rows: DataFrame, stems: DataFrame, folder: str, prefix: str, content: str) -> DataFrame:
    return rows.join(stems, "doc_id").select("stem", F.concat(F.lit(f"{folder}/{prefix}_"), F.lpad(F.col("n").cast("string"), 2, "0"), F.lit(".md")).alias("name"), F.col(content).alias("content"))


def audit_files(rows: DataFrame, stems: DataFrame, name: str, doc: str = "doc_id") -> DataFrame:
    """``stem, name, content``: the rows of an audit as one JSON array for each paper, in ``_raw``."""
    own = F.struct(*[c for c in rows.columns if c != doc])
    listed = rows.groupBy(doc).agg(F.to_json(F.array_sort(F.collect_list(own)), {"ignoreNullFields": "false"}).alias("content"))
    return listed.join(stems, doc).select("stem", F.lit(f"_raw/{name}").alias("name"), "content")


def raw_files(extracted: DataFrame) -> DataFrame:
    """``stem, name, content`` of what a paper was made from: the source, the extractor's markdown and metadata; what is missing is left out."""
    parts = F.array(*[F.struct(F.lit(f"_raw/{name}").alias("name"), F.col(c).cast("binary").alias("content")) for name, c in (("source.pdf", "content"), ("marker.md", "marker_md"), ("marker_meta.json", "marker_meta"))])
    return extracted.select("stem", F.explode(F.filter(parts, lambda x: x["content"].isNotNull())).alias("f")).select("stem", "f.name", "f.content")


def figure_copies(records: DataFrame, stems: DataFrame) -> DataFrame:
    """``stem, name, path`` of the kept figures: where each image goes, beside its sidecar, and where it lies."""
    nn = F.lpad(F.col("n").cast("string"), 2, "0")
    ext = F.lower(F.regexp_extract("path", r"(\.[^./]*)\z", 1))
    return records.join(stems, "doc_id").select("stem", F.concat(F.lit("figures/figure_"), nn, ext).alias("name"), "path")


def write_files(files: DataFrame, root: str) -> None:
    """Writes ``stem, name, content`` below ``root``, a folder or URI that all executors share; each file is put in place whole, so a task that runs again does no harm."""

    def run(rows: Iterable[Row]) -> None:
        import os

        from pyarrow.fs import FileSystem

        fs, base = FileSystem.from_uri(root)
        for row in rows:
            target = f"{base}/{row['stem']}/{row['name']}"
            fs.create_dir(target.rsplit("/", 1)[0], recursive=True)
            content = row["content"] or ""
            with fs.open_output_stream(f"{target}.{os.getpid()}.part") as f:
                f.write(content.encode("utf-8") if isinstance(content, str) else bytes(content))
            fs.move(f"{target}.{os.getpid()}.part", target)

    files.select("stem", "name", "content").foreachPartition(run)
