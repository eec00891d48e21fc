"""Files that the extractors read and write, as tables."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papyrine.sources.filenames import sanitise

#: Bytes of an image that mostly hold its size.
HEAD = 65536

DOCLING_META = "title string, headings array<struct<level int, text string>>, n_pages int, n_pictures int, n_tables int, n_texts int, saved_pictures array<string>, runtime_seconds double"


def _name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def pdfs(spark: SparkSession, target: str, contents: bool = False) -> DataFrame:
    """``path, stem, length`` (and ``content``) of a PDF file or of all below a folder in order of their paths, without links and without those in ``_raw`` folders."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.pdf").load(target)
    files = files.where(~F.col("path").rlike("/_raw/") & ~_is_link("path"))
    stem = sanitise(F.regexp_replace(_name(F.col("path")), r"\.pdf\z", ""))
    return files.select("path", stem.alias("stem"), "length", *(["content"] if contents else [])).orderBy("path")


@F.pandas_udf(T.BooleanType())
def _is_link(path: pd.Series) -> pd.Series:
    """Whether a path of a mounted file system is a symbolic link; other stores have none."""
    import os
    from urllib.parse import unquote, urlparse

    return path.map(lambda p: urlparse(p).scheme in ("", "file") and os.path.islink(unquote(urlparse(p).path)))


def markdown(spark: SparkSession, path: str) -> DataFrame:
    """``path, md`` of whole markdown files, with one kind of line end."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.md")
    return files.select(F.col("_metadata.file_path").alias("path"), F.regexp_replace("value", "\r\n?", "\n").alias("md"))


def key_values(text: Column) -> Column:
    """A map of ``key=value`` lines, split at the first sign; the last of equal keys counts, other lines do not."""
    rows = F.filter(F.split(text, "\n", -1), lambda x: F.contains(x, F.lit("=")))
    pairs = F.transform(rows, lambda x: F.split(x, "=", 2))
    keys = F.transform(pairs, lambda p: F.get(p, F.lit(0)))
    last = F.filter(pairs, lambda p, i: ~F.array_contains(F.slice(keys, i + 2, F.greatest(F.size(keys), F.lit(1))), F.get(p, F.lit(0))))
    return F.map_from_arrays(F.transform(last, lambda p: F.get(p, F.lit(0))), F.transform(last, lambda p: F.get(p, F.lit(1))))


def docling_meta(text: Column) -> Column:
    """The docling metadata of a JSON text; null if it cannot be read."""
    return F.from_json(text, DOCLING_META)


def page_count(marker_meta: Column) -> Column:
    """Pages by the marker metadata: the length of ``page_stats``, or its ``n_pages``."""
    listed = F.from_json(marker_meta, "page_stats array<string>")["page_stats"]
    return F.coalesce(F.when(listed.isNotNull(), F.size(listed)), F.get_json_object(marker_meta, "$.page_stats.n_pages").cast("int"))


_IMAGE = re.compile(r"/(marker_out/[^/]+|docling_out/docling_pictures)/[^/]+\.(png|jpe?g)$")


def images(spark: SparkSession, work: str) -> DataFrame:
    """``path, source, rank, w, h, error`` of the extractors' images below ``work``, a folder or URI that all executors share; sizes are read from their headers.

    Names that begin with an underscore, as the first extractor gives them, are hidden from Spark's own
    listing. So the folders directly below ``work`` become rows, and each task lists and reads its own.
    """
    from pyarrow.fs import FileSelector, FileSystem

    fs, base = FileSystem.from_uri(work)
    folders = [(x.path,) for x in fs.get_file_info(FileSelector(base, allow_not_found=True))]
    cores = spark.sparkContext.defaultParallelism

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, _ = FileSystem.from_uri(work)
        for batch in batches:
            for folder in batch["folder"]:
                rows = []
                for info in store.get_file_info(FileSelector(folder, recursive=True)) if store.get_file_info(folder).type.name == "Directory" else ():
                    if info.is_file and (m := _IMAGE.search(info.path)):
                        source = "marker" if m[1].startswith("marker") else "docling"
                        order = ["jpeg", "jpg", "png"] if source == "marker" else ["png", "jpeg", "jpg"]
                        with store.open_input_file(info.path) as f:
                            w, h = image_size(f.read(HEAD))
                            if w is None and info.size > HEAD:  # large segments may stand before the size
                                f.seek(0)
                                w, h = image_size(f.read())
                        rows.append((info.path, source, order.index(m[2]) + 1, w, h, None if w else "not an image"))
                yield pd.DataFrame(rows, columns=["path", "source", "rank", "w", "h", "error"]).astype({"w": "Int32", "h": "Int32"})

    listed = spark.createDataFrame(folders, "folder string").repartition(max(1, min(len(folders), 8 * cores)))
    return listed.mapInPandas(run, "path string, source string, rank int, w int, h int, error string")


def contents(files: DataFrame, root: str) -> DataFrame:
    """``files`` with the bytes of the file at ``path`` as ``content``, read where the rows are; ``root`` names the store."""
    from pyarrow.fs import FileSystem

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, _ = FileSystem.from_uri(root)
        for batch in batches:
            for k in range(len(batch)):  # one file at a time
                one = batch.iloc[k : k + 1]
                with store.open_input_file(one["path"].iloc[0]) as f:
                    yield one.assign(content=[f.read()])

    return files.mapInPandas(run, T.StructType([*files.schema.fields, T.StructField("content", T.BinaryType())]))


def image_size(head: bytes) -> tuple[int | None, int | None]:
    """Width and height of a PNG or JPEG by its first bytes."""
    if head[:8] == b"\x89PNG\r\n\x1a\n" and len(head) >= 24:
        return int.from_bytes(head[16:20]), int.from_bytes(head[20:24])
    if head[:2] == b"\xff\xd8":
        at = 2
        while at + 9 < len(head) and head[at] == 0xFF:
            mark = head[at + 1]
            if 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC):
                return int.from_bytes(head[at + 7 : at + 9]), int.from_bytes(head[at + 5 : at + 7])
            at += 2 + int.from_bytes(head[at + 2 : at + 4])
    return None, None


#: What an extractor says that was given too much at once, fixed values of its messages.
OVERFLOW = r"AcceleratorError|index 8192 is out of bounds|unpack_qkv_with_mask"

Marker = Callable[[str, bytes, "int | None"], "tuple[str | None, str | None]"]
Docling = Callable[[str, bytes], "str | None"]


def check_extractors(marker: Marker | None, docling: Docling | None) -> None:
    """The first extractor is mandatory, the second optional."""
    if not callable(marker):
        raise ValueError("no extractor: give marker(path, content, batch_size) -> (markdown, metadata)")
    if docling is not None and not callable(docling):
        raise ValueError("docling must be docling(path, content) -> JSON, or None")


def extract(files: DataFrame, marker: Marker, docling: Docling | None = None, retries: int = 1) -> DataFrame:
    """``path, stem, marker_md, marker_meta, docling_json, error`` by extractors that are plugged in and run side by side.

    The first is mandatory, the second optional: if it fails, its output is null. A file whose first
    extraction fails by an overflow is tried again page by page, otherwise as it was; then it becomes a row
    with its error, and never stops the others.
    """
    check_extractors(marker, docling)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(2) as pool:
            for batch in batches:
                rows = []
                for path, stem, content in zip(batch["path"], batch["stem"], batch["content"]):
                    second = pool.submit(docling, path, bytes(content)) if docling else None
                    md = meta = error = other = size = None
                    for _ in range(retries + 1):
                        try:
                            md, meta = marker(path, bytes(content), size)
                            error = None if md is not None else "no_marker_md"
                            break
                        except Exception as e:  # noqa: BLE001, the row tells
                            error = f"extract_failed: {e}"[-500:]
                            size = 1 if re.search(OVERFLOW, str(e)) else size
                    try:
                        other = second.result() if second else None
                    except Exception:  # noqa: BLE001, the second output is optional
                        other = None
                    rows.append((path, stem, md, meta, other, error))
                yield pd.DataFrame(rows, columns=["path", "stem", "marker_md", "marker_meta", "docling_json", "error"])

    return files.mapInPandas(run, "path string, stem string, marker_md string, marker_meta string, docling_json string, error string")


def pending(found: DataFrame, done: DataFrame, key: str = "stem") -> DataFrame:
    """What is found and not yet done."""
    return found.join(done.select(key).distinct(), key, "left_anti")
