"""Papers processed once, as their files arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from papyrine.operators.cleaning import clean_stats, dominant_style, mechanical_clean
from papyrine.sources.filenames import parse_filename, sanitise


def stream_markdown(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of ``path, stem, md`` of whole markdown files."""
    files = spark.readStream.format("text").option("wholetext", "true").option("pathGlobFilter", "*.md").load(folder)
    path = F.col("_metadata.file_path")
    stem = sanitise(F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.md\z", ""))
    return files.select(path.alias("path"), stem.alias("stem"), F.regexp_replace("value", "\r\n?", "\n").alias("md"))


def process_new(spark: SparkSession, folder: str, out: str, checkpoint: str) -> StreamingQuery:
    """Appends a row for each file not yet processed, then stops; the checkpoint remembers what was done."""
    rows = stream_markdown(spark, folder).withColumn("text", mechanical_clean(F.col("md")))
    style = dominant_style(F.col("text"))
    facts = rows.select("path", "stem", "text", *clean_stats(F.col("text")), style["style"].alias("citation_style"), parse_filename(F.col("stem")).alias("name"))
    return facts.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
