"""What a paper's file name tells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from papyrine.functions.patterns import S

#: ``YYYY-MM_Journal_topic_(PMIDn|DOIx)``, a fixed value of the naming scheme.
STEM = r"\A(\p{Nd}{4})-(\p{Nd}{2})_([^_]+)_([^\n]+?)_(?:PMID(\p{Nd}+)|DOI([\p{Nd}.]+))\n?\z"


def sanitise(stem: Column) -> Column:
    return F.regexp_replace(stem, f"{S}+", "_")


def parse_filename(stem: Column) -> Column:
    """Struct ``year, month, journal, topic, pmid, doi``; null for null and for names that do not follow the scheme."""
    part = lambda k: F.nullif(F.regexp_extract(stem, STEM, k), F.lit(""))
    fields = F.struct(part(1).cast("int").alias("year"), part(2).cast("int").alias("month"), part(3).alias("journal"), part(4).alias("topic"), part(5).alias("pmid"), part(6).alias("doi"))
    return F.when(stem.rlike(STEM), fields)
