"""Rows that are delivered again, without a shuffle of what they carry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Repeated keys up to which they are broadcast, 8 bytes each; beyond, all rows are shuffled.
MAX_REPEATED = 2_000_000


def once(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """Each non-null key once, with ``columns``: repeated deliveries carry equal columns, so any of them serves.

    Keys alone are counted over all rows. Those that come several times are few and are broadcast after
    that count; only their rows are shuffled, and no text of the others. Where no key is repeated, the
    rows stay as they lie. Keys that are not integers, or too many repeated ones, shuffle all rows.
    """
    kept = df.select(F.col(key), *[F.col(c) for c in columns]).where(F.col(key).isNotNull())
    if not isinstance(df.schema[key].dataType, T.IntegralType):
        return kept.dropDuplicates([key])
    repeated = df.select(F.col(key)).where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(key)
    n = repeated.limit(MAX_REPEATED + 1).count()
    if n == 0:
        return kept
    if n > MAX_REPEATED:
        return kept.dropDuplicates([key])
    again = F.broadcast(repeated)
    return kept.join(again, key, "left_anti").unionByName(kept.join(again, key, "left_semi").dropDuplicates([key]))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Distinct rows where few are repeated: rows are counted by a hash, and only those whose hash comes several times are shuffled."""
    keyed = df.withColumn("_row", F.xxhash64(*df.columns))
    repeated = keyed.groupBy("_row").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_row")
    n = repeated.limit(MAX_REPEATED + 1).count()
    if n == 0:
        return df
    if n > MAX_REPEATED:
        return df.distinct()
    again = F.broadcast(repeated)
    return keyed.join(again, "_row", "left_anti").unionByName(keyed.join(again, "_row", "left_semi").distinct()).drop("_row")
