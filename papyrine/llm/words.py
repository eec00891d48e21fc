"""Words, shingles and texts as every text operator of this subpackage sees them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """Lower-cased maximal runs of letters or numbers; empty for null text."""
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})")), F.array().cast("array<string>"))


def window_hashes(ws: Column, n: int) -> Column:
    """A 64-bit hash of each ``n`` consecutive words, in order; empty if there are fewer."""
    return F.when(
        F.size(ws) >= n,
        F.transform(F.sequence(F.lit(1), F.size(ws) - (n - 1)), lambda i: F.xxhash64(*[F.element_at(ws, (i + k).cast("int")) for k in range(n)])),
    ).otherwise(F.array().cast("array<bigint>"))


