"""Loading delimited text records, with the broken ones set apart and explained.

One anchored regular expression, generated from the schema, accepts a whole record. Only records it
refuses go through the field-prefix patterns, which name the first field that does not fit.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Field:
    """A field of the record: ``body`` is the regular expression of its unquoted value, or None for any text."""

    name: str
    type: str
    body: str | None = None

    @property
    def pattern(self) -> str:
        # possessive, so that neither long values nor long runs of doubled quotes can exhaust the stack
        if self.body is None:
            return r'(?:"(?:[^"]++|"")*+"|[^",]*+)'
        return f'(?:"(?:{self.body})"|(?:{self.body}))'


COUNT_FROM_1 = "0*[1-9][0-9]*"
COUNT_FROM_0 = "[0-9]+"

TABLE_AUDIT = (
    Field("doc_id", "bigint", COUNT_FROM_1),
    Field("start_line", "int", COUNT_FROM_1),
    Field("n_rows", "int", COUNT_FROM_0),
    Field("n_cols", "int", "0*(?:[0-9]{1,2}|1[0-9]{2}|200)"),
    Field("verdict", "string", "data|admin|prose|empty"),
    Field("admin_score", "int", "[0-9]*"),
    Field("data_score", "int", "[0-9]*"),
    Field("preview", "string"),
)


def record_pattern(fields: Sequence[Field]) -> str:
    """The anchored pattern of a good record."""
    return r"\A" + ",".join(f.pattern for f in fields) + r"\z"


def prefix_pattern(fields: Sequence[Field], k: int) -> str:
    """The anchored pattern of records whose first ``k`` fields are good."""
    return r"\A" + ",".join(f.pattern for f in fields[:k]) + ("," if k < len(fields) else r"\z")


#: Runs of digits that may be too long for a number.
LONG = r"[0-9]{10}"


def _text(raw: Column, fields: Sequence[Field], k: int) -> Column:
    groups = ",".join(f"({f.pattern})" if i == k else f.pattern for i, f in enumerate(fields))
    text = F.regexp_extract(raw, r"\A" + groups + r"\z", 1)
    quoted = text.startswith('"')
    return F.when(quoted, F.replace(text.substr(F.lit(2), F.length(text) - 2), F.lit('""'), F.lit('"'))).otherwise(text)


def _value(raw: Column, fields: Sequence[Field], k: int) -> Column:
    text = _text(raw, fields, k)
    return text if fields[k].type == "string" else text.try_cast(fields[k].type)


def reason(raw: Column, fields: Sequence[Field]) -> Column:
    """Why a record is refused: ``null``, ``blank``, ``fields missing after k``, ``field k: name`` (the first that is broken, or beyond its type) or ``more than k fields``; null if it is good."""
    fits = F.when(raw.isNull(), F.lit("null")).when(~raw.rlike(r"[^\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"), F.lit("blank"))
    good = raw.rlike(record_pattern(fields))
    # only a long run of digits can be beyond the range of a type
    fits = fits.when(good & ~raw.rlike(LONG), F.lit(None).cast("string"))
    for k, f in enumerate(fields):
        if f.type != "string":
            fits = fits.when(good & (_text(raw, fields, k) != "") & _value(raw, fields, k).isNull(), F.lit(f"field {k + 1}: {f.name} beyond the range of {f.type}"))
    fits = fits.when(good, F.lit(None).cast("string"))
    for k in range(1, len(fields)):
        short = r"\A" + ",".join(f.pattern for f in fields[:k]) + r"\z"
        fits = fits.when(raw.rlike(short), F.lit(f"fields missing after {k}"))
        fits = fits.when(~raw.rlike(prefix_pattern(fields, k)), F.lit(f"field {k}: {fields[k - 1].name}"))
    more = r"\A" + ",".join(f.pattern for f in fields) + ","
    return fits.when(raw.rlike(more), F.lit(f"more than {len(fields)} fields")).otherwise(F.lit(f"field {len(fields)}: {fields[-1].name}"))


def load_records(df: DataFrame, key: str, raw: str, fields: Sequence[Field] = TABLE_AUDIT) -> tuple[DataFrame, DataFrame]:
    """Split ``df`` into (good rows, broken rows), each key once however often it was delivered.

    Good: the key and the typed fields; empty numbers become null. Broken: the key, the raw text and the
    reason. Null and blank records are broken, and so are numbers that their type cannot take. An empty table
    gives two empty results. Columns other than ``key`` and ``raw`` are ignored, whatever their names.
    Everything is a projection of the scan; the only shuffle removes repeated deliveries.
    """
    src = df.select(F.col(key).alias("_key"), F.col(raw).alias("_raw")).withColumn("_reason", reason(F.col("_raw"), fields))
    bad = src.where(F.col("_reason").isNotNull()).groupBy("_key").agg(F.min(F.struct("_raw", "_reason")).alias("_r"))
    bad = bad.select(F.col("_key").alias(key), F.col("_r._raw").alias("raw"), F.col("_r._reason").alias("reason"))
    good = src.where(F.col("_reason").isNull()).groupBy("_key").agg(F.min("_raw").alias("_raw"))
    good = good.select(F.col("_key").alias(key), *[_value(F.col("_raw"), fields, k).alias(f.name) for k, f in enumerate(fields)])
    return good, bad
