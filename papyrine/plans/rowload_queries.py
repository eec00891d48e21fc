"""Queries of problem 1 with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from papyrine.functions.patterns import BLANKS
from papyrine.operators.rowload import TABLE_AUDIT, load_records
from papyrine.session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_records(table(spark, sf_dir, "table_audit_raw"), "rec_id", "raw")[1].select("rec_id")


def p1_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_records(table(spark, sf_dir, "table_audit_raw"), "rec_id", "raw")[1]


def p1_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_records(table(spark, sf_dir, "table_audit_raw"), "rec_id", "raw")[0]


QUERIES = {"p1_found": p1_found, "p1_rejects": p1_rejects, "p1_loaded": p1_loaded}

_PARTS = [f"(?:\"(?:{f.body})\"|(?:{f.body}))" if f.body else "(?:\"(?:[^\"]|\"\")*\"|[^\",]*)" for f in TABLE_AUDIT]
_GOOD = "^" + ",".join(_PARTS) + "$"
_OK = f"coalesce(regexp_full_match(raw, '{_GOOD}'), false)"


def _sql_value(k: int) -> str:
    groups = ",".join(f"({p})" if i == k else p for i, p in enumerate(_PARTS))
    text = f"regexp_extract(raw, '^{groups}$', 1)"
    text = f"case when {text} like '\"%' then replace(substr({text}, 2, length({text}) - 2), '\"\"', '\"') else {text} end"
    return f"{text if TABLE_AUDIT[k].type == 'string' else f'try_cast({text} as {TABLE_AUDIT[k].type})'} as {TABLE_AUDIT[k].name}"


def _sql_reason() -> str:
    def fits(k: int, end: str) -> str:
        return f"regexp_matches(raw, '\\A(?:{','.join(_PARTS[:k])}){end}')"

    steps = ["when raw is null then 'null'", f"when not regexp_matches(raw, '[^{BLANKS}]') then 'blank'"]
    for k in range(1, len(_PARTS)):
        steps.append(f"when {fits(k, chr(92) + 'z')} then 'fields missing after {k}'")
        steps.append(f"when not {fits(k, ',')} then 'field {k}: {TABLE_AUDIT[k - 1].name}'")
    last = len(_PARTS)
    steps.append(f"when {fits(last, ',')} then 'more than {last} fields'")
    return f"case {' '.join(steps)} else 'field {last}: {TABLE_AUDIT[-1].name}' end"


ORACLE = {
    "p1_found": f"select distinct rec_id from table_audit_raw where not {_OK}",
    "p1_rejects": f"select distinct rec_id, raw, {_sql_reason()} as reason from table_audit_raw where not {_OK}",
    "p1_loaded": f"select distinct rec_id, {', '.join(_sql_value(k) for k in range(len(TABLE_AUDIT)))} from table_audit_raw where {_OK}",
}
