"""Pipe tables of a document: blocks, shape, and whether they are forms, data or prose."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from papyrine.functions.patterns import D, NS, S, lines, matches, strip

# Fixed values of the rules that tell forms from data.
FORM_LABEL = rf"\A[A-Z]?{D}+(?:\.{D}+)?\.?{S}+{NS}"
ADMIN_WORD = (
    rf"(?i)\A{S}*(?:Email|Phone|Name|Full[{S[1:-1]}_]+Name|Address|ORCID|Date|Signature|Title|Position|Institution|Organisation|Organization|Department|Role|Affiliation|Contact|"
    rf"Job{S}+title|Project{S}+(?:title|lead|name)|Lead{S}+applicant|Co[{S[1:-1]}-]+applicant|Budget|Estimate|Justification|Staff{S}+costs|Running{S}+costs)(?:[^\p{{L}}\p{{N}}_]|\z)"
)
LABEL_SHARE, SHORT_FORM, DATA_COLS, DATA_ROWS, NUMERIC_ROWS, TIE_ROWS, PREVIEW = 0.4, 12, 3, 4, 3, 6, 140


def table_blocks(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc, start_line, lines`` of every maximal run of lines that begin with a pipe.

    Runs are found inside each row, so documents need no shuffle: a line begins a run when the line
    before it does not begin with a pipe.
    """
    ls = lines(F.col(text))
    flagged = F.transform(ls, lambda x, i: F.struct(i.alias("i"), x.alias("x"), matches(x, rf"\A{S}*\|").alias("p")))
    runs = F.aggregate(
        flagged,
        F.array().cast("array<struct<start_line:int,n:int>>"),
        lambda acc, r: F.when(~r["p"], acc)
        .when(
            (F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1)["start_line"] + F.get(acc, F.size(acc) - 1)["n"] == r["i"] + 1),
            F.concat(
                F.slice(acc, F.lit(1), F.size(acc) - 1),
                F.array(F.struct(F.get(acc, F.size(acc) - 1)["start_line"].alias("start_line"), (F.get(acc, F.size(acc) - 1)["n"] + 1).alias("n"))),
            ),
        )
        .otherwise(F.concat(acc, F.array(F.struct((r["i"] + 1).cast("int").alias("start_line"), F.lit(1).alias("n"))))),
    )
    blocks = docs.select(F.col(doc), ls.alias("_ls"), runs.alias("_runs")).select(doc, "_ls", F.explode_outer("_runs").alias("_r")).where("_r is not null")
    return blocks.select(doc, F.col("_r.start_line").alias("start_line"), F.slice("_ls", F.col("_r.start_line"), F.col("_r.n")).alias("lines"))


def cells(row: Column) -> Column:
    """The stripped cells of a row."""
    inner = F.regexp_replace(F.regexp_replace(strip(row), r"\A\|", ""), r"\|\z", "")
    return F.transform(F.split(inner, r"\|", -1), strip)


def classify(blocks: DataFrame, doc: str = "doc_id") -> DataFrame:
    """``doc, start_line, n_rows, n_cols, verdict, admin_score, data_score, reasons, preview``.

    Separator rows do not count. No rows: empty; one column: prose, both without scores; otherwise the
    greater score decides, a tie by the number of rows.
    """
    rows = F.filter(F.transform("lines", cells), lambda r: ~F.forall(r, lambda c: matches(c, rf"\A[\-:{S[1:-1]}]*\z")))
    base = blocks.select(doc, "start_line", rows.alias("rows"))
    base = base.withColumns({"n_rows": F.size("rows"), "n_cols": F.coalesce(F.array_max(F.transform("rows", F.size)), F.lit(0))})
    filled = F.filter(F.transform("rows", lambda r: F.get(r, F.lit(0))), lambda c: c != "")
    base = base.withColumn("first", filled)
    labels = F.aggregate("first", F.lit(0), lambda n, c: n + matches(c, FORM_LABEL).cast("int") + matches(c, ADMIN_WORD).cast("int") + c.endswith("?").cast("int"))
    some = F.greatest(F.size("first"), F.lit(1))
    base = base.withColumns({"ratio": labels / some, "n_numeric": F.size(F.filter("first", lambda c: matches(c, rf"\A[{D}.]+\z")))})
    scored = F.col("n_cols") > 1
    label, short = F.col("ratio") >= LABEL_SHARE, (F.col("n_cols") == 2) & (F.col("n_rows") <= SHORT_FORM)
    wide, numeric = (F.col("n_cols") >= DATA_COLS) & (F.col("n_rows") >= DATA_ROWS), (F.col("n_numeric") >= NUMERIC_ROWS) & (F.col("n_numeric") / some >= 0.5)
    admin, data = F.when(label, 3).otherwise(0) + F.when(short, 1).otherwise(0), F.when(wide, 2).otherwise(0) + F.when(numeric, 2).otherwise(0)
    base = base.withColumns({"admin_score": F.when(scored, admin), "data_score": F.when(scored, data)})
    tie = F.when(F.col("n_rows") <= TIE_ROWS, "admin").otherwise("data")
    verdict = F.when(F.col("n_rows") == 0, "empty").when(~scored, "prose").when(F.col("admin_score") > F.col("data_score"), "admin").when(F.col("data_score") > F.col("admin_score"), "data").otherwise(tie)
    tied = F.when(F.col("admin_score") == F.col("data_score"), F.concat(F.lit("tie-break by size ("), F.col("n_rows").cast("string"), F.lit(" rows → "), tie, F.lit(")")))
    told = F.array_compact(
        F.array(
            F.when(label, F.concat(F.lit("label-shaped first-col cells ("), F.bround(F.col("ratio") * 100, 0).cast("int").cast("string"), F.lit("%)"))),
            F.when(short, F.lit("2-col, short → likely label/value")),
            F.when(wide, F.concat(F.col("n_cols").cast("string"), F.lit(" cols × "), F.col("n_rows").cast("string"), F.lit(" rows"))),
            F.when(numeric, F.concat(F.col("n_numeric").cast("string"), F.lit(" numeric IDs in first col"))),
            tied,
        )
    )
    reasons = F.when(F.col("n_rows") == 0, F.array(F.lit("no rows"))).when(~scored, F.array(F.lit("1-col block — prose wrapped in pipes, not a real table"))).otherwise(told)
    first_row = F.get("rows", F.lit(0))
    preview = F.coalesce(F.left(F.when(scored, F.concat_ws(" | ", first_row)).otherwise(F.concat_ws(" ", first_row)), F.lit(PREVIEW)), F.lit(""))
    return base.select(doc, "start_line", "n_rows", "n_cols", verdict.alias("verdict"), "admin_score", "data_score", reasons.alias("reasons"), preview.alias("preview"))


def audit(verdicts: DataFrame, doc: str = "doc_id") -> DataFrame:
    """``doc, n_total, n_admin, n_data, n_prose``: one row per document that has a block."""
    return verdicts.groupBy(doc).agg(F.count(F.lit(1)).alias("n_total"), *[F.count_if(F.col("verdict") == v).alias(f"n_{v}") for v in ("admin", "data", "prose")])


def data_tables(blocks: DataFrame, verdicts: DataFrame, doc: str = "doc_id") -> DataFrame:
    """``doc, n, preview, content`` of the data tables, numbered in order, as files of their own."""
    joined = blocks.join(verdicts.where("verdict = 'data'").select(doc, "start_line", "preview"), [doc, "start_line"])
    n = F.row_number().over(Window.partitionBy(doc).orderBy("start_line"))
    numbered = joined.select(doc, n.alias("n"), F.left("preview", F.lit(120)).alias("preview"), "lines")
    return numbered.select(doc, "n", "preview", F.concat(F.lit("# Table "), F.col("n").cast("string"), F.lit("\n\n"), F.array_join("lines", "\n"), F.lit("\n")).alias("content"))
