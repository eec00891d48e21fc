"""Passes and searches over manuscripts rendered from the table of documents, in which every artefact occurs.

The text of the view is the same in both engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrine.functions.patterns import quoted, rewrite, sql_count, sql_rewrite
from papyrine.operators import cleaning, headings
from papyrine.session import spread, table

MANUSCRIPTS = """
select doc_id, concat(
  '{', cast(doc_id % 7 as string), '}------', chr(10),
  case when doc_id % 5 = 0 then concat('# Europe PMC Funders Group', chr(10), chr(10)) else '' end,
  '# ', case when doc_id % 4 = 1 then 'Review' else concat('Study ', cast(doc_id as string), ' of clearance in aging cells') end, chr(10), chr(10),
  case when doc_id % 6 = 2 then concat('| Project title | Synthetic project number ', cast(doc_id as string), ' |', chr(10), '|---|---|', chr(10), chr(10)) else '' end,
  case when doc_id % 9 = 0 then concat('bioRxiv preprint', chr(10), chr(10)) else '' end,
  substr(replace(text, chr(10), ' '), 1, (doc_id % 5) * 150), chr(10), chr(10),
  case when doc_id % 3 = 2 then '### ' when doc_id % 3 = 1 then '## ' else '# ' end, 'Abstract', chr(10), chr(10),
  'a ', substr(replace(text, chr(10), ' '), 1, 200), 'x <sup>', cast(doc_id % 40 + 1 as string), '</sup> and[s', cast(doc_id % 30 + 1 as string), ',](https://paperpile.com/c/a) too', chr(10), chr(10),
  case when doc_id % 3 = 2 then '### ' when doc_id % 3 = 1 then '## ' else '# ' end, 'Methods', chr(10), chr(10),
  'mice were kept  in [A](#page-1-0), [B](https://docs.google.com/u) <span id="page-2-0"></span>*(legend on next page)*', chr(10), chr(10),
  '![](_page_', cast(doc_id % 8 as string), '_Figure_1.jpeg)', chr(10), chr(10),
  case when doc_id % 2 = 0 then concat('Figure 1. Panel overview ', cast(doc_id as string), '. More words.', chr(10), chr(10), '(A) left side', chr(10), 'Scale bar 5 um', chr(10), chr(10)) else '' end,
  case when doc_id % 8 = 3 then concat('#### Figure 2. Heading caption text.', chr(10), 'caption tail', chr(10), chr(10)) else '' end,
  case when doc_id % 3 = 2 then '### ' when doc_id % 3 = 1 then '## ' else '# ' end, 'Results', chr(10), chr(10),
  'We cite [', cast(doc_id % 9 + 1 as string), '](https://www.zotero.org/google-docs/?k', cast(doc_id as string), ') and [3,4] as in Smith et al. 2019.<br>', chr(10), chr(10), chr(10),
  case when doc_id % 4 = 0 then concat('| id | qty | price |', chr(10), '|---|---|---|', chr(10), '| 1 | 2 | 3 |', chr(10), '| 2 | 2 | 3 |', chr(10), '| 3 | 2 | 3 |', chr(10), chr(10))
       when doc_id % 4 = 1 then concat('| Email | a@b |', chr(10), '|---|---|', chr(10), '| Name | x |', chr(10), chr(10))
       when doc_id % 4 = 2 then concat('| one column of piped prose |', chr(10), '| more prose |', chr(10), chr(10))
       else concat('|---|', chr(10), chr(10)) end,
  case when doc_id % 7 < 3 then concat('# Alpha part', chr(10), 'aa', chr(10), '# Beta part', chr(10), 'bbbb', chr(10), '# Gamma part', chr(10), 'c', chr(10), '# Delta part', chr(10), 'dddddd', chr(10), '# Epsilon part', chr(10), 'ee', chr(10), '# Zeta part', chr(10), 'ffff', chr(10), '# 3D imaging', chr(10), 'gg', chr(10), '# Highlights', chr(10), 'hh', chr(10), chr(10)) else '' end,
  case when doc_id % 3 = 1 then concat('<sup>1</sup>Department of Cell Biology, Nowhere', chr(10), chr(10), '<sup>*</sup>Correspondence: someone', chr(10), chr(10), '# SUMMARY', chr(10), chr(10), 'cut in', chr(10), chr(10), 'the middle', chr(10), chr(10)) else '' end,
  case when doc_id % 11 = 0 then concat('seen in PMID: ', cast(10000000 + doc_id as string), '. ', chr(10), chr(10)) else '' end,
  case when doc_id % 10 = 9 then '' else concat('## **', case when doc_id % 10 = 8 then 'Works Cited' else 'References' end, '**', chr(10), chr(10),
    case when doc_id % 2 = 0 then concat('1. Smith J. doi:10.1234/a', cast(doc_id % 50 as string), '.', chr(10), '2. Doe A. 10.1234/b;', chr(10), '3. Roe B. x', chr(10), '4. Poe C. y', chr(10), '5. Loe D. z', chr(10))
         else concat('Smith AB, Doe C (2020) Title', chr(10), 'Roe BC, Poe D (2018) Other', chr(10)) end) end

) as md
from documents where text is not null
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
_SQL = f"select doc_id, md from ({MANUSCRIPTS}) where md is not null"


def _manuscripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    src.createOrReplaceTempView("_rendered_documents")
    return spark.sql(MANUSCRIPTS.replace("from documents", "from _rendered_documents")).where("md is not null")


def _add(name: str, rules: cleaning.Rules) -> None:
    """A pass over the rendered manuscripts, with their lengths before it."""
    QUERIES[name] = lambda spark, sf_dir: _manuscripts(spark, sf_dir).select("doc_id", rewrite(F.col("md"), rules).alias("text"), F.length("md").alias("n_before"))
    ORACLE[name] = f"with m as ({_SQL}) select doc_id, {sql_rewrite('md', rules)} as text, length(md)::int as n_before from m"


for _name, _rules in cleaning.PASSES.items():
    _add(f"rendered_clean_{_name}", _rules)
_add("rendered_clean", cleaning.MECHANICAL)
for _name, _rules in cleaning.SECTION_PASSES.items():
    _add(f"rendered_post_{_name}", _rules)
_add("rendered_post_clean", cleaning.POST)


def rendered_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = rewrite(F.col("md"), cleaning.MECHANICAL)
    return _manuscripts(spark, sf_dir).select("doc_id", text.alias("text")).select("doc_id", *cleaning.citation_counts(F.col("text")), F.size(headings.headings(F.col("text"))).alias("n_headings"))


QUERIES["rendered_counts"] = rendered_counts
ORACLE["rendered_counts"] = (
    f"with m as (select doc_id, {sql_rewrite('md', cleaning.MECHANICAL)} as text from ({_SQL})) select doc_id, {', '.join(f'{sql_count("text", p)}::int as n_{k}' for k, p in cleaning.CITATIONS.items())}, "
    f"len(list_filter(regexp_extract_all(text, {quoted(headings.HEADING)}, 2), lambda x: trim(trim(x, ' '), '*') <> ''))::int as n_headings from m"
)
