"""Queries of the text problems with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrine.llm import furniture, leaks, lookalike, markup, neardup, scans, sentences, split, tokens
from papyrine.llm.words import window_hashes, words
from papyrine.session import table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return furniture.repeated_lines(table(spark, sf_dir, "manuscript"), table(spark, sf_dir, "shred_batch"))


def p2_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return furniture.without_repeated_lines(table(spark, sf_dir, "manuscript"), table(spark, sf_dir, "shred_batch"))


def _text_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = table(spark, sf_dir, "manuscript").where("marker_md is not null and doc_id is not null")
    return src.select(F.col("doc_id").alias("id"), words(F.col("marker_md")).alias("ws")).select("id", window_hashes(F.col("ws"), 3).alias("hashes"))


def _title_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "meta").where("title is not null and doc_id is not null").select(F.col("doc_id").alias("id"), neardup.char_shingles(F.col("title")).alias("hashes"))


#: (threshold, size of sketch) of the texts and of the titles.
TEXT_RULE, TITLE_RULE = (0.6, 96), (0.75, 512)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = neardup.similar_pairs(_text_sets(spark, sf_dir), *TEXT_RULE)
    titles = neardup.similar_pairs(_title_sets(spark, sf_dir), *TITLE_RULE)
    return texts.select(F.lit("marker_md").alias("field"), "id_a", "id_b").unionByName(titles.select(F.lit("title").alias("field"), "id_a", "id_b"))


def p3_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs of p3_found with whole sets in place of sketches, to measure what sketches miss."""
    return neardup.similar_pairs(_text_sets(spark, sf_dir), TEXT_RULE[0]).select(F.lit("marker_md").alias("field"), "id_a", "id_b")


def p3_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = neardup.groups(_text_sets(spark, sf_dir), *TEXT_RULE).select(F.lit("marker_md").alias("field"), "*")
    titles = neardup.groups(_title_sets(spark, sf_dir), *TITLE_RULE).select(F.lit("title").alias("field"), "*")
    return texts.unionByName(titles).withColumnRenamed("id", "doc_id")


def _titles_and_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = table(spark, sf_dir, "meta").select(F.lit("title").alias("field"), F.col("doc_id").alias("id"), F.col("title").alias("raw"))
    return titles.unionByName(table(spark, sf_dir, "extract_refs").select(F.lit("snippet").alias("field"), F.col("entry_id").alias("id"), F.col("snippet").alias("raw")))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike.lookalike_pairs(_titles_and_snippets(spark, sf_dir))


def p4_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike.unify(_titles_and_snippets(spark, sf_dir)).select("field", "id", "text")


def p5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.pieces(table(spark, sf_dir, "manuscript"), table(spark, sf_dir, "docling_meta"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_pieces(spark, sf_dir).where("piece_no = 2").select("field", "doc_id")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.scan_noise(table(spark, sf_dir, "manuscript"))


def p6_mended(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.mended(table(spark, sf_dir, "manuscript"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.residue(table(spark, sf_dir, "manuscript"))


def p7_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.cleaned(table(spark, sf_dir, "manuscript"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences.sentences(table(spark, sf_dir, "documents"), with_text=False)


def p10_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences.sentences(table(spark, sf_dir, "documents"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode(table(spark, sf_dir, "documents"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_item"))


def p9_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.without_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_item"))


QUERIES = {f.__name__: f for f in (p2_found, p2_cleaned, p3_found, p3_exact, p3_groups, p4_found, p4_unified, p5_found, p5_pieces, p6_found, p6_mended, p7_found, p7_cleaned, p8_ids, p9_found, p9_cleaned, p10_found, p10_sentences)}

P9 = """
with w as (select doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') as ws from (select distinct doc_id, text from documents)),
v as (select item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') as ws from eval_item),
dw as (select doc_id, array_to_string(ws[i:i+11], ' ') as g from w, unnest(range(1, len(ws) - 10)) as t(i)),
ew as (select distinct item_id, array_to_string(ws[i:i+11], ' ') as g from v, unnest(range(1, len(ws) - 10)) as t(i))
select distinct doc_id, item_id from dw join ew using (g)
"""

P9_CLEANED = """
with w as (select distinct doc_id, text, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') as ws, regexp_extract_all(text, '[\\p{L}\\p{N}]+') as raw, string_split_regex(text, '[\\p{L}\\p{N}]+') as gaps from documents where doc_id is not null),
v as (select regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') as ws from eval_item),
dw as (select doc_id, i, array_to_string(ws[i:i+11], ' ') as g from w, unnest(range(1, len(ws) - 10)) as t(i)),
ew as (select distinct array_to_string(ws[i:i+11], ' ') as g from v, unnest(range(1, len(ws) - 10)) as t(i)),
hits as (select doc_id, list_distinct(flatten(list(range(i - 1, i + 11)))) as hit from dw semi join ew using (g) group by doc_id)
select doc_id, case when hit is null then text else array_to_string(list_transform(range(0, len(raw) + 1), lambda i: (case when list_contains(hit, i) and list_contains(hit, i - 1) then '' else gaps[i + 1] end)
  || (case when list_contains(hit, i) or i >= len(raw) then '' else raw[i + 1] end)), '') end as text from w left join hits using (doc_id)
"""

P2 = """
with j as (select doc_id, min(journal) as journal from shred_batch where journal is not null and doc_id is not null group by doc_id),
m as (select distinct doc_id, marker_md, journal from manuscript join j using (doc_id) where marker_md is not null),
l as (select doc_id, journal, i as line_no, trim(regexp_replace(regexp_replace(lower(ls[i]), '[0-9]', '', 'g'), '[ \t]+', ' ', 'g'), ' ') as form
      from (select *, string_split(marker_md, chr(10)) as ls from m), unnest(range(1, len(ls) + 1)) as t(i)),
n as (select journal, count(distinct doc_id) as papers from m group by journal),
f as (select journal, form from l join n using (journal) where length(form) >= 30 group by journal, form, papers
      having count(distinct doc_id) >= 4 and count(distinct doc_id) >= 0.15 * papers)
select doc_id, line_no from l join f using (journal, form)
"""

P3 = """
with t as (select distinct doc_id, regexp_extract_all(lower(marker_md), '[\\p{L}\\p{N}]+') as ws from manuscript where marker_md is not null),
g as (select distinct 'marker_md' as field, doc_id, array_to_string(ws[i:i+2], ' ') as g from t, unnest(range(1, len(ws) - 1)) as u(i)
      union all
      select distinct 'title', doc_id, substr(lower(title), i, 3) from meta, unnest(range(1, length(title) - 1)) as u(i)),
n as (select field, doc_id, count(*) as n from g group by field, doc_id),
p as (select a.field, a.doc_id as id_a, b.doc_id as id_b, count(*) as k from g a join g b on a.field = b.field and a.g = b.g and a.doc_id < b.doc_id group by all)
select p.field, id_a, id_b from p join n x on (x.field = p.field and x.doc_id = id_a) join n y on (y.field = p.field and y.doc_id = id_b)
where k >= (x.n + y.n - k) * case p.field when 'title' then 0.75 else 0.6 end
"""

#: Groups by a recursion that spreads the least id, over all records that have a shingle.
P3_GROUPS = f"""
with recursive pairs as materialized ({P3}),
links as materialized (select field, id_a as a, id_b as b from pairs union select field, id_b, id_a from pairs),
sets as materialized (select 'marker_md' as field, doc_id, list_sort(list_distinct(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i+2], ' ')))) as g
  from (select distinct doc_id, regexp_extract_all(lower(marker_md), '[\\p{{L}}\\p{{N}}]+') as ws from manuscript where marker_md is not null and doc_id is not null) where len(ws) >= 3
  union all select 'title', doc_id, list_sort(list_distinct(list_transform(range(1, length(title) - 1), lambda i: substr(lower(title), i, 3)))) from (select distinct doc_id, title from meta where title is not null and doc_id is not null) where length(title) >= 3),
reached as (select field, a as id, b as other from links union select r.field, r.id, l.b from reached r join links l on l.field = r.field and l.a = r.other),
least as (select field, id, least(id, min(other)) as group_id from reached group by field, id),
near as (select l.field, l.a as id, count(distinct y.g) as n from links l join sets x on x.field = l.field and x.doc_id = l.a join sets y on y.field = l.field and y.doc_id = l.b where x.g <> y.g group by l.field, l.a)
select field, doc_id, coalesce(group_id, doc_id) as group_id, coalesce(n, 0) as n_links from sets left join least on (least.field = sets.field and least.id = doc_id) left join near on (near.field = sets.field and near.id = doc_id)
""".replace("select field, doc_id, coalesce", "select sets.field, doc_id, coalesce")

P5 = """
select 'marker_md' as field, doc_id from manuscript where length(marker_md) > 4000
union
select 'headings' as field, doc_id from docling_meta where list_sum(list_transform(headings, lambda h: length(coalesce(h.text, '')))) > 1000
"""

ORACLE = {"p2_found": P2, "p3_found": P3, "p3_exact": f"select * from ({P3}) where field = 'marker_md'", "p3_groups": P3_GROUPS, "p5_found": P5, "p9_found": P9, "p9_cleaned": P9_CLEANED}
