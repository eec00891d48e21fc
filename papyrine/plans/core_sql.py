"""SQL that gives what the queries on papers give, for engines without lookaround."""

from __future__ import annotations

from papyrine.functions.patterns import D, S, quoted, sql_count, sql_lines, sql_rewrite, sql_strip, sql_strip_stars
from papyrine.operators import cleaning, figures, headings, papers, references, sections, tables, titles
from papyrine.sources.filenames import STEM

RAW = "select distinct doc_id, marker_md as md from manuscript where doc_id is not null and marker_md is not null"
STEMMED = sql_rewrite("stem", [(f"{S}+", "_")])
PAPERS = f"m as materialized (select distinct doc_id, {STEMMED} as stem, {sql_rewrite('marker_md', cleaning.MECHANICAL)} as text from manuscript where doc_id is not null and marker_md is not null)"
SLUG_RULES = [(rf"\A(?:the|a|an){S}+", ""), ("[^a-z0-9]+", "_")]


def full(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, {quoted(pattern)})"


def located(text: str, pattern: str, source: str) -> str:
    """Rows of ``source`` with ``i, g0, g1, g2, s`` (offset) of each match; groups that do not exist are left out."""
    groups = 2 if pattern in (headings.HEADING, figures.CAPTION) else 1
    more = "".join(f", regexp_extract_all({text}, {quoted(pattern)}, {k}) as a{k}" for k in range(1, groups + 1))
    each = "".join(f", a{k}[i] as g{k}" for k in range(1, groups + 1))
    return f"""(select * exclude (a0, p{''.join(f', a{k}' for k in range(1, groups + 1))}), a0[i] as g0{each},
      list_sum(list_transform(p[1:i], lambda x: length(x)))::int + coalesce(list_sum(list_transform(a0[1:i-1], lambda x: length(x))), 0)::int as s
      from (select *, regexp_extract_all({text}, {quoted(pattern)}) as a0{more}, string_split_regex({text}, {quoted(pattern)}) as p from {source}), unnest(range(1, len(a0) + 1)) as t(i))"""


HEADS = f"""h as materialized (select doc_id, stem, text, length(g1)::int as level, {sql_strip_stars('g2')} as title, s, s + length(g0)::int as e,
  (length(left(text, s)) - length(replace(left(text, s), chr(10), '')) + 1)::int as line from {located('text', headings.HEADING, 'm')} where {sql_strip_stars('g2')} <> '')"""

KIND = "case " + " ".join(f"when {full('title', headings.kind_pattern(k))} then '{k}'" for k in headings.KINDS) + f" when {full('title', rf'(?i)^\**{S}*box{S}+{D}')} then 'box' end"


def kind_is(k: str, title: str = "title") -> str:
    return full(title, headings.kind_pattern(k))


BLOCKS = f"""b as materialized (select doc_id, min(i)::int as start_line, list(x order by i) as ls from (
    select doc_id, i, x, i - row_number() over (partition by doc_id order by i) as g
    from (select doc_id, l[i] as x, i from (select doc_id, {sql_lines('text')} as l from m), unnest(range(1, len(l) + 1)) as t(i)) where {full('x', rf'^{S}*\|')}
  ) group by doc_id, g)"""
_CELLS = f"list_transform(string_split(regexp_replace(regexp_replace({sql_strip('r')}, '^\\|', ''), '\\|$', ''), '|'), lambda c: {sql_strip('c')})"
_SEPARATOR = f"^[-:{S[1:-1]}]*$"
VERDICTS = f"""v as materialized (select *, case when n_rows = 0 then 'empty' when n_cols <= 1 then 'prose' when admin_score > data_score then 'admin' when data_score > admin_score then 'data'
      when n_rows <= {tables.TIE_ROWS} then 'admin' else 'data' end as verdict from (
  select *, case when n_cols > 1 then (case when ratio >= {tables.LABEL_SHARE} then 3 else 0 end + case when n_cols = 2 and n_rows <= {tables.SHORT_FORM} then 1 else 0 end) end as admin_score,
      case when n_cols > 1 then (case when n_cols >= {tables.DATA_COLS} and n_rows >= {tables.DATA_ROWS} then 2 else 0 end + case when n_num >= {tables.NUMERIC_ROWS} and n_num / n_first >= 0.5 then 2 else 0 end) end as data_score from (
    select doc_id, start_line, ls, rows, len(rows)::int as n_rows, coalesce(list_max(list_transform(rows, lambda r: len(r))), 0)::int as n_cols, greatest(len(f), 1) as n_first,
      len(list_filter(f, lambda c: {full('c', rf'^[{D}.]+$')}))::int as n_num,
      coalesce(list_sum(list_transform(f, lambda c: {full('c', tables.FORM_LABEL)}::int + {full('c', tables.ADMIN_WORD)}::int + (c like '%?')::int)), 0) / greatest(len(f), 1) as ratio from (
      select *, list_filter(list_transform(rows, lambda r: r[1]), lambda c: c <> '') as f from (
        select *, list_filter(list_transform(ls, lambda r: {_CELLS}), lambda r: len(list_filter(r, lambda c: not {full('c', _SEPARATOR)})) > 0) as rows from b)))))"""
REASONS = f"""case when n_rows = 0 then 'no rows' when n_cols <= 1 then '1-col block — prose wrapped in pipes, not a real table' else array_to_string(list_filter([
  case when ratio >= {tables.LABEL_SHARE} then 'label-shaped first-col cells (' || round_even(ratio * 100, 0)::int || '%)' end,
  case when n_cols = 2 and n_rows <= {tables.SHORT_FORM} then '2-col, short → likely label/value' end,
  case when n_cols >= {tables.DATA_COLS} and n_rows >= {tables.DATA_ROWS} then n_cols || ' cols × ' || n_rows || ' rows' end,
  case when n_num >= {tables.NUMERIC_ROWS} and n_num / n_first >= 0.5 then n_num || ' numeric IDs in first col' end,
  case when admin_score = data_score then 'tie-break by size (' || n_rows || ' rows → ' || verdict || ')' end], lambda x: x is not null), '; ') end"""
PREVIEW = f"coalesce(left(case when n_cols > 1 then array_to_string(rows[1], ' | ') else array_to_string(rows[1], ' ') end, {tables.PREVIEW}), '')"

REFS = f"""r as materialized (select doc_id, text, {full('text', headings.BIBLIOGRAPHY)} as has,
  nullif({sql_strip(f"regexp_extract(text, {quoted(headings.BIBLIOGRAPHY)})")}, '') as heading,
  string_split_regex(text, {quoted(headings.BIBLIOGRAPHY)})[1] as before, {sql_lines('text')} as ls from m)"""
_AT = "(length(before) - length(replace(before, chr(10), '')) + 1)::int"
_PART = f"(case when has then ls[{_AT} + 1:] else ls end)"
COUNTS = ", ".join(f"len(list_filter({_PART}, lambda x: {full('x', p)}))::int as n_{k}" for k, p in references.FORMATS.items())
_CREDIT = "coalesce(" + ", ".join(f"case when n_{k} >= {references.CREDIBLE} then n_{k} end" for k in references.FORMATS) + ", greatest(" + ", ".join(f"n_{k}" for k in references.FORMATS) + "))"
IDS = f"""ids as materialized (select doc_id, ref_id, min(s) as start_pos from (
   select doc_id, 'PMID:' || g1 as ref_id, s from {located('text', references.PMID, 'm')}
   union all select doc_id, 'doi:' || regexp_replace(g1, '[.,;:>)\\\\]+$', ''), s from {located('text', references.DOI, 'm')}) group by all)"""

_T = sql_strip("title")
REJECT = (
    f"case when title is null or {_T} = '' then 'empty' when {full(_T, titles.SECTION_PREFIX)} then 'matches section-prefix pattern' when length({_T}) < {titles.SHORTEST} then 'too short (' || length({_T}) || ' chars)'"
    f" when length({_T}) > {titles.LONGEST} then 'too long (' || length({_T}) || ' chars)' when {full(_T, '[\\p{Lu}]')} and not {full(_T, '[\\p{Ll}\\p{Lt}]')} and length({_T}) < {titles.CAPITALS} then 'all-caps banner shape' "
    + " ".join(f"when contains(lower({_T}), '{b}') then 'banner substring: ''{b}'''" for b in titles.BANNERS)
    + f" when {full(_T, titles.BANNER_WORD)} then 'publisher banner word' end"
)
_IMAGES = "(select distinct doc_id, path, source, w, h, error from image)"
CLASSIFIED = f"""i as materialized (select *, w::bigint * h as area, round_even(greatest(w, h) / greatest(least(w, h), 1), 2) as aspect,
  case when w is null or h is null then 'open_failed' else nullif(concat_ws(',', case when least(w, h) < {figures.MIN_SIDE} then 'min_dim<{figures.MIN_SIDE}' end,
    case when greatest(w, h) / greatest(least(w, h), 1) > {figures.MAX_ASPECT} then 'aspect>{figures.MAX_ASPECT}' end, case when w::bigint * h < {figures.MIN_AREA} then 'area<{figures.MIN_AREA}' end), '') end as reason from {_IMAGES})"""
_BLOCK = sql_strip_stars("g2")
_ONE = f"coalesce(nullif(regexp_extract({_BLOCK}, {quoted(f'^([^\\n]*?[.!?]){S}')}, 1), ''), {_BLOCK})"
_CUT = f"left({_ONE}, {figures.CAPTION_CHARS})"
CAPTION = f"case when length({_ONE}) > {figures.CAPTION_CHARS} then (case when contains({_CUT}, ' ') then regexp_replace({_CUT}, ' [^ ]*$', '') else {_CUT} end) || '…' else {_ONE} end"
CAPTIONS = f"c as materialized (select doc_id, try_cast(g1 as int) as n, {CAPTION} as caption, row_number() over (partition by doc_id, try_cast(g1 as int) order by s) as k from {located('text', figures.CAPTION, 'm')} where {_BLOCK} <> '')"
_LINE = "(length(left(text, pos - 1)) - length(replace(left(text, pos - 1), chr(10), '')))"
_NEAR = f"array_to_string(string_split(text, chr(10))[greatest(0, {_LINE} - {figures.CAPTION_LINES}) + 1:{_LINE} + {figures.CAPTION_LINES} + 1], chr(10))"
_WORDS = lambda x: f"len(list_filter(string_split_regex({x}, {quoted(f'{S}+')}), lambda w: w <> ''))"
_SHAPED = lambda x: f"({_WORDS(x)} between 3 and 25 and {x} not like '%.')"
_OWN_HEAD = rf"^#{{1,6}}{S}+."
_PLAIN_LINE = f"list_filter(list_transform(l, lambda x: {sql_strip('x')}), lambda x: x <> '' and x not like '#%' and x not like '|%')[1]"
_HEAD_TITLES = f"list_transform(list_filter(l, lambda x: {full('x', _OWN_HEAD)}), lambda x: {sql_strip(sql_rewrite('x', [(rf'^#{{1,6}}{S}+', '')]))})"

#: Sections: the anchors, what precedes them, and merging by a recursion that joins the shortest to its neighbour.
_SLUG = "coalesce(nullif(rtrim(left(trim(" + sql_rewrite(sql_strip_stars("lower(title)"), SLUG_RULES) + f", '_'), {sections.SLUG}), '_'), ''), 'section')"
ANCHORS = f"""e as materialized (select m.doc_id, m.text, min(s) filter ({kind_is('references')})::int as refs_at, coalesce(min(s) filter ({kind_is('references')}), length(m.text))::int as body_end from m left join h using (doc_id) group by m.doc_id, m.text),
k as (select h.doc_id, h.title, h.s, h.level, body_end from h join e using (doc_id) where s < body_end and level <= 3 and not {full('title', headings.BANNER)} and length(title) >= 3),
n as (select doc_id, count(*) filter (level = 1) as a, count(*) filter (level = 2) as b, count(*) filter (level = 3) as c from k group by doc_id),
anchors as materialized (select k.* from k join n using (doc_id) where case when a >= 3 then level = 1 when b >= 3 then level = 2 when c >= 3 then level = 3 else true end)"""
_PREFACE = sql_strip(f"regexp_replace({sql_strip('left(text, first)')}, '(?m)^#{{1,6}}[^\\n]*$', '', 'g')")
_LEN = "list_transform(secs, lambda x: case when x.slug = '00_abstract' then null else x.e - x.s end)"
SECTIONS = f"""spans as (select doc_id, list({{'slug': {_SLUG}, 'title': title, 's': s::int, 'e': e::int}} order by s) as secs, min(s)::int as first
  from (select doc_id, title, s, coalesce(lead(s) over (partition by doc_id order by s), body_end) as e from anchors) group by doc_id),
merging as (select doc_id, case when length({_PREFACE}) > {sections.PREFACE} then list_prepend({{'slug': '00_abstract', 'title': 'Abstract', 's': 0, 'e': first}}, secs) else secs end as secs from spans join e using (doc_id)
  union all
  select doc_id, secs[1:l - 1] || [{{'slug': secs[l].slug, 'title': secs[l].title || ' & ' || secs[l + 1].title, 's': secs[l].s, 'e': secs[l + 1].e}}] || secs[l + 2:] from (
    select doc_id, secs, case when i < len(secs) then i else i - 1 end as l from (select doc_id, secs, list_position({_LEN}, list_min({_LEN})) as i from merging where len(secs) > {sections.MOST}))),
sections as materialized (select doc_id, secs[i].title as title, secs[i].s as s, secs[i].e as e, i::int as n, lpad(i::varchar, 2, '0') || '_' || coalesce(nullif(regexp_replace(secs[i].slug, '^\\p{{Nd}}+_?', ''), ''), 'section') as slug
  from merging, unnest(range(1, len(secs) + 1)) as t(i) where len(secs) <= {sections.MOST}
  union all select doc_id, 'Body', 0, body_end, 1, '01_body' from e where doc_id not in (select doc_id from anchors))"""

#: Snippets: boundaries in the window move its start, one after the other.
_KEPT = sql_strip("substr(text, moved + 1, greatest(0, stop - moved))")
_DOT = "(length(kept) - strpos(reverse(kept), '.'))"
SNIPPETS = f"""w as (select doc_id, ref_id, start_pos as pos, text, greatest(0, start_pos - {references.SPAN}) as start, least(length(text), start_pos + {references.SPAN}) as stop from ids join m using (doc_id)),
u as (select *, substr(text, start + 1, stop - start) as chunk from w),
v as (select *, list_filter(range(0, length(chunk)), lambda i: chunk[i + 1] in ('.', chr(10)) and (i + 1 = length(chunk) or regexp_matches(chunk[i + 2], '{S}'))) as bounds from u),
x as (select *, list_reduce(bounds, lambda acc, q: case when q < pos - acc - 20 then acc + q + 1 else acc end, start) as moved from v),
y as (select *, {_KEPT} as kept from x),
snippets as materialized (select doc_id, ref_id, pos, {sql_strip(sql_rewrite(f"(case when contains(kept, '.') and {_DOT} > length(kept) // 2 then substr(kept, 1, {_DOT} + 1) else kept end)", [(f'{S}+', ' ')]))} as snippet from y)"""
_REF_BLOCK = sql_strip("substr(text, refs_at + 1)")

#: Titles: a labelled cell, the first substantial line after a label, docling's, a heading, the file name.
_BODY = "coalesce(text, '')"
_TABLE_TITLE = sql_strip_stars(f"regexp_extract({_BODY}, {quoted(titles.TABLE_LABEL)}, 1)")
_LABEL_LINE = f"(?i)\\A{titles._LABEL}\\z"
_PROMPTED = " or ".join(f"starts_with(lower(x), {quoted(w)})" for w in titles.PROMPTS)
TITLES = f"""dm as (select distinct doc_id, title as docling_title from docling_meta where doc_id is not null),
b as (select doc_id, arg_min(title, s) as h1 from (select doc_id, s, {sql_strip_stars('g1')} as title from {located('t', titles.BODY_H1, f'(select doc_id, left(text, {titles.PAGE_ONE}) as t from m)')}) where title <> '' and ({REJECT}) is null group by doc_id),
lab as (select doc_id, list_transform(string_split_regex({_BODY}, {quoted(titles.LABEL)})[2:], lambda p: list_filter(list_transform({sql_lines('p')}, lambda x: {sql_strip_stars('x')}), lambda x: x <> '' and not {full('x', _LABEL_LINE)} and not ({_PROMPTED}))[1]) as f from m),
lb as (select doc_id, list_filter(list_transform(range(1, len(f) + 1), lambda k: list_filter(f[k:], lambda x: x is not null)[1]), lambda x: length(x) >= {titles.SHORTEST} and not {full('x', titles.SECTION_PREFIX)})[1] as label from lab),
t as (select m.doc_id, stem, case when length({_TABLE_TITLE}) >= {titles.SHORTEST} then {_TABLE_TITLE} end as cell, label, docling_title as title, h1 from m left join dm using (doc_id) left join b using (doc_id) left join lb using (doc_id)),
tp as (select *, {REJECT} as reason from t)"""

#: Section files: without a first section that repeats the title, its own heading first, other top headings one level down.
_PLAIN_TITLE = lambda x: f"lower(regexp_replace({x}, '[^\\p{{L}}\\p{{N}}_]+', '', 'g'))"
_CHOSEN = f"coalesce(nullif(coalesce(cell, label, case when reason is null then {_T} end, h1, {sql_strip(sql_rewrite('stem', [(f'[_{S[1:-1]}]+', ' ')]))}), ''), {sql_strip(sql_rewrite('stem', [(f'[_{S[1:-1]}]+', ' ')]))})"
_OWN = headings.HEADING.replace("(?m)^", "\\A").replace("$", "\\z")
_SECTION_BODY = sql_strip("substr(text, x.s + 1, x.e - x.s)")
FILES = f"""chosen as (select doc_id, {_CHOSEN} as chosen from tp),
blocks as (select x.doc_id, x.n, {_PLAIN_TITLE('x.title')} = {_PLAIN_TITLE('chosen')} and length({_SECTION_BODY}) < {sections.TITLE_BLOCK} as repeats from sections x join m using (doc_id) join chosen using (doc_id) where x.n = 1),
filed as materialized (select doc_id, title, s, e, (n - coalesce(repeats, false)::int)::int as n, slug from (select x.*, b.repeats from sections x left join (select doc_id, repeats from blocks) b using (doc_id)) where not (coalesce(repeats, false) and n = 1)),
parts as (select x.doc_id, x.n, x.title, regexp_replace(x.slug, '^[0-9]+_', lpad(x.n::varchar, 2, '0') || '_') as slug, {sql_lines(_SECTION_BODY)} as ls from filed x join m using (doc_id)),
own as (select *, coalesce(list_position(list_transform(ls, lambda x: {full('x', _OWN)}), true), 0) as first from parts),
files as materialized (select doc_id, n, slug, title, regexp_replace(array_to_string(['# ' || title, ''] || list_filter(list_transform(range(1, len(ls) + 1), lambda i: case when i = first then null when {full('ls[i]', _OWN)} and regexp_extract(ls[i], {quoted(_OWN)}, 1) = '#'
  then '## ' || regexp_extract(ls[i], {quoted(_OWN)}, 2) else ls[i] end), lambda x: x is not null), chr(10)), '{S}+\\z', '') || chr(10) as body from own)"""

ORACLE: dict[str, str] = {
    **{f"clean_{k}": f"with m as ({RAW}) select doc_id, {sql_rewrite('md', r)} as text from m" for k, r in cleaning.PASSES.items()},
    **{f"post_{k}": f"with m as ({RAW}) select doc_id, {sql_rewrite('md', r)} as text from m" for k, r in cleaning.SECTION_PASSES.items()},
    "post_clean": f"with m as ({RAW}) select doc_id, {sql_rewrite('md', cleaning.POST)} as text from m",
    "post_stats": f"with m as ({RAW}), c as (select md, {sql_rewrite('md', cleaning.POST)} as t from m) select count(*) filter (md <> t) as n_changed, sum(length(md) - length(t))::bigint as n_removed from c",
    "mechanical_clean": f"with {PAPERS} select doc_id, text from m",
    "clean_stats": f"with {PAPERS} select doc_id, length(text)::int as n_chars, {sql_count('text', r'![[][^\n]*?[]][(][^\n]*?[)]')}::int as n_images, ((length(text) - length(replace(text, '|---', ''))) // 4)::int as n_table_marks from m",
    "citation_style": f"with {PAPERS}, c as (select doc_id, {', '.join(f'{sql_count("text", p)}::int as n_{k}' for k, p in cleaning.CITATIONS.items())} from m) "
    "select *, case when greatest(n_sup, n_bracketed, n_authoryear) = 0 then null when n_sup = greatest(n_sup, n_bracketed, n_authoryear) then 'sup' when n_bracketed >= n_authoryear then 'bracketed' else 'authoryear' end as style, greatest(n_sup, n_bracketed, n_authoryear) as n_dominant from c",
    "heading_spans": f"with {PAPERS}, {HEADS} select doc_id, level, title, line, s as start_pos, e as end_pos from h",
    "heading_levels": f"with d as (select distinct doc_id, docling_md from manuscript where doc_id is not null and docling_md is not null), l as (select doc_id, list_filter({sql_lines('docling_md')}, lambda x: {full('x', rf'^#{{1,6}}{S}+[^\n]+?{S}*$')}) as l from d) "
    f"select doc_id, (i - 1)::int as n, length(regexp_extract(l[i], '^(#{{1,6}})', 1))::int as level, {sql_strip(f'regexp_extract(l[i], {quoted(rf'^#{{1,6}}{S}+(.+?){S}*$')}, 1)')} as text from l, unnest(range(1, len(l) + 1)) as t(i)",
    "section_kinds": f"with {PAPERS}, {HEADS} select doc_id, s as start_pos, {KIND} as kind, {full('title', headings.BANNER)} as banner from h",
    "table_blocks": f"with {PAPERS}, {BLOCKS} select doc_id, start_line, len(ls)::int as n_lines, array_to_string(ls, chr(10)) as block from b",
    "table_verdicts": f"with {PAPERS}, {BLOCKS}, {VERDICTS} select doc_id, start_line, n_rows, n_cols, verdict, admin_score, data_score, {REASONS} as reasons, {PREVIEW} as preview from v",
    "table_audit": f"with {PAPERS}, {BLOCKS}, {VERDICTS} select doc_id, count(*) as n_total, {', '.join(f"count(*) filter (verdict = '{k}') as n_{k}" for k in ('admin', 'data', 'prose'))} from v group by doc_id",
    "data_tables": f"with {PAPERS}, {BLOCKS}, {VERDICTS}, d as (select doc_id, row_number() over (partition by doc_id order by start_line)::int as n, left({PREVIEW}, 120) as preview, ls from v where verdict = 'data') "
    "select doc_id, n, preview, '# Table ' || n || chr(10) || chr(10) || array_to_string(ls, chr(10)) || chr(10) as content from d",
    "refs_audit": f"with {PAPERS}, {REFS}, {IDS}, k as (select doc_id, has, heading, case when has then {_AT} end as line, {COUNTS} from r), n as (select doc_id, count(*) filter (ref_id like 'PMID:%')::int as p, count(*) filter (ref_id like 'doi:%')::int as d from ids group by doc_id) "
    f"select doc_id, has as has_references_section, heading as section_heading, line as section_start_line, coalesce(p, 0) as n_pmids, coalesce(d, 0) as n_dois, {', '.join(f'n_{k}' for k in references.FORMATS)}, {_CREDIT} as n_refs_estimate, "
    f"not has and coalesce(p, 0) + coalesce(d, 0) = 0 and greatest({', '.join(f'n_{k}' for k in references.FORMATS)}) < {references.CREDIBLE} as likely_truncated from k left join n using (doc_id)",
    "ref_identifiers": f"with {PAPERS}, {IDS} select doc_id, ref_id, start_pos from ids",
    "section_plan": f"with recursive {PAPERS}, {HEADS}, {ANCHORS}, {SECTIONS} select doc_id, n, slug, title, s as start_pos, e as end_pos from sections",
    "section_texts": f"with recursive {PAPERS}, {HEADS}, {ANCHORS}, {SECTIONS}, {TITLES}, {FILES} select doc_id, n, slug, title, {sql_rewrite('body', cleaning.POST)} as cleaned from files",
    "ref_snippets": f"with {PAPERS}, {IDS}, {SNIPPETS} select doc_id, ref_id, snippet from snippets",
    "references_md": f"with {PAPERS}, {HEADS}, {ANCHORS}, {IDS}, {SNIPPETS}, o as (select doc_id, string_agg(i || '. `' || ref_id || '` — ' || snippet, chr(10) order by i) as listed from (select *, row_number() over (partition by doc_id order by case when ref_id like 'PMID:%' then 0 else 1 end, pos) as i from snippets) group by doc_id), "
    f"r as (select *, {_REF_BLOCK} as block from e) select doc_id, case when refs_at is not null then '# References' || chr(10) || chr(10) || (case when strpos(block, chr(10)) > 1 then {sql_strip('substr(block, strpos(block, chr(10)) + 1)')} else block end) || chr(10) "
    "when listed is not null then '# References' || chr(10) || chr(10) || '*Reconstructed from inline PMID/DOI tokens — the source PDF lacked a parseable bibliography section.*' || chr(10) || chr(10) || listed || chr(10) "
    "else '# References' || chr(10) || chr(10) || '*No machine-parseable references found in source.*' || chr(10) end as content from r left join o using (doc_id)",
    "title_pick": f"with {PAPERS}, {TITLES} select doc_id, coalesce(cell, label, case when reason is null then {_T} end, h1, {sql_strip(sql_rewrite('stem', [(f'[_{S[1:-1]}]+', ' ')]))}) as title, "
    "case when cell is not null then 'body_table' when label is not null then 'body_heading' when reason is null then 'docling' when h1 is not null then 'body_h1' else 'filename' end as source, reason from tp",
    "title_reject": f"select distinct doc_id, title, {REJECT} as reason from docling_meta where doc_id is not null",
    "title_from_filename": f"select distinct stem, {sql_strip(sql_rewrite('stem', [(f'[_{S[1:-1]}]+', ' ')]))} as title from shred_batch",
    "title_body_h1": f"with {PAPERS}, c as (select doc_id, s, {sql_strip_stars('g1')} as title from {located('t', titles.BODY_H1, f'(select doc_id, left(text, {titles.PAGE_ONE}) as t from m)')}), k as (select doc_id, arg_min(title, s) as title from c where title <> '' and ({REJECT}) is null group by doc_id) select doc_id, title from m left join k using (doc_id)",
    "title_detect": f"with d as (select distinct doc_id, {sql_lines('docling_md')} as l from manuscript where doc_id is not null and docling_md is not null) select doc_id, coalesce(list_filter({_HEAD_TITLES}, lambda x: {_SHAPED('x')} and not lower(x) in ({', '.join(quoted(w) for w in titles.SECTION_WORDS)}))[1], case when {_SHAPED(_PLAIN_LINE)} then {_PLAIN_LINE} end) as title from d",
    "title_mismatch": "select distinct doc_id, m.title as meta_title, d.title as docling_title from meta m join docling_meta d using (doc_id) where lower(trim(m.title, ' ')) <> lower(trim(d.title, ' '))",
    "filename_meta": f"with s as (select distinct stem, {STEMMED} as t from shred_batch) select stem, {', '.join(f'nullif(regexp_extract(t, {quoted(STEM)}, {k}), {chr(39) * 2}){kind} as {n}' for k, n, kind in ((1, 'year', '::int'), (2, 'month', '::int'), (3, 'journal', ''), (4, 'topic', ''), (5, 'pmid', ''), (6, 'doi', '')))} from s",
    "slugs": f"with {PAPERS}, {HEADS}, k as (select distinct title, trim({sql_rewrite(sql_strip_stars('lower(title)'), SLUG_RULES)}, '_') as t from h) select title, coalesce(nullif(rtrim(left(t, 25), '_'), ''), 'section') as slug from k",
    "doc_types": f"with {PAPERS}, {HEADS}, k as (select doc_id, bool_or({kind_is('methods')}) as me, bool_or({kind_is('results')}) as re from h group by doc_id) select doc_id, case when contains(left(lower(text), 2000), 'biorxiv') or contains(left(lower(text), 2000), 'medrxiv') then 'preprint' when coalesce(me and re, false) then 'paper' "
    f"when regexp_matches(regexp_extract(stem, {quoted(STEM)}, 3), '(?i)natrev|annurev|trends|cshpersp|curropin|review') then 'review' when coalesce(re, false) then 'paper' else 'review' end as doc_type from m left join k using (doc_id)",
    "section_anchors": f"with {PAPERS}, {HEADS}, e as (select doc_id, min(s) filter ({kind_is('references')}) as r from h group by doc_id), k as (select h.*, coalesce(r, length(text))::int as body_end from h join e using (doc_id) where s < coalesce(r, length(text)) and level <= 3 and not {full('title', headings.BANNER)} and length(title) >= 3), "
    "n as (select doc_id, count(*) filter (level = 1) as a, count(*) filter (level = 2) as b, count(*) filter (level = 3) as c from k group by doc_id) "
    "select doc_id, (row_number() over (partition by doc_id order by s) - 1)::int as n, s as start_pos, level, body_end from k join n using (doc_id) where case when a >= 3 then level = 1 when b >= 3 then level = 2 when c >= 3 then level = 3 else true end",
    "figure_filter": f"with {CLASSIFIED} select doc_id, path, source, w, h, area, aspect, reason is null as kept, reason from i",
    "figure_audit": f"with {CLASSIFIED} select doc_id, count(*) as n_total, count(*) filter (reason is null) as n_kept, count(*) filter (reason is not null) as n_dropped from i group by doc_id",
    "figure_reasons": f"with {CLASSIFIED} select reason, count(*) as n from i where reason is not null group by reason",
    "captions": f"with {PAPERS}, {CAPTIONS} select doc_id, n, caption from c where k = 1",
    "figure_captions": f"with {PAPERS}, {CAPTIONS}, {CLASSIFIED}, k as (select doc_id, row_number() over (partition by doc_id order by case when source = 'marker' then 0 else 1 end, path)::int as n, path from i where reason is null) select doc_id, n, path, coalesce(caption, '') as caption from k left join (select doc_id, n, caption from c where k = 1) using (doc_id, n)",
    "caption_gate": f"with {PAPERS}, {CLASSIFIED}, n as (select i.*, text, string_split(path, '/')[-1] as name from i left join m using (doc_id)), a as (select *, case when strpos(text, '](' || name) > 0 then strpos(text, '](' || name) else strpos(text, regexp_replace(name, '[.][^.]*$', '')) end as pos from n), "
    f"g as (select *, reason is null and coalesce(pos > 0 and not {full(_NEAR, figures.CAPTION_LINE)}, false) as lost from a) select doc_id, path, source, w, h, reason is null and not lost as kept, case when lost then 'no_caption' else reason end as reason from g",
    "image_pages": f"select distinct path, try_cast(nullif(regexp_extract(path, {quoted(figures.PAGE_IN_NAME)}, 1), '') as int) as page from image",
    "sanity_counts": f"with {PAPERS} select doc_id, len(list_filter({sql_lines('text')}, lambda x: {full('x', rf'^{S}*{D}+[.]{S}')}))::int as n_numbered, {sql_count('text', '<sup>')}::int as n_sup from m",
    "count_differences": "with a as (select doc_id, max(n_figures) as n_figures, max(n_tables) as n_tables from meta where doc_id is not null group by doc_id), b as (select doc_id, max(n_pictures) as n_pictures, max(n_tables) as t from docling_meta where doc_id is not null group by doc_id) "
    "select doc_id, n_figures, n_pictures, coalesce(abs(n_figures - n_pictures) > 1, false) as figures_differ, coalesce(n_tables <> t, false) as tables_differ from a full join b using (doc_id)",
    "run_totals": "select journal, count(*) filter (status in ('ok', 'skipped')) as n_ok, count(*) as n_runs from (select distinct run_id, journal, status from shred_batch) group by journal",
    "skip_done": "select distinct stem from manuscript where stem is not null and stem not in (select stem from shred_batch where status = 'ok' and stem is not null)",
}

ORACLE["output_counts"] = f"""with r as ({ORACLE['references_md'].replace('with m as', 'with m as', 1)}), x as ({ORACLE['section_texts']}), f as ({ORACLE['figure_captions']}), d as ({ORACLE['data_tables']}),
sx as (select doc_id, count(*) as n_sections, sum({sql_count('cleaned', '<sup>')}) as n_sup from x group by doc_id), fx as (select doc_id, count(*) filter (path like '%.jpeg') as n_jpeg from f group by doc_id), dx as (select doc_id, count(*) as n_tables from d group by doc_id)
select doc_id, coalesce(n_sections, 0) as n_sections, coalesce(n_sup, 0)::bigint as n_sup, coalesce(n_jpeg, 0) as n_jpeg, coalesce(n_tables, 0) as n_tables, len(list_filter({sql_lines('content')}, lambda x: {full('x', rf'^{D}+[.]{S}')}))::bigint as n_listed
from r left join sx using (doc_id) left join fx using (doc_id) left join dx using (doc_id)"""

ORACLE["docling_json"] = "select distinct doc_id, title, n_pages, n_pictures, n_tables, n_texts, len(saved_pictures)::int as n_saved, array_to_string(list_transform(headings, lambda h: concat_ws(' ', h.level::varchar, h.text)), chr(10)) as told from docling_meta"
ORACLE["key_value_logs"] = "select distinct run_id, stem, coalesce('a=' || status, 'begun') as status from shred_batch"

_NAME = ", ".join(f"nullif(regexp_extract(stem, {quoted(STEM)}, {k}), '') as {n}" for k, n in ((1, "year"), (3, "journal"), (5, "pmid"), (6, "doi")))
ORACLE["paper_meta"] = f"""with x as ({ORACLE['section_texts']}), t as ({ORACLE['title_pick']}), r as ({ORACLE['refs_audit']}), c as ({ORACLE['citation_style']}), y as ({ORACLE['doc_types']}), k as ({ORACLE['section_kinds']}), f as ({ORACLE['figure_audit']}), d as ({ORACLE['table_audit']}),
m as (select distinct doc_id, {STEMMED} as stem from manuscript where doc_id is not null and marker_md is not null), nm as (select *, {_NAME} from m), dl as (select distinct doc_id, title as docling_title, n_pages from docling_meta where doc_id is not null),
sx as (select doc_id, count(*)::int as n_sections, string_agg(slug || '.md', ' | ' order by n) as sections from x group by doc_id), kx as (select distinct doc_id from k where kind = 'references')
select doc_id, stem, t.title, t.source as title_source, array_to_string(list_filter([case when dl.doc_id is null then 'docling_meta.json not found' end,
    case when t.source in ('body_table', 'body_heading') and reason is null and lower({sql_strip('t.title')}) <> lower({sql_strip('docling_title')}) then 'body title differs from docling title (docling: ''' || docling_title || ''')' end,
    case when t.source = 'body_h1' then 'docling title rejected (' || reason || '); using body H1' end, case when t.source = 'filename' then 'no body title found and docling rejected; using filename stem' end], lambda w: w is not null), ' | ') as title_warnings,
  null::varchar as authors, year::int as year, doc_type as type, doi, pmid, journal, null::varchar as funder, null::varchar as grant_id, '_raw/source.pdf' as source_pdf, '{papers.EXTRACTOR}' as extractor, n_pages, coalesce(n_sections, 0) as n_sections,
  case when kx.doc_id is not null then n_refs_estimate else n_pmids + n_dois end as n_references, likely_truncated as refs_likely_truncated, style as citation_style, n_dominant as n_citations_inline, coalesce(sections, '') as sections,
  coalesce(n_kept, 0)::int as n_figures, coalesce(n_data, 0)::int as n_tables
from nm join t using (doc_id) join r using (doc_id) join c using (doc_id) join y using (doc_id) left join dl using (doc_id) left join sx using (doc_id) left join kx using (doc_id) left join f using (doc_id) left join d using (doc_id)"""

ORACLE["qc_red_flags"] = f"""with recursive {PAPERS}, {HEADS}, {ANCHORS}, {SECTIONS}, {TITLES}, {FILES}, pm as ({ORACLE['paper_meta']}),
hx as (select doc_id, count(*) as n_heads from h group by doc_id), sx as (select doc_id, min(e - s) as shortest, sum({sql_count('substr(text, s + 1, e - s)', '<sup>')}) as sup_sections from filed join m using (doc_id) group by doc_id),
bx as (select doc_id, {sql_count('left(text, body_end)', '<sup>')} as sup_body from e), dl as (select distinct doc_id, n_pictures, len(headings) as n_docling from docling_meta where doc_id is not null)
select doc_id, array_to_string(list_filter([case when n_sections > {sections.MOST} then 'too many sections' end, case when sup_body <> coalesce(sup_sections, 0) then 'citations lost between sections' end,
  case when n_references < 5 and type in ('paper', 'grant') then 'few references' end, case when coalesce(shortest, 0) < 200 then 'short section' end, case when title is null then 'title missing' end,
  case when abs(n_pictures - n_figures) > 1 then 'figure counts differ' end, case when abs(n_docling - coalesce(n_heads, 0)) > 2 then 'heading counts differ' end, case when title_source = 'filename' then 'title from the file name' end], lambda w: w is not null), '; ') as flags
from pm join bx using (doc_id) left join sx using (doc_id) left join hx using (doc_id) left join dl using (doc_id)"""


def _listed(source: str, kind: str, label: str, text: str) -> str:
    line = f"'- [[{kind}s/{kind}_' || lpad(n::varchar, 2, '0') || '|{label} ' || n || case when {text} <> '' then ' — ' || {text} else '' end || ']]'"
    return f"(select doc_id, string_agg({line}, chr(10) order by n) as {kind}_lines from ({ORACLE[source]}) group by doc_id)"


_FRONT = [
    ("title", "'\"' || shown || '\"'"), ("authors", "'null'"), ("year", "coalesce(year::varchar, 'null')"), ("type", "type"), ("doi", "coalesce('\"' || doi || '\"', 'null')"), ("journal", "coalesce('\"' || journal || '\"', 'null')"),
    ("pmid", "coalesce(pmid, 'null')"), ("source", "source_pdf"), ("extracted", "strftime(current_date, '%Y-%m-%d')"), ("extractor", "extractor"),
]
_HEAD = "array_to_string(['---', " + ", ".join(f"'{k}: ' || {v}" for k, v in _FRONT) + ", 'tags:', '  - ' || type, '---'], chr(10))"
ORACLE["paper_readme"] = f"""with recursive {PAPERS}, {HEADS}, {ANCHORS}, {SECTIONS}, {TITLES}, {FILES}, pm as (select *, replace(title, '"', chr(39)) as shown from ({ORACLE['paper_meta']})),
toc as (select doc_id, string_agg('- [[sections/' || slug || '|' || title || ']]', chr(10) order by n) as toc from files group by doc_id)
select doc_id, {_HEAD} || chr(10) || chr(10) || '# ' || shown || chr(10) || chr(10) || '> **Source:** `' || stem || '.pdf`' || chr(10) || '> **Type:** ' || type || ' · **Year:** ' || coalesce(year::varchar, '—') || ' · **DOI:** ' || coalesce(doi, '—') || ' · **PMID:** ' || coalesce(pmid, '—')
  || chr(10) || chr(10) || '## Sections' || chr(10) || chr(10) || coalesce(toc, '') || chr(10) || chr(10) || coalesce('## Figures' || chr(10) || chr(10) || figure_lines || chr(10) || chr(10), '') || coalesce('## Tables' || chr(10) || chr(10) || table_lines || chr(10) || chr(10), '')
  || '## References' || chr(10) || chr(10) || '[[references|' || n_references || ' references]]' || chr(10) as content
from pm left join toc using (doc_id) left join {_listed('figure_captions', 'figure', 'Figure', 'caption')} using (doc_id) left join {_listed('data_tables', 'table', 'Table', 'preview')} using (doc_id)"""
