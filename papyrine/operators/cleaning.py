"""Rewrites of extractor markdown before and after it is cut into sections, and citation counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from papyrine.functions.patterns import D, S, SI, Rules, count, rewrite

# Patterns below are fixed values of the artefacts they match.
ZOTERO: Rules = [
    (rf"\[({D}+(?:[,{S[1:-1]}]+{D}+)*)\]\(https?://(?:www\.)?zotero\.org/[^)]+\)", "<sup>$1</sup>"),
    (r"\[([^\]]+)\]\(https?://(?:www\.)?zotero\.org/[^)]+\)", "$1"),
]
PAPERPILE: Rules = [
    (rf"\[([a-z]?)({D}[{D},\-–{S[1:-1]}]*?)([,.)]?)\]\(https?://(?:www\.)?paperpile\.com/[^)]+\)", "$1<sup>$2</sup>$3"),
    (r"\[([^\]]+)\]\(https?://(?:www\.)?paperpile\.com/[^)]+\)", "$1"),
]
GOOGLE_DOCS: Rules = [(r"\[([^\]]+)\]\(https?://docs\.google\.com/[^)]+\)", "$1")]
SPAN_ANCHORS: Rules = [(r'<span id="[^"]*"></span>', "")]
_WORD = r"[\-\p{L}\p{N}_]"
DEAD_ANCHORS: Rules = [(rf"\[([^\]]+)\]\(#(?:page|bib|sec|fig|tab|opt){_WORD}+\)", "$1"), (rf"\[([^\]]+)\]\(#{_WORD}+\\?\)", "$1")]
LEGENDS: Rules = [(r"\*\(legend (?:on|continued on) next page\)\*", "")]
PAGE_BREAKS: Rules = [(rf"\{{{D}+\}}-+{S}*", "\n\n")]
LINE_BREAKS: Rules = [("<br ?/>|<br>", " ")]
BLANK_RUNS: Rules = [(rf"{S}+<sup>", "<sup>"), (" {2,}", " "), (" +\n", "\n"), ("\n{3,}", "\n\n"), (rf"\A{S}+", ""), (rf"{S}+\z", ""), (r"\z", "\n")]

#: The passes in order; they do not commute.
PASSES: dict[str, Rules] = {
    "zotero": ZOTERO,
    "paperpile": PAPERPILE,
    "google_docs": GOOGLE_DOCS,
    "span_anchors": SPAN_ANCHORS,
    "dead_anchors": DEAD_ANCHORS,
    "legends": LEGENDS,
    "page_breaks": PAGE_BREAKS,
    "line_breaks": LINE_BREAKS,
    "blank_runs": BLANK_RUNS,
}
MECHANICAL: Rules = [r for rules in PASSES.values() for r in rules]

# Passes over section texts.
_FIGURE = rf"Figure{S}+S?{D}+\."
_OTHER_LINE = rf"(?:[^#\n][^\n]*|#{{1,6}}[^#{S[1:-1]}][^\n]*|#{{7,}}[^\n]*|)"
FIGURE_BLOCKS: Rules = [(rf"(?m)^#{{1,6}}{S}+{_FIGURE}(?:{SI}[^\n]*)?\n(?:{_OTHER_LINE}\n)*(?:{_OTHER_LINE}\z)?|^#{{1,6}}{S}+{_FIGURE}{SI}[^\n]*\z", "")]
_STARTS = "Data are mean|Data represent mean|Comparisons were|Statistical|Scale bar|See also|\\*p <|\\*\\*p <|Individual values|n ="
_CAPTION = rf"Figure{SI}+S?{D}+\.{SI}[^\n]*"
_PANEL = rf"\([A-Z]+(?:-[A-Z]+)?(?:,{SI}*[A-Z]+)*\){SI}[^\n]*"
ORPHAN_CAPTIONS: Rules = [(r"\n\z", ""), (rf"(?m)^{_CAPTION}(?:\n|\z)(?:(?:{SI}*(?:{_STARTS})[^\n]*|{_PANEL}|{_CAPTION}|{SI}*)(?:\n|\z))*", "")]
BANNERS: Rules = [(rf"(?m)^#{S}+(?:Article|Authors|Cell|Correspondence|Graphical abstract|In brief|Highlights|SUMMARY){S}*$\n?", "")]
_PLACES = "Department|Institute|Departments|Section|Division|School|Lab|Centre|Center|Faculty|Hospital|Universit|Lead contact|Present address|Correspondence:|Inst\\.|Cellular|Pharma"
AFFILIATIONS: Rules = [(rf"(?m)^<sup>[{D}\\*]+</sup>(?:{_PLACES})[^\n]*$\n?\n?", "")]
CORRESPONDENCE: Rules = [(rf"(?m)^<sup>\\?\*</sup>{S}*Correspondence:[^\n]*$\n?\n?", "")]
BROKEN_SENTENCES: Rules = [(r"([a-zA-Z,])\n\n([a-z][a-z])", "$1 $2")]
SECTION_BLANKS: Rules = [("\n{3,}", "\n\n"), (" {2,}", " "), (" +\n", "\n"), (rf"\A{S}+", ""), (rf"{S}+\z", ""), (r"\z", "\n")]

SECTION_PASSES: dict[str, Rules] = {
    "legends": LEGENDS,
    "figure_blocks": FIGURE_BLOCKS,
    "orphan_captions": ORPHAN_CAPTIONS,
    "banners": BANNERS,
    "affiliations": AFFILIATIONS,
    "correspondence": CORRESPONDENCE,
    "broken_sentences": BROKEN_SENTENCES,
    "section_blanks": SECTION_BLANKS,
}
POST: Rules = [r for rules in SECTION_PASSES.values() for r in rules]

CITATIONS = {
    "sup": rf"<sup>{D}[{D},\-–{S[1:-1]}]*</sup>",
    "bracketed": rf"\[{D}+(?:[,\-–{S[1:-1]}]+{D}+)*\]",
    "authoryear": rf"\b[A-Z][A-Za-z'\-]{{2,}}(?:{S}+(?:et{S}+al\.?|(?:and|&){S}+[A-Z][A-Za-z'\-]+))?{S}*,?{S}+\(?{D}{{4}}[a-z]?\)?\b",
}


def mechanical_clean(text: Column) -> Column:
    """All passes over extractor markdown, in order; null stays null, the empty text becomes one line feed."""
    return rewrite(text, MECHANICAL)


def clean_section(text: Column) -> Column:
    """All passes over a section's text, in order."""
    return rewrite(text, POST)


def clean_stats(cleaned: Column) -> list[Column]:
    """Characters, images and column separators of tables."""
    return [
        F.length(cleaned).alias("n_chars"),
        count(cleaned, r"!\[[^\n]*?\]\([^\n]*?\)").alias("n_images"),
        ((F.length(cleaned) - F.length(F.replace(cleaned, F.lit("|---"), F.lit("")))) / 4).cast("int").alias("n_table_marks"),
    ]


def citation_counts(text: Column) -> list[Column]:
    return [count(text, p).alias(f"n_{k}") for k, p in CITATIONS.items()]


def dominant_style(text: Column) -> Column:
    """``style, n`` of the most frequent style, the first of equals; both null where there is no citation."""
    best = F.array_max(F.array(*[F.struct(count(text, p).alias("n"), F.lit(-i).alias("r"), F.lit(k).alias("style")) for i, (k, p) in enumerate(CITATIONS.items())]))
    return F.when(best["n"] > 0, F.struct(best["style"].alias("style"), best["n"].alias("n")))


