"""Expected values are derived by reading the rules, one for each branch."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from papyrine.functions.patterns import rewrite
from papyrine.operators import cleaning, figures, headings, references, sections, tables, titles
from papyrine.sources.filenames import parse_filename


@pytest.fixture(scope="module")
def apply(spark):
    def run(text, column):
        return spark.createDataFrame([(text,)], "text string").select(column(F.col("text")).alias("x")).first()["x"]

    return run


@pytest.mark.parametrize(
    ("rules", "before", "after"),
    [
        (cleaning.ZOTERO, "a [1, 2](https://www.zotero.org/g/x) [see](http://zotero.org/y)", "a <sup>1, 2</sup> see"),
        (cleaning.PAPERPILE, "processe[s1](https://paperpile.com/c/a) IDRs[6,7](https://paperpile.com/c/b) end[s29,](https://paperpile.com/c/c)", "processes<sup>1</sup> IDRs<sup>6,7</sup> ends<sup>29</sup>,"),
        (cleaning.PAPERPILE, r"mechanism[s45,46\)](https://paperpile.com/c/a)", r"mechanisms45,46\)"),
        (cleaning.GOOGLE_DOCS, "[B](https://docs.google.com/u)", "B"),
        (cleaning.SPAN_ANCHORS, 'a<span id="page-1-0"></span>b', "ab"),
        (cleaning.DEAD_ANCHORS, "[A](#page-1-0) [B](#other) [[C](#page-2)](#page-3)", "A B C"),
        (cleaning.LEGENDS, "x*(legend continued on next page)*y", "xy"),
        (cleaning.PAGE_BREAKS, "a\n{12}------\n\nb", "a\n\n\nb"),
        (cleaning.LINE_BREAKS, "a<br>b<br/>c<br />d<BR>", "a b c d<BR>"),
        (cleaning.BLANK_RUNS, " a\n <sup>1</sup>  b \n\n\n\nc\f", "a<sup>1</sup> b\n\nc\n"),
        (cleaning.FIGURE_BLOCKS, "x\n#### Figure 2. Cap\ntail\n\n## Next\ny", "x\n## Next\ny"),
        (cleaning.FIGURE_BLOCKS, "x\n# Figure S1. Cap", "x\n"),
        (cleaning.ORPHAN_CAPTIONS, "a\nFigure 1. Cap.\n\n(A) left\n(A-C) all\nScale bar 5\n*p < 0.1\nb\nFigure 2.\n", "a\nb\nFigure 2."),
        (cleaning.BANNERS, "# Highlights\nx\n# Abstract\n", "x\n# Abstract\n"),
        (cleaning.AFFILIATIONS, "<sup>1</sup>Department of X\n\nText", "Text"),
        (cleaning.CORRESPONDENCE, "<sup>*</sup> Correspondence: me\n\nText", "Text"),
        (cleaning.BROKEN_SENTENCES, "split\n\nhere.\n\nnot", "split here.\n\nnot"),
    ],
)
def test_rewrites(apply, rules, before, after):
    assert apply(before, lambda t: rewrite(t, rules)) == after


def test_clean_null_and_empty(apply):
    assert apply(None, cleaning.mechanical_clean) is None
    assert apply("", cleaning.mechanical_clean) == "\n"


def test_citations(apply):
    assert tuple(apply("a<sup>1,2</sup> [3] Smith et al. 2019", cleaning.dominant_style)) == ("sup", 1)
    assert tuple(apply("[3] [4,5] Smith et al. 2019", cleaning.dominant_style)) == ("bracketed", 2)
    assert apply("none", cleaning.dominant_style) is None


def test_headings(apply):
    got = [tuple(h) for h in apply("😀\n# **A b**  \n\n#\n\nnext\n## **\nx ### no", headings.headings)]
    assert got == [(1, "A b", 2, 2, 14), (1, "next", 4, 15, 22)]
    assert [apply(t, headings.section_kind) for t in ("**Methods**", "STAR Methods", "References", "Box 2 x", "Particle")] == ["methods", "methods", "references", "box", None]
    assert apply("Particle tracking", headings.is_banner) and not apply("graphical abstract", headings.is_banner)
    assert tuple(apply("a\n## **Works  Cited**\nb", headings.bibliography)) == ("## **Works  Cited**", 2)
    assert apply("## Reference\n", headings.bibliography) is None


def verdict(spark, text):
    return tables.classify(tables.table_blocks(spark.createDataFrame([(1, text)], "doc_id long, text string"))).collect()


def test_tables(spark):
    data = "| id | q | p |\n|---|---|---|\n" + "".join(f"| {i} | 2 | 3 |\n" for i in (1, 2, 3))
    admin = "x\n| Email | a |\n|---|---|\n| Name | b |"
    assert [(r.start_line, r.n_rows, r.n_cols, r.verdict, r.admin_score, r.data_score) for r in verdict(spark, data + "\n" + admin)] == [(1, 4, 3, "data", 0, 4), (8, 2, 2, "admin", 4, 0)]
    assert [(r.verdict, r.admin_score, r.preview) for r in verdict(spark, "| one |\n\n|---|\n\n   |a|b|c|")] == [("prose", None, "one"), ("empty", None, ""), ("admin", 0, "a | b | c")]
    seven = "\n".join("| a | b | c |" if i < 3 else "| a |" for i in range(7))
    assert [r.reasons for r in verdict(spark, "| why? |  b |\n")] == [["label-shaped first-col cells (100%)", "2-col, short → likely label/value"]]
    assert [r.verdict for r in verdict(spark, seven)] == ["data"]
    assert verdict(spark, "") == [] and verdict(spark, "no pipe") == []


def test_references(apply):
    listed = "# A\n1. x (2020)\n## References\n" + "".join(f"{i}. Smith J. Y (2019)\n" for i in range(1, 6))
    assert apply(listed, lambda t: references.best_estimate(references.format_counts(t))) == 5
    assert [x["id"] for x in apply("PMID: 123456 doi:10.1234/a). again pmid 123456, 10.1234/a; PMID:1234", references.identifiers)] == ["PMID:123456", "doi:10.1234/a"]
    text = "One. Two ends here. " + "x" * 60 + " PMID:123456 tail. More"
    pos = text.index("PMID")
    assert apply(text, lambda t: references.snippet(t, F.lit(pos))) == "x" * 57 + " PMID:123456 tail."  # boundaries add up
    assert apply("x PMID:123456", lambda t: references.references_document(t, F.lit(None).cast("int"))).endswith("1. `PMID:123456` — x PMID:123456\n")
    assert "No machine-parseable" in apply("x", lambda t: references.references_document(t, F.lit(None).cast("int")))


@pytest.mark.parametrize(
    ("title", "reason"),
    [
        (None, "empty"), ("  ", "empty"), ("Section 3 of the whole form", "matches section-prefix pattern"), ("a" * 14, "too short (14 chars)"), ("a" * 15, None), ("a" * 201, "too long (201 chars)"),
        ("A" * 20, "all-caps banner shape"), ("A" * 30, None), ("The Europe PMC Funders Group", "banner substring: 'europe pmc'"),
    ],
)
def test_title_rejection(apply, title, reason):
    assert apply(title, titles.rejection) == reason


def test_title_sources(spark, apply):
    assert apply("| Project title | A title that is long |", titles.from_table) == "A title that is long"
    assert apply("## **2. Project Title**\n\n#### **2.1 Title (max 9 chars)**\nPlease write\n**A real project title**\n", titles.from_labels) == "A real project title"
    assert apply("Title\nshort\nTitle\nA long enough title\n", titles.from_labels) == "A long enough title"
    assert apply("Title\nshort\n", titles.from_labels) is None
    assert apply("# Review\n# **A fine title of a paper**\n", titles.body_h1) == "A fine title of a paper"
    cases = [("x", "A docling title here", True), ("# A heading as the title\n", None, True), ("x", "short", False)]
    df = spark.createDataFrame([(t, d, "a_b", h) for t, d, h in cases], "text string, docling_title string, stem string, has_docling boolean")
    assert rows(titles.pick(df).select("pick.source", "pick.recommended")) == [("body_h1", "A heading as the title"), ("docling", "A docling title here"), ("filename", "a b")]


def plan(spark, text):
    return sections.plan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()


@pytest.mark.parametrize("n", [0, 2, 3, 8, 9, 12])
def test_section_plan(spark, n):
    text = "".join(f"# Part {chr(97 + i)}{'x' * i}\n{'b' * (10 + i)}\n" for i in range(n)) + "body\n# References\n1. x\n# Methods\n"
    got = plan(spark, text)
    spans = [(s["start"], s["end"]) for s in got["sections"]]
    assert len(spans) == min(8, max(1, n)) and spans[-1][1] == got["refs_at"] == text.index("# References")
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and spans[0][0] == 0
    assert [s["slug"][:2] for s in got["sections"]] == [f"{i:02d}" for i in range(1, len(spans) + 1)] or n == 0


def test_section_merge_and_preface(spark):
    sizes = [50, 9, 40, 30, 60, 70, 80, 90, 100]
    text = "".join(f"# Head {i}\n{'b' * s}\n" for i, s in enumerate(sizes))
    assert [s["title"] for s in plan(spark, text)["sections"]][1] == "Head 1 & Head 2"
    for size, first in ((200, "Aaa"), (201, "Abstract")):
        assert plan(spark, "p" * size + "\n# Aaa\n# Bbb\n# Ccc\n")["sections"][0]["title"] == first
    assert [s["slug"] for s in plan(spark, "# 3D imaging\n# The Results!\n# Introduction\n")["sections"]] == ["01_d_imaging", "02_results", "03_introduction"]


def test_section_text(spark):
    df = spark.createDataFrame([("## Old\nline\n# Other\n### x\n",)], "text string").select(sections.section_text(F.col("text"), F.struct(F.lit("T").alias("title"), F.lit(0).alias("start"), F.length("text").alias("end"))).alias("x"))
    assert df.first()["x"] == "# T\n\nline\n## Other\n### x\n"


def test_figures(spark, apply):
    sizes = [(822, 90), (25, 29), (416, 92), (300, 334), (300, 333), (None, None), (1501, 300), (0, 0)]
    df = spark.createDataFrame([(i, w, h) for i, (w, h) in enumerate(sizes)], "i int, w int, h int")
    got = {r["i"]: r["reason"] for r in figures.classify(df).collect()}
    assert got == {0: "min_dim<300,aspect>5.0,area<100000", 1: "min_dim<300,area<100000", 2: "min_dim<300,area<100000", 3: None, 4: "area<100000", 5: "open_failed", 6: "aspect>5.0", 7: "min_dim<300,area<100000"}
    assert [tuple(c) for c in apply("**Figure 2.** One two. Three\nFigure 2. Again\nFig. 1: " + "w " * 200, figures.captions)] == [(2, "One two."), (1, ("w " * 120).rstrip() + "…")]
    for gap, near in ((19, True), (20, False)):
        assert apply("![](a.jpeg)\n" + "x\n" * gap + "Figure 1. c", lambda t: figures.has_caption_near(t, F.lit("a.jpeg"))) is near
    assert apply("nothing", lambda t: figures.has_caption_near(t, F.lit("a.jpeg"))) is None


def test_filenames(apply):
    assert tuple(apply("2025-05_Cell_a_b_PMID12", parse_filename)) == (2025, 5, "Cell", "a_b", "12", None)
    assert apply("2025-05_Cell_a_b_PMID12x", parse_filename) is None and apply(None, parse_filename) is None
