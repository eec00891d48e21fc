"""Which of a document's possible titles to believe."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyrine.functions.patterns import D, S, extract_all, java, let, lines, matches, rewrite, strip, strip_stars

# Fixed values of the rules.
SECTION_PREFIX = rf"(?i)\A(?:Judging Criterion|Section|Question|Annex|Part|Chapter|Appendix){S}+{D}"
BANNERS = (
    "europe pmc", "funders group", "author manuscript", "hhs public access", "nih public access", "sciencedirect",
    "cell press", "nature publishing group", "wellcome open research", "in brief", "graphical abstract",
)
BANNER_WORD = r"(?i)\A(?:article|review|summary|highlights|correspondence|abstract)\z"
_LABEL = rf"(?:#{{1,6}}{S}+)?\**{S}*(?:{D}+(?:\.{D}+)?\.?{S}+)?(?:Project Title|Project Name|Title \(max[^)]*\)|Title){S}*\**{S}*"
LABEL = rf"(?im)^{_LABEL}$"
TABLE_LABEL = rf"(?im)^\|{S}*\**{S}*(?:Project title|Project name|Title){S}*\**{S}*\|{S}*([^|]+?){S}*\|"
PROMPTS = ("please ", "your ", "this ", "guidance", "note that", "we will", "applicants", "if ", "in the ", "in your ", "the form ", "do not ")
BODY_H1 = rf"(?m)^#{S}+\**{S}*([^\n]+?){S}*\**{S}*$"
PAGE_ONE, SHORTEST, LONGEST, CAPITALS = 6000, 15, 200, 30
SECTION_WORDS = ("abstract", "introduction", "methods", "results", "discussion", "references", "bibliography", "conclusion", "acknowledgements", "vision", "approach", "summary")


def rejection(title: Column) -> Column:
    """Why a title is not believed, null if it is."""
    return let(F.coalesce(strip(title), F.lit("")), _rejection)


def _rejection(t: Column) -> Column:
    why = F.when(t == "", F.lit("empty")).when(matches(t, SECTION_PREFIX), F.lit("matches section-prefix pattern"))
    n = F.length(t)
    why = why.when(n < SHORTEST, F.concat(F.lit("too short ("), n.cast("string"), F.lit(" chars)")))
    why = why.when(n > LONGEST, F.concat(F.lit("too long ("), n.cast("string"), F.lit(" chars)")))
    why = why.when(t.rlike(r"[\p{Lu}]") & ~t.rlike(r"[\p{Ll}\p{Lt}]") & (n < CAPITALS), F.lit("all-caps banner shape"))
    for banner in BANNERS:
        why = why.when(F.contains(F.lower(t), F.lit(banner)), F.lit(f"banner substring: '{banner}'"))
    return why.when(matches(t, BANNER_WORD), F.lit("publisher banner word"))


def from_filename(stem: Column) -> Column:
    return strip(rewrite(stem, [(rf"[_{S[1:-1]}]+", " ")]))


def from_table(text: Column) -> Column:
    """The value beside the first title label of a table, if it is long enough."""
    value = strip_stars(F.regexp_extract(text, java(TABLE_LABEL), 1))
    return F.when(F.length(value) >= SHORTEST, value)


def from_labels(text: Column) -> Column:
    """The first substantial line after a title label; labels and prompts are passed over, a short line or a section name ends the search from that label."""
    pieces = F.split(text, java(LABEL), -1)
    rows = F.transform(pieces, lambda p: F.filter(F.transform(lines(p), strip_stars), lambda x: (x != "") & ~matches(x, rf"(?i)\A{_LABEL}\z") & ~F.coalesce(F.array_max(F.array(*[F.lower(x).startswith(w) for w in PROMPTS])), F.lit(False))))
    firsts = F.transform(rows, lambda r: F.get(r, F.lit(0)))

    def step(acc: Column, x: Column) -> Column:  # from the last label to the first, which wins
        line = F.coalesce(x, acc["line"])
        good = (F.length(line) >= SHORTEST) & ~matches(line, SECTION_PREFIX)
        return F.struct(line.alias("line"), F.when(good, line).otherwise(acc["best"]).alias("best"))

    nothing = F.struct(F.lit(None).cast("string").alias("line"), F.lit(None).cast("string").alias("best"))
    return F.aggregate(F.reverse(F.slice(firsts, F.lit(2), F.greatest(F.size(firsts), F.lit(1)))), nothing, step, lambda acc: acc["best"])


def body_h1(text: Column) -> Column:
    """The first top heading of the first page that is believable as a title."""
    found = F.transform(extract_all(F.left(text, F.lit(PAGE_ONE)), BODY_H1, 1), strip_stars)
    return F.get(F.filter(found, lambda x: (x != "") & rejection(x).isNull()), F.lit(0))


def pick(docs: DataFrame) -> DataFrame:
    """Adds ``pick``: struct ``recommended, source, rejected_docling, rejection_reason, warnings``, to rows with ``text, docling_title, stem, has_docling``.

    ``text`` is the cleaned text, null or empty if unreadable. Candidates become columns first, so that
    each is searched for once.
    """
    body = F.coalesce("text", F.lit(""))
    d = docs.withColumns({"_why": rejection(F.col("docling_title")), "_table": from_table(body), "_label": from_labels(body), "_h1": body_h1(body), "_file": from_filename(F.col("stem"))})
    d = d.withColumn("_found", F.coalesce("_table", "_label"))
    why = F.col("_why")
    source = F.when(F.col("_table").isNotNull(), "body_table").when(F.col("_label").isNotNull(), "body_heading").when(why.isNull(), "docling").when(F.col("_h1").isNotNull(), "body_h1").otherwise("filename")
    d = d.withColumn("_source", source)
    differs = F.col("_found").isNotNull() & why.isNull() & (F.lower(strip(F.col("_found"))) != F.lower(strip(F.col("docling_title"))))
    warnings = F.array_compact(
        F.array(
            F.when(~F.col("has_docling"), F.lit("docling_meta.json not found")),
            F.when(body == "", F.lit("cleaned.md not readable")),
            F.when(differs, F.concat(F.lit("body title differs from docling title (docling: '"), F.col("docling_title"), F.lit("')"))),
            F.when(F.col("_source") == "body_h1", F.concat(F.lit("docling title rejected ("), why, F.lit("); using body H1"))),
            F.when(F.col("_source") == "filename", F.lit("no body title found and docling rejected; using filename stem")),
        )
    )
    chosen = F.struct(
        F.coalesce("_found", F.when(why.isNull(), strip(F.col("docling_title"))), "_h1", "_file").alias("recommended"),
        F.col("_source").alias("source"),
        F.when(why.isNotNull(), F.col("docling_title")).alias("rejected_docling"),
        why.alias("rejection_reason"),
        warnings.alias("warnings"),
    )
    return d.withColumn("pick", chosen).drop("_why", "_table", "_label", "_h1", "_file", "_found", "_source")


def detect(text: Column) -> Column:
    """A title from structure alone: the first heading shaped like a title, otherwise the first line of text if it is."""
    ls = lines(text)
    words = lambda x: F.size(F.filter(F.split(x, f"{S}+"), lambda w: w != ""))
    shaped = lambda x: (words(x) >= 3) & (words(x) <= 25) & ~x.endswith(".")
    heads = F.transform(F.filter(ls, lambda x: x.rlike(rf"\A#{{1,6}}{S}+.")), lambda x: strip(F.regexp_replace(x, rf"\A#{{1,6}}{S}+", "")))
    titled = F.filter(heads, lambda x: shaped(x) & ~F.lower(x).isin(*SECTION_WORDS))
    plain = F.get(F.filter(F.transform(ls, strip), lambda x: (x != "") & ~x.startswith("#") & ~x.startswith("|")), F.lit(0))
    return F.coalesce(F.get(titled, F.lit(0)), F.when(shaped(plain), plain))
