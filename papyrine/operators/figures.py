"""Images that are figures, and the captions that go with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from papyrine.functions.patterns import D, S, first_of_each, let, located, matches, strip_stars

# The thresholds of the rule.
MIN_SIDE, MAX_ASPECT, MIN_AREA, CAPTION_LINES, CAPTION_CHARS = 300, 5.0, 100_000, 20, 240

CAPTION_LINE = rf"(?m)^(?:#{{1,6}}{S}+)?\**{S}*(?:Figure|Fig\.?|FIGURE){S}+{D}+{S}*[.|:](?:[^\p{{Nd}}]|\z)"
CAPTION = rf"(?m)^(?:#{{1,6}}{S}+)?\**{S}*(?:Figure|Fig\.?|FIGURE){S}+({D}+)\b[{S[1:-1]}.:|]*\**{S}*([^\n]{{0,400}})"
PAGE_IN_NAME = r"(?i)_page_(\p{Nd}+)_(?:Figure|Picture)_\p{Nd}+"


def classify(images: DataFrame) -> DataFrame:
    """Adds ``area, aspect, kept, reason`` to rows with ``w, h``; an image that did not open is dropped as ``open_failed``."""
    small, large = F.least("w", "h"), F.greatest("w", "h")
    aspect = large / F.greatest(small, F.lit(1))
    area = F.col("w").cast("bigint") * F.col("h")
    bad = F.col("w").isNull() | F.col("h").isNull()
    why = F.concat_ws(",", F.when(small < MIN_SIDE, f"min_dim<{MIN_SIDE}"), F.when(aspect > MAX_ASPECT, f"aspect>{MAX_ASPECT}"), F.when(area < MIN_AREA, f"area<{MIN_AREA}"))
    reason = F.when(bad, "open_failed").otherwise(F.nullif(why, F.lit("")))
    return images.withColumns({"area": area, "aspect": F.rint(aspect * 100) / 100, "kept": reason.isNull(), "reason": reason})


def audit(classified: DataFrame, doc: str = "doc_id") -> DataFrame:
    return classified.groupBy(doc).agg(F.count(F.lit(1)).alias("n_total"), F.count_if("kept").alias("n_kept"), F.count_if(~F.col("kept")).alias("n_dropped"))


def drop_reasons(classified: DataFrame) -> DataFrame:
    return classified.where(~F.col("kept")).groupBy("reason").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "reason")


def captions(text: Column) -> Column:
    """Structs ``n, caption``: the first caption of each figure number, cut to its first sentence."""
    found = F.transform(located(text, CAPTION, (1, 2)), lambda m: F.struct(m["g1"].cast("int").alias("n"), _sentence(_block(text, m)).alias("caption")))
    found = F.filter(found, lambda x: x["caption"].isNotNull() & x["n"].isNotNull())
    return first_of_each(found, "n", "struct<n:int,caption:string>")


def _block(text: Column, m: Column) -> Column:
    tail = F.get(F.split(strip_stars(F.substring(text, m["end"] + 1, F.lit(400))), "\n\n"), F.lit(0))
    return F.nullif(let(strip_stars(m["g2"]), lambda own: F.when(own != "", own).otherwise(tail)), F.lit(""))


def _sentence(block: Column) -> Column:
    def shortened(one: Column) -> Column:
        cut = F.left(one, F.lit(CAPTION_CHARS))
        at = F.locate(" ", F.reverse(cut))
        return F.when(F.length(one) > CAPTION_CHARS, F.concat(F.when(at > 0, F.left(cut, F.length(cut) - at)).otherwise(cut), F.lit("…"))).otherwise(one)

    return let(F.get(F.split(block, rf"(?<=[.!?]){S}+", 2), F.lit(0)), shortened)


def has_caption_near(text: Column, name: Column, window: int = CAPTION_LINES) -> Column:
    """Whether a caption stands within ``window`` lines of the image's mark; null if the text does not mention it."""
    at = F.call_function("locate", F.concat(F.lit("]("), name), text)
    stem = F.regexp_replace(name, r"\.[^.]*\z", "")
    at = F.when(at > 0, at).otherwise(F.call_function("locate", stem, text))
    rows = F.split(text, "\n", -1)
    line = F.size(F.split(F.left(text, at - 1), "\n", -1)) - 1
    lo = F.greatest(F.lit(0), line - window)
    chunk = F.array_join(F.slice(rows, lo + 1, line + window + 1 - lo), "\n")
    return F.when(at > 0, matches(chunk, CAPTION_LINE))


def require_captions(classified: DataFrame, texts: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Drops kept images whose mark in the text has no caption near; images the text does not mention stay."""
    name = F.element_at(F.split("path", "/"), -1)
    gated = classified.join(texts.select(F.col(doc), F.col("text").alias("_text")), doc, "left")
    lost = F.col("kept") & F.coalesce(~has_caption_near(F.col("_text"), name), F.lit(False))
    return gated.withColumns({"kept": F.col("kept") & ~lost, "reason": F.when(lost, F.lit("no_caption")).otherwise(F.col("reason"))}).drop("_text")


def figure_records(classified: DataFrame, texts: DataFrame, doc: str = "doc_id") -> DataFrame:
    """``doc, n, path, caption, sidecar``: kept images in order, each with the caption of its ordinal."""
    rank = F.row_number().over(Window.partitionBy(doc).orderBy(F.when(F.col("source") == "marker", 0).otherwise(1), "path"))
    kept = classified.where("kept").select(doc, rank.alias("n"), "path", F.lower(F.regexp_extract("path", r"(\.[^./]*)\z", 1)).alias("ext"))
    told = texts.select(F.col(doc), F.explode_outer(captions(F.col("text"))).alias("c")).where("c is not null").select(doc, F.col("c.n").alias("n"), F.col("c.caption").alias("caption"))
    rows = kept.join(told, [doc, "n"], "left")
    shown = F.coalesce("caption", F.lit("(no caption detected; see surrounding section text)"))
    no, nn = F.col("n").cast("string"), F.lpad(F.col("n").cast("string"), 2, "0")
    sidecar = F.concat(F.lit("# Figure "), no, F.lit("\n\n![Figure "), no, F.lit("](figure_"), nn, F.col("ext"), F.lit(")\n\n**Caption (verbatim):** "), shown, F.lit("\n\n**Description:** "), shown, F.lit("\n"))
    return rows.select(doc, "n", "path", F.coalesce("caption", F.lit("")).alias("caption"), sidecar.alias("sidecar"))
