"""Problem 9: evaluation passages inside a training corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyrine.llm.words import window_hashes, words
from papyrine.operators.deliveries import once
from papyrine.session import broadcast_if_small, checkpoint

#: Rows up to which the table of test windows is broadcast, 24 bytes each; a larger one is joined by a shuffle.
MAX_BROADCAST_WINDOWS = 1_000_000

#: Documents with hits up to which their ids are broadcast to the corpus.
MAX_BROADCAST_DOCS = 1_000_000


def _windows(rows: DataFrame, key: str, text: str, n: int, name: str) -> DataFrame:
    """``h, key, position`` of each window of ``n`` words; nothing else of a text travels with its windows."""
    ws = rows.select(F.col(key).alias(f"_{name}"), words(F.col(text)).alias("_ws")).where(F.col(f"_{name}").isNotNull())
    return ws.select(f"_{name}", F.posexplode(window_hashes(F.col("_ws"), n)).alias(f"_{name}_at", "_h"))


def _gram(ws: Column, at: Column, n: int) -> Column:
    return F.array_join(F.slice(ws, at + 1, n), " ")


def _hits(docs: DataFrame, items: DataFrame, doc: str, item: str, text: str, n: int) -> DataFrame:
    """``_doc, _doc_at, _item``: windows of documents that are windows of an item, word by word.

    The hash of a window finds; the words of both texts, looked up again for the few hits, verify.
    """
    tested = _windows(items, item, text, n, "item").groupBy("_h", "_item").agg(F.min("_item_at").alias("_item_at"))
    found = checkpoint(_windows(docs, doc, text, n, "doc").join(broadcast_if_small(tested, MAX_BROADCAST_WINDOWS), "_h").select("_doc", "_doc_at", "_item", "_item_at").distinct())

    def gram(rows: DataFrame, key: str, name: str) -> DataFrame:
        wanted = found.select(f"_{name}").distinct()
        own = rows.select(F.col(key).alias(f"_{name}"), F.col(text).alias("_text")).join(broadcast_if_small(wanted, MAX_BROADCAST_DOCS), f"_{name}", "left_semi")
        at = found.groupBy(f"_{name}").agg(F.collect_set(f"_{name}_at").alias("_at"))
        own = own.dropDuplicates([f"_{name}"]).join(at, f"_{name}").select(f"_{name}", words(F.col("_text")).alias("_ws"), "_at")
        return own.select(f"_{name}", "_ws", F.explode("_at").alias(f"_{name}_at")).where("_ws is not null").select(f"_{name}", f"_{name}_at", _gram(F.col("_ws"), F.col(f"_{name}_at"), n).alias(f"_{name}_gram"))

    both = found.join(gram(docs, doc, "doc"), ["_doc", "_doc_at"]).join(gram(items, item, "item"), ["_item", "_item_at"])
    return both.where("_doc_gram = _item_gram").select("_doc", "_doc_at", "_item")


def leaks(docs: DataFrame, items: DataFrame, doc: str = "doc_id", item: str = "item_id", text: str = "text", n: int = 12) -> DataFrame:
    """Pairs (document, item) that share at least ``n`` consecutive words, each once.

    The windows of the evaluation texts form a hash set that is broadcast when its counted size allows;
    the corpus is scanned once without a shuffle, and only what is found is shuffled, to remove repeats.
    Null, empty and shorter texts leak nothing; repeated rows count once; columns other than the key
    and the text are ignored. Either table may be empty.
    """
    return _hits(docs, items, doc, item, text, n).select(F.col("_doc").alias(doc), F.col("_item").alias(item)).distinct()


def without_leaks(docs: DataFrame, items: DataFrame, doc: str = "doc_id", item: str = "item_id", text: str = "text", n: int = 12) -> DataFrame:
    """``doc, text`` of every document once: the words of each leaked span, and what stands between them, cut out.

    Overlapping and touching spans are merged first, so each position is cut once. Documents without a
    leak stay as they are, null stays null.
    """
    spans = checkpoint(_hits(docs, items, doc, item, text, n).groupBy("_doc").agg(F.sort_array(F.collect_set("_doc_at")).alias("_at")))
    src = once(docs, doc, text).select(F.col(doc).alias("_doc"), F.col(text).alias("_text"))
    leaking = broadcast_if_small(spans, MAX_BROADCAST_DOCS)
    # pieces alternate: the text before word k is piece k, so cutting words i..j keeps the gaps outside
    gaps = F.split(F.col("_text"), r"[\p{L}\p{N}]+", -1)
    raw = F.regexp_extract_all(F.col("_text"), F.lit(r"([\p{L}\p{N}]+)"))
    joined = src.join(leaking, "_doc").select("_doc", "_at", gaps.alias("_gaps"), raw.alias("_ws"))
    hit = F.array_distinct(F.flatten(F.transform("_at", lambda p: F.sequence(p, p + (n - 1)))))
    kept = joined.withColumn("_hit", F.map_from_arrays(hit, F.transform(hit, lambda _: F.lit(True)))).select(
        "_doc",
        F.array_join(
            F.transform(
                F.sequence(F.lit(0), F.size("_ws")),
                lambda i: F.concat(
                    F.when(F.element_at("_hit", i).isNotNull() & F.element_at("_hit", i - 1).isNotNull(), F.lit("")).otherwise(F.get("_gaps", i)),
                    F.when(F.element_at("_hit", i).isNotNull() | (i >= F.size("_ws")), F.lit("")).otherwise(F.coalesce(F.get("_ws", i), F.lit(""))),
                ),
            ),
            "",
        ).alias("_text"),
    )
    return src.join(leaking.select("_doc"), "_doc", "left_anti").unionByName(kept).select(F.col("_doc").alias(doc), F.col("_text").alias(text))
