"""Problem 2: lines repeated across the documents of one source.

Lines are masked and clustered within each source by locality-sensitive hashing. Clusters of high
document frequency hold what is repeated: the same lines, found by an exact count of their forms that
follows, and lines that differ by numbers, dates, names or a few words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyrine.operators.deliveries import once
from papyrine.session import broadcast_if_small, checkpoint, spread

LEAST_LENGTH, LEAST_PAPERS, LEAST_SHARE = 30, 4, 0.15

#: Month names, fixed values; a line's dates are masked by them once its digits are gone.
MONTHS = "january february march april may june july august september october november december jan feb mar apr jun jul aug sep oct nov dec".split()

#: Bands of a signature, and least hashes in each.
BANDS, ROWS = 2, 2

#: Words of a line that have no capital letter, at least, for capitalised ones to be masked as names.
PLAIN_WORDS = 4

#: Share of masked words that two lines of a cluster have in common at least.
ALIKE = 0.8

#: Clusters, and papers with their source, up to which they are broadcast.
MAX_BROADCAST = 1_000_000


def form(line: Column) -> Column:
    """What remains of a line in which digits, case and the width of blanks do not count."""
    kept = F.translate(F.lower(line), "0123456789", "")
    wide = F.contains(kept, F.lit("  ")) | F.contains(kept, F.lit("\t"))
    return F.trim(F.when(wide, F.regexp_replace(kept, "[ \t]+", " ")).otherwise(kept))


def _masked_words(line: Column) -> Column:
    """The words of a line whose digits are gone, without addresses; names of months are left out when they are hashed."""
    addressed = F.contains(line, F.lit("@")) | F.contains(line, F.lit("://")) | F.contains(line, F.lit("doi:"))
    masked = F.when(addressed, F.regexp_replace(line, r"\S+@\S+|https?://\S+|doi:\S+", "@")).otherwise(line)
    return F.split(masked, r"[^\p{L}\p{N}@]+")


def _nameless_words(line: Column) -> Column:
    """Hashes of the distinct masked words in order: without capitalised ones, which may be names, where enough others remain."""
    words = F.filter(_masked_words(F.translate(line, "0123456789", "")), lambda w: (w != "") & ~F.lower(w).isin(MONTHS))
    both = F.struct(words.alias("all"), F.filter(words, lambda w: F.lower(w) == w).alias("plain"))
    kept = F.get(F.transform(F.array(both), lambda x: F.when(F.size(x["plain"]) >= PLAIN_WORDS, x["plain"]).otherwise(F.transform(x["all"], lambda w: F.lower(w)))), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(kept, lambda w: F.xxhash64(w))))


def _least_hashes(words: Column, bands: int) -> Column:
    """The least hash of the words under each seed, in one pass over them."""
    names = [f"m{i}" for i in range(bands * ROWS)]
    nothing = F.struct(*[F.lit(2**63 - 1).alias(n) for n in names])
    step = lambda acc, w: F.struct(*[F.least(acc[n], F.xxhash64(w, F.lit(i))).alias(n) for i, n in enumerate(names)])
    return F.aggregate(words, nothing, step)


def _band(least: Column, b: int) -> Column:
    """A band key of a masked line: equal lines have equal keys, similar ones are likely to share one."""
    return F.xxhash64(F.lit(b), *[least[f"m{b * ROWS + r}"] for r in range(ROWS)])


def _sources(runs: DataFrame, doc: str, source: str) -> DataFrame:
    known = runs.select(F.col(doc).alias("_doc"), F.col(source).alias("_source")).where("_doc is not null and _source is not null")
    return broadcast_if_small(known.groupBy("_doc").agg(F.min("_source").alias("_source")), MAX_BROADCAST)


def _papers(docs: DataFrame, own: DataFrame, doc: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(documents with a text, once each, number of papers of each source)."""
    src = spread(once(docs.where(F.col(text).isNotNull()), doc, text), doc).select(F.col(doc).alias("_doc"), F.col(text).alias("_text"))
    return src, checkpoint(src.select("_doc").join(own, "_doc").groupBy("_source").agg(F.count(F.lit(1)).alias("_papers")))  # one row for each source


def _lines(src: DataFrame) -> DataFrame:
    lines = src.select("_doc", F.posexplode(F.split("_text", "\n", -1)).alias("_at", "_line")).where(F.length("_line") >= LEAST_LENGTH)
    return lines.select("_doc", (F.col("_at") + 1).alias("_no"), "_line", form(F.col("_line")).alias("_form")).where(F.length("_form") >= LEAST_LENGTH)


def _enough(n: str) -> Column:
    return (F.col(n) >= LEAST_PAPERS) & (F.col(n) >= F.col("_papers") * LEAST_SHARE)


def _often(rows: DataFrame, papers: DataFrame, *key: str) -> DataFrame:
    """``_source, key, _papers`` of what enough documents of a source hold; each row of ``rows`` is a document's.

    Few pass: a document has a limited number of lines, and what passes is in a share of the documents.
    """
    counts = rows.groupBy("_source", *key).agg(F.count(F.lit(1)).alias("_df")).where(F.col("_df") >= LEAST_PAPERS)
    return counts.join(F.broadcast(papers), "_source").where(_enough("_df")).drop("_df")  # one row for each source


def repeated_lines(docs: DataFrame, runs: DataFrame, doc: str = "doc_id", text: str = "marker_md", source: str = "journal") -> DataFrame:
    """``doc, line_no`` of the lines that recur in too many documents of their source.

    Masked lines are clustered within each source; only lines of clusters with a high document frequency
    go on, and are taken when their own form reaches the minimum number and share of documents. Equal
    forms share their cluster, so clustering loses none.

    Lines travel as hashes, never as text, and are counted before each shuffle, so a source or a form
    that holds a third of all rows is a few partial counts per task. Null texts and documents without a
    source do not count; empty texts count as documents; repeated rows count once.
    """
    own = _sources(runs, doc, source)
    src, papers = _papers(docs, own, doc, text)
    words = F.filter(_masked_words(F.col("_form")), lambda w: ~w.isin(MONTHS))
    hashed = _lines(src).select("_doc", "_no", F.xxhash64("_form").alias("_h1"), F.xxhash64(F.lit(1), F.reverse("_form")).alias("_h2"), _least_hashes(words, 1).alias("_m"))
    # three later steps read the hashed lines, so that each line is masked and hashed once
    keyed = checkpoint(hashed.select("_doc", "_no", "_h1", "_h2", _band(F.col("_m"), 0).alias("_key")).join(own, "_doc"))
    clusters = broadcast_if_small(checkpoint(_often(_once_a_document(keyed, "_key"), papers, "_key").drop("_papers")), MAX_BROADCAST)
    held = keyed.join(clusters, ["_source", "_key"], "left_semi")
    hits = broadcast_if_small(checkpoint(_often(_once_a_document(held, "_h1", "_h2"), papers, "_h1", "_h2").drop("_papers")), MAX_BROADCAST)
    found = held.join(hits, ["_source", "_h1", "_h2"], "left_semi")
    return found.select(F.col("_doc").alias(doc), F.col("_no").cast("bigint").alias("line_no"))


def _once_a_document(rows: DataFrame, *key: str) -> DataFrame:
    """Rows ``_doc, _source, key`` without repeats inside a document; a document's lines lie together, so most repeats fall before the shuffle."""
    return rows.select("_doc", "_source", *key).distinct()


def repeated_clusters(docs: DataFrame, runs: DataFrame, doc: str, text: str, source: str) -> DataFrame:
    """``_source, _exact, _near``: for each source the hashes of the forms that recur, and its near-duplicate clusters as (band, key, words).

    A cluster is taken when enough documents of the source have a line in it that shares ``ALIKE`` of its
    masked words with the cluster's most frequent one; ``words`` are those of that line.
    """
    own = _sources(runs, doc, source)
    src, papers = _papers(docs, own, doc, text)
    hashed = _lines(src).select("_doc", F.xxhash64("_form").alias("_h"), _nameless_words(F.col("_line")).alias("_words"))
    hashed = hashed.withColumn("_m", _least_hashes(F.col("_words"), BANDS)).select("_doc", "_h", "_words", F.array(*[_band(F.col("_m"), b) for b in range(BANDS)]).alias("_keys"))
    keyed = checkpoint(hashed.join(own, "_doc"))
    exact = _often(_once_a_document(keyed, "_h"), papers, "_h").groupBy("_source").agg(F.collect_list("_h").alias("_exact"))
    banded = keyed.select("_doc", "_source", "_words", F.posexplode("_keys").alias("_band", "_key"))
    often = checkpoint(_often(_once_a_document(banded, "_band", "_key"), papers, "_band", "_key"))
    held = banded.join(broadcast_if_small(often, MAX_BROADCAST), ["_source", "_band", "_key"])
    key = ["_source", "_band", "_key"]
    forms = held.groupBy(*key, "_words").agg(F.count(F.lit(1)).alias("_n"))
    usual = forms.groupBy(*key).agg(F.max_by("_words", F.struct("_n", F.xxhash64("_words"))).alias("_usual"))
    alike = held.join(broadcast_if_small(usual, MAX_BROADCAST), key).where(_similar(F.col("_words"), F.col("_usual")))
    sure = alike.select("_doc", *key, "_usual", "_papers").distinct().groupBy(*key, "_usual", "_papers").agg(F.count(F.lit(1)).alias("_df")).where(_enough("_df"))
    near = sure.groupBy("_source").agg(F.collect_list(F.struct(F.col("_band").alias("band"), F.col("_key").alias("key"), F.col("_usual").alias("words"))).alias("_near"))
    return exact.join(near, "_source", "full")


def _similar(a: Column, b: Column) -> Column:
    shared = F.size(F.array_intersect(a, b))
    return shared >= ALIKE * (F.size(a) + F.size(b) - shared)


def without_repeated_lines(docs: DataFrame, runs: DataFrame, doc: str = "doc_id", text: str = "marker_md", source: str = "journal") -> DataFrame:
    """``doc, text`` of every document once, without lines that recur and lines of near-duplicate clusters; null stays null.

    The clusters of a source, few since each is in a share of its documents, meet its documents in a
    broadcast; texts are rewritten where they lie. Documents without a source stay as they are.
    """
    clusters = checkpoint(repeated_clusters(docs, runs, doc, text, source))  # one row for each source
    own = _sources(runs, doc, source)
    src = spread(once(docs, doc, text), doc).select(F.col(doc).alias("_doc"), F.col(text).alias("_text")).join(own, "_doc", "left").join(F.broadcast(clusters), "_source", "left")
    nothing = F.array().cast("array<struct<band:int,key:bigint,words:array<bigint>>>")
    exact, near = F.coalesce("_exact", F.array().cast("array<bigint>")), F.coalesce("_near", nothing)

    def repeated(line: Column) -> Column:
        def of(f: Column) -> Column:
            told = F.get(F.transform(F.array(_nameless_words(line)), lambda w: F.struct(w.alias("w"), _least_hashes(w, BANDS).alias("m"))), F.lit(0))
            keys = lambda x: F.array(*[_band(x["m"], b) for b in range(BANDS)])
            keyed = F.transform(F.array(told), lambda x: F.struct(x["w"].alias("w"), keys(x).alias("k")))
            in_cluster = F.exists(keyed, lambda x: F.exists(near, lambda c: (F.get(x["k"], c["band"]) == c["key"]) & _similar(x["w"], c["words"])))
            return (F.length(f) >= LEAST_LENGTH) & (F.array_contains(exact, F.xxhash64(f)) | in_cluster)

        return F.exists(F.array(form(line)), of)

    kept = F.filter(F.split("_text", "\n", -1), lambda x: (F.length(x) < LEAST_LENGTH) | ~repeated(x))
    some = (F.size(exact) > 0) | (F.size(near) > 0)
    cleaned = F.when(some, F.array_join(kept, "\n")).otherwise(F.col("_text"))
    return src.select(F.col("_doc").alias(doc), cleaned.alias(text))
