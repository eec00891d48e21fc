"""Problem 3: groups of records that share most of their content.

A record is the set of its shingles. Records meet in tiles: a tile holds the records of which a rare
shingle is among those that every similar partner must share some of. Inside a tile records are in
order of size, so each is compared only with the band of sizes that can reach the threshold; hashed
bitmaps bound the overlap of a pair from above, and only pairs that pass are intersected exactly.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyrine.session import broadcast_if_small, checkpoint

#: Bits of a bitmap for each shingle of its set, at least; widths are powers of two.
BITS_PER_SHINGLE = 2

#: Records of a shingle above which its tile is cut into tiles of two shingles, and above which such a tile is cut into blocks that meet pairwise in different tasks.
TILE_ROWS, BLOCK_ROWS = 1024, 8192

#: Standard deviations by which the shared part of two sketches may fall short; 4.5 miss about three pairs in a million at the threshold, fewer above it.
DEVIATIONS = 4.5

#: Size of sketch that holds every set whole.
EVERY = 1 << 40

#: Pairs held at a time while a tile is compared.
PAIRS_AT_ONCE = 200_000

#: Ids of records to verify up to which they are broadcast.
MAX_BROADCAST_IDS = 2_000_000


def char_shingles(text: Column, n: int = 3) -> Column:
    """A 64-bit hash of each ``n`` consecutive characters of the lower-cased text."""
    low = F.lower(text)
    return F.when(F.length(low) >= n, F.transform(F.sequence(F.lit(1), F.length(low) - (n - 1)), lambda i: F.xxhash64(F.substring(low, i, F.lit(n))))).otherwise(F.array().cast("array<bigint>"))


def bitmap(hashes: np.ndarray) -> np.ndarray:
    """Bit i is the parity of the shingles hashed to i: each bit in which two maps differ is a shingle that only one set has.

    The width grows with the set, so that large sets are told apart as well as small ones; a wide map
    folds into one of half its width.
    """
    width = 1 << max(0, math.ceil(math.log2(max(1, len(hashes) * BITS_PER_SHINGLE / 64))))
    at = (hashes.view(np.uint64) >> np.uint64(7)) % np.uint64(width * 64)
    odd = np.flatnonzero(np.bincount(at.astype(np.int64), minlength=width * 64) & 1)
    words = np.zeros(width, np.uint64)
    np.bitwise_or.at(words, odd >> 6, np.uint64(1) << (odd & 63).astype(np.uint64))
    return words.view(np.int64)


def fold(words: np.ndarray, width: int) -> np.ndarray:
    while len(words) > width:
        half = len(words) // 2
        words = words[:half] ^ words[half:]
    return words


def least_shared(size: int, threshold: float, k: int) -> int:
    """Shingles that the sketch of a set of ``size`` shares at least with the sketch of any similar set."""
    exact = math.ceil(threshold * size - 1e-9)
    if size / threshold <= k:
        return max(1, exact)
    sampled = math.floor(k * threshold - DEVIATIONS * math.sqrt(k * threshold * (1 - threshold)))
    return max(1, min(exact, sampled))


def _sets(items: DataFrame, threshold: float, k: int) -> DataFrame:
    """``id, n, k1, k2, prefix, sketch, bits`` of every non-empty set; equal sets have equal keys k1, k2."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for i, hashes in zip(batch["id"], batch["hashes"]):
                own = np.unique(np.asarray(hashes, np.int64))
                if len(own):
                    k1, k2 = np.frombuffer(hashlib.blake2b(own.tobytes(), digest_size=16).digest(), np.int64)
                    sketch = own.view(np.uint64)
                    sketch = (np.sort(sketch)[:k] if len(own) > k else sketch).view(np.int64)
                    rows.append((i, len(own), int(k1), int(k2), len(sketch) - least_shared(len(own), threshold, k) + 1, sketch, bitmap(own)))
            yield pd.DataFrame(rows, columns=["id", "n", "k1", "k2", "prefix", "sketch", "bits"])

    return items.mapInPandas(run, "id bigint, n int, k1 bigint, k2 bigint, prefix int, sketch array<bigint>, bits array<bigint>")


def _compare(frame: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Pairs of one or more whole tiles, sorted by tile and size, that the bitmaps do not rule out."""
    n = frame["n"].to_numpy(np.int64)
    ids, own = frame["id"].to_numpy(np.int64), frame["own"].to_numpy(np.int64)
    crossed = (frame["bi"] != frame["bj"]).to_numpy()
    bits = frame["bits"].to_numpy()
    widths = np.fromiter(map(len, bits), np.int64, len(bits))
    maps = {w: np.stack([fold(x, w) if len(x) >= w else np.zeros(w, np.int64) for x in bits]).view(np.uint64) for w in np.unique(widths)}
    new = np.ones(len(frame), bool)
    tiles = frame[["tok", "bi", "bj"]].to_numpy(np.int64)
    new[1:] = (tiles[1:] != tiles[:-1]).any(1)
    tile = np.cumsum(new) - 1
    scale = np.int64(1) << np.int64(33)
    end = np.searchsorted(tile * scale + n, tile * scale + np.floor(n / threshold + 1e-9).astype(np.int64), side="right")
    count = end - np.arange(len(frame)) - 1
    found = []
    start = 0
    while start < len(frame):
        upto = start + max(1, int(np.searchsorted(np.cumsum(count[start:]), PAIRS_AT_ONCE, side="right")))
        c = count[start:upto]
        a = np.repeat(np.arange(start, upto), c)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(c) - c, c)
        most = (1 - threshold) / (1 + threshold) * (n[a] + n[b]) + 1e-9  # shingles that a similar pair may not share
        ok = (~crossed[a] | (own[a] != own[b])) & (ids[a] != ids[b])
        for w, m in maps.items():
            at = np.flatnonzero(ok & (np.minimum(widths[a], widths[b]) == w))
            ok[at] = np.bitwise_count(m[a[at]] ^ m[b[at]]).sum(1) <= most[at]
        lo, hi = np.minimum(ids[a[ok]], ids[b[ok]]), np.maximum(ids[a[ok]], ids[b[ok]])
        found.append(pd.DataFrame({"a": lo, "b": hi}))
        start = upto
    return pd.concat(found).drop_duplicates() if found else pd.DataFrame({"a": [], "b": []}, dtype="int64")


def _candidates(sets: DataFrame, threshold: float) -> DataFrame:
    """``a, b``: pairs of sets that meet in a tile and pass the bitmaps."""
    tokens = sets.select("id", F.explode("sketch").alias("tok"))
    common = tokens.groupBy("tok").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = tokens.join(common, "tok").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("df", "tok"))).alias("toks"))
    facts = sets.select("id", "n", F.size("sketch").alias("m"), "prefix", "bits")
    # shingles of one record only come first in the order of rarity and meet nobody, so they use up the prefix
    length = F.greatest(F.lit(0), F.col("prefix") - F.col("m") + F.size("toks"))
    held = shared.join(facts, "id").where(length > 0).select("id", "n", "bits", length.alias("length"), F.slice("toks", 1, length + 1).alias("toks"))
    tile = lambda key, df, rows: F.struct(key.alias("tok"), F.ceil(df / rows).cast("int").alias("blocks"))

    def tiles(t: Column, i: Column) -> Column:
        """The tile of a rare shingle, or those of a common one with each later shingle of the prefix that is longer by one.

        Similar sets share two shingles there, and the first of them in both prefixes; so no pair is lost.
        """
        own = F.array(tile(t["tok"], t["df"], BLOCK_ROWS))
        if threshold <= 0.5:  # sets might share one shingle only
            return own
        rest = F.slice("toks", i + 2, F.greatest(F.size("toks"), F.lit(1)))
        return F.when(t["df"] <= TILE_ROWS, own).otherwise(F.transform(rest, lambda y: tile(F.xxhash64(t["tok"], y["tok"]), t["df"], BLOCK_ROWS)))

    meets = F.array_distinct(F.flatten(F.transform(F.slice("toks", 1, F.col("length")), tiles)))
    rows = held.select("id", "n", "bits", F.explode(meets).alias("t")).select("id", "n", "bits", "t.tok", "t.blocks")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("tok", F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"), "own", "n", "id", "bits")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: pd.DataFrame | None = None
        for batch in batches:
            frame = batch if kept is None else pd.concat([kept, batch], ignore_index=True)
            last = frame[["tok", "bi", "bj"]].iloc[-1]
            tail = int(((frame["tok"] == last["tok"]) & (frame["bi"] == last["bi"]) & (frame["bj"] == last["bj"])).sum())
            if len(frame) > tail:  # the last tile may go on in the next batch
                yield _compare(frame.iloc[: len(frame) - tail].reset_index(drop=True), threshold)
            kept = frame.iloc[len(frame) - tail :].reset_index(drop=True)
        if kept is not None and len(kept):
            yield _compare(kept, threshold)

    tiled = rows.repartition("tok", "bi", "bj").sortWithinPartitions("tok", "bi", "bj", "n")
    return tiled.mapInPandas(run, "a bigint, b bigint").distinct()


def _verify(pairs: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose sorted arrays of shingles have the threshold in common."""
    ids = broadcast_if_small(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), MAX_BROADCAST_IDS)
    arrays = items.join(ids, "id", "left_semi").groupBy("id").agg(F.first("hashes").alias("h")).select("id", F.sort_array(F.array_distinct("h")).alias("h"))
    both = pairs.join(arrays.select(F.col("id").alias("a"), F.col("h").alias("ha")), "a").join(arrays.select(F.col("id").alias("b"), F.col("h").alias("hb")), "b")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ok = []
            for x, y in zip(batch["ha"], batch["hb"]):
                at = np.searchsorted(y, x)
                shared = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                ok.append(shared / (len(x) + len(y) - shared) >= threshold)
            yield batch.loc[np.array(ok, bool), ["a", "b"]]

    return both.mapInPandas(run, "a bigint, b bigint")


def _classes(items: DataFrame, threshold: float, k: int) -> tuple[DataFrame, DataFrame]:
    """(``rep, id`` of every record with shingles, ``a, b`` of similar representatives)."""
    sets = checkpoint(_sets(items, threshold, k))
    reps = sets.groupBy("k1", "k2").agg(F.min("id").alias("rep"))
    members = sets.select("k1", "k2", "id").distinct().join(reps, ["k1", "k2"]).select("rep", "id")
    firsts = sets.join(members.select(F.col("rep").alias("id")).distinct(), "id", "left_semi").dropDuplicates(["id"])
    return members, _verify(checkpoint(_candidates(firsts, threshold)), items, threshold)


def similar_pairs(items: DataFrame, threshold: float, k: int = EVERY) -> DataFrame:
    """``id_a, id_b``, id_a < id_b, of all records of ``id, hashes`` whose sets have at least ``threshold`` of their union in common.

    Records without shingles (null, empty or too short texts) are similar to none. Equal sets form one
    class that takes part once, so hot groups of copies never fill a tile; their pairs are listed at the
    end because the result asks for them. Sets of up to ``k`` shingles, or all without ``k``, are searched
    exactly; larger ones through their ``k`` least hashes, see ``DEVIATIONS``. No tile, partner or candidate
    is capped: a tile beyond ``TILE_ROWS`` is cut by second shingles, and beyond ``BLOCK_ROWS`` compared in
    blocks by different tasks.
    """
    members, links = _classes(items, threshold, k)
    a = members.select(F.col("rep").alias("a"), F.col("id").alias("ia"))
    b = members.select(F.col("rep").alias("b"), F.col("id").alias("ib"))
    linked = links.join(a, "a").join(b, "b").select("ia", "ib")
    copies = a.join(b, F.col("a") == F.col("b")).where("ia < ib").select("ia", "ib")
    return linked.unionByName(copies).where("ia <> ib").select(F.least("ia", "ib").alias("id_a"), F.greatest("ia", "ib").alias("id_b")).distinct()


def groups(items: DataFrame, threshold: float, k: int = EVERY) -> DataFrame:
    """``id, group_id, n_links`` of every record with shingles.

    The group is the connected component, named by its least id; ``n_links`` counts the other classes
    that the record's class is linked to. Labels spread over the links of class representatives,
    following each other's label, until none changes.
    """
    members, links = _classes(items, threshold, k)
    links = checkpoint(links)
    both = checkpoint(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = both.groupBy("a").agg(F.least("a", F.min("b")).alias("l"))
    while True:
        spread = both.join(label.withColumnRenamed("a", "b"), "b").groupBy("a").agg(F.min("l").alias("near"))
        jumped = label.join(label.select(F.col("a").alias("l"), F.col("l").alias("far")), "l", "left").select("a", "l", F.coalesce("far", "l").alias("far"))
        new = checkpoint(jumped.join(spread, "a").select("a", F.col("l").alias("old"), F.least("l", "far", "near").alias("l")))
        done = new.where("old <> l").isEmpty()
        label = new.select("a", "l")
        if done:
            break
    degree = both.groupBy("a").agg(F.count(F.lit(1)).alias("d"))
    facts = label.join(degree, "a")
    return members.join(facts, members["rep"] == facts["a"], "left").select("id", F.coalesce("l", "rep").alias("group_id"), F.coalesce("d", F.lit(0)).alias("n_links"))
