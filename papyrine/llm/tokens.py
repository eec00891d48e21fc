"""Problem 8: ids of whole texts under a public byte-level BPE vocabulary.

DuckDB contracts the words inside each partition: rows of (word, position, token) meet the merge
table, each word's pair of least rank is contracted, leftmost first, and the recursion ends when no
pair of any word is in the table. Rows stay in the order of the text, so that neighbours are found by
streaming windows, without a sort. Spark distributes the texts; a partition encodes each distinct word
of a batch once.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrine.operators.deliveries import once
from papyrine.session import spread

TOKENIZERS = "/opt/tokenizers"

#: The vocabulary's splitting pattern, a fixed value of its format.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Bytes of distinct words that one recursion takes at a time, which bounds its memory; a longer word runs alone.
BYTES_AT_ONCE = 120_000

#: Rows kept of words already encoded, over the batches of a partition.
CACHE_WORDS = 500_000

CONTRACT = """
with recursive state as (
  select w, tok, false as done from word_tokens
  union all
  (
    with met as materialized (
      select s.w, s.tok, s.i, m.rank, m.id as new_id
      from (
        select w, tok, row_number() over () as i, case when lead(w) over () = w then tok::bigint * 65536 + lead(tok) over () end as pair
        from state where not done
      ) s left join merges m on m.pair = s.pair
    ),
    least as materialized (select w, min(rank) as best from met group by w)
    select w, case when hit then new_id else tok end, best is null
    from (
      select *, lag(hit, 1, false) over () as after_hit
      from (
        -- in a run of overlapping pairs, as in "aaaa", every second one is contracted, from the left
        select *, coalesce(rank = best and (i - max(case when rank = best then 0 else i end) over (rows between unbounded preceding and current row)) % 2 = 1, false) as hit
        from (select met.*, best from met left join least on met.w = least.w)
      )
    )
    where not after_hit
  )
)
select w, tok from state where done
"""


def _byte_alphabet() -> list[str]:
    """The printable stand-in of each byte: bytes that print stand for themselves, the rest follow from 256."""
    shown = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def read_merges(path: str) -> tuple[list[int], pd.DataFrame]:
    """(id of each byte, merge table with columns a, b, rank, id) of a tokenizer file."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab = model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    rows = [(vocab[a], vocab[b], rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)]
    return [vocab[c] for c in _byte_alphabet()], pd.DataFrame(rows, columns=["a", "b", "rank", "id"])


class PartitionEncoder:
    """Encodes texts inside one partition."""

    def __init__(self, byte_ids: list[int], merges: pd.DataFrame) -> None:
        import duckdb
        import regex

        self.split = regex.compile(PATTERN)
        self.byte_ids = np.array(byte_ids, np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        # one thread, and joins that keep their sides, leave the rows of the state in order
        self.db.execute("set disabled_optimizers='join_order,build_side_probe_side'")
        self.db.execute("create table merges as select a::bigint * 65536 + b as pair, rank::int as rank, id::int as id from merges")
        self.known: dict[str, list[int]] = {}

    def _contract(self, part: list[bytes]) -> Iterator[tuple[int, list[int]]]:
        """(number of the word, its ids) of each word."""
        sizes = np.fromiter(map(len, part), np.int64, len(part))
        word_tokens = pd.DataFrame({"w": np.repeat(np.arange(len(part), dtype=np.int32), sizes), "tok": self.byte_ids[np.frombuffer(b"".join(part), np.uint8)]})  # noqa: F841, read by the SQL
        found = self.db.execute(CONTRACT).fetchnumpy()
        order = np.argsort(found["w"], kind="stable")
        w, tok = found["w"][order], found["tok"][order]
        starts = np.flatnonzero(np.diff(w, prepend=-1))
        for i, ids in zip(w[starts], np.split(tok, starts[1:])):
            yield int(i), ids.tolist()

    def _learn(self, new: list[str]) -> None:
        part: list[str] = []
        coded: list[bytes] = []
        held = 0
        for word in [*new, None]:
            own = word.encode("utf-8") if word is not None else b""
            if part and (word is None or held + len(own) > BYTES_AT_ONCE):
                self.known.update((part[i], ids) for i, ids in self._contract(coded))
                part, coded, held = [], [], 0
            if word is not None:
                part.append(word)
                coded.append(own)
                held += len(own)

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        split = [self.split.findall(t) if t else [] for t in texts]
        self._learn(list(dict.fromkeys(w for ws in split for w in ws if w not in self.known)))
        return [[i for w in ws for i in self.known[w]] for ws in split]


def encode(docs: DataFrame, doc: str = "doc_id", text: str = "text", tokenizers: str = TOKENIZERS, name: str = "byte_bpe_50k") -> DataFrame:
    """``doc, ids`` of each document once; empty and null texts give an empty list.

    Special tokens do not exist here: their strings are ordinary text. The merge table is read once by
    the driver from ``tokenizers`` and travels with the tasks; its size is that of the vocabulary.
    """
    byte_ids, merges = read_merges(f"{tokenizers}/{name}.json")
    shared = docs.sparkSession.sparkContext.broadcast((byte_ids, merges))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = None
        for batch in batches:
            encoder = encoder or PartitionEncoder(*shared.value)
            yield pd.DataFrame({"_doc": batch["_doc"], "ids": encoder.encode(list(batch["_text"]))})

    src = once(docs, doc, text).select(F.col(doc).cast("bigint").alias("_doc"), F.col(text).alias("_text"))
    return spread(src, "_doc").mapInPandas(run, "_doc bigint, ids array<int>").withColumnRenamed("_doc", doc)


def decode(ids: DataFrame, doc: str = "doc_id", tokenizers: str = TOKENIZERS, name: str = "byte_bpe_50k") -> DataFrame:
    """``doc, text`` from ids, by an ordered aggregation of the tokens' bytes; an empty list gives the empty text."""
    with open(f"{tokenizers}/{name}.json", encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    back = {c: f"{b:02X}" for b, c in enumerate(_byte_alphabet())}
    rows = [(i, "".join(back.get(c, "") for c in token)) for token, i in vocab.items()]
    bytes_of = F.broadcast(ids.sparkSession.createDataFrame(rows, "_id int, _hex string"))  # as many rows as the vocabulary has
    tokens = ids.select(F.col(doc).alias("_doc"), F.posexplode_outer("ids").alias("_pos", "_id")).join(bytes_of, "_id", "left")
    joined = tokens.groupBy("_doc").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_pos", "_hex"))), lambda x: x["_hex"]), "").alias("_hex"))
    return joined.select(F.col("_doc").alias(doc), F.decode(F.unhex("_hex"), "UTF-8").alias("text"))
