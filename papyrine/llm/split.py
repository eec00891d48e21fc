"""Problem 5: pieces of oversized items, cut at the deepest valleys of lexical cohesion."""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrine.operators.deliveries import once

TEXT_LIMIT, TEXT_OVERLAP = 4000, 200
HEADINGS_LIMIT, HEADINGS_OVERLAP = 1000, 100

#: Words on either side of a gap whose vocabularies are compared.
BLOCK = 60

#: A cut lies beyond this part of the window, so that pieces are no slivers.
LEAST_FILL = 0.25

#: Where a text pauses, and by how much such a pause is favoured over one of the last kind; a match ends where the next piece may begin.
PAUSES = [(re.compile(r"\n[^\S\n]*\n\s*"), 0.3), (re.compile(r"\n"), 0.15), (re.compile(r"[.!?][\"'”’»)\]]*\s+|[。！？][”」』）]*|[।؟]\s*"), 0.0)]
_BLANK = re.compile(r"\s+")

_WORD = re.compile(r"[^\W_]+")


def _similarity(left: list[str], right: list[str]) -> float:
    a, b = Counter(left), Counter(right)
    norm = math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))
    return sum(v * b[k] for k, v in a.items()) / norm if norm else 0.0


def depths(cohesion: list[float]) -> list[float]:
    """How far each value lies below the nearest peaks on its two sides."""
    n = len(cohesion)
    left, right = list(cohesion), list(cohesion)
    for i in range(1, n):  # the peak is where the climb from i ends
        left[i] = left[i - 1] if cohesion[i - 1] >= cohesion[i] else cohesion[i]
        j = n - 1 - i
        right[j] = right[j + 1] if cohesion[j + 1] >= cohesion[j] else cohesion[j]
    return [left[i] + right[i] - 2 * cohesion[i] for i in range(n)]


def _ends(kind: re.Pattern[str], text: str, lo: int, hi: int) -> list[int]:
    return [m.end() for m in kind.finditer(text, max(lo - 2, 0), min(hi + 64, len(text))) if lo < m.end() <= hi]


def _gaps(text: str, lo: int, hi: int) -> dict[int, float]:
    """Pauses with a place in ``lo < p <= hi`` and how much each is favoured; blanks where there is no other."""
    found: dict[int, float] = {}
    for kind, favour in reversed(PAUSES):
        found.update(dict.fromkeys(_ends(kind, text, lo, hi), favour))
    return dict(sorted(found.items())) or dict.fromkeys(_ends(_BLANK, text, lo, hi), 0.0)


def _deepest(text: str, gaps: dict[int, float]) -> int:
    """The gap at the bottom of the deepest valley of cohesion, pauses of stronger kinds being favoured."""
    places = list(gaps)
    if len(places) == 1:
        return places[0]
    base = max(0, places[0] - BLOCK * 12)
    found = [(m.start() + base, m[0]) for m in _WORD.finditer(text[base : places[-1] + BLOCK * 12].lower())]
    starts, words = [a for a, _ in found], [w for _, w in found]
    at = [bisect_left(starts, g) for g in places]
    cohesion = [_similarity(words[max(0, k - BLOCK) : k], words[k : k + BLOCK]) for k in at]
    deep = depths(cohesion)
    return places[max(range(len(places)), key=lambda i: (deep[i] + gaps[places[i]], -cohesion[i], places[i]))]


def split_text(text: str, limit: int = TEXT_LIMIT, overlap: int = TEXT_OVERLAP) -> list[tuple[int, int]]:
    """Spans of at most ``limit`` characters that cover ``text`` in order.

    The cut is the deepest valley of cohesion among the pauses of the window; without any pause it falls
    at the limit. The next span begins up to ``overlap`` characters earlier, at the strongest pause there.
    A text within the limit is one span, an empty one none.
    """
    spans, start, cut = [], 0, 0
    while len(text) - start > limit:
        hi = start + limit
        gaps = _gaps(text, max(cut, start + int(limit * LEAST_FILL)), hi)
        cut = _deepest(text, gaps) if gaps else hi
        spans.append((start, cut))
        back = _gaps(text, cut - overlap - 1, cut - 1)
        start = min(back, key=lambda g: (-back[g], g)) if back else cut - overlap
    return [*spans, (start, len(text))] if text else []


def split_headings(items: list[str], limit: int = HEADINGS_LIMIT, overlap: int = HEADINGS_OVERLAP) -> list[tuple[int, int, list[str]]]:
    """(first, last, texts) of pieces of a heading list whose texts have at most ``limit`` characters together.

    Consecutive pieces share one heading where it fits, otherwise up to ``overlap`` characters of it. A
    heading beyond the limit is cut like a text.
    """
    units: list[tuple[int, str]] = []
    for k, item in enumerate(items):
        units.extend((k, item[a:b]) for a, b in (split_text(item, limit, overlap) or [(0, 0)]))
    pieces, at = [], 0
    carried: tuple[int, str] | None = None
    while at < len(units):
        part = [carried] if carried else []
        size = sum(len(t) for _, t in part)
        end = at
        while end < len(units) and (size + len(units[end][1]) <= limit or end == at):
            size += len(units[end][1])
            end += 1
        if end < len(units) and end - at > 2:
            lows = list(range(at + int((end - at) * LEAST_FILL) + 1, end + 1))
            cohesion = [_similarity(_WORD.findall(" ".join(t for _, t in units[max(at, c - 6) : c]).lower()), _WORD.findall(" ".join(t for _, t in units[c : c + 6]).lower())) for c in lows]
            deep = depths(cohesion)
            end = lows[max(range(len(lows)), key=lambda i: (deep[i], -cohesion[i], lows[i]))]
        part += units[at:end]
        pieces.append((part[0][0], part[-1][0], [t for _, t in part]))
        carried = None
        if end < len(units):
            k, text = units[end - 1]
            if units[end][0] != k:  # the cut heading's own parts overlap already
                room = limit - len(units[end][1])
                carried = (k, text) if len(text) <= room else (k, text[-min(overlap, room) :]) if room > 0 else None
        at = end
    return pieces


_SCHEMA = "field string, _doc bigint, piece_no int, start_pos bigint, end_pos bigint, texts array<string>"


def pieces(manuscripts: DataFrame, docling: DataFrame, doc: str = "doc_id", text: str = "marker_md", headings: str = "headings") -> DataFrame:
    """``field, doc, piece_no, start_pos, end_pos, texts`` of every item above its limit.

    For ``marker_md`` positions are characters, end exclusive, and ``texts`` holds the one piece; for
    ``headings`` they are the first and the last index in the list. Null items are within the limit,
    null heading texts are empty; repeated rows count once. The filter runs before any shuffle, so only
    oversized items travel; each is cut on its own, whatever its length.
    """

    def cut_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [("marker_md", d, n, a, b, [t[a:b]]) for d, t in zip(batch["_doc"], batch["_text"]) for n, (a, b) in enumerate(split_text(t), 1)]
            yield pd.DataFrame(rows, columns=["field", "_doc", "piece_no", "start_pos", "end_pos", "texts"])

    def cut_headings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [("headings", d, n, a, b, t) for d, own in zip(batch["_doc"], batch["_texts"]) for n, (a, b, t) in enumerate(split_headings([x or "" for x in own]), 1)]
            yield pd.DataFrame(rows, columns=["field", "_doc", "piece_no", "start_pos", "end_pos", "texts"])

    long_texts = once(manuscripts.where(F.length(F.col(text)) > TEXT_LIMIT), doc, text)
    long_texts = long_texts.select(F.col(doc).cast("bigint").alias("_doc"), F.col(text).alias("_text"))
    texts = F.transform(F.col(headings), lambda h: F.coalesce(h["text"], F.lit("")))
    sized = docling.select(F.col(doc).cast("bigint").alias("_doc"), texts.alias("_texts"))
    sized = sized.where(F.aggregate("_texts", F.lit(0), lambda n, t: n + F.length(t)) > HEADINGS_LIMIT)
    both = long_texts.mapInPandas(cut_texts, _SCHEMA).unionByName(once(sized, "_doc", "_texts").mapInPandas(cut_headings, _SCHEMA))
    return both.withColumnRenamed("_doc", doc)
