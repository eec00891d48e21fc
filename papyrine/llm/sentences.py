"""Problem 10: sentences of documents in many languages and scripts.

A full stop is ambiguous. Each document decides from its own unambiguous places first: a word whose
stop stands before a small-letter word or a comma is an abbreviation there, one whose stop ends a
paragraph may end sentences, and a capitalised word that also occurs in small letters is no proper
name. Where a document is silent, the same places counted over the corpus decide: an ordinary last
word of sentences ends paragraphs in a share of its places, an abbreviation that no sentence ends with
never does. There is no list of abbreviations.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrine.operators.deliveries import once
from papyrine.session import checkpoint, spread

#: German months, fixed values: after a number and a stop they continue a date.
MONTHS = frozenset("januar februar märz april mai juni juli august september oktober november dezember jan feb mär apr jun jul aug sep sept okt nov dez".split())

ENDS_ALONE = "。！？｡"  # need no blank after them
ENDS = ENDS_ALONE + ".!?؟।॥۔"
CLOSERS = ")]}»›”’\"'」』）】〉》"
PAIRS = {"“": "”", "«": "»", "‹": "›", "「": "」", "『": "』", "„": "“”", '"': '"'}

#: Letters, marks and stops of an abbreviation at most.
LONGEST = 12

#: Corpus evidence: the stop of an abbreviation stands before a small-letter word or a comma at least so often, and in this share of its places.
SMALL_PLACES, SMALL_SHARE = 5, 0.25

#: A word is never a sentence's last if so many paragraph ends are expected of an ordinary word at its places, and it has less than this share of them; with the second share of them it may be.
EXPECTED_ENDS, NEVER_SHARE, OFTEN_SHARE = 6.0, 0.1, 0.5

#: A word is a usual beginning if it has this share, and at least so many, of the beginnings of paragraphs and of what follows ! and ?; the share bounds the list.
START_SHARE, START_PLACES = 0.0002, 10

#: Entries of the corpus list up to which every task receives it whole; a longer one is joined to the documents.
MAX_SHARED = 50_000

_BREAK = re.compile(r"\r?\n[^\S\n]*\r?\n\s*")
_EDGE = frozenset("()[]{}\"“”„«»‹›‘「」『』,;:/")
_NEXT = re.compile(r"\s*(\S+)")
_BEGINNING = re.compile(r"\s*(\S{1,64})")  # enough of the next word to tell its first letter and its case
_THAI = re.compile(r"[ก-๛]")
_PLAIN = re.compile(r"[^\W\d_]+")
_CASELESS = re.compile(r"[֐-ࣿऀ-෿฀-໿぀-ヿ㐀-鿿가-힯]")
_CJK = re.compile(r"[぀-ヿ㐀-鿿가-힯]")
_QUOTE = re.compile(f"[{''.join(PAIRS)}]")
_MARKS = re.compile(f"[{ENDS}…]")
_MARKS_OR_BLANKS = re.compile(f"[{ENDS}…]|[^\\S\r\n]")
_PLACES = re.compile(rf"(?<![^\s(\[\"“„«])([^\W\d_](?:[^\W\d_]|[.\-](?=[^\W\d_])){{0,{LONGEST}}})\.(?=([,;])|(\s*\Z|[^\S\n]*\n[^\S\n]*\r?\n)|\s+([^\W\d_]+)(?![\w-]))")


@dataclass(frozen=True)
class Corpus:
    """What all documents tell: abbreviations that never end a sentence, those that may, other ones, and usual beginnings."""

    never: frozenset[str] = field(default_factory=frozenset)
    may: frozenset[str] = field(default_factory=frozenset)
    other: frozenset[str] = field(default_factory=frozenset)
    starts: frozenset[str] = field(default_factory=frozenset)


def _key(word: str) -> str:
    """Case tells single letters apart (M. and m.), not words."""
    return word if len(word) == 1 else word.lower()


def _small(word: str) -> bool:
    """A plain word in small letters; names like h23, pH or β-actin may begin a sentence."""
    m = _PLAIN.match(word.lstrip("(\"'“„«"))
    return bool(m) and m[0].islower() and not "Ͱ" <= m[0][0] <= "Ͽ" and not re.match(r"[\d]", word.lstrip("(\"'“„«")[m.end() :][:1] or " ")


def document_abbreviations(text: str) -> tuple[set[str], set[str]]:
    """(words whose stop the document has before a comma or a small-letter word, words whose stop ends a paragraph of it)."""
    inside: dict[str, int] = {}
    last: dict[str, int] = {}
    for m in _PLACES.finditer(text):
        if m[3] is not None:
            last[_key(m[1])] = last.get(_key(m[1]), 0) + 1
        elif m[2] or m[4].islower() and not "Ͱ" <= m[4][0] <= "Ͽ":
            inside[_key(m[1])] = inside.get(_key(m[1]), 0) + 1
    return {w for w, n in inside.items() if n >= last.get(w, 0)}, set(last)


def _quotations(text: str, lo: int, hi: int) -> dict[int, int]:
    """Opening place -> closing place of the outermost paired quotations of a paragraph."""
    found: dict[int, int] = {}
    ahead: dict[str, int] = {}  # closing mark -> its first place from where it was looked for, hi if there is none

    def closing(mark: str, start: int) -> int:
        at = ahead.get(mark, -1)
        if at < start:
            at = text.find(mark, start, hi)
            ahead[mark] = at = hi if at < 0 else at
        return at

    i = lo
    while m := _QUOTE.search(text, i, hi):
        i, c = m.start(), m[0]
        if (c != '"' or (i == lo or text[i - 1].isspace() or text[i - 1] in "([—–:" or _CASELESS.match(text[i - 1])) and i + 1 < hi and not text[i + 1].isspace()):
            end = min(closing(x, i + 1) for x in PAIRS[c])
            if end < hi:
                found[i] = i = end
        i += 1
    return found


class Splitter:
    """Sentence spans of one document, given what the corpus tells."""

    def __init__(self, text: str, corpus: Corpus = Corpus()) -> None:
        self.text = text
        self.inside, self.last = document_abbreviations(text)
        self.corpus = corpus
        self.thai = bool(_THAI.search(text))
        self.small_words: set[str] | None = None

    def _ordinary(self, word: str) -> bool:
        """The capitalised word is no name: the document has it in small letters, or else it is a usual beginning in the corpus."""
        if self.small_words is None:
            self.small_words = {w for w in _PLAIN.findall(self.text) if w.islower()}
        m = _PLAIN.match(word)
        if not m or not m[0][:1].isupper() or len(m[0]) > 1 and m[0].isupper():
            return False
        return m[0].lower() in self.small_words or m[0] in self.corpus.starts

    def _token(self, lo: int, at: int) -> int:
        """Where the token that ends before ``at`` begins."""
        text, i = self.text, at
        while i > lo and not text[i - 1].isspace() and text[i - 1] not in _EDGE:
            i -= 1
        return i

    def _counted(self, lo: int, at: int) -> bool:
        """A number stands before ``at``."""
        text, i = self.text, at
        while i > lo and text[i - 1].isspace():
            i -= 1
        j = i
        while j > lo and (text[j - 1].isdecimal() or text[j - 1] in ".,"):
            j -= 1
        return j < i and (j == lo or text[j - 1].isspace() or text[j - 1] in "(~±<>=")

    def _initial_before(self, lo: int, at: int) -> bool:
        """A single letter with its stop stands right before ``at``."""
        text, i = self.text, at
        if i > lo and text[i - 1].isspace():
            i -= 1
        return i - 2 >= lo and text[i - 1] == "." and text[i - 2].isalpha() and (i - 2 == lo or text[i - 3].isspace() or text[i - 3] in "(.")

    def _stop_ends(self, lo: int, at: int, after: int) -> bool:
        """Whether the full stop at ``at``, with closers up to ``after``, ends a sentence begun at or after ``lo``."""
        text = self.text
        nxt = _NEXT.match(text, after)
        word = nxt[1] if nxt else ""
        begin = self._token(lo, at)
        token = text[begin:at].strip("'*_.")
        opened = word.lstrip("(\"'“„«¿¡")
        if after > at + 1 and not token:
            return not _small(word)
        if _small(word) and not word.startswith(("(", '"', "“", "«", "„")):
            return False
        if token.isdigit():
            return bool(text[lo:begin].strip()) and opened.rstrip(".,").lower() not in MONTHS
        if not token or not _PLAIN.match(token):
            return True
        key, corpus = _key(token), self.corpus
        # the document's own places first, then those of the corpus, then the shape of the word
        if key in self.inside:
            if key in self.last or key in corpus.may:
                return True
            return key not in corpus.never and self._ordinary(opened)
        if key in self.last:
            return True
        if key in corpus.never:
            return False
        if key in corpus.may:
            return True
        if key in corpus.other:
            return self._ordinary(opened)
        if self._counted(lo, begin):  # a unit of measure
            return True
        initials = len(token) == 1 and (token.isupper() or self._initial_before(lo, begin) or bool(re.match(r"\s?[^\W\d_]\.", text[at + 1 : at + 4])))
        dotted = "." in token and len(token) <= 6 and all(len(p) <= 2 for p in token.split(".")) and not any(c.isdigit() for c in token)
        return self._ordinary(opened) and not (initials and self._initial_before(lo, begin)) if initials or dotted else True

    def _paragraph(self, lo: int, hi: int) -> Iterator[tuple[int, int]]:
        text = self.text
        quotes = _quotations(text, lo, hi)
        opened = sorted(quotes)
        q = 0  # the next quotation that was not passed
        events = _MARKS_OR_BLANKS if self.thai else _MARKS
        thai = -1  # the first Thai letter from the sentence's start
        start = i = lo
        while i < hi:
            event = events.search(text, i, hi)
            at = event.start() if event else hi
            while q < len(opened) and opened[q] < i:
                q += 1
            if q < len(opened) and opened[q] < at:
                opening = opened[q]
                close = quotes[opening]
                opens_sentence = not text[start:opening].strip() if opening - start < 64 else False
                i = after = close + 1
                k = close
                while k > opening + 1 and text[k - 1].isspace():
                    k -= 1
                if k > opening + 1 and text[k - 1] in ENDS:
                    nxt = _BEGINNING.match(text, after, hi)
                    word = nxt[1] if nxt else ""
                    goes_on = not word or _small(word) and word[0] != "(" or word[0] in ",;:—–-)…，、；：" or opens_sentence and _CASELESS.match(word)
                    if word and not goes_on:
                        yield start, after
                        start = after
                continue
            if not event:
                break
            i = at
            if text[i].isspace():
                if thai < start:
                    found = _THAI.search(text, start, hi)
                    thai = found.start() if found else hi
                if thai < i:
                    yield start, i
                    start = i
                i += 1
                continue
            end = i + 1
            while end < hi and (text[end] in ENDS or text[end] == "…"):
                end += 1
            marks = text[i:end]
            after = end
            while after < hi and text[after] in CLOSERS and after not in quotes:
                after += 1
            blank = after >= hi or text[after].isspace()
            nxt = _BEGINNING.match(text, after, hi)
            word = nxt[1] if nxt else ""
            if "…" in marks or "..." in marks:
                ends = blank and not _CJK.match(word) and bool(word) and not _small(word) and word[0] not in ",;:"
            elif any(m in ENDS_ALONE for m in marks):
                ends = True
            elif marks == ".":
                ends = (blank and self._stop_ends(start, i, after)) or (not blank and bool(_CJK.match(text[after])) and bool(_CJK.match(text[i - 1 : i])))
            elif any(m in "।॥۔؟" for m in marks):
                ends = True
            else:
                ends = (blank or bool(_CASELESS.match(text[after]))) and (word.startswith("(") or not _small(word))
            if ends:
                yield start, after
                start = after
            i = after
        yield start, hi

    def spans(self) -> list[tuple[int, int]]:
        text, found, lo = self.text, [], 0
        for m in [*_BREAK.finditer(text), None]:
            hi = m.start() if m else len(text)
            for a, b in self._paragraph(lo, hi):
                while a < b and text[a].isspace():
                    a += 1
                while b > a and text[b - 1].isspace():
                    b -= 1
                if a < b:
                    found.append((a, b))
            lo = m.end() if m else hi
        return found


def corpus_abbreviations(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word, kind``: words of at most ``LONGEST`` letters that the whole corpus shows to be abbreviations.

    The kind is ``never`` or ``may`` where paragraph ends tell whether a sentence ends with it, ``other``
    where they do not. Each document's places are reduced to counts before the shuffle, so frequent words
    travel as a few rows.
    """
    # what follows a stop is told by what the piece ends with: a comma, the blanks before a small-letter word, a blank line, or the stop itself
    stop = r"\.(?:[,;]|[^\S\n]*\n[^\S\n]*\r?\n|\s+(?=[\p{Ll}&&[^\u0370-\u03FF]]\p{Ll}*+(?![\w-]))|(?=\s))"
    piece = rf"(?<![^\s(\[\"“„«])\p{{L}}(?:[\p{{L}}\p{{M}}]|[.\-](?=\p{{L}})){{0,{LONGEST}}}+{stop}"
    seen = docs.select(F.explode(F.regexp_extract_all(F.concat(F.col(text), F.lit("\n\n")), F.lit(piece), 0)).alias("_p"))
    kind = F.when(F.col("_p").rlike(r"\n[^\S\n]*\r?\n\z"), 1).when(F.col("_p").rlike(r"[,;\s]\z"), 0).otherwise(2)
    own = F.regexp_replace("_p", r"\.[\s,;]*\z", "")
    word = F.when(F.length(own) == 1, own).otherwise(F.lower(own))
    counts = seen.select(word.alias("word"), kind.alias("_kind"))
    counts = checkpoint(counts.groupBy("word").agg(*[F.count_if(F.col("_kind") == k).alias(n) for k, n in enumerate(("_small", "_end", "_open"))]))
    # how often an ordinary last word stands at the end of a paragraph: one number of all words that ever do
    usual = counts.where("_end > 0").agg(F.sum("_end") / F.sum(F.col("_end") + F.col("_open"))).first()[0] or 0.0
    expected = usual * (F.col("_end") + F.col("_open"))
    small = (F.col("_small") >= SMALL_PLACES) & (F.col("_small") >= SMALL_SHARE * (F.col("_small") + F.col("_end") + F.col("_open")))
    told = F.when((expected >= EXPECTED_ENDS) & (F.col("_end") < NEVER_SHARE * expected), "never").when(small & (F.col("_end") > 0) & (F.col("_end") >= OFTEN_SHARE * expected), "may").when(small, "other")
    return counts.select("word", told.alias("kind")).where("kind is not null")


def usual_starts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word``: capitalised words that often begin a paragraph, or follow an exclamation or question mark."""
    begins = F.regexp_extract_all(F.col(text), F.lit(r"(?:\A|\n[^\S\n]*\r?\n\s*|[!?]\s+)(\p{Lu}\p{Ll}*)(?![\p{L}\p{N}.\-])"), 1)
    counts = checkpoint(docs.select(F.explode(begins).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("_n")))
    least = max(START_PLACES, START_SHARE * (counts.agg(F.sum("_n")).first()[0] or 0))
    return counts.where(F.col("_n") >= least).select("word")


def sentences(docs: DataFrame, doc: str = "doc_id", text: str = "text", with_text: bool = True) -> DataFrame:
    """``doc, start_pos, end_pos, sentence`` of every document once; null, empty and blank texts have none.

    Positions count code points from 0, the end is exclusive; without ``with_text`` there are only these.
    Documents are split where they lie.
    """
    names = ["_doc", "start_pos", "end_pos", "sentence"][: 4 if with_text else 3]
    src = once(docs, doc, text).where(F.col(text).isNotNull()).select(F.col(doc).cast("bigint").alias("_doc"), F.col(text).alias("_text"))
    starts = frozenset(r["word"] for r in usual_starts(docs, text).collect())  # at most one over START_SHARE
    listed = corpus_abbreviations(docs, text).limit(MAX_SHARED + 1).collect()
    if len(listed) <= MAX_SHARED:
        src = spread(src, "_doc").withColumn("_abbr", F.lit(None).cast("array<struct<word:string,kind:string>>"))
    else:
        words = F.array_distinct(F.regexp_extract_all("_text", F.lit(rf"(\p{{L}}[\p{{L}}\p{{M}}.\-]{{0,{LONGEST}}})\."), 1))
        own = src.select("_doc", F.explode(words).alias("word")).select("_doc", F.when(F.length("word") == 1, F.col("word")).otherwise(F.lower("word")).alias("word")).distinct()
        own = own.join(corpus_abbreviations(docs, text), "word").groupBy("_doc").agg(F.collect_list(F.struct("word", "kind")).alias("_abbr"))
        src, listed = src.join(own, "_doc", "left").withColumn("_abbr", F.coalesce("_abbr", F.array().cast("array<struct<word:string,kind:string>>"))), []
    whole = _corpus([(r["word"], r["kind"]) for r in listed], starts)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for d, t, abbr in zip(batch["_doc"], batch["_text"], batch["_abbr"]):
                corpus = whole if abbr is None else _corpus([(x["word"], x["kind"]) for x in abbr], starts)
                spans = Splitter(t, corpus).spans()
                rows.extend([(d, a, b, t[a:b]) for a, b in spans] if with_text else [(d, a, b) for a, b in spans])
            yield pd.DataFrame(rows, columns=names)

    schema = "_doc bigint, start_pos bigint, end_pos bigint" + ", sentence string" * with_text
    return src.mapInPandas(run, schema).withColumnRenamed("_doc", doc)


def _corpus(listed: list[tuple[str, str]], starts: frozenset[str]) -> Corpus:
    return Corpus(*[frozenset(w for w, k in listed if k == kind) for kind in ("never", "may", "other")], starts)
