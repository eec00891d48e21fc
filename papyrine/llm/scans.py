"""Problem 6: readable paragraphs from the text of scanned pages.

An averaged perceptron edits: it scores keeping a word, replacing a letter or pair of it, deleting or
inserting a letter, and joining a line with the next. An edit must give a common word, but which edits
are misreadings it learns: from common words of the corpus that are misread on purpose, by what letters
look like and by the edits that the scanned papers turn out to need, and from words and compounds of
papers that are not scanned, which are right as they stand. A second one of its kind takes page numbers
and running headers by their form and by where on the page they stand; it learns from the lines that
count on from page to page. Both learn from all papers.
"""

from __future__ import annotations

import random
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Iterator
from difflib import SequenceMatcher
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyrine.operators.deliveries import once
from papyrine.session import checkpoint, spread

#: What recognition makes of letters, fixed values of their shapes: read -> written. Words are misread on purpose by them.
CONFUSIONS = {
    "0": "o", "1": "l", "5": "s", "6": "b", "9": "g", "@": "a", "!": "i", "c": "e", "f": "t",
    "rn": "m", "ri": "n", "li": "h", "ii": "u", "cl": "d", "vv": "w", "F": "E",
}

#: Signs at a line's end that may cut a word.
HYPHENS = "-¬‐\xad"

#: A word is common if this share of the documents has it, and at least so many. The share bounds the list: it cannot exceed the mean number of words of a document divided by it.
COMMON_SHARE, COMMON_DOCS = 0.002, 5

#: Words misread on purpose in a training at least, passes over what it is trained on, and words and joins of the papers that one training takes; more are shared among several, whose weights are averaged.
MISREADINGS, EPOCHS, SHARD = 6000, 3, 20_000

#: Common words that are left out before words are counted, at most; the others are left out after.
PASSED = 5000

#: Words of the scanned papers that an edit has to mend before it counts as a misreading that happens, and its share of all such words.
SEEN_EDITS, EDIT_SHARE = 3, 0.01

#: A page number may follow another by so much, the pages between being unnumbered or misread.
GAP = 4

_NUMBER = r"(?:\d{1,5}|[ivxlc]{1,8})"
_OPENING, _CLOSING, _BETWEEN = r"[\[(—–\-·•|~*=<]", r"[\])—–\-·•|~*=>]", r"(?:\s{2,}|\s*\|\s*|\t)"
_PAGE_FORM = rf"(?:{_OPENING}\s*)*(?:(?:page|pg\.?|p\.|seite|s\.)\s*)?({_NUMBER})(?:\s*(?:/|of|von)\s*\d{{1,5}})?(?:\s*{_CLOSING})*"
_PAGE = re.compile(_PAGE_FORM, re.IGNORECASE)
_HEAD = re.compile(rf"({_NUMBER}){_BETWEEN}(?=\S)")
_LAST = re.compile(_NUMBER)

#: Lines that _scanned() asks for, as the JVM finds them: cut words, page numbers, and texts before and after a number. The first pattern of a line
#: begins with what is rare, is found wherever the others are, and spares most texts their search.
_SUSPECT = [
    [r"[-¬‐\x{AD}](?:(?<=[\p{L}\p{Cs}][-¬‐\x{AD}])[ \t]*\n|\n\p{IsLowercase})", r"\p{L}[-¬‐\x{AD}][ \t]*\n|[-¬‐\x{AD}]\n\p{IsLowercase}"],
    [rf"(?dmiuU)^[^\S\n]*{_PAGE_FORM}[^\S\n]*$".replace(r"\s", r"[^\S\n]")],
    [rf"(?dmU)^[^\S\n]*{_NUMBER}{_BETWEEN}\S".replace(r"\s", r"[^\S\n]")],
    [rf"(?dmU)[^!-{{}}~\n]{_NUMBER}[^\S\n]*$", rf"(?dmU)\S{_BETWEEN}{_NUMBER}[^\S\n]*$".replace(r"\s", r"[^\S\n]")],
]
#: Page numbers that are told by what stands around them.
_DRESSED = re.compile(r"page|pg|p\.|s\.|seite|[—\[/]|\d\s*(?:of|von)\s*\d|^[-–•·|~*=<].*[-–•·|~*=>]$", re.IGNORECASE)
_ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100}
_TOKEN = re.compile(r"[^\s()\[\]{}<>\"“”„«»|/*_`#,;:]+")
_BEFORE, _AFTER = "'‘.~", ".?'’¬‐\xad"

#: The same for the JVM: lines that have no words to mend, parts of tokens between hyphens, and whole words.
_NO_TEXT = [r"(?dms)^```.*?(?:\n```|\z)", r"(?dm)^(?:\||\{\p{Nd}+\}-{8,})[^\n]*"]
_PART = r"[^\s\x{1C}-\x{1F}\x{85}\p{Z}()\[\]{}<>\"“”„«»|/*_`#,;:\-]+"
_WORD = r"(?<![\p{L}\p{N}_\-])[\p{L}\p{N}]+(?:-[\p{L}\p{N}]+)*+(?![\p{L}\p{N}_\-])"


def page_value(digits: str) -> int | None:
    """The number that digits or Roman numerals stand for."""
    if digits.isdigit():
        return int(digits)
    values = [_ROMAN[c] for c in digits.lower()]
    total = sum(-v if v < max(values[i:], default=0) else v for i, v in enumerate(values))
    return total if 0 < total < 400 else None


def runs(found: list[tuple[int, int]], apart: Callable[[int, int], bool] = lambda a, b: True) -> list[list[int]]:
    """Places of all runs of two or more numbers that go up, the longest first, of (place, number) in order.

    A number goes on by one, or by up to ``GAP`` where ``apart`` holds of both places: pages may be unnumbered or misread.
    """
    out: list[list[int]] = []
    left = found
    while len(left) > 1:
        length, back = [1] * len(left), [-1] * len(left)
        last: dict[int, int] = {}  # number -> the entry that ends the longest run with it
        for k, (place, number) in enumerate(left):
            for step in range(1, GAP + 1):
                j = last.get(number - step, -1)
                if j >= 0 and length[j] >= length[k] and (step == 1 or apart(left[j][0], place)):
                    length[k], back[k] = length[j] + 1, j
            if length[k] >= length[last.get(number, k)]:
                last[number] = k
        k = length.index(max(length))
        if length[k] < 2:
            break
        run: list[int] = []
        while k >= 0:
            run.append(k)
            k = back[k]
        out.append([left[k][0] for k in reversed(run)])
        taken = set(run)
        left = [x for k, x in enumerate(left) if k not in taken]
    return out


def _off_by_a_sign(number: int, meant: int) -> bool:
    a, b = str(number), str(meant)
    return len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1


def page_places(lines: list[str], alone: list[tuple[int, int]], beside: list[tuple[int, int]]) -> set[int]:
    """Places of the page numbers among numbers that stand alone; those ``beside`` a running header count on with them.

    These are all runs, dressed numbers, and single ones that a run explains: numbering begins anew at one,
    or a sign of a number is misread where the run leaves one out.
    """
    value = dict(sorted(alone + beside))
    at = sorted(value)
    numbers = set(at)

    def apart(a: int, b: int) -> bool:
        return any(lines[i].strip() and i not in numbers for i in range(a + 1, b))

    chained = runs([(i, value[i]) for i in at], apart)
    pages = {i for run in chained for i in run} | {i for i, _ in alone if _DRESSED.search(lines[i].strip())}
    begins, ends = {run[0] for run in chained}, {run[-1] for run in chained}
    for k, i in enumerate(at):
        if i in pages:
            continue
        before, after = (at[k - 1] if k else -1), (at[k + 1] if k + 1 < len(at) else -1)
        anew = value[i] == 1 and before in ends
        fore = after in begins and value[after] == 1 and not lines[i].strip().isdigit()
        if anew or fore:
            pages.add(i)
    for run in chained:
        for a, b in zip(run, run[1:]):
            for i in at[bisect_right(at, a) : bisect_left(at, b)]:
                if any(_off_by_a_sign(value[i], meant) for meant in range(value[a] + 1, value[b])):
                    pages.add(i)
    return pages & {i for i, _ in alone}


def _alike(a: str, b: str) -> bool:
    return abs(len(a) - len(b)) <= 2 + 0.15 * max(len(a), len(b)) and SequenceMatcher(None, a, b, autojunk=False).ratio() >= 0.85


def _header_shape(text: str, title: str) -> bool:
    """A running title in capitals, or the first author, with or without the journal."""
    core = text.split(" | ")[0].strip()
    if re.search(r"\bet\s+al\.?$", core[-24:]):
        return len(core.split(None, 5)) <= 5
    if not title or len(core) > 2 * len(title) + 8:  # a header is no longer than what it runs
        return False
    letters = [c for c in core if c.isalpha()]
    if len(letters) >= 8 and sum(c.isupper() for c in letters) >= 0.85 * len(letters):
        return SequenceMatcher(None, core.upper(), title.upper()[: len(core)], autojunk=False).ratio() >= 0.7
    return False


def _numbered(bare: str) -> tuple[str, str] | None:
    """(number, text) of a line that begins or ends with a number set apart."""
    if m := _HEAD.match(bare):
        return m[1], bare[m.end() :]
    cut = max(bare.rfind("|"), bare.rfind(" "), bare.rfind("\t"), bare.rfind("\xa0"))
    front, last = bare[: cut + 1], bare[cut + 1 :]
    text = front.rstrip()
    if text and _LAST.fullmatch(last) and (text != front[:-1] or front[-1] in "|\t"):
        return (last, text[:-1].rstrip()) if text.endswith("|") else (last, text)
    return None


Fact = tuple[int, str, list[str]]  # line, kind that the rules give it ("" for text), features


def line_facts(lines: list[str]) -> list[Fact]:
    """What is known of every line that may be furniture.

    The rules that give the kinds know numbers that count on, numbers that are dressed as page numbers, and
    headers that stand beside either or come back. The features say the same one by one, and where on the
    page the line stands: its distance from the numbers before and after, in pages.
    """
    title = next((x.lstrip("# ").strip() for x in lines if x.startswith("# ")), "")
    alone: list[tuple[int, int]] = []
    beside: list[tuple[int, int]] = []
    shaped: dict[int, bool] = {}
    for i, line in enumerate(lines):
        bare = line.strip()
        if not bare:
            continue
        if (m := _PAGE.fullmatch(bare)) and (v := page_value(m[1])) is not None and not (bare[-1] == "." and not bare[0].isdigit()):
            alone.append((i, v))
        elif (parts := _numbered(bare)) and _header_shape(parts[1], title) and (v := page_value(parts[0])) is not None:
            beside.append((i, v))
        elif not line.startswith("#") and _header_shape(bare, title):
            shaped[i] = True
    pages = page_places(lines, alone, beside)
    headers = {i for i, _ in beside}
    near = {j for i in pages for j in (i + 1, i - 1) if 0 <= j < len(lines) and lines[j].strip() and j not in pages}
    headers |= {j for j in near if shaped.get(j)}
    told = list(dict.fromkeys(lines[i].strip() for i in headers))
    alike: dict[int, bool] = {}
    for i in sorted({*shaped, *near} - headers):
        bare = lines[i].strip()
        if not lines[i].startswith("#"):
            alike[i] = any(_alike(bare, t) for t in told)
    headers |= {i for i, same in alike.items() if same}

    marks = sorted(pages | {i for i, _ in beside})
    gaps = sorted(b - a for a, b in zip(marks, marks[1:]))
    page = gaps[len(gaps) // 2] if gaps else 0

    def place(i: int) -> list[str]:
        k = bisect_left(marks, i)
        before = i - marks[k - 1] if k else None
        after = next((m - i for m in marks[k : k + 2] if m > i), None)
        far = lambda d: "none" if d is None or not page else "next" if d <= 2 else str(min(3, round(2 * d / page)))
        blank = lambda j: not (0 <= j < len(lines)) or not lines[j].strip()
        return [f"before={far(before)}", f"after={far(after)}", f"pages={far(before)},{far(after)}", f"blank={blank(i - 1)}{blank(i + 1)}"]

    facts: list[Fact] = []
    values = dict(alone)
    for i in values:
        bare = lines[i].strip()
        own = [f"chained={i in pages}", f"dressed={bool(_DRESSED.search(bare))}", f"digits={bare.isdigit()}", f"many={min(len(values), 4)}"]
        facts.append((i, "page" if i in pages else "", ["number", *own, *place(i)]))
    numbered = {i for i, _ in beside}
    for i in sorted({*numbered, *shaped, *alike} - values.keys()):
        own = [f"numbered={i in numbered}", f"shape={bool(shaped.get(i))}", f"near={i in near}", f"alike={alike.get(i, i in headers)}"]
        facts.append((i, "header" if i in headers else "", ["text", *own, f"{own[1]}&{own[2]}&{own[3]}", *place(i)]))
    return facts


def furniture(lines: list[str], taker: Perceptron | None = None) -> tuple[set[int], set[int]]:
    """(places of page numbers, places of running headers), by the rules alone or as the trained taker decides."""
    found: dict[str, set[int]] = {"page": set(), "header": set()}
    for i, kind, features in line_facts(lines):
        if taker:
            own = "page" if features[0] == "number" else "header"
            kind = own if taker.score([f"{own}:{f}" for f in features]) > 0 else ""
        if kind:
            found[kind].add(i)
    return found["page"], found["header"]


class Perceptron:
    """Averaged perceptron that ranks alternatives by their features."""

    def __init__(self) -> None:
        self.weights: dict[str, float] = {}

    def score(self, features: list[str]) -> float:
        w = self.weights
        return sum([w[f] for f in features if f in w])

    def train(self, samples: list[list[tuple[list[str], bool]]]) -> Perceptron:
        """Each sample lists alternatives as (features, right one), of both kinds; weights are averaged over all steps."""
        total: dict[str, float] = {}
        step = 1
        for epoch in range(EPOCHS):
            random.Random(epoch).shuffle(samples)
            for alternatives in samples:
                (least, right), (most, wrong) = (max(((self.score(f), f) for f, is_ok in alternatives if is_ok is ok), key=lambda x: x[0]) for ok in (True, False))
                if least <= most:
                    for f, d in [*((f, 1.0) for f in right), *((f, -1.0) for f in wrong)]:
                        self.weights[f] = self.weights.get(f, 0.0) + d
                        total[f] = total.get(f, 0.0) + d * step
                step += 1
        self.weights = {f: w - total[f] / step for f, w in self.weights.items()}
        return self


Edit = tuple[int, str, str]  # place, read, written; all empty for keeping


class Lexicon:
    """Common words and what is one edit away from them."""

    def __init__(self, common: Iterable[str], attested: Iterable[str] = ()) -> None:
        common = set(common)
        self.common, self.attested = frozenset(common.union(*(w.split("-") for w in common if "-" in w))), frozenset(attested)
        self.begins = {w[:i] for w in self.common for i in range(len(w) + 1)}
        self.ends = {w[i:] for w in self.common for i in range(len(w) + 1)}
        self.gaps: dict[str, list[str]] = {}  # a common word with a gap -> the letter or pair that belongs there
        for word in sorted(self.common):
            for i in range(len(word)):
                self.gaps.setdefault(f"{word[:i]}\0{word[i + 1 :]}", []).append(word[i])
                if i + 2 <= len(word):
                    self.gaps.setdefault(f"{word[:i]}\0\0{word[i + 2 :]}", []).append(word[i : i + 2])

    def edits(self, word: str) -> list[Edit]:
        """Every replacement of a letter or pair, deletion and insertion of a letter that gives a common word."""
        low, n = word.lower(), len(word)
        if len(low) != n:
            return []
        found: list[Edit] = []
        first, last = n, 0  # the edit leaves the beginning and the end of a common word
        while first and low[first - 1 :] in self.ends:
            first -= 1
        while last < n and low[: last + 1] in self.begins:
            last += 1
        for at in range(max(0, first - 2), last + 1):
            head = low[:at]
            for size in (1, 2):
                if at + size <= n:
                    tail = low[at + size :]
                    found += [(at, word[at : at + size], c) for c in self.gaps.get(f"{head}\0{tail}", ()) if c != low[at : at + size]]
            if at < n:
                found += [(at, word[at], c) for c in self.gaps.get(f"{head}\0\0{low[at + 1 :]}", ()) if low[at] not in c]
                if head + low[at + 1 :] in self.common and (at == 0 or low[at] != low[at - 1]):
                    found.append((at, word[at], ""))
            if n > 3:
                found += [(at, "", c) for c in self.gaps.get(f"{head}\0{low[at:]}", ()) if at == 0 or c != low[at - 1]]
        cased = [(at, read, c.upper() if read[:1].isupper() and (at > 0 or len(c) == 1) else c.capitalize() if read[:1].isupper() else c) for at, read, c in found]
        fits = lambda x: x[1:].islower() or x.isupper()
        cased = [e for e in cased if e[1] < "ɐ"]  # letters of other scripts are not misread
        return [e for e in dict.fromkeys(cased) if fits(word[: e[0]] + e[2] + word[e[0] + len(e[1]) :])]

    def known(self, word: str) -> str:
        low = word.lower()
        return "common" if low in self.common else "attested" if low in self.attested else "no"

    def alternatives(self, word: str, known: str = "") -> list[tuple[Edit, list[str]]]:
        """Keeping the word, and each single edit that makes a common word of it, with their features."""
        known = known or self.known(word)
        keep = ["keep", f"keep|known={known}", f"keep|n={min(len(word), 8)}", f"keep|letters={word.isalpha()}"]
        out: list[tuple[Edit, list[str]]] = [((0, "", ""), keep)]
        for at, read, written in self.edits(word):
            op = f"{read}>{written}"
            left, right = word[max(0, at - 2) : at] or "^", word[at + len(read) : at + len(read) + 2] or "$"
            kind = "insert" if not read else "delete" if not written else "replace"
            out.append(((at, read, written), [kind, f"{kind}|known={known}", op, f"{op}|{left[-1]}", f"{op}|{right[0]}", f"{op}|{left}|", f"{op}||{right}", f"{op}|known={known}"]))
        return out


def edited(word: str, edit: Edit) -> str:
    at, read, written = edit
    return word[:at] + written + word[at + len(read) :]


def join_facts(left: str, sign: str, right: str, lexicon: Lexicon) -> list[str]:
    """What speaks for and against joining the last word of a line with the first of the next: eight facts on known words and forms, and the letters at the cut."""
    common, own = lexicon.common, left.split("-")[-1]
    facts = [
        f"sign={sign}", f"joined={(own + right).lower() in common}", f"kept={f'{left}-{right}'.lower() in common}", f"left={own.lower() in common}", f"right={right.lower() in common}",
        f"len={min(len(own), 3)}{'G' if own and 'Ͱ' <= own[-1] <= 'Ͽ' else ''}", f"digit={right[:1].isdigit()}", f"case={left[-1:].isupper()}{right[:1].isupper()}",
    ]
    a, b = own.lower(), re.sub(r"\d", "9", right.lower())
    letters = [f"end={a[-2:]}", f"begin={b[:2]}", f"cut={a[-2:]}-{b[:2]}", f"rest={min(len(b), 6)}"]
    return [*facts, *letters]


def join_features(facts: list[str]) -> list[str]:
    """The facts of ``join_facts``, and all pairs of those that are no letters."""
    return [*facts, *(f"{x}&{y}" for i, x in enumerate(facts[:8]) for y in facts[i + 1 : 8])]


class Material:
    """What papers give for training: edits that mend words of scanned papers; of other papers words that an edit could change and yet are right, rare words and compounds, or the facts of their joins; lines that may be furniture."""

    def __init__(
        self, edits: dict[tuple[str, str], int] | None = None, right: Iterable[str] = (), words: Iterable[str] = (), compounds: Iterable[str] = (), lines: Iterable[tuple[str, list[str]]] = (), joins: Iterable[tuple[list[str], bool]] = ()
    ) -> None:
        self.edits, self.right, self.words, self.compounds, self.lines, self.joins = edits or {}, list(right), list(words), list(compounds), list(lines), list(joins)


def train_editor(lexicon: Lexicon, material: Material, seed: int = 7) -> Perceptron:
    """An editor from all common words, misread and cut in random places, and the words and compounds that are right."""
    draw = random.Random(seed)
    words = sorted(w for w in lexicon.common if len(w) >= 4 and w.isascii() and "-" not in w)
    draw.shuffle(words)
    misread: dict[str, list[str]] = {}  # written -> what it is read as, as often as it happens
    least = max(SEEN_EDITS, EDIT_SHARE * sum(material.edits.values()))
    for (read, written), n in [*((e, least) for e in CONFUSIONS.items()), *material.edits.items()]:
        if n >= least:
            misread.setdefault(written.lower(), []).extend([read] * int(min(n, 20)))
    samples: list[list[tuple[list[str], bool]]] = []
    for word in words:
        for _ in range(-(-MISREADINGS // len(words))):  # as many in all, however few words are common
            spots = [(i, size) for i in range(len(word)) for size in (0, 1, 2) if word[i : i + size] in misread and len(word[i : i + size]) == size]
            if spots:
                i, size = draw.choice(spots)
                noisy = word[:i] + draw.choice(misread[word[i : i + size]]) + word[i + size :]
                options = lexicon.alternatives(noisy, "no")
                right = [edited(noisy, e) == word and bool(e[1] or e[2]) for e, _ in options]
                if any(right) and noisy.lower() not in lexicon.common:
                    samples.append([(f, ok) for (_, f), ok in zip(options, right)])
                    samples.append([(f, not (e[1] or e[2])) for e, f in lexicon.alternatives(noisy, "attested")])
        samples.append([(f, not (e[1] or e[2])) for e, f in lexicon.alternatives(word)])
        # what no misreading explains stays as it is
        i, size = draw.randrange(len(word)), draw.choice((0, 1, 1, 2))
        other = word[:i] + draw.choice("abcdefghijklmnopqrstuvwxyz") + word[i + size :]
        if other not in lexicon.common and word[i : i + size] != other[i] and other[i] not in misread.get(word[i : i + size], ()):
            samples.append([(f, not (e[1] or e[2])) for e, f in lexicon.alternatives(other, "no")])
    samples += [[(f, not (e[1] or e[2])) for e, f in lexicon.alternatives(w)] for w in material.right]

    def joining(facts: list[str], joins: bool) -> None:
        features = join_features(facts)
        samples.append([([f"join:{f}" for f in features], joins), ([f"stay:{f}" for f in features], not joins)])

    for word in [*words, *material.words]:
        if len(word) > 4:
            cut = draw.randrange(2, len(word) - 1)
            joining(join_facts(word[:cut], draw.choice(HYPHENS), word[cut:], lexicon), True)
    for compound in [*sorted(w for w in lexicon.common if "-" in w), *material.compounds]:
        left, right = compound.rsplit("-", 1)
        if left and right:
            joining(join_facts(left, "-", right, lexicon), False)
    for facts, joins in material.joins:
        joining(facts, joins)
    return Perceptron().train([s for s in samples if len(s) > 1])


def train_taker(material: Material) -> Perceptron | None:
    """A taker of furniture from the lines; none if no line is furniture."""
    if not any(kind for kind, _ in material.lines):
        return None
    samples = []
    for kind, features in material.lines:
        own = "page" if features[0] == "number" else "header"
        samples.append([([], not kind), ([f"{own}:{f}" for f in features], bool(kind))])
    return Perceptron().train(samples)


class Model:
    """Everything that is learned from the corpus before its papers are mended."""

    def __init__(self, lexicon: Lexicon, editor: Perceptron, taker: Perceptron | None = None) -> None:
        self.lexicon, self.editor, self.taker = lexicon, editor, taker


def _joins(left: str, sign: str, right: str, model: Model) -> bool:
    facts = join_features(join_facts(left, sign, right, model.lexicon))
    return model.editor.score([f"join:{f}" for f in facts]) > model.editor.score([f"stay:{f}" for f in facts])


def _scanned(lines: list[str], pages: set[int], headers: set[int]) -> bool:
    """Hard-wrapped lines that go on in small letters, together with cut words or page furniture."""
    wrapped = cut = 0
    for a, b in zip(lines, lines[1:]):
        if len(a) > 30 and b[:1].islower():
            wrapped += 1
            cut += a[-1] in HYPHENS
    return bool(cut and wrapped >= 2 or (pages or headers) and wrapped >= 2 or len(pages) >= 2 and headers)


class Page:
    """What is wrong with the lines of one paper, and the paper mended."""

    def __init__(self, text: str, model: Model | None = None) -> None:
        self.lines = text.split("\n")
        self.pages, self.headers = furniture(self.lines, model.taker if model else None)
        self.scanned = _scanned(self.lines, self.pages, self.headers)
        self.cut: dict[int, int] = {}  # line -> the line on which its last word goes on
        self.misread: dict[int, list[tuple[int, str, str]]] = {}
        if self.scanned and model:
            self._cuts(model)
            for word, where in self.words():
                self._mend(word, where, model)

    def _texts(self) -> list[int]:
        fenced, out = False, []
        for i, line in enumerate(self.lines):
            if line.startswith("```"):
                fenced = not fenced
            if i not in self.pages and i not in self.headers and line.strip() and not fenced and not line.startswith("|") and not re.match(r"\{\d+\}-{8,}", line):
                out.append(i)
        return out

    def _cuts(self, model: Model) -> None:
        texts = self._texts()
        for i, j in zip(texts, texts[1:]):
            line = self.lines[i].rstrip(" \t")
            if line[-1] not in HYPHENS or self.lines[j].startswith(("#", ">", "- ", "* ", "![")):
                continue
            begin = len(line) - 1
            while begin and not line[begin - 1].isspace() and line[begin - 1] not in "(/,;:":
                begin -= 1
            left, right = re.search(r"[^\W_]", line[begin:-1]), re.match(r"[^\W_]+", self.lines[j].lstrip())
            if left and right and line[-2:-1].isalnum() and _joins(line[begin + left.start() : -1], line[-1], right[0], model):
                self.cut[i] = j

    def words(self) -> Iterator[tuple[str, list[tuple[int, int, int]]]]:
        """Words of the text lines and where they stand, as (line, start, length); a cut word stands on two lines."""
        taken: set[int] = set()  # lines whose first word was read with the line before
        for i in self._texts():
            line = self.lines[i]
            spans = [(m.start(), m.end()) for m in _TOKEN.finditer(line)]
            for k, (a, b) in enumerate(spans):
                if k == 0 and i in taken:
                    continue
                if k == len(spans) - 1 and i in self.cut and line.rstrip(" \t")[-1] in HYPHENS:
                    j = self.cut[i]
                    rest = _TOKEN.search(self.lines[j])
                    head = line[a : len(line.rstrip(" \t")) - 1]
                    taken.add(j)
                    yield from _parts(head + (rest[0] if rest else ""), [(i, a, len(head)), (j, rest.start() if rest else 0, 99)])
                else:
                    yield from _parts(line[a:b], [(i, a, b - a)])

    def _mend(self, word: str, where: list[tuple[int, int, int]], model: Model) -> None:
        for w in dict.fromkeys((word, word.rstrip("!"))):
            if w.lower() in model.lexicon.common:
                return
            if len(w) < 3 or w.isdigit():
                continue
            options = model.lexicon.alternatives(w)
            spot, read, written = max(options, key=lambda x: model.editor.score(x[1]))[0]
            if read or written:
                line, start, size = where[0]
                if spot >= size and len(where) > 1:
                    spot, (line, start, _) = spot - size, where[1]
                self.misread.setdefault(line, []).append((start + spot, read, written))
                return

    def found(self) -> list[tuple[int, str]]:
        """(line from 1, kind) of every line to be mended or removed."""
        if not self.scanned:
            return []
        kinds = [*((i, "page") for i in self.pages), *((i, "header") for i in self.headers), *((i, "hyphen") for i in self.cut), *((i, "misread") for i in self.misread)]
        return sorted((i + 1, kind) for i, kind in kinds)

    def mended(self) -> str:
        """Paragraphs of one line each, without furniture; headings, lists, tables and code keep their lines."""
        if not self.scanned:
            return "\n".join(self.lines)
        lines = list(self.lines)
        for i, changes in self.misread.items():
            for at, read, written in sorted(changes, reverse=True):
                lines[i] = lines[i][:at] + written + lines[i][at + len(read) :]
        out: list[str] = []
        fenced = joined = removed = False
        for i, line in enumerate(lines):
            if i in self.pages or i in self.headers:
                removed = True
                continue
            if line.startswith("```"):
                fenced = not fenced
            prose = bool(line.strip()) and not fenced and not re.match(r"#|\||>|[-*] |\d+\. |!\[|```|\{\d+\}-", line)
            if not line.strip() and removed and (joined or out and out[-1].strip() and out[-1].rstrip()[-1:] not in ".!?:"):
                continue  # the page break, not the paper, left this line blank
            goes_on = prose and bool(out) and out[-1].strip() != "" and not re.match(r"#|\||!\[|```|\{\d+\}-", out[-1])
            if joined:
                out[-1] += line.lstrip()
            elif goes_on:
                out[-1] = out[-1].rstrip() + ("" if out[-1].rstrip().endswith("-") else " ") + line.strip()
            else:
                out.append(line)
            joined = i in self.cut
            if joined:
                out[-1] = out[-1].rstrip()[:-1]
            removed = False
        return "\n".join(out)


def _parts(token: str, where: list[tuple[int, int, int]]) -> Iterator[tuple[str, list[tuple[int, int, int]]]]:
    """The words of a token between hyphens, without the signs around them."""
    offset = 0
    for part in token.split("-"):
        bare = part.rstrip(_AFTER)
        lead = len(bare) - len(bare.lstrip(_BEFORE))
        at = offset + lead
        offset += len(part) + 1
        if bare[lead:]:
            (line, start, size), *more = where
            if at < size:
                yield bare[lead:], [(line, start + at, size - at), *more]
            elif more:
                yield bare[lead:], [(more[0][0], more[0][1] + at - size, more[0][2])]


def lexicon_of(docs: DataFrame, doc: str, text: str, judged: DataFrame | None = None) -> tuple[Lexicon, int]:
    """(common words and attested ones, number of texts), counted over all documents.

    Common are words that a fixed share of the documents has; the share bounds their number. Attested are
    others that are one edit away from a common word and in two different documents that cannot stem
    from scanned pages; the edits bound their number.
    """
    src = _judged(docs, doc, text) if judged is None else judged
    n = src.count()
    found = F.regexp_extract_all(F.col("_text"), F.lit(r"(?<![\p{L}\p{N}\-@!])([a-zß-ÿ]+(?:-[a-zß-ÿ]+)*)(?![\p{L}\p{N}@!])"), 1)
    clean = F.when(~F.col("_suspect"), F.col("_doc")).alias("c")
    seen = src.select(clean, F.array_distinct(found).alias("ws")).select("c", F.explode_outer("ws").alias("w")).where(F.col("w").isNotNull())
    counts = checkpoint(seen.groupBy("w").agg(F.count(F.lit(1)).alias("df"), (F.min("c") < F.max("c")).alias("clean")))
    least = max(COMMON_DOCS, COMMON_SHARE * n)
    common = frozenset(r["w"] for r in counts.where(F.col("df") >= least).select("w").collect())
    lexicon = Lexicon(common)

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[[bool(lexicon.edits(w)) for w in batch["w"]]]

    attested = counts.where((F.col("df") < least) & F.col("clean") & (F.length("w") >= 3)).select("w").mapInPandas(near, "w string") if common else None
    return Lexicon(common, (r["w"] for r in attested.collect()) if attested is not None else ()), n


def clean_material(docs: DataFrame, doc: str, text: str, lexicon: Lexicon, judged: DataFrame | None = None) -> DataFrame:
    """``kind, a, flag`` from all papers that cannot stem from scanned pages, one row for each ``kind, a``.

    ``right``: a word that an edit could change, flagged if two papers have it. ``join``: the facts of a
    rare word cut in a place that its hash gives, or of a compound, flagged if more words than compounds
    have them. Words are found and counted in the JVM; only distinct ones leave it. Common words give neither,
    and most of them are left out before they are counted.
    """
    clean = (_judged(docs, doc, text) if judged is None else judged).where(~F.col("_suspect"))
    prose = reduce(lambda t, pattern: F.regexp_replace(t, F.lit(pattern), F.lit(" ")), _NO_TEXT, F.col("_text"))
    parts = F.transform(F.array_distinct(F.regexp_extract_all(prose, F.lit(_PART), F.lit(0))), lambda w: F.concat(F.lit("p"), F.ltrim(F.rtrim(w, F.lit(_AFTER)), F.lit(_BEFORE))))
    whole = F.transform(F.array_distinct(F.regexp_extract_all(F.col("_text"), F.lit(_WORD), F.lit(0))), lambda w: F.concat(F.lit("w"), w))
    tagged = clean.select(F.col("_doc").alias("d"), F.explode_outer(F.concat(parts, whole)).alias("w")).where((F.length("w") > 3) & ~F.col("w").rlike("^p[0-9]*$"))
    if passed := sorted(w for w in lexicon.common if w.isalpha())[:PASSED]:
        tagged = tagged.where(F.expr(f"w NOT IN ({', '.join(f"'{tag}{w}'" for w in passed for tag in 'pw')})"))
    counts = tagged.groupBy("w").agg(F.coalesce(F.min("d") < F.max("d"), F.lit(False)).alias("twice"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows: list[tuple[str, str, bool]] = []
            for tagged_word, twice in zip(batch["w"], batch["twice"]):
                word = tagged_word[1:]
                if tagged_word[0] == "p":
                    if word.lower() not in lexicon.common and not word.isdigit() and lexicon.edits(word):
                        rows.append(("right", word, twice))
                elif "-" in word:
                    left, right = word.rsplit("-", 1)
                    rows.append(("join", "\t".join(join_facts(left, "-", right, lexicon)), False))
                elif len(word) > 4 and word.lower() not in lexicon.common and word.isalpha() and word[1:].islower():
                    h = zlib.crc32(word.encode())
                    cut = 2 + h % (len(word) - 3)
                    rows.append(("join", "\t".join(join_facts(word[:cut], HYPHENS[(h >> 16) % len(HYPHENS)], word[cut:], lexicon)), True))
            yield pd.DataFrame(rows, columns=["kind", "a", "flag"])

    found = counts.mapInPandas(run, "kind string, a string, flag boolean")
    return checkpoint(found.groupBy("kind", "a").agg((F.avg(F.col("flag").cast("int")) > 0.5).alias("flag")))


def scanned_material(judged: DataFrame, lexicon: Lexicon) -> Material:
    """Edits and lines from all papers that may stem from scanned pages, reduced to counts where they lie.

    Lines are told apart by their features, which bounds their number.
    """
    suspects = judged.where("_suspect").select("_text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows: set[tuple[str, str, str, str]] = set()
            for t in batch["_text"]:
                rows.update(("line", kind, "\t".join(features), "") for _, kind, features in line_facts(t.split("\n")))
                page = Page(t)
                for word in dict.fromkeys(w for w, _ in page.words()) if page.scanned else ():
                    edits = lexicon.edits(word) if len(word) >= 4 and lexicon.known(word) == "no" and not word.isdigit() else []
                    if len({edited(word, e).lower() for e in edits}) == 1:
                        rows.update(("edit", e[1], e[2], word.lower()) for e in edits)
            yield pd.DataFrame(sorted(rows), columns=["kind", "a", "b", "c"])

    seen = checkpoint(suspects.mapInPandas(run, "kind string, a string, b string, c string").distinct())
    edits = seen.where("kind = 'edit'").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= SEEN_EDITS).orderBy("a", "b").collect()
    lines = seen.where("kind = 'line'").select("a", "b").orderBy(F.xxhash64("a", "b"), "a", "b").collect()
    return Material({(r["a"], r["b"]): r["n"] for r in edits}, lines=((r["a"], r["b"].split("\t")) for r in lines))


def editor_of(clean: DataFrame, lexicon: Lexicon, edits: dict[tuple[str, str], int]) -> Perceptron:
    """An editor from all rows of ``clean_material``: trained on shards that a hash draws, on common words in each, and averaged over them."""
    spark = clean.sparkSession
    shards = max(1, -(-clean.count() // SHARD))
    shared = spark.sparkContext.broadcast(lexicon)
    items = clean.select(F.pmod(F.xxhash64("kind", "a"), F.lit(shards)).alias("shard"), "kind", "a", "flag")
    items = items.unionByName(spark.range(shards).select(F.col("id").alias("shard"), F.lit("none").alias("kind"), F.lit("").alias("a"), F.lit(False).alias("flag")))

    def run(key: tuple[int], shard: pd.DataFrame) -> pd.DataFrame:
        rows = sorted(zip(shard["kind"], shard["a"], shard["flag"]))
        joins = [(a.split("\t"), bool(flag)) for kind, a, flag in rows if kind == "join"]
        editor = train_editor(shared.value, Material(edits, [a for kind, a, _ in rows if kind == "right"], joins=joins), 7 + int(key[0]))
        return pd.DataFrame(editor.weights.items(), columns=["feature", "weight"])

    weights = items.groupBy("shard").applyInPandas(run, "feature string, weight double").groupBy("feature").agg(F.array_sort(F.collect_list("weight")).alias("ws"))
    editor = Perceptron()
    editor.weights = {r["feature"]: sum(r["ws"]) / shards for r in weights.collect()}
    return editor


def fit(docs: DataFrame, doc: str = "doc_id", text: str = "marker_md", judged: DataFrame | None = None) -> Model:
    """The model of a corpus: words counted, editor and taker trained over all its documents.

    Words that two papers have, which are not scanned, are attested in whatever case. Papers are judged once
    and kept with the verdict, unless given as ``judged``.
    """
    judged = checkpoint(_judged(docs, doc, text)) if judged is None else judged
    lexicon, _ = lexicon_of(docs, doc, text, judged)
    clean = clean_material(docs, doc, text, lexicon, judged)
    twice = [r["a"].lower() for r in clean.where("kind = 'right' and flag").select("a").collect()]
    lexicon = Lexicon(lexicon.common, lexicon.attested.union(twice))
    material = scanned_material(judged, lexicon)
    return Model(lexicon, editor_of(clean, lexicon, material.edits), train_taker(material))


def _suspect(text: Column) -> Column:
    """Whether a text may stem from scanned pages."""
    return reduce(Column.__or__, (reduce(Column.__and__, (text.rlike(pattern) for pattern in patterns)) for patterns in _SUSPECT))


def _judged(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """``_doc, _text, _suspect`` of all papers with a text: whether it may stem from scanned pages."""
    src = spread(docs.where(F.col(text).isNotNull()).select(F.col(doc).alias("_doc"), F.col(text).alias("_text")), "_doc")
    return src.withColumn("_suspect", _suspect(F.col("_text")))


def scan_noise(docs: DataFrame, doc: str = "doc_id", text: str = "marker_md", model: Model | None = None) -> DataFrame:
    """``doc, line_no, kind`` of page furniture, cut words and misread words in papers from scanned pages.

    Null and empty texts have none; repeated rows count once; other columns are ignored. Papers are judged
    where they lie, and only those that may stem from scanned pages leave the JVM; only what is found is
    shuffled, to drop repeats. The model is fitted on ``docs`` unless given; it travels with the tasks.
    """
    judged = _judged(docs, doc, text)
    if model is None:
        judged = checkpoint(judged)
        model = fit(docs, doc, text, judged)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(d, line, kind) for d, t in zip(batch["_doc"], batch["_text"]) for line, kind in Page(t, shared.value).found()]
            yield pd.DataFrame(rows, columns=["_doc", "line_no", "kind"])

    suspects = judged.where(F.col("_doc").isNotNull() & F.col("_suspect")).select(F.col("_doc").cast("bigint").alias("_doc"), "_text")
    return suspects.mapInPandas(run, "_doc bigint, line_no bigint, kind string").distinct().withColumnRenamed("_doc", doc)


def mended(docs: DataFrame, doc: str = "doc_id", text: str = "marker_md", model: Model | None = None) -> DataFrame:
    """``doc, text`` of the papers from scanned pages, as readable paragraphs, each once."""
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs, doc, text))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            papers = [(d, Page(t, shared.value)) for d, t in zip(batch["_doc"], batch["_text"])]
            yield pd.DataFrame([(d, p.mended()) for d, p in papers if p.scanned], columns=["_doc", "text"])

    suspects = once(docs, doc, text).where(_suspect(F.col(text))).select(F.col(doc).cast("bigint").alias("_doc"), F.col(text).alias("_text"))
    return spread(suspects, "_doc").mapInPandas(run, "_doc bigint, text string").withColumnRenamed("_doc", doc)
