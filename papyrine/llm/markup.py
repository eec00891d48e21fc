"""Problem 7: clean text from documents with residue of HTML, wiki and LaTeX markup.

Every line is a node of a small graph. A classifier's costs are the capacities to the two terminals;
lines that follow each other are tied by smoothness edges, and so are the lines of an element, table,
environment or comment to the line that opens it. The minimum cut separates the lines that carry residue
from clean ones: rows and lines that say little by themselves go with what they stand in. The classifier
is a naive Bayes model over signs of markup, fitted on lines of clean documents of the corpus and on such
lines with markup put into them. Fenced and inline code and formulas are masked before anything is
judged, and stay letter by letter.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyrine.operators.deliveries import once
from papyrine.session import spread

#: Signs of markup that a line without code and formulas may carry. Fixed values of the formats.
SIGNS_OF_MARKUP = {
    "tag": r"</?[A-Za-z][A-Za-z0-9]*(?:\s+[A-Za-z:_-]+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s<>\"']+))?)*\s*/?>",
    "comment": r"<!--|-->|<!DOCTYPE\b|<\?xml\b",
    "entity": r"&(?:[A-Za-z][A-Za-z0-9]{1,31}|#\d{1,7}|#[xX][0-9A-Fa-f]{1,6});",
    "link": r"\[\[[^\[\]\n]+\]\]",
    "template": r"\{\{[^{}\n]*(?:\}\}|$)",
    "quotes": r"(?<!')'{2,5}(?!')(?=\S)[^\n]*?\S'{2,5}",
    "equals": r"^\s*(={2,6})\s*[^=\n]+?\s*\1\s*$",
    "table": r"^\s*(?:\{\||\|\}\s*$|\|-\s*$)",
    "command": r"\\(?:begin|end|[A-Za-z]*section|chapter|paragraph|item|textbf|textit|texttt|emph|cite[a-z]*|ref|label|caption|footnote|url|href|it|bf|em|rm|sc|centering|hline|includegraphics|noindent|newline|linebreak|vspace|hspace)\b\*?",
    "argument": r"\\[A-Za-z]+\*?\s*[{\[]",
    "backslash": r"\\(?:[A-Za-z]{2,})\b|\\[()\[\]]|\\\\\s*$",
}
#: Signs that clean lines carry as well. Alone they never outweigh ``CLEAN``, so they are looked for inside tables, environments and comments only.
WEAK_SIGNS = {"row": r"^\s*[|!]", "cells": r"\|\||\S\s+&\s+\S", "listed": r"^\s*[*#:;]\s", "percent": r"(?<!\\)%", "braces": r"[{}]"}

#: Where markup is put into clean lines for training; ``@`` stands for words of a line. Fixed values of the formats.
MARKED = (
    "@ <b>@</b> @", "<p>@</p>", "<div class=\"x\">@", "@<br/>@", "@<sup>12</sup> @", "<!-- @ -->", "<!-- @", "@ -->", "@ &amp; @", "@&#8201;@", "@ &lt; @", "@ [[@|@]] @", "[[@]]", "@ {{@|2}} @", "{{@",
    "@ '''@''' @", "''@'' @", "== @ ==", "{| class=\"@\"", "|-", "|}", "| @ || @", "! @ !! @", "\\section{@}", "\\begin{tabular}{ll}", "\\end{itemize}", "\\item @", "@ \\textbf{@} @", "{\\it @} @", "@~\\cite{@}", "@ & @ \\\\", "@ \\( @", "\\hline",
)
#: Clean lines that hold signs of their own. Fixed values of the format.
PLAIN = ("@", "| @ | @ |", "|---|---|", "# @", "- @", "* @", "1. @", "> @", "@ & @", "@ 5 % @", "[@](@)", "![@](@)", "**@** @", "a {@} b", "@ < 5 @")

#: Lines of clean documents that the classifier is fitted on at most, and how often each pattern above is filled with them.
TRAINING_LINES, FILLINGS = 3000, 40

#: Bits by which clean lines are more usual than others.
CLEAN = 4.0

#: Smoothness in bits between neighbours, and between a line and the one that opens what it stands in.
NEXT_LINE, ELEMENT, TABLE, COMMENT = 0.8, 0.6, 8.0, 8.0

#: By what the bits of a line are multiplied whose own signs speak for residue more than ``CLEAN`` does against it.
SEED = 1000.0

_STANDIN = re.compile(r"\ue000(\ue001*)\ue002")
_FENCE = re.compile(r"^\s*(```|~~~)")
_DISPLAY = re.compile(r"\$\$.+?\$\$", re.DOTALL)
_INLINE = re.compile(r"(`+)(?!`)[^\n]+?(?<!`)\1(?!`)|\$(?![\s$])[^$\n]*?(?<![\s\\])\$(?!\d)")
_QUICK = re.compile(r"<[A-Za-z/!?]|-->|&#?\w+;|\\|\[\[|\{[{|]|\|\}|\|-|''|==")
_PARTS = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9]*)\b[^<>]*?(/?)>|\\(begin|end)\{([a-z*]+)\}|^\s*(\{\||\|\})|(<!--|-->)")
#: Elements whose lines belong to the markup, text or not. Fixed values of the formats.
TABLES = {"table", "tr", "thead", "tbody", "tabular", "array", "longtable", "{|"}
_STRONG = [(name, re.compile(p)) for name, p in SIGNS_OF_MARKUP.items()]
_WEAK = [(name, re.compile(p)) for name, p in WEAK_SIGNS.items()]
_VOID = {"br", "hr", "img", "input", "meta", "link", "col", "wbr"}


def masked(text: str) -> tuple[str, list[str]]:
    """The text with code and formulas replaced by letters of private use, and what they stand for."""
    kept: list[str] = []

    def keep(m: re.Match[str]) -> str:
        kept.append(m[0])
        return "\ue000" + "\ue001" * m[0].count("\n") + "\ue002"

    lines, out, block, fence = text.split("\n"), [], [], ""
    for line in lines:
        m = _FENCE.match(line)
        if fence:
            block.append(line)
            if m and m[1] == fence:
                kept.append("\n".join(block))
                out.append("\ue000" + "\ue001" * (len(block) - 1) + "\ue002")
                block, fence = [], ""
        elif m:
            block, fence = [line], m[1]
        else:
            out.append(line)
    if block:  # a fence left open reaches to the end
        kept.append("\n".join(block))
        out.append("\ue000" + "\ue001" * (len(block) - 1) + "\ue002")
    fences, kept = kept, []
    # one pass over the stand-ins of fences and over inline code and formulas keeps them in order
    body = "\n".join(out)
    queue = deque(fences)

    def again(m: re.Match[str]) -> str:
        if m[0].startswith("\ue000"):
            kept.append(queue.popleft())
            return m[0]
        return keep(m)

    return re.sub(rf"\ue000\ue001*\ue002|{_DISPLAY.pattern.replace('.+?', '[^`]+?')}|{_INLINE.pattern}", again, body), kept


def _restored(text: str, kept: list[str]) -> str:
    queue = iter(kept)
    return re.sub(r"\ue000\ue001*\ue002", lambda _: next(queue), text)


def _minimum_cut(source: list[float], sink: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay on the source's side of a minimum cut.

    A node whose terminals differ by more than all its edges is on the side of the larger one in every
    minimum cut; such nodes are settled first, and their edges passed on to their neighbours' terminals.
    The rest is cut by augmenting shortest paths.
    """
    n = len(source)
    source, sink = list(source), list(sink)
    tied: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in edges:
        tied[a][b] = tied[a].get(b, 0.0) + w
        tied[b][a] = tied[b].get(a, 0.0) + w
    side: list[bool | None] = [None] * n
    open_ = deque(range(n))
    while open_:
        i = open_.popleft()
        if side[i] is None and abs(source[i] - sink[i]) > sum(tied[i].values()):
            side[i] = source[i] > sink[i]
            for j, w in tied[i].items():
                (source if side[i] else sink)[j] += w
                del tied[j][i]
                open_.append(j)
            tied[i] = {}
    left = [i for i in range(n) if side[i] is None]
    if left:
        s, t = n, n + 1
        room: list[dict[int, float]] = [dict(tied[i]) for i in range(n)] + [{}, {}]
        for i in left:
            room[s][i], room[i][s] = source[i], 0.0
            room[i][t], room[t][i] = sink[i], 0.0
        while True:
            came, wave = {s: s}, deque([s])
            while wave and t not in came:
                u = wave.popleft()
                for v, r in room[u].items():
                    if r > 1e-9 and v not in came:
                        came[v] = u
                        wave.append(v)
            if t not in came:
                for i in left:
                    side[i] = i in came
                break
            path, v = [], t
            while v != s:
                path.append((came[v], v))
                v = came[v]
            push = min(room[u][v] for u, v in path)
            for u, v in path:
                room[u][v] -= push
                room[v][u] = room[v].get(u, 0.0) + push
    return [bool(x) for x in side]


class Classifier:
    """Bits for and against residue of each sign, by naive Bayes with one half added to every count."""

    def __init__(self, dirty: list[str], clean: list[str]) -> None:
        def shares(lines: list[str]) -> dict[str, float]:
            return {name: (sum(1 for x in lines if p.search(x)) + 0.5) / (len(lines) + 1) for name, p in [*_STRONG, *_WEAK]}

        p, q = shares(dirty), shares(clean)
        self.bits = {name: math.log2(p[name] / q[name]) for name in p}

    @classmethod
    def fitted(cls, lines: list[str], seed: int = 7) -> Classifier:
        """On clean lines, and on patterns with and without markup that are filled with their words."""
        draw = random.Random(seed)
        words = [w for x in lines for w in x.split()] or ["word"]
        fill = lambda pattern: re.sub("@", lambda _: " ".join(draw.choice(words) for _ in range(draw.randrange(1, 6))), pattern)
        return cls([fill(m) for m in MARKED for _ in range(FILLINGS)], [*lines, *(fill(m) for m in PLAIN for _ in range(FILLINGS))])

    def costs(self, line: str, weak: bool) -> tuple[float, float, bool]:
        """(bits for residue, bits against it, whether there is any sign)."""
        found = [self.bits[name] for name, p in (_STRONG + _WEAK if weak else _STRONG) if p.search(line)]
        return sum(b for b in found if b > 0), sum(-b for b in found if b < 0), bool(found)


Element = tuple[int, int, str]  # opening line, closing line, name


def elements(lines: list[str]) -> list[Element]:
    """Elements, environments, wiki tables and comments that are opened on one line and closed on another."""
    found: list[Element] = []
    opened: list[tuple[str, int]] = []
    count: dict[str, int] = {}  # names that stand open, so that a closing one without an opening one is passed over at once
    ends = max((i for i, x in enumerate(lines) if "-->" in x), default=-1)
    comment = -1
    for i, line in enumerate(lines):
        if comment < 0 and not _QUICK.search(line) or comment >= 0 and "-->" not in line:
            continue
        for m in _PARTS.finditer(line):
            if m[7]:
                if m[7] == "<!--" and comment < 0 and (ends > i or "-->" in line[m.end() :]):
                    comment = i
                elif m[7] == "-->" and comment >= 0:
                    if comment < i:
                        found.append((comment, i, "<!--"))
                    comment = -1
                continue
            if comment >= 0:
                continue
            name = (m[2] or m[5] or "{|").lower()
            if m[1] or m[4] == "end" or m[6] == "|}":
                while count.get(name):
                    top, at = opened.pop()
                    count[top] -= 1
                    if top == name:
                        if at < i:
                            found.append((at, i, name))
                        break
            elif not m[3] and name not in _VOID:
                opened.append((name, i))
                count[name] = count.get(name, 0) + 1
    return found


def _judged(lines: list[str], classifier: Classifier, tied: bool = True) -> tuple[list[int], list[Element]]:
    """(places of lines that carry residue, elements)."""
    spans = elements(lines)
    edges: list[tuple[int, int, float]] = [(a, b, ELEMENT) for a, b, _ in spans]
    cost, against, sign = [0.0] * len(lines), [CLEAN] * len(lines), [False] * len(lines)
    whole = sorted((s for s in spans if s[2] in TABLES or s[2] == "<!--"), key=lambda s: (s[0], -s[1]))
    stack: list[Element] = []  # tables and comments around the line
    k = 0
    held: dict[int, Element] = {}  # line -> the innermost of them
    for i, line in enumerate(lines):
        while stack and stack[-1][1] <= i:
            stack.pop()
        while k < len(whole) and whole[k][0] < i:
            if whole[k][1] > i:
                stack.append(whole[k])
            k += 1
        if stack:
            held[i] = stack[-1]
        if stack or _QUICK.search(line):
            plus, minus, sign[i] = classifier.costs(line, bool(stack))
            # a line that its own signs settle is a seed: what is tied to it cannot outweigh it
            cost[i], against[i] = plus * SEED if plus > CLEAN + minus else plus, CLEAN + minus
    if not any(sign):
        return [], spans
    for i, (a, _, name) in held.items():
        if lines[i].strip():
            edges.append((a, i, COMMENT if name == "<!--" else TABLE))
            sign[i] = sign[i] or name == "<!--"
    edges += [(i, i + 1, NEXT_LINE) for i in range(len(lines) - 1) if lines[i].strip() and lines[i + 1].strip()]
    sides = _minimum_cut(cost, against, edges if tied else [])
    # the cut decides about doubtful lines; a line without any sign of markup has nothing to be removed
    return [i for i, side in enumerate(sides) if side and sign[i]], spans


def residue_lines(text: str, classifier: Classifier, tied: bool = True) -> list[int]:
    """Lines from 1 that carry residue; without ``tied`` each line is judged by itself."""
    return [i + 1 for i in _judged(_plain_lines(text), classifier, tied)[0]]


def _plain_lines(text: str) -> list[str]:
    body, _ = masked(text)
    return _STANDIN.sub(lambda m: "\ue000" + "\n" * len(m[1]), body).split("\n")


def _table(m: re.Match[str]) -> str:
    rows = [[re.sub(r"\s+", " ", c).strip() for c in re.findall(r"<t[dh]\b[^<>]*>(.*?)(?=</t[dh]>|<t[dh]\b|</tr>|$)", r, re.DOTALL | re.IGNORECASE)] for r in re.findall(r"<tr\b[^<>]*>(.*?)(?=</tr>|<tr\b|$)", m[1], re.DOTALL | re.IGNORECASE)]
    rows = [r for r in rows if r]
    if not rows:
        return ""
    width = max(map(len, rows))
    shown = ["| " + " | ".join(r + [""] * (width - len(r))) + " |" for r in rows]
    return "\n".join([shown[0], "|" + "---|" * width, *shown[1:]])


_REWRITES: list[tuple[re.Pattern[str], object]] = [
    (re.compile(r"<!--.*?-->", re.DOTALL), ""),
    (re.compile(r"<table\b[^<>]*>(.*?)</table>", re.DOTALL | re.IGNORECASE), _table),
    (re.compile(r"<h([1-6])\b[^<>]*>(.*?)</h\1>", re.DOTALL | re.IGNORECASE), lambda m: "#" * int(m[1]) + " " + m[2].strip()),
    (re.compile(r"<li\b[^<>]*>\s*", re.IGNORECASE), "- "),
    (re.compile(r"<sup\b[^<>]*>\s*(\d[\d,\-– ]*)\s*</sup>", re.IGNORECASE), r"[\1]"),
    (re.compile(r"<(?:b|strong)>(.*?)</(?:b|strong)>", re.IGNORECASE), r"**\1**"),
    (re.compile(r"<(?:i|em)>(.*?)</(?:i|em)>", re.IGNORECASE), r"*\1*"),
    (re.compile(r"<br\s*/?>", re.IGNORECASE), " "),
    (re.compile(r"^[ \t]*</?(?:ul|ol|div|p|table|tbody|thead|tr|section|body|html)\b[^<>]*>[ \t]*\n", re.MULTILINE | re.IGNORECASE), ""),
    (re.compile(SIGNS_OF_MARKUP["tag"]), ""),
    (re.compile(r"^[ \t]*(={2,6})[ \t]*([^=\n]+?)[ \t]*\1[ \t]*$", re.MULTILINE), lambda m: "#" * len(m[1]) + " " + m[2]),
    (re.compile(r"\[\[(?:File|Image):([^\[\]|\n]+)(?:\|[^\[\]\n]*?)??\|?([^\[\]|\n]*)\]\]", re.IGNORECASE), r"![\2](\1)"),
    (re.compile(r"\[\[(?:[^\[\]|\n]*\|)?([^\[\]|\n]+)\]\]"), r"\1"),
    (re.compile(r"[ \t]?\{\{[^{}]*\}\}"), ""),
    (re.compile(r"(?<!')'''(?!')(.+?)'''"), r"**\1**"),
    (re.compile(r"(?<!')''(?!')(.+?)''"), r"*\1*"),
    (re.compile(r"\\(sub)?(sub)?section\*?\{([^{}\n]*)\}"), lambda m: "#" * (1 + bool(m[1]) + bool(m[2])) + " " + m[3]),
    (re.compile(r"\\(?:sub)?paragraph\*?\{([^{}\n]*)\}"), r"**\1**"),
    (re.compile(r"^[ \t]*\\(?:begin|end)\{[A-Za-z*]+\}(?:\[[^\]\n]*\])?[ \t]*\n?", re.MULTILINE), ""),
    (re.compile(r"^([ \t]*)\\item\b[ \t]*", re.MULTILINE), r"\1- "),
    (re.compile(r"~?\\(?:cite[a-z]*|ref|label)\*?(?:\[[^\]\n]*\])?\{[^{}\n]*\}"), ""),
    (re.compile(r"\\(?:textbf|mathbf)\{([^{}\n]*)\}"), r"**\1**"),
    (re.compile(r"\\(?:emph|textit)\{([^{}\n]*)\}|\{\\(?:it|em|sl)\s+([^{}\n]*)\}"), lambda m: f"*{m[1] if m[1] is not None else m[2]}*"),
    (re.compile(r"\{\\[a-z]+\s+([^{}\n]*)\}|\\[A-Za-z]+\*?(?:\[[^\]\n]*\])?\{([^{}\n]*)\}"), lambda m: m[1] if m[1] is not None else m[2]),
    (re.compile(r"\(\s*\)"), ""),
]


def clean(text: str, classifier: Classifier) -> str:
    """The text without residue; headings, lists, tables, code and formulas keep their structure.

    Only lines that the cut labels, and what stands between the ends of an element that it labels, are
    rewritten; the others stay letter by letter.
    """
    body, kept = masked(text)
    lines = _STANDIN.sub(lambda m: "\ue000" + "\n" * len(m[1]), body).split("\n")
    labelled, spans = _judged(lines, classifier)
    if not labelled:
        return text
    own = set(labelled)
    change = [0] * (len(lines) + 1)
    for a, b in [*((i, i) for i in labelled), *((a, b) for a, b, _ in spans if a in own and b in own)]:
        change[a] += 1
        change[b + 1] -= 1
    parts: list[tuple[bool, list[str]]] = []
    depth = at = 0
    for row in body.split("\n"):  # a stand-in of several lines is one row here
        step = 1 + sum(len(m[1]) for m in _STANDIN.finditer(row))
        depth_here = False
        for i in range(at, at + step):
            depth += change[i]
            depth_here = depth_here or depth > 0
        at += step
        if parts and parts[-1][0] == depth_here:
            parts[-1][1].append(row)
        else:
            parts.append((depth_here, [row]))
    out = "".join(_rewritten("".join(f"{x}\n" for x in rows)) if dirty else "".join(f"{x}\n" for x in rows) for dirty, rows in parts)
    return _restored(re.sub(r"\n{3,}", "\n\n", out[:-1] if out.endswith("\n") else out), kept)


def _rewritten(body: str) -> str:
    for pattern, by in _REWRITES:
        body = pattern.sub(by, body)
    body = html.unescape(body).replace("\xa0", " ")
    return re.sub(r"(?<=\S)[ \t\u2009]{2,}(?=\S)", " ", body)


#: Documents without any of these signs are clean and never leave the JVM.
SIGNS = r"<[A-Za-z/!?]|&#?\w+;|\\[A-Za-z(\[\\]|\[\[|\{[{|]|''|(?m)^\s*==|^\s*\|[-}]\s*$"


def _fields(docs: DataFrame, doc: str, fields: tuple[str, ...], only: Column | None) -> DataFrame:
    parts = None
    for field in fields:
        part = docs.select(F.col(doc).cast("bigint").alias("_doc"), F.col(field).alias("_text")).where("_doc is not null and _text is not null")
        if only is not None:
            part = part.where(only)
        part = part.select(F.lit(field).alias("field"), "_doc", "_text")
        parts = part if parts is None else parts.unionByName(part)
    return parts


def fit(docs: DataFrame, doc: str, fields: tuple[str, ...]) -> Classifier:
    """A classifier from at most ``TRAINING_LINES`` lines of documents without any sign, which are drawn by a hash of their key and text."""
    share = min(1.0, TRAINING_LINES / max(docs.count(), 1))
    drawn = _fields(docs, doc, fields, F.pmod(F.xxhash64("_doc"), F.lit(1 << 30)) < int(share * (1 << 30))).where(~F.col("_text").rlike(SIGNS))
    lines = drawn.select(F.explode(F.split("_text", "\n", -1)).alias("x")).where("trim(x) <> ''").distinct()
    return Classifier.fitted([r["x"] for r in lines.orderBy(F.xxhash64("x"), "x").limit(TRAINING_LINES).collect()])


def residue(docs: DataFrame, doc: str = "doc_id", fields: tuple[str, ...] = ("marker_md", "docling_md"), classifier: Classifier | None = None) -> DataFrame:
    """``field, doc, line_no`` of lines with residue. Null and empty texts have none; repeated rows count once.

    Documents are judged where they lie; only the lines found are shuffled, to remove repeats. The
    classifier is fitted on ``docs`` unless given.
    """
    shared = classifier or fit(docs, doc, fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(f, d, n) for f, d, t in zip(batch["field"], batch["_doc"], batch["_text"]) for n in residue_lines(t, shared)]
            yield pd.DataFrame(rows, columns=["field", "_doc", "line_no"])

    suspects = spread(_fields(docs, doc, fields, F.col("_text").rlike(SIGNS)), "_doc")
    return suspects.mapInPandas(run, "field string, _doc bigint, line_no bigint").distinct().withColumnRenamed("_doc", doc)


def cleaned(docs: DataFrame, doc: str = "doc_id", fields: tuple[str, ...] = ("marker_md", "docling_md"), classifier: Classifier | None = None) -> DataFrame:
    """``field, doc, text`` of every non-null text once, in clean form."""
    shared = classifier or fit(docs, doc, fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"field": batch["field"], "_doc": batch["_doc"], "text": batch["_text"].map(lambda t: clean(t, shared))})

    src = once(docs, doc, *fields)
    suspect = F.col("_text").rlike(SIGNS)
    schema = "field string, _doc bigint, text string"
    dirty = spread(_fields(src, doc, fields, suspect), "_doc").mapInPandas(run, schema)
    return dirty.unionByName(_fields(src, doc, fields, ~suspect).withColumnRenamed("_text", "text")).withColumnRenamed("_doc", doc)
