"""Operators on texts, against hand-made cases and brute force."""

import itertools
import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from papyrine.llm import furniture, leaks, lookalike, markup, neardup, scans, sentences, split, tokens
from papyrine.llm.words import window_hashes, words

CLASH = "_text string, field string"


def docs(spark, texts, key="doc_id", text="text"):
    """Every row twice, beside columns whose names clash with those used inside."""
    return spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)] * 2, f"{key} long, {text} string, {CLASH}")


# 2: repeated lines

FURNITURE = "Copyright 2020 by the Quiet Press Group of Nowhere"


def test_repeated_lines(spark):
    texts = [f"Own line number {w} of this very paper here\n{FURNITURE.replace('2020', str(i))}\n  {FURNITURE.upper()}\nshort" for i, w in enumerate("abcdefgh")] + [None, ""]
    papers = docs(spark, texts, text="marker_md")
    runs = spark.createDataFrame([(i, "J", "r") for i in range(10)] * 3 + [(50, None, "r")], "doc_id long, journal string, _doc string")
    found = rows(furniture.repeated_lines(papers, runs))
    assert found == sorted([(i, 2) for i in range(8)] + [(i, 3) for i in range(8)], key=repr)
    cleaned = {r["doc_id"]: r["marker_md"] for r in furniture.without_repeated_lines(papers, runs).collect()}
    assert len(cleaned) == 10 and cleaned[8] is None and cleaned[9] == "" and cleaned[0].endswith("here\nshort")
    assert rows(furniture.repeated_lines(papers.where("false"), runs)) == []
    three = papers.where("doc_id < 3")
    assert rows(furniture.repeated_lines(three, runs)) == []


def test_near_duplicate_lines(spark):
    """Lines that differ by names, dates or a word recur as clusters, of which no form is frequent; others of the kind stay."""
    draw = random.Random(2)
    name = lambda: "".join(draw.choices("abcdefg", k=7)).capitalize()
    byline = lambda i: f"Edited on {i % 27 + 1} {draw.choice(['March', 'June'])} 2{i:03d} by {name()} {name()} and approved by the board of this journal for open use by {name()}"
    own = lambda: " ".join(draw.sample(PROSE, 9))
    texts = [f"{own()}\n{byline(i)}\n{own()}" for i in range(30)]
    papers, runs = docs(spark, texts, text="marker_md"), spark.createDataFrame([(i, "J") for i in range(30)], "doc_id long, journal string")
    assert rows(furniture.repeated_lines(papers, runs)) == []
    cleaned = {r["doc_id"]: r["marker_md"] for r in furniture.without_repeated_lines(papers, runs).collect()}
    assert cleaned == {i: "\n".join(t.split("\n")[::2]) for i, t in enumerate(texts)}


# 3: near-duplicates


def brute(sets, threshold):
    return sorted((a, b) for a, b in itertools.combinations(sorted(sets), 2) if sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= threshold)


@pytest.mark.parametrize("tile", [1024, 3])
def test_similar_pairs_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(neardup, "TILE_ROWS", tile)
    monkeypatch.setattr(neardup, "BLOCK_ROWS", tile + 2)
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = [None, "", "one two"]
    for _ in range(12):
        base = [draw.choice(vocabulary) for _ in range(draw.choice((5, 40, 300)))]
        texts.append(" ".join(base))
        for edits in (0, 1, 4, 30):
            copy = list(base)
            for _ in range(edits):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            texts.append(" ".join(copy).upper())
    items = docs(spark, texts).select(F.col("doc_id").alias("id"), words(F.col("text")).alias("ws")).select("id", window_hashes(F.col("ws"), 3).alias("hashes"))
    sets = {i: {tuple(w[k : k + 3]) for k in range(len(w) - 2)} for i, t in enumerate(texts) for w in [re.findall(r"[^\W_]+", (t or "").lower())]}
    for k in (96, neardup.EVERY):
        assert [tuple(r) for r in neardup.similar_pairs(items, 0.6, k).orderBy("id_a", "id_b").collect()] == brute(sets, 0.6)
    if tile == 3:
        return
    grouped = {r["id"]: r for r in neardup.groups(items, 0.6, 512).collect()}
    assert all(grouped[a]["group_id"] == grouped[b]["group_id"] for a, b in brute(sets, 0.6)) and grouped.keys() == {i for i, s in sets.items() if s}
    assert rows(neardup.similar_pairs(items.where("false"), 0.6, 96)) == []


def test_bitmaps_bound_the_overlap():
    import numpy as np

    draw = np.random.default_rng(3)
    for n in (1, 40, 700):
        a = draw.integers(-(2**62), 2**62, n)
        b = np.concatenate([a[: n // 2], draw.integers(-(2**62), 2**62, n)])
        x, y = neardup.bitmap(a), neardup.bitmap(b)
        w = min(len(x), len(y))
        assert int(np.bitwise_count((neardup.fold(x, w) ^ neardup.fold(y, w)).view(np.uint64)).sum()) <= len(set(a) ^ set(b))


# 4: look-alikes


def test_lookalikes(spark):
    same = [
        ("Two faces of ice", "Two﻿ fаces of ice"), ("Ｍａｐ： ９", "Map: 9"), ("a b", "a b"), ("été", "été"), ("ﬁne", "fine"), ("co­op", "coop"),
        ("Κ-chain", "K-chain"), ("сop", "cоp"), ("naı̈ve x", "naı̈ve x"), ("naїve", "naïve"),
    ]
    other = [("Case", "case"), ("role", "rôle"), ("x²", "x2"), ("γ-x", "y-x"), ("a  b", "a b "), ("Il", "ll")]
    raw = [t for pair in same + other for t in pair] + [None, "", ""]
    df = spark.createDataFrame([("title", i, t, "c") for i, t in enumerate(raw)] * 2, "field string, id long, raw string, text string")
    assert rows(lookalike.lookalike_pairs(df)) == sorted([("title", 2 * i, 2 * i + 1) for i in range(len(same))], key=repr)
    assert lookalike.unify(df).count() == len(raw) - 1
    assert rows(lookalike.lookalike_pairs(df.where("false"))) == []
    alone = spark.createDataFrame([("title", 1, "сор cat")], "field string, id long, raw string")
    assert rows(lookalike.unify(alone).select("text")) == [("сор cat",)]  # no other text has the word


@pytest.mark.parametrize("letter, latin", [("ν", "v"), ("Ϲ", "C"), ("Ϳ", "J"), ("Ϻ", "M"), ("Ϝ", "F"), ("ѵ", "v"), ("Ѵ", "V"), ("ӏ", "l"), ("Ӏ", "I")])
def test_letters_of_a_latin_shape(letter, latin):
    assert lookalike.candidate(f"tur{letter}er", "LATIN") == f"tur{latin}er"
    assert all(lookalike.candidate(f"{own}-chain", "LATIN") is None for own in "αβγδκ")


def test_nu_for_v(spark):
    df = spark.createDataFrame([("title", 1, "A reνiew of turnoνer"), ("title", 2, "A review of turnover")], "field string, id long, raw string")
    assert rows(lookalike.lookalike_pairs(df)) == [("title", 1, 2)]


def test_latin_letters_in_words_of_another_script(spark):
    same = [("делят клeтка", "делят клетка"), ("the клeтка in a Latin text", "the клетка in a Latin text"), ("здесь Бopщ", "здесь Борщ"), ("здесь бaрж", "здесь барж")]
    other = [("здесь дом", "здесь дым"), ("здесь дzм", "здесь дзм")]
    raw = [t for pair in same + other for t in pair]
    df = spark.createDataFrame([("title", i, t) for i, t in enumerate(raw)], "field string, id long, raw string")
    assert rows(lookalike.lookalike_pairs(df)) == sorted([("title", 2 * i, 2 * i + 1) for i in range(len(same))], key=repr)
    assert {r["text"] for r in lookalike.unify(df).collect()} >= {b for _, b in same}
    assert lookalike.native("үлкен") == "үлкен" and lookalike.native("сор") is None and lookalike.native("β-chain") is None


# 5: pieces


def check_spans(text, spans, limit, overlap):
    assert spans[0][0] == 0 and spans[-1][1] == len(text)
    for (a, b), (c, d) in zip(spans, spans[1:]):
        assert a < c <= b < d and b - c <= overlap
    assert all(b - a <= limit for a, b in spans)


@pytest.mark.parametrize("text", ["word " * 3000, "x" * 9000, "# T\n\n" + "A sentence of words. " * 100 + "\n\n" + "Other things came up here. " * 300, "a\n" * 5000, "字" * 8001 + "。" + "词" * 100])
def test_split_text(text):
    check_spans(text, split.split_text(text), split.TEXT_LIMIT, split.TEXT_OVERLAP)


def test_split_prefers_valleys():
    cats, stars = "The cat chased a mouse near the cat house. ", "A bright star burned within the galaxy of stars. "
    text = "\n\n".join([cats * 20] * 3 + [stars * 20] * 3)
    assert text[split.split_text(text)[0][1] :].startswith("A bright")


def test_split_finds_the_topic_boundary_in_the_whole_window():
    """Held out: texts of made-up topics; the cut falls where the topic changes, not merely at a late pause."""
    draw = random.Random(8)
    hits = 0
    for n in range(40):
        topics = [made_up(draw, 30, 3) for _ in range(2)]
        parts = [" ".join(" ".join(draw.choices(topic, k=8)).capitalize() + "." for _ in range(k)) for topic, k in ((topics[0], draw.randrange(18, 36)), (topics[1], 60))]
        text = " ".join(parts)
        hits += abs(split.split_text(text)[0][1] - len(parts[0]) - 1) <= 2
    assert hits >= 38


def test_split_headings():
    items = [f"Heading {i} " + "w" * 90 for i in range(30)] + ["", "y" * 2500, "z"]
    got = split.split_headings(items)
    assert all(sum(map(len, t)) <= split.HEADINGS_LIMIT for _, _, t in got) and got[0][0] == 0 and got[-1][1] == len(items) - 1
    assert all(b[0] <= a[1] + 1 for a, b in zip(got, got[1:]))


def test_pieces(spark):
    papers = docs(spark, ["x" * 4000, "y " * 2001, None, ""], text="marker_md")
    meta = spark.createDataFrame([(1, [("a" * 600,), ("b" * 400,)]), (2, [("a" * 600,), (None,), ("b" * 401,)]), (3, None), (4, [])] * 2, "doc_id long, headings array<struct<text:string>>")
    got = split.pieces(papers, meta)
    assert rows(got.groupBy("field", "doc_id").count()) == [("headings", 2, 2), ("marker_md", 1, 2)]


# 6: scans

PROSE = "after the whole receptor was changed during secretion of the protein and the signal returned within some days because the membrane moved".split()


def test_scans(spark):
    clean = [" ".join(random.Random(i).sample(PROSE, len(PROSE))) for i in range(40)]
    scanned = (
        "# Receptor signals in membranes\n\nAfter the whole receptor was changed during secre-\ntion of the protein and the signal returned within\nsome days because the mernbrane moved during the\n"
        "12\nRECEPTOR SIGNALS IN MEMBRANES | Journal\nwhole secretion of the protein and the signal was changed fo-\nr some days becausc the membrane moved after half-\n13\nSmith et al. | Journal\n\nlife of the protein."
    )
    papers = docs(spark, [*clean, scanned, None, ""], text="marker_md")
    found = rows(scans.scan_noise(papers))
    own = [x[1:] for x in found if x[0] == 40]
    assert len(own) == len(found)
    assert {("page", 6), ("page", 10), ("header", 7), ("header", 11), ("hyphen", 3), ("misread", 5), ("misread", 9)} <= {(k, n) for n, k in own}
    text = scans.mended(papers).first()["text"]
    assert "secretion of the protein" in text and "membrane moved" in text and "because the membrane" in text and "| Journal" not in text and "12" not in text
    assert rows(scans.scan_noise(papers.where("false"))) == []


SYLLABLES = ["ba", "cor", "del", "fen", "gim", "hol", "mar", "nat", "pol", "rub", "sed", "tur"]


def made_up(draw, n, k=4):
    return sorted({"".join(draw.choices(SYLLABLES, k=k)) for _ in range(n)})


def misreadings(draw, words):
    back = {v: k for k, v in scans.CONFUSIONS.items()}
    for word in words:
        i = draw.choice([i for i, c in enumerate(word) if c in back])
        yield word[:i] + back[word[i]] + word[i + 1 :], word


def mend(lexicon, editor, word, known=""):
    return scans.edited(word, max(lexicon.alternatives(word, known), key=lambda x: editor.score(x[1]))[0])


def test_editor_on_held_out_words():
    draw = random.Random(11)
    pool = made_up(draw, 900)
    draw.shuffle(pool)
    editor, lexicon = scans.train_editor(scans.Lexicon(pool[:400]), scans.Material()), scans.Lexicon(pool)
    cases = list(misreadings(draw, pool[400:]))
    assert sum(mend(lexicon, editor, noisy) == word for noisy, word in cases) / len(cases) > 0.97
    # what is no misreading stays; a test of the dictionary alone, or an editor without training, would change all or nothing
    typos = [w[:i] + c + w[i + 1 :] for w in pool[400:] for i in [draw.randrange(len(w))] for c in draw.choice("kqxzjvy") if c != w[i]]
    typos = [t for t in typos if lexicon.edits(t) and t not in lexicon.common]
    assert len(typos) > 100 and sum(mend(lexicon, editor, t) == t for t in typos) / len(typos) > 0.97
    assert all(mend(lexicon, scans.Perceptron(), noisy) == noisy for noisy, _ in cases[:50])


def test_edits_learned_from_the_papers():
    """A misreading that no table has, and letters lost or added, when the scanned papers of the sample show it."""
    pool = made_up(random.Random(3), 600)
    seen = scans.Material({("q", "d"): 30, ("", "r"): 30, ("~", ""): 30})
    plain, taught = (scans.train_editor(scans.Lexicon(pool), m) for m in (scans.Material(), seen))
    lexicon = scans.Lexicon(pool)
    words = [w for w in pool if "d" in w][:80]
    assert sum(mend(lexicon, taught, w.replace("d", "q", 1)) == w for w in words) > 75 > 20 > sum(mend(lexicon, plain, w.replace("d", "q", 1)) == w for w in words)
    assert sum(mend(lexicon, taught, w[:4] + "~" + w[4:]) == w for w in words) > 75
    words = [w for w in pool if "r" in w][:80]
    assert sum(mend(lexicon, taught, w.replace("r", "", 1)) == w for w in words) > 60


def test_edits_against_brute_force():
    draw = random.Random(4)
    pool = made_up(draw, 60, 2)
    lexicon = scans.Lexicon(pool)
    letters = sorted({c for w in pool for c in w})
    for word in [*pool[:10], *("".join(draw.choices(letters, k=draw.randrange(3, 8))) for _ in range(200))]:
        got = {scans.edited(word, e) for e in lexicon.edits(word)} - {word}
        near = {word[:i] + c + word[i + k :] for i in range(len(word) + 1) for k in (0, 1, 2) for c in ["", *letters] if i + k <= len(word) and (k or len(word) > 3) and (c or k == 1)}
        near |= {word[:i] + c + d + word[i + 1 :] for i in range(len(word)) for c in letters for d in letters if word[i] not in c + d}
        assert got == (near & lexicon.common) - {word}, word


def test_joins_of_held_out_names():
    draw = random.Random(9)
    names = made_up(draw, 1600, 4)
    draw.shuffle(names)
    compounds = [f"{n.capitalize()}-{draw.randrange(100)}" for n in names[:300]] + [f"{draw.choice('αβγδ')}-{n}" for n in names[300:600]]
    common = names[600:900] + [f"{a}-{b}" for a, b in zip(names[600:700], names[700:800])]
    lexicon = scans.Lexicon(common)
    model = scans.Model(lexicon, scans.train_editor(lexicon, scans.Material(words=[n.capitalize() for n in names[:300]], compounds=compounds)))
    right = [scans._joins(n[:c].capitalize(), "-", n[c:], model) for n in names[1000:1100] for c in [draw.randrange(2, len(n) - 1)]]
    right += [not scans._joins(n.capitalize(), "-", str(draw.randrange(100)), model) for n in names[1000:1100]]
    right += [not scans._joins(draw.choice("κλμ"), "-", n, model) for n in names[1000:1100]]
    right += [not scans._joins(a, "-", b, model) for a, b in zip(names[600:700], names[700:800])]
    untrained = scans.Model(lexicon, scans.Perceptron())
    assert sum(right) / len(right) > 0.95 and not any(scans._joins(n[:3], "-", n[3:], untrained) for n in names[:20])


def test_taker_uses_the_place_on_the_page():
    """Numbers that are neither dressed nor in a run are taken when they stand where the page ends."""
    def paper(n, every, stray):
        lines = []
        for k in range(n):
            lines += ["Some text of the page that goes on"] * (every - 1) + [str(100 + k)]
            if stray:
                lines[-every // 2] = str(7 + 90 * k)
        return lines

    facts = [(kind, f) for n in range(4, 9) for every in (12, 16, 20) for stray in (True, False) for _, kind, f in scans.line_facts(paper(n, every, stray))]
    taker = scans.train_taker(scans.Material(lines=facts))
    lines = paper(7, 14, True)
    assert scans.furniture(lines, taker)[0] == {i for i, x in enumerate(lines) if x.isdigit() and 100 <= int(x) < 107 and i % 14 == 13}
    assert any("before=" in f or "after=" in f for f in taker.weights)
    assert scans.furniture(lines, scans.Perceptron()) == (set(), set()) and scans.train_taker(scans.Material()) is None


def test_words_that_exist_are_kept(spark):
    lines = [" ".join(random.Random(i).sample([*PROSE, "down", "tin"], len(PROSE) + 2)) for i in range(40)]
    lines[3] += " clown fin"
    lines[4] += " clown fin"
    scanned = "The membrane moved clown during secre-\ntion of the protein and the signal was changed fin\nsome days becausc the rnembrane moved clovvn after\nthe signal and the tlle receptor returned withiri days."
    papers = docs(spark, [*lines, scanned], text="marker_md").distinct()
    once_only = docs(spark, ["down"] * 5 + ["clown"], text="marker_md")
    assert scans.lexicon_of(papers, "doc_id", "marker_md")[0].attested == {"clown", "fin"} and not scans.lexicon_of(once_only, "doc_id", "marker_md")[0].attested
    model = scans.fit(papers)
    assert [x[1:] for x in rows(scans.scan_noise(papers, model=model))] == [(1, "hyphen"), (3, "misread"), (4, "misread")]
    text = scans.mended(papers, model=model).first()["text"]
    assert "moved clown during" in text and "changed fin some" in text and "because the membrane" in text and "within days" in text


def test_all_papers_teach_the_model(spark, monkeypatch):
    """Two of many papers attest a word, wherever they lie, and trainings on shards make one editor."""
    names = [f"Re{c}ceptor" for c in "abdfghijklmnoqstuvwxyz"]
    texts = [" ".join(PROSE)] * 9000
    for k, name in enumerate(names):
        texts[400 * k] += f" {name}."
        texts[400 * k + 1] += f" ({name})"
    texts[17] += "\n```\nReaaceptor\n```\n| Reaaceptor |\nReceptorr-Kelnor"
    texts += ["The receptor moved during secre-\ntion of the protein and the signal was changed within\nsome days becausc the rnembrane moved after " + names[0]]
    papers = docs(spark, texts, text="marker_md")
    lexicon, _ = scans.lexicon_of(papers, "doc_id", "marker_md")
    clean = {(r["kind"], r["a"]): r["flag"] for r in scans.clean_material(papers, "doc_id", "marker_md", lexicon).collect()}
    assert {a: flag for (kind, a), flag in clean.items() if kind == "right"} == {**dict.fromkeys(names, True), "Receptorr": False}
    monkeypatch.setattr(scans, "SHARD", 10)
    model = scans.fit(papers)
    assert {n.lower() for n in names} <= model.lexicon.attested
    assert [x[1:] for x in rows(scans.scan_noise(papers, model=model))] == [(1, "hyphen"), (3, "misread")] and len(clean) > 20


def test_page_values():
    assert [scans.page_value(x) for x in ("12", "xiv", "IX", "iv")] == [12, 14, 9, 4]


def pages_of(*numbers):
    """Line numbers of the pages found when each number stands after two lines of text."""
    lines = [x for n in numbers for x in ("Some text of the page that goes on", "and on without an end", n)]
    assert all(lines[i] in numbers for i in scans.furniture(lines)[0])
    return [lines[i] for i in sorted(scans.furniture(lines)[0])]


@pytest.mark.parametrize(
    "numbers",
    [("xxiii", "xxiv", "xxv", "i"), ("xxiv", "xxv", "i", "ii", "iii", "iv"), ("xxv", "i", "ii"), ("7", "8", "1", "2", "3"), ("12", "13", "15", "16"), ("4", "7", "8"), ("12", "13", "18", "15", "16"), ("5", "6", "— 31 —", "Page 77")],
)
def test_all_page_numbers(numbers):
    assert pages_of(*numbers) == list(numbers)


def test_page_numbers_beside_headers():
    lines = "# A Title of Some Length\n\nText of it\n12\nmore text\n13  A TITLE OF SOME LENGTH\nlast text".split("\n")
    assert scans.furniture(lines) == ({3}, {5})


def test_other_numbers_stay():
    assert pages_of("7", "8", "90", "9") == ["7", "8", "9"] and pages_of("90", "3") == [] and pages_of("42") == []
    assert scans.furniture(["Axis", "2", "4", "6", "8", "text"])[0] == set()


MARKED = ["pg. {}", "Seite {}", "s. {}", "{} of 12", "{} von 12", "| {}", "• {} •", "-- {} --", "[({})]", "\t{}\u00a0", "{}\r", "{}\tA TITLE OF SOME LENGTH", "{} | A TITLE OF SOME LENGTH", "A TITLE OF SOME LENGTH|{}", "A TITLE OF SOME LENGTH\t{}", "iv  A TITLE OF SOME LENGTH"]


def test_filter_passes_all_scanned_papers(spark):
    papers = ["# A Title of Some Length\n" + "".join(f"the text of the page goes on and on here\nand goes on in small letters and does so\nuntil its end\n{form.format(n)}\n" for n in (3, 4)) for form in MARKED]
    papers.append("the text of the page goes on with 2-\nhydroxy acids and others\n" * 3)
    expected = {i for i, t in enumerate(papers) if scans.Page(t).scanned}
    found = {r["doc_id"] for r in docs(spark, papers, text="marker_md").where(scans._suspect(F.col("marker_md"))).collect()}
    assert len(expected) >= len(MARKED) - 1 and expected <= found
    clean = docs(spark, ["Plain text\n\n| a | 3 |\n|---|---|\nin 2010 we saw 3 mice\n\n---\n\nend", ""], text="marker_md")
    assert rows(clean.where(scans._suspect(F.col("marker_md")))) == []


def test_papers_are_judged_once(spark, monkeypatch):
    """One search of the texts for signs of scanned pages serves the words, the material and the result."""
    asked, suspect = [], scans._suspect
    monkeypatch.setattr(scans, "_suspect", lambda text: asked.append(text) or suspect(text))
    scanned = "The membrane moved during secre-\ntion of the protein and the signal was changed within\nsome days becausc the rnembrane moved after"
    papers = docs(spark, [" ".join(PROSE)] * 40 + [scanned, None, ""], text="marker_md")
    assert [x[1:] for x in rows(scans.scan_noise(papers))] == [(1, "hyphen"), (3, "misread")] and len(asked) == 1


def test_first_patterns_spare_no_suspect(spark):
    draw = random.Random(5)
    signs = [*"aaabbEZvi19 \n\n--¬‐\xad|_\t  \x85,Ωя٣𝐚😀ǅ\r\u2028"]
    texts = docs(spark, ["".join(draw.choices(signs, k=draw.randrange(4, 60))) for _ in range(20000)]).distinct()
    for first, *others in scans._SUSPECT:
        for other in others:
            found = texts.where(F.col("text").rlike(other))
            assert found.count() > 100 and found.where(~F.col("text").rlike(first)).count() == 0
    assert sum(len(patterns) > 1 for patterns in scans._SUSPECT) == 2


def test_common_words_give_no_material(spark, monkeypatch):
    """What is left out before words are counted gives nothing after, however many words are left out."""
    texts = [" ".join(PROSE) + f" Membrane {w} The-{w} well-known PROTEIN proteinn" for w in ("receptorr", "signall", "Daysx")] * 3
    papers = docs(spark, texts, text="marker_md")
    lexicon, _ = scans.lexicon_of(papers, "doc_id", "marker_md")
    material = rows(scans.clean_material(papers, "doc_id", "marker_md", lexicon))
    assert material and {"membrane", "protein"} <= lexicon.common
    for n in (0, 3):
        monkeypatch.setattr(scans, "PASSED", n)
        assert rows(scans.clean_material(papers, "doc_id", "marker_md", lexicon)) == material


# 7: markup

RESIDUE = ["a <b>c</b>", "x &amp; y", "<!-- image -->", "see [[Link|link]] here", "{{cite|1}} x", "the '''bold''' word", "== Title ==", r"\section{A}", r"a \textbf{b}", r"{\it c}", "<br/>", "(\\ref{f:1}) x"]
CLEAN = ["3 < 5 and n > 4, R&D for $5 to $9", "`<div>` and `\\textbf`", r"$E = \frac{a}{b}$ holds", r"$$ \sqrt{2} $$", "[link](x) *a* **b**", "| a | b |", "> quote", "it's, isn't", "[1] [a][b]", "# Head", "a == b", "a & b; c"]


RESIDUE_OF = markup.Classifier.fitted(["Loss of the protein was seen in 3 % of the cells", "| a | b |", "Smith & Jones wrote", "* one", "# Title"])


def residue_of(text, **more):
    return markup.residue_lines(text, RESIDUE_OF, **more)


def test_residue_lines():
    for line in RESIDUE:
        assert residue_of(f"before\n\n{line}\n\nafter") == [3], line
    for line in CLEAN:
        assert residue_of(f"before\n\n{line}\n\nafter") == [], line
    assert residue_of("```\n<b>x</b>\n```\n<i>y</i>\n$$\n\\alpha\n$$") == [4]


@pytest.mark.parametrize(
    "block, alone",
    [
        ("<!-- a\nb\nc d\ne\nf\ng\n-->", [1, 7]),
        ("{| class=wikitable\n! one\n! two\n|-\n| a\n| b\n|}", [1, 4, 7]),
        ("\\begin{tabular}{ll}\na & b \\\\\nc & d\n\\end{tabular}", [1, 2, 4]),
    ],
)
def test_the_cut_takes_doubtful_lines(block, alone):
    """Lines that say little by themselves go with what they stand in; without the edges of the graph they are lost."""
    n = block.count("\n") + 1
    text = f"{block}\n\n| a | b |\n|---|---|\n\nSmith & Jones\n\n! no\n\n<div>\nplain words\n</div>"
    tags = [n + 9, n + 11]
    assert residue_of(text) == [*range(1, n + 1), *tags]
    assert residue_of(text, tied=False) == [*alone, *tags]


def test_open_comments_take_linear_time():
    import time

    def took(n):
        start = time.perf_counter()
        for text in ("<!-- x\n" * n, "<!-- x\n" * n + "-->", "<b>\n" * n, "</b>\n" * n, "<i>\n</b>\n" * n, "{|\n" * n, "<table>\n" * n + "x\n" * n + "</table>\n" * n, "<table>\n" + "x\n" * n + "</table>"):
            residue_of(text)
        return time.perf_counter() - start

    took(200)
    assert took(8_000) < 12 * took(2_000) + 0.5


def test_minimum_cut_against_all_cuts():
    draw = random.Random(1)
    for _ in range(60):
        n = draw.randrange(1, 7)
        source, sink = [draw.choice((0, 2, 5, 8)) for _ in range(n)], [4.0] * n
        edges = [(a, b, draw.choice((0.5, 1.5, 3.0))) for a, b in itertools.combinations(range(n), 2) if draw.random() < 0.5]
        cost = lambda s: sum(sink[i] if s[i] else source[i] for i in range(n)) + sum(w for a, b, w in edges if s[a] != s[b])  # noqa: B023, E731
        assert cost(markup._minimum_cut(source, sink, edges)) == min(map(cost, itertools.product((False, True), repeat=n)))


def test_clean_keeps_structure(spark):
    text = "<h2>Head</h2>\n\n<ul>\n<li>one</li>\n<li>two\n</ul>\n\n<table><tr><td>a</td><td>1</td></tr><tr><td>b</td><td>2</td></tr></table>\n\n```\n<b>\n```\n\n\\begin{itemize}\n\\item x &amp; y\n\\end{itemize}\n\n$a<b$ and [[A|b]]"
    assert markup.clean(text, RESIDUE_OF) == "## Head\n\n- one\n- two\n\n| a | 1 |\n|---|---|\n| b | 2 |\n\n```\n<b>\n```\n\n- x & y\n\n$a<b$ and b"
    kept = "two  spaces\xa0here &\n\n<i>x</i>\n\nand  here"
    assert markup.clean(kept, RESIDUE_OF) == kept.replace("<i>x</i>", "*x*")  # what is not labelled stays letter by letter
    df = spark.createDataFrame([(1, "<i>x</i>", None, "c"), (2, None, "", "c"), (3, "plain", "&lt;", "c")] * 2, "doc_id long, marker_md string, docling_md string, field string")
    assert rows(markup.residue(df)) == [("docling_md", 3, 1), ("marker_md", 1, 1)]
    assert rows(markup.cleaned(df)) == [("docling_md", 2, ""), ("docling_md", 3, "<"), ("marker_md", 1, "*x*"), ("marker_md", 3, "plain")]


# 8: tokens


def test_tokens_round_trip(spark):
    from tokenizers import Tokenizer

    texts = ["Hello world, it's 2024!", "", None, "  \n\n x  y", "naïve 你好 привет 😀", "aaaaaaa aaaa", "<|endoftext|>", "ab" * 900, "don't\tstop\r\n"]
    encoded = tokens.encode(docs(spark, texts))
    got = {r["doc_id"]: r["ids"] for r in encoded.collect()}
    reference = Tokenizer.from_file(f"{tokens.TOKENIZERS}/byte_bpe_50k.json")
    reference.encode_special_tokens = True
    assert got == {i: reference.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(texts)}
    assert {r["doc_id"]: r["text"] for r in tokens.decode(encoded).collect()} == {i: t or "" for i, t in enumerate(texts)}


# 9: leaks


def test_leaks(spark):
    item = " ".join(f"w{i}" for i in range(20))
    texts = ["Intro. W3, w4; " + " ".join(f"w{i}" for i in range(5, 15)) + "! End", " ".join(f"w{i}" for i in range(11)), None, "", item + " x " + item]
    items = spark.createDataFrame([(7, item, "c"), (8, "too short", "c"), (9, None, "c")] * 2, "item_id long, text string, doc_id string")
    papers = docs(spark, texts)
    assert rows(leaks.leaks(papers, items)) == [(0, 7), (4, 7)]
    assert {r["doc_id"]: r["text"] for r in leaks.without_leaks(papers, items).collect()} == {0: "Intro. ! End", 1: texts[1], 2: None, 3: "", 4: " x "}
    assert rows(leaks.leaks(papers.where("false"), items)) == rows(leaks.leaks(papers, items.where("false"))) == []


# 10: sentences

SENTENCES = [
    "Dr. Fennark saw 2.5 mg of X vs. controls, e.g. in yeast. |At 5 p.m. XAH86 was added. |They tested salt, etc. |The end.",
    "He said \"it is not so.\" |Then he left. |\"Why?\" asked Prof. Smith. |The label read \"Keep dry. Keep dark.\" in print.",
    "Is it known?! |h23 was lost. |The signal faded... then came back. |(See also Sect. 2.1 for Xelor.) |J. K. Nahinnd came from the U.S. and left.",
    "Am 3. Okt. 19 Uhr kam er, d. h. spät. |„Warum?“, fragte Dr. X. |Er nennt es „zu schwach.“ |Gilt das auch?",
    "« Le signal a disparu ! » écrit Mme Lumark. |Selon M. Yvel, env. 3 h.",
    "Проф. Ladark (см. стр. 2) измерил Peljor. |«Сигнал исчез!» — пишет д-р Pelulck. |Образцы, т. е. клетки, хранили 7 ч. |Как?",
    "报告写道：“没有变化。”|真的吗？！|“去哪了？”审稿人问道。|先下降……随后恢复。",
    "「消えた。」と書いた。|本当なのか？",
    "كتب المراجع: «لم يتغير.» |هل اختفى؟ |قاس د. X مستوى.",
    "डॉ. X ने मापा। |प्रो. Y ने कहा, “स्थिर है।” |क्या?",
    "ผลนี้ตรง |GSJจับกับTRN",
]


def shuffled(seed, n):
    """Documents of paragraphs in which the marked sentences stand in random order, with the sentences meant."""
    draw = random.Random(seed)
    out = []
    for _ in range(n):
        own = [s for _ in range(3) for s in draw.sample(SENTENCES[:2] + SENTENCES[3:6], 2)]
        parts = [draw.sample([x.strip() for x in s.split("|")], s.count("|") + 1) for s in own]
        out.append(("\n\n".join(" ".join(p) for p in parts), [x for p in parts for x in p]))
    return out


@pytest.fixture(scope="module")
def told(spark):
    df = docs(spark, [t for t, _ in shuffled(1, 150)] + ["|".join(SENTENCES).replace("|", "\n\n")] * 30)
    kinds = sentences.corpus_abbreviations(df).collect()
    return sentences._corpus([(r["word"], r["kind"]) for r in kinds], frozenset(r["word"] for r in sentences.usual_starts(df).collect()))


def test_corpus_evidence(told):
    assert {"dr", "проф", "стр", "sect"} <= told.never and {"vs", "см"} <= told.other and "h" in told.may and not {"etc", "yeast", "end", "added", "spät"} & (told.never | told.may | told.other)


@pytest.mark.parametrize("marked", SENTENCES)
def test_sentences(marked, told):
    text = marked.replace("|", "")
    assert [text[a:b] for a, b in sentences.Splitter(text, told).spans()] == [s.strip() for s in marked.split("|")]


def right_share(corpus, blind=False):
    right = total = 0
    for text, meant in shuffled(2, 40):
        splitter = sentences.Splitter(text, corpus)
        if blind:
            splitter.inside, splitter.last, splitter.small_words = set(), set(), set()
        got = [text[a:b] for a, b in splitter.spans()]
        total, right = total + len(meant), right + sum(1 for x in meant if x in got)
    return right / total


def test_evidence_decides(told):
    assert right_share(told) > 0.99 and right_share(sentences.Corpus()) < 0.7 and right_share(sentences.Corpus(), blind=True) < 0.7


def test_document_comes_before_the_corpus():
    text = "Keep the abz. low, and the abz. high. The abz. It was so."
    ends = lambda c: [text[a:b] for a, b in sentences.Splitter(text, c).spans()]
    assert ends(sentences.Corpus())[1] == "The abz. It was so."
    assert ends(sentences.Corpus(starts=frozenset({"It"})))[1:] == ["The abz.", "It was so."]


def test_long_texts_without_ends_take_linear_time():
    import time

    def took(n):
        start = time.perf_counter()
        for text in ("word vs. " * n, '"open ' * n, "„open " * n, "ก ข" * n, "a.a" * n):
            sentences.Splitter(text, sentences.Corpus(never=frozenset({"vs"}))).spans()
        return time.perf_counter() - start

    took(500)
    assert took(16_000) < 12 * took(4_000) + 0.5


def test_sentence_rows(spark):
    texts = ["A one. B two.\r\n\r\nTable 4\n\n\nlast line\nwith break. End", None, "", " \n ", "😀 Yes. No.", "x" * 50_000]
    got = sentences.sentences(docs(spark, texts)).select("doc_id", "sentence").collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r["sentence"])
    assert by == {0: ["A one.", "B two.", "Table 4", "last line\nwith break.", "End"], 4: ["😀 Yes.", "No."], 5: ["x" * 50_000]}
    assert all(texts[r["doc_id"]][r["start_pos"] : r["end_pos"]] == r["sentence"] for r in sentences.sentences(docs(spark, texts)).collect())


def test_empty_tables(spark):
    nothing = docs(spark, ["x"]).where("false")
    papers = nothing.withColumnRenamed("text", "marker_md").withColumn("docling_md", F.col("marker_md"))
    runs = spark.createDataFrame([], "doc_id long, journal string")
    heads = spark.createDataFrame([], "doc_id long, headings array<struct<text:string>>")
    records = spark.createDataFrame([], "field string, id long, raw string")
    sets = spark.createDataFrame([], "id long, hashes array<bigint>")
    for result in (
        furniture.without_repeated_lines(papers, runs), neardup.groups(sets, 0.6), lookalike.unify(records), split.pieces(papers, heads), scans.mended(papers), markup.residue(papers), markup.cleaned(papers),
        tokens.encode(nothing), tokens.decode(tokens.encode(nothing)), leaks.without_leaks(nothing, nothing.withColumnRenamed("doc_id", "item_id")), sentences.sentences(nothing),
    ):
        assert result.count() == 0


def test_hot_rows(spark):
    """A third of all rows are one text under many ids, or one id: results stay whole."""
    same = "Dr. Smith saw the protein.\n\nIt was gone!\n\nThe end."
    texts = [same] * 40 + [f"Text number {i} is here. It ends." for i in range(80)]
    df = docs(spark, texts)
    assert sentences.sentences(df).where("doc_id < 40").groupBy("doc_id").count().where("count = 3").count() == 40
    assert tokens.encode(df).where("doc_id < 40").select("ids").distinct().count() == 1
    items = df.select(F.col("doc_id").alias("id"), words(F.col("text")).alias("ws")).select("id", window_hashes(F.col("ws"), 3).alias("hashes"))
    grouped = neardup.groups(items, 0.99).where("id < 40")
    assert grouped.select("group_id").distinct().count() == 1 and grouped.count() == 40
    one_id = df.withColumn("doc_id", F.when(F.col("doc_id") < 40, F.lit(0)).otherwise(F.col("doc_id")))
    assert sentences.sentences(one_id).where("doc_id = 0").count() == 3 and tokens.encode(one_id).count() == 81
