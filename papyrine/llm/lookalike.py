"""Problem 4: one form for texts that look the same but hold other characters."""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papyrine.operators.deliveries import distinct_rows
from papyrine.session import broadcast_if_small, checkpoint, spread

#: Words, and keys of texts, up to which they are broadcast.
MAX_BROADCAST = 1_000_000

#: Letters of the shape of a Latin letter, by script. Fixed values of their shapes.
CYRILLIC = dict(zip("аеорсухіјѕԁһԛԝүѵӏАВЕКМНОРСТУХІЈЅԌԚԜҮѴӀ", "aeopcyxijsdhqwyvlABEKMHOPCTYXIJSGQWYVI"))
GREEK = dict(zip("οΑΒΕΖΗΙΚΜΝΟΡΤΥΧϲϳνϹͿϺϜ", "oABEZHIKMNOPTYXcjvCJMF"))
ARMENIAN = dict(zip("օսոհցՕՍ", "ounhgOU"))
LOOKS = CYRILLIC | GREEK | ARMENIAN

#: Signs of no width, besides those of category Cf.
NO_WIDTH = {0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180E, *range(0x180B, 0x180E), *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)}

#: Compatibility forms that a reader can tell from their plain form.
VISIBLE = {0x017F, 0x03D0, 0x03D1, 0x03D5, 0x03D6, 0x03F0, 0x03F1, 0x00AA, 0x00BA}


@cache
def _plain_table() -> dict[int, str]:
    """What replaces a character on its own, from its Unicode properties."""
    table: dict[int, str] = {}
    for cp in range(0x80, sys.maxunicode + 1):
        c = chr(cp)
        kind = unicodedata.category(c)
        if cp in NO_WIDTH or kind == "Cf" and not 0x600 <= cp <= 0x8FF:
            table[cp] = ""
        elif kind == "Zs":
            table[cp] = " "
        elif cp not in VISIBLE and unicodedata.decomposition(c).startswith(("<wide>", "<narrow>", "<compat>", "<noBreak>")):
            full = unicodedata.normalize("NFKC", c)
            if not full.startswith(" "):  # spacing accents stay
                table[cp] = full
    table[0x2010] = table[0x2011] = "-"
    return table


def plain(text: str) -> str:
    """Composed, with ordinary blanks, letters, signs and digits, and without invisible characters."""
    if text.isascii():
        return text
    return unicodedata.normalize("NFC", unicodedata.normalize("NFC", text).translate(_plain_table()))


_LOOKS = str.maketrans(LOOKS)

#: Letters to be looked at: the look-alikes, those that are one of them with an accent, and all of the scripts whose words may hold Latin letters.
_ALIKE = "".join(c for c in map(chr, range(0x370, 0x590)) if unicodedata.normalize("NFD", c)[0] in LOOKS)
SUSPECT = "".join(c for c in _ALIKE if c < "Ѐ") + "Ѐ-\u058f"
_FOREIGN = re.compile(f"[{_ALIKE}]")
_SUSPECT = re.compile(f"[{SUSPECT}]")

#: Script -> Latin letter -> its letter of that shape, the more usual one of two. Greek letters beside Latin ones are signs, not words.
_BACK = {script: str.maketrans({latin: c for c, latin in reversed(looks.items())}) for script, looks in (("CYRILLIC", CYRILLIC), ("ARMENIAN", ARMENIAN))}
_LETTER = re.compile(r"[^\W\d_]")


def _script(c: str) -> str:
    return "LATIN" if c < "ɐ" else unicodedata.name(c, "").split(" ")[0]


def dominant_script(text: str) -> str:
    """The script of most letters; Latin in a tie and without letters."""
    count: dict[str, int] = {"LATIN": 0}
    for c in _LETTER.findall(text):
        s = _script(c)
        count[s] = count.get(s, 0) + 1
    return max(count, key=lambda s: (count[s], s == "LATIN"))


def candidate(token: str, around: str) -> str | None:
    """The token in Latin letters where it mixes scripts, or is foreign to a Latin text; null if no look-alike is to be replaced."""
    if not _FOREIGN.search(token):
        return None
    scripts = {_script(c) for c in _LETTER.findall(token)}
    if "LATIN" in scripts or around == "LATIN":
        return unicodedata.normalize("NFC", unicodedata.normalize("NFD", token).translate(_LOOKS))
    return None


def native(token: str) -> str | None:
    """The token wholly in the script that its letters without a Latin shape are of; null if it has none or a Latin letter has no such shape."""
    letters = _LETTER.findall(unicodedata.normalize("NFD", token))
    own = {_script(c) for c in letters if c not in LOOKS} - {"LATIN"}
    script = own.pop() if len(own) == 1 else ""
    if script not in _BACK or any(_script(c) != script and ord(c) not in _BACK[script] for c in letters):
        return None
    return unicodedata.normalize("NFC", unicodedata.normalize("NFD", token).translate(_BACK[script]))


@F.pandas_udf(T.StringType())
def _plain_udf(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else plain(t))


def repairs(token: str, around: str) -> list[str | None]:
    """Up to two forms of a token to be tried in turn: towards the script of most of its own letters first."""
    latin, own = candidate(token, around), native(token)
    if latin is None and own is None:
        return [None, None]
    first = [latin, own] if dominant_script(token) == "LATIN" else [own, latin]
    forms = [x for x in dict.fromkeys(first) if x is not None]
    return [*forms, None, None][:2]


@F.pandas_udf(T.ArrayType(T.ArrayType(T.StringType())))
def _repairs_udf(text: pd.Series) -> pd.Series:
    def of(t: str) -> list[list[str | None]] | None:
        if not _SUSPECT.search(t):
            return None
        around = dominant_script(t)
        return [[None, None] if token.isascii() else repairs(token, around) for token in t.split(" ")]

    return text.map(of)


def _formed(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows in plain form that need no repair, other ones with their tokens' repairs), each ``field, id, raw, text`` once.

    ASCII texts are in plain form already and never leave the JVM; the others, a small part, are brought
    to it once.
    """
    src = distinct_rows(records.select("field", "id", "raw").where("raw is not null and id is not null"))
    ascii_only = F.col("raw").rlike(r"\A[\x00-\x7F]*\z")
    formed = spread(src.where(~ascii_only), "id").select("field", "id", "raw", _plain_udf("raw").alias("text"))
    formed = checkpoint(formed.select("*", _repairs_udf("text").alias("_repairs")))
    as_they_are = src.where(ascii_only).select("field", "id", "raw", F.col("raw").alias("text"))
    return as_they_are.unionByName(formed.where("_repairs is null").drop("_repairs")), formed.where("_repairs is not null")


def _mended(clean: DataFrame, foreign: DataFrame) -> DataFrame:
    """The foreign rows with the repairs that the vocabulary of the corpus knows: tokens of another text, in whatever spelling.

    Only tokens that have a repair meet the vocabulary, and of it only the words that are asked for, each
    reduced to the texts that have it before the shuffle.
    """
    tokens = foreign.select("field", "id", "raw", F.posexplode(F.arrays_zip(F.split("text", " ", -1).alias("t"), F.col("_repairs").alias("c"))).alias("_at", "_z"))
    tokens = tokens.select("field", "id", "raw", "_at", F.col("_z.t").alias("_token"), F.col("_z.c")[0].alias("_first"), F.col("_z.c")[1].alias("_second"))
    asked = tokens.select(F.explode(F.array("_first", "_second")).alias("_v")).where("_v is not null").distinct()
    of_text = F.xxhash64("field", "raw")
    spelled = clean.select(F.explode(F.split("text", " ", -1)).alias("_v"), of_text.alias("_of"))
    spelled = spelled.unionByName(tokens.select(F.explode(F.array(F.coalesce("_first", "_token"), "_second")).alias("_v"), of_text.alias("_of")).where("_v is not null"))
    known = spelled.join(broadcast_if_small(asked, MAX_BROADCAST), "_v", "left_semi").groupBy("_v").agg(F.min("_of").alias("_lo"), F.max("_of").alias("_hi")).where("_lo <> _hi").select("_v")
    known = checkpoint(known)
    repaired = tokens.where("_first is not null")
    for column in ("_first", "_second"):
        found = broadcast_if_small(known.select(F.col("_v").alias(column), F.lit(True).alias(f"{column}_known")), MAX_BROADCAST)
        without = repaired.where(F.col(column).isNull()).withColumn(f"{column}_known", F.lit(None).cast("boolean"))
        repaired = repaired.where(F.col(column).isNotNull()).join(found, column, "left").unionByName(without)
    chosen = F.when(F.col("_first_known"), F.col("_first")).when(F.col("_second_known"), F.col("_second")).otherwise(F.col("_token"))
    parts = tokens.where("_first is null").select("field", "id", "raw", "_at", F.col("_token").alias("_t")).unionByName(repaired.select("field", "id", "raw", "_at", chosen.alias("_t")))
    whole = parts.groupBy("field", "id", "raw").agg(F.sort_array(F.collect_list(F.struct("_at", "_t"))).alias("_ts"))
    return whole.select("field", "id", "raw", F.array_join(F.transform("_ts", lambda x: x["_t"]), " ").alias("text"))


def unify(records: DataFrame) -> DataFrame:
    """``field, id, raw`` -> ``field, id, raw, text`` in one form, each (field, id, raw) once; null texts are left out.

    First every character is brought to its plain form. Then tokens that mix scripts, or stand in
    letters of another script within a Latin text, have their look-alike letters replaced, towards the
    script of most of their letters first, when the result occurs in the corpus vocabulary.
    """
    clean, foreign = _formed(records)
    return clean.unionByName(_mended(clean, foreign))


def lookalike_pairs(records: DataFrame) -> DataFrame:
    """``field, id_a, id_b`` of records in one unified form that differ in a code point, id_a < id_b.

    Of two such records at least one was changed, so only texts equal to the form of a changed record are
    looked at. Spellings are paired first, each once, so that copies of one spelling never meet; their
    records follow because the result lists them.
    """
    clean, foreign = _formed(records)
    mended = checkpoint(_mended(clean, foreign))
    key = F.xxhash64("field", "text").alias("_key")
    changed = clean.unionByName(mended).where("raw <> text").select(key).distinct()
    some = clean.unionByName(mended).withColumn("_key", key).join(broadcast_if_small(changed, MAX_BROADCAST), "_key", "left_semi")
    some = checkpoint(some.select("field", "text", "raw", "id").distinct())
    spellings = some.select("field", "text", "raw").distinct()
    a, b = (spellings.select("field", "text", F.col("raw").alias(f"_r{x}")) for x in "ab")
    pairs = a.join(b, ["field", "text"]).where("_ra < _rb").select("field", "text", "_ra", "_rb")
    for x in "ab":
        pairs = pairs.join(some.select("field", "text", F.col("raw").alias(f"_r{x}"), F.col("id").alias(f"_i{x}")), ["field", "text", f"_r{x}"])
    return pairs.where("_ia <> _ib").select("field", F.least("_ia", "_ib").alias("id_a"), F.greatest("_ia", "_ib").alias("id_b")).distinct()
