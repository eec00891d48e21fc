"""Regular expressions that mean the same in Spark and in SQL engines without lookaround.

Blanks, digits and word characters are spelled out as Unicode classes, so no engine's own idea of them
matters; only a line feed ends a line. A rewrite is a list of (pattern, replacement) steps in order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bodies of character classes: blanks, and blanks within a line.
BLANKS = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
INLINE = BLANKS.replace(r"\t-\r", r"\t\x{b}-\r")
S, SI, NS = f"[{BLANKS}]", f"[{INLINE}]", f"[^{BLANKS}]"
D = r"\p{Nd}"

Rules = Sequence[tuple[str, str]]

STRIP: Rules = [(rf"\A{S}+", ""), (rf"{S}+\z", "")]


def java(pattern: str) -> str:
    """Line anchors of the multi-line mode see line feeds only."""
    return pattern.replace("(?m)", "(?md)").replace("(?im)", "(?imd)")


def rewrite(text: Column, rules: Rules) -> Column:
    for pattern, by in rules:
        text = F.regexp_replace(text, java(pattern), by)
    return text


def strip(text: Column) -> Column:
    return rewrite(text, STRIP)


def strip_stars(text: Column) -> Column:
    """Without blanks, then asterisks, then blanks at both ends."""
    return strip(F.btrim(strip(text), F.lit("*")))


def matches(text: Column, pattern: str) -> Column:
    return text.rlike(java(pattern))


def count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(java(pattern)))


def extract_all(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(text, F.lit(java(pattern)), group)


def lines(text: Column) -> Column:
    """The lines of a text; a line feed at its end begins none."""
    return F.split(F.regexp_replace(text, r"\n\z", ""), "\n", -1)


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, also inside functions over arrays."""
    return F.get(F.transform(F.array(value), lambda x: then(x)), F.lit(0))


def _feeds(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))


def located(text: Column, pattern: str, groups: Sequence[int] = (0,)) -> Column:
    """All matches as structs ``start, end, line, g0, g1, ...``: offsets of code points from 0, lines from 1.

    The text is searched once for each group; a fold over what lies between the matches adds up the
    places, so that nothing is searched again for each match.
    """
    names = [f"g{g}" for g in dict.fromkeys([0, *groups])]
    found = [extract_all(text, pattern, int(n[1:])).alias(n) for n in names]
    parts = F.arrays_zip(F.split(text, java(pattern), -1).alias("gap"), *found)
    kind = "struct<start:int,end:int,line:int," + ",".join(f"{n}:string" for n in names) + ">"

    def step(acc: Column, z: Column) -> Column:
        start, line = acc["at"] + F.length(z["gap"]), acc["line"] + _feeds(z["gap"])
        hit = F.struct(start.alias("start"), (start + F.length(z["g0"])).alias("end"), line.alias("line"), *[z[n].alias(n) for n in names]).cast(kind)
        return F.when(z["g0"].isNull(), acc).otherwise(
            F.struct((start + F.length(z["g0"])).alias("at"), (line + _feeds(z["g0"])).alias("line"), F.concat(acc["out"], F.array(hit)).alias("out")),
        )

    nothing = F.struct(F.lit(0).alias("at"), F.lit(1).alias("line"), F.array().cast(f"array<{kind}>").alias("out"))
    return F.aggregate(parts, nothing, step, lambda acc: acc["out"])


def first_of_each(items: Column, key: str, kind: str) -> Column:
    """The items of an array whose ``key`` did not come before."""
    return F.aggregate(items, F.array().cast(f"array<{kind}>"), lambda acc, x: F.when(F.exists(acc, lambda y: y[key] == x[key]), acc).otherwise(F.concat(acc, F.array(x.cast(kind)))))


def yaml_str(value: Column) -> Column:
    """A value as front matter shows it: a quoted string, a list of them on lines of their own, ``null`` for null and empty ones."""
    quote = lambda x: F.regexp_extract(F.to_json(F.struct(x.alias("x"))), r"(?s)\A\{\"x\":(.*)\}\z", 1)
    return F.coalesce(F.nullif(quote(F.nullif(value.cast("string"), F.lit(""))), F.lit("")), F.lit("null"))


def yaml_list(values: Column) -> Column:
    listed = F.transform(values, lambda x: F.concat(F.lit("\n  - "), yaml_str(x)))
    return F.when(F.size(values) > 0, F.array_join(listed, "")).otherwise(F.lit("null"))


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_rewrite(text: str, rules: Rules) -> str:
    """The rewrite as a SQL expression."""
    for pattern, by in rules:
        by = by.replace("$1", r"\1").replace("$2", r"\2").replace("$3", r"\3")
        text = f"regexp_replace({text}, {quoted(pattern)}, {quoted(by)}, 'g')"
    return text


def sql_strip(text: str) -> str:
    return sql_rewrite(text, STRIP)


def sql_strip_stars(text: str) -> str:
    return sql_strip(f"trim({sql_strip(text)}, '*')")


def sql_count(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, {quoted(pattern)}))"


def sql_lines(text: str) -> str:
    return f"string_split(regexp_replace({text}, '\\n\\z', ''), chr(10))"
