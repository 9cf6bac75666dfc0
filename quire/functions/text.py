"""Text functions as Column expressions: everything here stays in the JVM's generated code.

Python's ``\\w`` and ``\\s`` are spelled out as classes, because Java's own are ASCII or differ.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The 29 white-space code points that Python's ``str.split`` knows (fixed value).
WS = r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WORD = r"\p{L}\p{N}_"
TOKEN = rf"[{WORD}]+|[^{WORD}{WS}]"

#: Letters and digits of Unicode 14 and 15, which the regular expressions of Java 17 don't know (hexadecimal).
_LATER = """
870-887 889-88e 8b5 8c8-8c9 c5d cdd 170d 171f 1b4c 2c2f 2c5f 9ffd-9fff a7c0-a7c1 a7d0-a7d1 a7d3 a7d5-a7d9 a7f2-a7f4 10570-1057a 1057c-1058a
1058c-10592 10594-10595 10597-105a1 105a3-105b1 105b3-105b9 105bb-105bc 10780-10785 10787-107b0 107b2-107ba 10f70-10f81 11071-11072 11075
1123f-11240 11740-11746 11ab0-11abf 11f02 11f04-11f10 11f12-11f33 11f50-11f59 12f90-12ff0 1342f 13441-13446 16a70-16abe 16ac0-16ac9
1aff0-1aff3 1aff5-1affb 1affd-1affe 1b11f-1b122 1b132 1b155 1d2c0-1d2d3 1df00-1df1e 1df25-1df2a 1e030-1e06d 1e290-1e2ad 1e4d0-1e4eb
1e4f0-1e4f9 1e7e0-1e7e6 1e7e8-1e7eb 1e7ed-1e7ee 1e7f0-1e7fe 2a6de-2a6df 2b735-2b739 31350-323af
"""
LATER = "".join("-".join(rf"\x{{{c}}}" for c in r.split("-")) for r in _LATER.split())

#: Names that a file may not have on some systems (fixed values).
RESERVED = ["CON", "PRN", "AUX", "NUL", "COM1", "LPT1"]


def count_matches(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def tokens(text: Column) -> Column:
    """Approximate tokens: word runs and single other marks."""
    return count_matches(text, TOKEN)


def conservative_tokens(text: Column) -> Column:
    """An upper estimate: tokens, a quarter of the UTF-8 bytes, or the non-ASCII non-space characters."""
    wide = count_matches(text, rf"[^\x00-\x7f{WS}]")
    return F.greatest(tokens(text).cast("long"), F.ceil(F.octet_length(text) / 4), wide.cast("long"))


def strip(text: Column) -> Column:
    """Trim all white space at both ends."""
    return F.regexp_replace(F.regexp_replace(text, rf"\A[{WS}]+", ""), rf"[{WS}]+\z", "")


def squeeze(text: Column) -> Column:
    """One space for each run of white space, none at the ends."""
    return F.btrim(F.regexp_replace(text, rf"[{WS}]+", " "), F.lit(" "))


def blank_to_null(text: Column) -> Column:
    """Trimmed text, null if nothing is left."""
    return F.nullif(strip(text), F.lit(""))


def clean_metadata(text: Column) -> Column:
    """Trimmed, with the placeholders for nothing turned into null."""
    trimmed = strip(text)
    return F.when(F.lower(trimmed).isin("", "none", "null"), F.lit(None)).otherwise(trimmed)


def hyphenated(text: Column, longest: int = 80) -> Column:
    """Letters and digits of any script, '-' and '_'; everything else becomes one '-', none at the ends."""
    name = F.btrim(F.regexp_replace(F.regexp_replace(strip(text), rf"[^\p{{L}}\p{{N}}{LATER}_-]", "-"), "-+", "-"), F.lit(" .-"))
    name = F.rtrim(F.substring(name, 1, longest), F.lit(" .-"))
    return F.when(name == "", F.lit("book")).otherwise(name)


def slug(text: Column, longest: int = 80) -> Column:
    """A hyphenated text as a file name that every system allows."""
    name = hyphenated(text, longest)
    return F.when(F.upper(name).isin(RESERVED), F.concat(F.lit("book-"), name)).otherwise(name)


def strip_fence(text: Column) -> Column:
    """The inside of a text that is one Markdown fence; other texts only trimmed."""
    trimmed = strip(text)
    fence = r"(?is)\A```(?:markdown|md)?\s*\n?(.*?)\n?```\z"
    return F.when(trimmed.rlike(fence), strip(F.regexp_extract(trimmed, fence, 1))).otherwise(trimmed)


def without_front_matter(text: Column) -> Column:
    """The text after a leading ``---`` block."""
    return F.regexp_replace(text, r"(?s)\A---\n.*?\n---\n", "")


def heading(text: Column) -> Column:
    """Title of a Markdown heading on the first line, else null."""
    line = F.substring_index(text, "\n", 1)
    pattern = rf"\A#{{1,6}}[{WS}]+(.+)\z"
    return F.when(line.rlike(pattern), strip(F.regexp_extract(line, pattern, 1)))


def heading_level(text: Column) -> Column:
    line = F.substring_index(text, "\n", 1)
    return F.when(heading(text).isNotNull(), F.length(F.regexp_extract(line, r"\A(#{1,6})", 1)))


def edge_key(text: Column) -> Column:
    """What a header or footer line is compared by: no number at its ends, one case, single spaces.

    Lower case stands for case folding; they differ for a few letters such as the German sharp s.
    """
    lower = F.lower(squeeze(text))
    bare = F.regexp_replace(lower, rf"\A[^{WORD}]*\p{{Nd}}+[^{WORD}]*", "")
    return squeeze(F.regexp_replace(bare, rf"[^{WORD}]*\p{{Nd}}+[^{WORD}]*\z", ""))


def is_rtl(text: Column) -> Column:
    """More letters of right-to-left scripts than of a-z."""
    return count_matches(text, r"[\x{590}-\x{8ff}]") > count_matches(text, "[a-zA-Z]")


def json_quoted(text: Column) -> Column:
    """A JSON string literal, good as a YAML scalar; ``null`` for null."""
    literal = F.regexp_replace(F.to_json(F.struct(text.alias("v"))), r"(?s)\A\{\"v\":(.*)\}\z", "$1")
    return F.when(text.isNull(), "null").otherwise(literal)


def without_tags(text: Column, tag: str) -> Column:
    """Opening and closing ``tag`` removed, in any case."""
    return F.regexp_replace(text, rf"(?i)</?{tag}>", "")


def relative_path(path: Column, root: str) -> Column:
    """POSIX path below ``root``; other paths as they are."""
    posix = F.replace(path, F.lit("\\"), F.lit("/"))
    top = root.rstrip("/") + "/"
    return F.when(posix.startswith(top), F.substring(posix, len(top) + 1, 1 << 30)).otherwise(posix)


def lookup_terms(text: Column) -> Column:
    """Folded letters-and-digits tokens of an indexed text: lower case, marks dropped from Latin letters."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")
