"""Text scalars as column expressions; none leaves the JVM."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..profile import DEFAULT, Profile

#: The line ends of str.splitlines.
LINE_END = "\r\n|[\n\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x85\\u2028\\u2029]"
#: White space that str.strip and str.split know.
BLANK = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


#: The same characters, for trimming without a pattern.
_BLANKS = "".join(chr(i) for i in (*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(_BLANKS))


def clean_text(raw: Column, profile: Profile = DEFAULT) -> Column:
    """Lines trimmed and their runs of spaces collapsed, boilerplate lines dropped, at most one blank line in a row.
    Null is empty."""
    drop = "(?iu)^(" + "|".join(profile.boilerplate) + ")"
    lines = F.transform(F.split(F.regexp_replace(F.coalesce(raw, F.lit("")), " {2,}", " "), LINE_END), strip)
    kept = F.filter(lines, lambda x: ~x.rlike(drop))
    return strip(F.regexp_replace(F.array_join(kept, "\n"), "\n{3,}", "\n\n"))


def char_count(c: Column) -> Column:
    return F.length(F.coalesce(c, F.lit("")))


def split_words(c: Column) -> Column:
    return F.filter(F.split(F.coalesce(c, F.lit("")), f"{BLANK}+"), lambda x: x != "")


def word_count(c: Column) -> Column:
    return F.size(split_words(c))


def non_ascii_ratio(c: Column, places: int = 4) -> Column:
    n = F.length(c)
    return F.when(n > 0, F.round(F.length(F.regexp_replace(c, "[\\x00-\\x7F]", "")) / n, places)).otherwise(F.lit(0.0))


@lru_cache
def _accents() -> tuple[str, str]:
    """Characters that NFD turns into one base character and marks, their bases, and the marks that simply go."""
    single, base, marks = [], [], []
    for i in range(sys.maxunicode + 1):
        c = chr(i)
        if 0xD800 <= i < 0xE000 or i < 128:
            continue
        if unicodedata.category(c) == "Mn":
            marks.append(c)
            continue
        rest = [x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn"]
        if len(rest) == 1 and rest[0] != c:
            single.append(c)
            base.append(rest[0])
    return "".join(single + marks), "".join(base)


def strip_accents(c: Column) -> Column:
    """Marks dropped as after NFD, by one table; Hangul, which NFD takes apart, stays composed."""
    return F.translate(c, *_accents())


def content_signals(c: Column, words: Column, hits: Column, profile: Profile = DEFAULT) -> dict[str, Column]:
    lines = F.filter(F.transform(F.split(c, "\n"), word_count), lambda n: (n >= 1) & (n <= profile.short_line_words))
    long = F.exists(F.split(c, f"[.!?]{BLANK}+"), lambda s: word_count(s) >= profile.long_sentence_words)
    return {"signal_many_short_lines": F.size(lines) > profile.many_lines, "signal_no_long_sentence": ~long, "signal_large_low_flood": (words > profile.large_words) & (hits < 3)}


def truncated(c: Column, enders: str = "\"')\uff09\u203a\u00bb\u2026?!.\uff1f\uff01\u3002", profile: Profile = DEFAULT) -> Column:
    """Of some length, and without the end of a sentence at the end."""
    t = strip(F.coalesce(c, F.lit("")))
    return (F.length(t) >= profile.min_chars) & ~F.right(t, F.lit(1)).isin(list(enders))


def flatten(c: Column) -> Column:
    """Paragraph breaks as ' || ', line ends as spaces."""
    t = F.regexp_replace(F.coalesce(c, F.lit("")), "\n{2,}", " || ")
    return strip(F.regexp_replace(F.replace(t, F.lit("\n"), F.lit(" ")), " {2,}", " "))


def sanitize(c: Column, profile: Profile = DEFAULT) -> Column:
    """For a CSV cell: controls and scripts beyond Latin, Greek and Cyrillic go, double quotes become apostrophes. Line
    ends are among what goes, so the words around them join."""
    t = F.regexp_replace(F.coalesce(c, F.lit("")), "[^\\x09\\x20-\\x7e\\u00a0-\\u00ac\\u00ae-\\u024f\\u0370-\\u03ff\\u0400-\\u04ff]", "")
    t = F.regexp_replace(F.translate(t, '"\t', "' "), " {2,}", " ")
    return F.left(strip(t), F.lit(profile.sanitize_chars))


def snippet(c: Column, profile: Profile = DEFAULT) -> Column:
    t = strip(F.regexp_replace(F.coalesce(c, F.lit("")), f"{BLANK}+", " "))
    return F.when(F.length(t) > profile.snippet_chars, F.concat(F.left(t, F.lit(profile.snippet_chars)), F.lit("…"))).otherwise(t)


def model_input(title: Column, body: Column, profile: Profile = DEFAULT) -> Column:
    head = F.array_join(F.slice(split_words(body), 1, profile.model_words), " ")
    return F.left(F.concat(F.coalesce(title, F.lit("")), F.lit(" [SEP] "), head), F.lit(profile.model_chars))


def text_hash(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit("")) != "", F.sha2(c, 256)).otherwise("")


def _quoted(term: str) -> str:
    return "".join(x if x.isalnum() or x in "_ " or ord(x) > 127 else "\\" + x for x in term)


def term_pattern(term: str) -> str:
    """ASCII terms as whole words; others between white space and the usual punctuation."""
    if term.isascii():
        return rf"(?iuU)\b{_quoted(term)}\b"
    edge = r"[^\s.,;:!?\-()\[\]]"
    return rf"(?U)(?<!{edge}){_quoted(term)}(?!{edge})"


def pattern_of(term: Column) -> Column:
    """term_pattern() of a column."""
    quoted = F.concat(F.lit("\\Q"), F.replace(term, F.lit("\\E"), F.lit("")), F.lit("\\E"))
    edge = r"[^\s.,;:!?\-()\[\]]"
    plain = F.concat(F.lit(r"(?iuU)\b"), quoted, F.lit(r"\b"))
    return F.when(term.rlike("^[\\x00-\\x7F]*$"), plain).otherwise(F.concat(F.lit(rf"(?U)(?<!{edge})"), quoted, F.lit(rf"(?!{edge})")))


def has_term(c: Column, term: Column, pattern: Column) -> Column:
    """A plain search first: it spares most of the pattern matching."""
    return F.contains(c, term) & F.regexp_like(c, pattern)
