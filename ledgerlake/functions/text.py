"""Text functions over built-in expressions only, so they stay inside generated code."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, functions as F

# Every character Python's str.strip() removes.
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())

# Every word delimiter but the space, as a regular expression. ASCII ranges: all punctuation but
# apostrophe, equals sign and backquote.
_WORD_BREAK = (
    r"([!-&(-/:-<>-@\[-_{-~\t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000])"
)

# Marks an inserted word break. Text that holds the first one takes the second, a Unicode
# noncharacter, which takes initcap's slower way for text beyond ASCII.
_BREAK, _RARE_BREAK = "\x01 ", "\ufdd0 "

_HANGUL_FIRST, _HANGUL_LAST = 0xAC00, 0xD7A3


def trim_ws(c: Column) -> Column:
    """Strip every kind of Unicode whitespace; Spark's plain trim strips spaces only."""
    return F.trim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    return F.when(trim_ws(c) != "", c)


@lru_cache(maxsize=1)
def _fold_table() -> tuple[str, str]:
    """Arguments for ``translate``: characters that decompose to one other character, then marks.

    The marks have no counterpart in the second string, so translate deletes them.
    """
    source, target, marks = [], [], []
    for code in range(sys.maxunicode + 1):
        if 0xD800 <= code <= 0xDFFF or _HANGUL_FIRST <= code <= _HANGUL_LAST:
            continue
        ch = chr(code)
        if unicodedata.category(ch).startswith("M"):
            marks.append(ch)
            continue
        if not unicodedata.decomposition(ch) or unicodedata.decomposition(ch).startswith("<"):
            continue
        bare = "".join(
            p for p in unicodedata.normalize("NFD", ch) if not unicodedata.category(p).startswith("M")
        )
        source.append(ch)
        target.append(bare)
    return "".join(source + marks), "".join(target)


def _decompose_hangul(c: Column) -> Column:
    """Write precomposed syllables as their letters, by the arithmetic of the Unicode standard."""
    def letter(code: Column) -> Column:
        return F.decode(F.unhex(F.lpad(F.hex(code.cast("long")), 4, "0")), "UTF-16BE")

    def one(ch: Column) -> Column:
        index = F.conv(F.hex(F.encode(ch, "UTF-16BE")), 16, 10).cast("int") - _HANGUL_FIRST
        tail = index % 28
        return F.when(
            ch.between(chr(_HANGUL_FIRST), chr(_HANGUL_LAST)),
            F.concat(
                letter(F.floor(index / 588) + 0x1100),
                letter(F.floor((index % 588) / 28) + 0x1161),
                F.when(tail > 0, letter(tail + 0x11A7)).otherwise(""),
            ),
        ).otherwise(ch)

    return F.when(
        c.rlike(f"[{chr(_HANGUL_FIRST)}-{chr(_HANGUL_LAST)}]"),
        F.array_join(F.transform(F.split(c, ""), one), ""),
    ).otherwise(c)


def fold(c: Column, hangul: bool = False) -> Column:
    """Upper-case and drop accents: canonical decomposition without its marks.

    Pure ASCII text, the common case, only pays for ``upper``. ``hangul`` also decomposes Korean
    syllables, which matters only when a keyword to be searched for holds Korean letters.
    """
    upper = F.upper(c)
    source, target = _fold_table()
    wide = _decompose_hangul(upper) if hangul else upper
    folded = F.translate(wide, source, target)
    return F.when(F.octet_length(c) == F.char_length(c), upper).otherwise(folded)


def capitalize(c: Column) -> Column:
    """First character upper, the rest lower; unlike initcap it ignores later words."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(c.substr(F.lit(2), F.length(c))))


def initcap_words(c: Column) -> Column:
    """INITCAP that also starts a word after punctuation and any whitespace.

    The native ``initcap`` breaks words at spaces only, so a break is inserted behind every other
    delimiter before it and taken out after it.
    """
    def titled(mark: str) -> Column:
        marked = F.regexp_replace(c, _WORD_BREAK, f"$1{mark}")
        return F.replace(F.initcap(marked), F.lit(mark), F.lit(""))

    return F.when(c.contains(_BREAK[0]), titled(_RARE_BREAK)).otherwise(titled(_BREAK))


def split_packed(c: Column, index: int, sep: str = "|") -> Column:
    """The index-th part of a packed string, NULL when there is none."""
    return F.get(F.split(c, f"[{sep}]"), index)


def strip_fences(c: Column) -> Column:
    """Drop Markdown code fences around a CSV answer, then surrounding whitespace."""
    return trim_ws(F.replace(F.replace(c, F.lit("```csv"), F.lit("")), F.lit("```"), F.lit("")))


def path_parts(c: Column) -> tuple[Column, Column, Column]:
    """File name, stem and lower-cased suffix (with its dot, or empty) of a path."""
    name = F.regexp_extract(c, r"([^/]*)$", 1)
    suffix = F.regexp_extract(name, r"[^.](\.[^.]+)$", 1)
    stem = name.substr(F.lit(1), F.length(name) - F.length(suffix))
    return name, stem, F.lower(suffix)
