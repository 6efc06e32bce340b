"""Amount parsing and the two-decimal text used in identities."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import trim_ws

_DIGITS = r"\d++(?:_\d++)*+"
# What a plain float literal looks like; keeps out the suffixes, 'nan' and 'inf' a cast would take.
_FLOAT = rf"^[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?\d++)?\z"
# The same without digit separators, as SQL writes numbers.
_SQL_FLOAT = r"^[+-]?(?:\d++\.?\d*+|\.\d++)(?:[eE][+-]?\d++)?\z"


def _finite(text: Column, shape: str) -> Column:
    value = F.when(text.rlike(shape), F.replace(text, F.lit("_"), F.lit("")).try_cast("double"))
    return F.when(F.abs(value) < float("inf"), value)


def parse_number(c: Column) -> Column:
    """Text to double, NULL when it is not a finite decimal number."""
    return _finite(trim_ws(c), _FLOAT)


def sql_number(c: Column) -> Column:
    """Text to double as SQL literals are written; NULL for anything else and for what is not finite."""
    return _finite(F.trim(c), _SQL_FLOAT)


def parse_amount(c: Column, locale: str = "auto") -> Column:
    """Amount text to double.

    ``auto``: a comma is the decimal point and dots beside it are thousands marks; a dot without a
    comma is the decimal point. ``us`` reads commas as thousands marks.
    """
    if locale == "us":
        return parse_number(F.replace(c, F.lit(","), F.lit("")))
    if locale != "auto":
        raise ValueError(f"unknown locale {locale!r}")
    # Translate turns the comma into a dot and, having no counterpart, deletes the dots.
    return parse_number(F.when(c.contains(","), F.translate(c, ",.", ".")).otherwise(c))


def exact_cents_text(c: Column) -> Column:
    """``%.2f`` of a double rounded by its exact binary value, ties to even, as C and Python do.

    ``format_string`` would round the shortest decimal text half up instead: 0.125 to 0.13, and
    2.675, which is stored slightly below, to 2.68.
    """
    return F.call_function("format_number", c, F.lit("0.00"))
